"""Message source side (SRC-5, FN-8 .. FN-12, T18/T19 dedup).

A topic delivers one page (JSON array of count records) per message. The
same decode runs on a live Kafka stream, a Kafka batch read, or any frame
with the Kafka columns ``key, value, topic, partition, offset``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.messages import decode_page, page_rows, provenance_key, strict_page
from ..schemas import DEFAULT_TOPIC
from .counts import normalize_counts

PROVENANCE = ["topic", "partition", "offset"]


def kafka_options(bootstrap_servers: str, topic: str = DEFAULT_TOPIC, starting: str = "earliest",
                  max_offsets_per_trigger: int | None = None, **extra) -> dict:
    """Options for ``readStream.format('kafka')`` (STR-2 start position, STR-4 throttle)."""
    if starting not in ("earliest", "latest") and not starting.startswith("{"):
        raise ValueError("starting must be 'earliest', 'latest' or a JSON offset spec")
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",  # lost offsets stop the query instead of being skipped
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_topic(spark: SparkSession, options: dict, stream: bool = True) -> DataFrame:
    """Kafka source (needs the Kafka connector on the classpath)."""
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load()


def decode_pages(messages: DataFrame, normalize: bool = True, malformed: str = "raise") -> DataFrame:
    """Kafka-shaped rows -> one row per count record, with provenance.

    Output: the canonical count columns (``normalize=True``) or the raw text
    fields, plus whichever of ``topic, partition, offset`` the input has and,
    when all three exist, ``message_id`` (``topic-partition-offset``).

    A page that is no JSON array of records fails the query; with
    ``malformed="reject"`` it is left out here and given by ``page_rejects``.
    """
    if malformed not in ("raise", "reject"):
        raise ValueError("malformed must be 'raise' or 'reject'")
    prov = [c for c in PROVENANCE if c in messages.columns]
    page = strict_page("value") if malformed == "raise" else decode_page("value")
    records = page_rows(messages, page, *prov)
    if normalize:
        records = normalize_counts(records, keep=prov)
    if len(prov) == 3:
        records = records.withColumn("message_id", provenance_key(*prov))
    return records


def page_rejects(messages: DataFrame) -> DataFrame:
    """Messages whose page cannot be decoded: provenance and the value as text."""
    prov = [c for c in PROVENANCE if c in messages.columns]
    return messages.filter(decode_page("value").isNull()).select(*prov, F.col("value").cast("string").alias("value"))


def dedup_messages(messages: DataFrame) -> DataFrame:
    """Drop re-delivered messages: same topic/partition/offset (T18).

    On a stream this is stateful ``dropDuplicates``; its state grows with the
    number of messages unless a watermark bounds it (see streaming).
    """
    return messages.dropDuplicates(PROVENANCE)


def record_identity(records: DataFrame, key: str = "id") -> list[Column]:
    """What makes two rows the same record: the id alone, whatever its day.

    A record without an id is only the same as one with equal values in every
    column, provenance included (a re-delivered message).
    """
    rest = F.to_json(F.struct(*records.columns))
    return [F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_same_id"),
            F.when(F.col(key).isNull(), rest).otherwise(F.lit("")).alias("_same_row")]


def dedup_records(records: DataFrame, key: str = "id") -> DataFrame:
    """One row per record id, batch side (T19: overlapping pages).

    Keeps the copy from the earliest message (smallest topic, partition,
    offset; then the smallest full row) with ``min`` in a grouped
    aggregation: partial aggregation keeps one candidate per id per task, so a
    hot id costs no more than any other and the choice is deterministic.
    Records without an id are kept, except full copies (``record_identity``).
    """
    return identified_records(records, key).select(*records.columns)


def identified_records(records: DataFrame, key: str = "id") -> DataFrame:
    """``dedup_records`` with the columns of ``record_identity``, by which its rows stay partitioned.

    A join on these columns needs no further shuffle. Each column is shuffled
    once: the struct that ranks the copies is also the row that is kept.
    """
    prov = [c for c in PROVENANCE if c in records.columns]
    ranked = prov + [c for c in records.columns if c not in (*prov, key)] + [key]
    marked = records.select(F.struct(*ranked).alias("_r"), *record_identity(records, key))
    best = marked.groupBy("_same_id", "_same_row").agg(F.min("_r").alias("_r"))
    return best.select(*[F.col(f"_r.{c}").alias(c) for c in records.columns], "_same_id", "_same_row")

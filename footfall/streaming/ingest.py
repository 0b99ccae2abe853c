"""Structured Streaming ingest (STR-1..7, SNK-5).

message stream (Kafka, or a file inbox of Kafka-shaped rows)
  -> decode pages -> typed count records
  -> per micro-batch (``foreachBatch``):
       dedup by id inside the batch (``min`` aggregation: skew-safe,
       deterministic: the copy from the earliest message wins)
       -> left-anti join with the ids of the landing table
       -> append to the landing table (parquet, partitioned by day)

One rule says what the same record is, in both modes and for any day: equal
ids. A record without an id is only the same as a re-delivery of itself, i.e.
equal in every column, provenance included (``record_identity``).

The landing table itself is the dedup memory: a re-run of a micro-batch after
a failure finds its rows already landed and appends nothing (idempotent). The
anti-join reads one column of that table per micro-batch, so take few, large
batches. The query checkpoint makes a restart resume where it stopped.

``mode="ledger"`` keeps that memory in a ledger of keys beside the table
(``ledger.KeyLedger``): a batch opens only the buckets and files that can hold
one of its ids, so its cost does not grow with what has landed.

``mode="state"`` keeps the seen ids in the query's state store instead
(``dropDuplicates`` on the provenance key and the record, optionally bounded
by a watermark): look-ups by key, for tables too large to scan a column of
per batch (with the RocksDB state store), and for sinks that are not tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..schemas import COUNTS_SCHEMA
from ..session import delete_path
from ..sources.messages import PROVENANCE, decode_pages, dedup_records, identified_records, page_rejects, record_identity
from .landing import LandingLog
from .ledger import BUCKETS, SAME, KeyLedger, with_keys

# File-inbox form of a Kafka record (value as UTF-8 text).
MESSAGE_FILE_SCHEMA = StructType([
    StructField("key", StringType(), True),
    StructField("value", StringType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
])

LANDED_SCHEMA = StructType(COUNTS_SCHEMA.fields + [
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("message_id", StringType(), True),
])
LANDED_COLUMNS = [f.name for f in LANDED_SCHEMA.fields]

LANDING_PARTITIONS = ["year", "month", "mdate"]


def read_message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of Kafka-shaped rows from JSON-lines files (stand-in topic)."""
    r = spark.readStream.schema(MESSAGE_FILE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.json(path)


def trigger_args(trigger: str | None) -> dict:
    """'availableNow' | 'once' | a processing-time interval like '1 hour' (STR-5)."""
    if trigger in (None, "availableNow"):
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def dedup_stream(records: DataFrame, key: str = "id", watermark: str | None = None,
                 time_col: str = "date_time") -> DataFrame:
    """Stateful streaming dedup by record (``record_identity``): unbounded, or bounded by a watermark."""
    marked = records.select("*", *record_identity(records, key))
    if watermark:
        marked = marked.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(SAME)
    else:
        marked = marked.dropDuplicates(SAME)
    return marked.drop(*SAME)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join on keys that may be null."""
    return left.join(right, reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys]), how)


HIVE_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_touched(spark: SparkSession, path: str, schema: StructType, keys: list[str],
                 values: list[tuple]) -> DataFrame:
    """Rows of a partitioned parquet table in the given partitions only.

    One Hadoop glob over the touched values of each partition column
    (``year={2024}/month={01}/mdate={1,2}``) limits directory listing to
    those folders, so the cost does not grow with the number of partitions
    the table holds; the exact (year, month, day) filter is applied on top.
    A glob that matches nothing yet (new partitions) reads as empty.
    """
    def text(v):
        return HIVE_NULL_PARTITION if v is None else str(v)

    levels = [sorted({text(v[i]) for v in values}) for i in range(len(keys))]
    glob = path.rstrip("/") + "/" + "/".join(
        f"{k}={{{','.join(vals)}}}" for k, vals in zip(keys, levels))
    try:
        df = spark.read.schema(schema).option("basePath", path).parquet(glob)
    except AnalysisException as e:
        cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
        if cond is not None and cond() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
    types = StructType([schema[k] for k in keys])
    # A row per touched partition, from a list already on the driver.
    return null_safe(df, F.broadcast(spark.createDataFrame(values, types)), keys, "left_semi")


def compact_partitions(spark: SparkSession, path: str, schema: StructType, keys: list[str],
                       values: list[tuple], target: str) -> None:
    """Copy the given partitions of a table into another one, about one file each.

    Streaming appends leave one file per partition per micro-batch; this
    maintenance step keeps a compact copy for batch readers at ``target``, whose
    listed partitions are overwritten. The table itself is not rewritten:
    a stream reads its files by path and would take rewritten ones as new rows.
    """
    if target.rstrip("/") == path.rstrip("/"):
        raise ValueError("a table that streams read must not be rewritten: give another target")
    if not values:
        return
    rows = read_touched(spark, path, schema, keys, values)
    (rows.hint("rebalance", *keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(target))


def ensure_table(spark: SparkSession, path: str, schema: StructType, partition_by: list[str]) -> None:
    """Make sure a (possibly empty) partitioned parquet table exists at ``path``.

    Appending an empty frame creates the folder when missing and adds no
    rows when the table exists, so it is safe to run on every start.
    """
    spark.createDataFrame([], schema).write.mode("append").partitionBy(*partition_by).parquet(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back: a lineage cut in the shared
    folder that survives executor loss and, unlike a cached plan, lets AQE
    size the partitions (a small micro-batch becomes a few files, not one
    task per shuffle partition)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def land_new_records(records: DataFrame, landing_path: str, key: str = "id") -> None:
    """Append the records of ``records`` not yet in the landing table (batch).

    One job: dedup inside the batch, anti-join with what has landed (the id
    column alone, and whole rows only where the id is null), append.
    """
    spark = records.sparkSession
    batch = identified_records(records.select(*LANDED_COLUMNS), key)
    landed = spark.read.schema(LANDED_SCHEMA).parquet(landing_path).select(*LANDED_COLUMNS)
    ids = landed.filter(F.col(key).isNotNull()).select(F.col(key).alias("_same_id"), F.lit("").alias("_same_row"))
    nameless = landed.filter(F.col(key).isNull())
    nameless = nameless.select(*record_identity(nameless, key))
    fresh = batch.join(ids.unionByName(nameless), on=SAME, how="left_anti")
    # Rebalance on the partition columns: about one file per day, while
    # AQE still splits a day that holds most of the batch.
    (fresh.select(*LANDED_COLUMNS).hint("rebalance", *LANDING_PARTITIONS)
     .write.mode("append").partitionBy(*LANDING_PARTITIONS).parquet(landing_path))


def land_through_ledger(records: DataFrame, landing_path: str, ledger: KeyLedger, writer: str, batch_id: int, staging: str, key: str = "id") -> None:
    """``land_new_records`` with the ledger as memory: cost follows the batch, not the landing table."""
    spark = records.sparkSession
    root = f"{staging.rstrip('/')}/batch={batch_id}"
    batch = dedup_records(records.select(*LANDED_COLUMNS), key)
    keyed = stage(with_keys(batch, record_identity(batch, key), ledger.state().buckets), root)

    def append(fresh: DataFrame) -> None:
        (fresh.select(*LANDED_COLUMNS).hint("rebalance", *LANDING_PARTITIONS)
         .write.mode("append").partitionBy(*LANDING_PARTITIONS).parquet(landing_path))

    def landed(fresh: DataFrame) -> DataFrame:
        days = [tuple(r) for r in fresh.select(*LANDING_PARTITIONS).distinct().collect()]
        rows = read_touched(spark, landing_path, LANDED_SCHEMA, LANDING_PARTITIONS, days).select(*LANDED_COLUMNS)
        return rows.select(*record_identity(rows, key))

    ledger.land(keyed, writer, batch_id, append, landed)
    delete_path(spark, root)


def ingest(messages: DataFrame, landing_path: str, checkpoint: str,
           trigger: str | None = "availableNow", mode: str = "table",
           watermark: str | None = None, rejects_path: str | None = None,
           ledger_path: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """messages -> decode -> dedup -> landing table (parquet, by day).

    ``mode="table"`` looks ids up in the landing table itself, ``"ledger"`` in a
    ledger beside it (``ledger_path``, default ``<landing_path>_ledger``), which
    a landing table must have had from its first batch on; ``"state"`` in the
    query's state store. A malformed page stops the query, unless
    ``rejects_path`` (not in mode "state") names a folder that gets such
    messages, one sub-folder per micro-batch.
    """
    spark = messages.sparkSession
    if mode == "state":
        if rejects_path is not None:
            raise ValueError("rejects_path needs mode='table' or 'ledger'")
        # Message-level dedup must precede decoding: after it, one message is many rows.
        deduped = dedup_stream(decode_pages(messages.dropDuplicates(PROVENANCE)), "id", watermark)
        return (deduped.select(*LANDED_COLUMNS).writeStream.format("parquet")
                .option("path", landing_path).option("checkpointLocation", checkpoint)
                .partitionBy(*LANDING_PARTITIONS).outputMode("append")
                .trigger(**trigger_args(trigger)).start())
    if mode not in ("table", "ledger"):
        raise ValueError("mode must be 'table', 'ledger' or 'state'")
    ensure_table(spark, landing_path, LANDED_SCHEMA, LANDING_PARTITIONS)
    ledger = KeyLedger(spark, ledger_path or f"{landing_path.rstrip('/')}_ledger", buckets)

    def put(records: DataFrame, batch_id: int) -> None:
        if mode == "ledger":
            land_through_ledger(records, landing_path, ledger, checkpoint, batch_id, f"{checkpoint.rstrip('/')}/staging")
        else:
            land_new_records(records, landing_path)

    def land(batch: DataFrame, batch_id: int) -> None:
        if rejects_path is None:
            put(decode_pages(batch), batch_id)
            return
        put(decode_pages(batch, malformed="reject"), batch_id)
        page_rejects(batch).write.mode("overwrite").json(f"{rejects_path.rstrip('/')}/batch={batch_id}")

    return (messages.writeStream
            .option("checkpointLocation", checkpoint)
            .foreachBatch(land)
            .trigger(**trigger_args(trigger))
            .start())


def landing_log(spark: SparkSession, path: str) -> LandingLog:
    """The landing table with a record a batch (``landing.LandingLog``)."""
    return LandingLog(spark, path, LANDED_SCHEMA, LANDING_PARTITIONS)


def ingest_to_log(messages: DataFrame, log_path: str, checkpoint: str, trigger: str | None = "availableNow",
                  ledger_path: str | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """messages -> decode -> look-up in the key ledger -> landing log.

    A batch lands by its record and is entered in the ledger after. If it is
    broken off in between, the re-run finds the record and only enters the keys.
    """
    spark = messages.sparkSession
    log, ledger = landing_log(spark, log_path), KeyLedger(spark, ledger_path or f"{log_path.rstrip('/')}_ledger", buckets)

    def land(batch: DataFrame, batch_id: int) -> None:
        root = f"{checkpoint.rstrip('/')}/staging/batch={batch_id}"
        records = dedup_records(decode_pages(batch).select(*LANDED_COLUMNS))
        keyed = stage(with_keys(records, record_identity(records), ledger.state().buckets), root)
        nothing = spark.createDataFrame([], StructType([StructField(c, StringType(), True) for c in SAME]))
        ledger.land(keyed, checkpoint, batch_id, lambda fresh: log.append(fresh.select(*LANDED_COLUMNS), checkpoint, batch_id), lambda fresh: nothing)
        delete_path(spark, root)

    return messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land).trigger(**trigger_args(trigger)).start()


def landing_stream(spark: SparkSession, landing_path: str, schema: StructType = LANDED_SCHEMA,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Read the landing table incrementally (STR-7 hand-off to aggregates).

    The table is append-only: see ``compact_partitions``.
    """
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(landing_path)

"""Message sink side (SNK-6): count records -> pages -> Kafka-shaped rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.messages import encode_utf8, record_json
from ..schemas import COUNT_JSON_COLUMNS, DEFAULT_TOPIC



def to_feed_records(counts: DataFrame) -> DataFrame:
    """Canonical counts -> the feed's text record shape (inverse of normalize)."""
    from ..functions.time import format_date_time

    def text(c):
        return F.col(c).cast("string")

    month_name = F.date_format(F.try_to_timestamp(F.col("month"), F.lit("MM")), "MMMM")
    return counts.select(
        format_date_time("date_time").alias("date_time"),
        text("day").alias("day"),
        text("hourly_counts").alias("hourly_counts"),
        text("id").alias("id"),
        text("mdate").alias("mdate"),
        month_name.alias("month"),
        text("sensor_id").alias("sensor_id"),
        text("sensor_name").alias("sensor_name"),
        text("time").alias("time"),
        text("year").alias("year"),
    )


def _page(records: list[str], pretty: bool) -> str:
    """Object texts as one JSON array text."""
    return "[ " + ", ".join(records) + " ]" if pretty else "[" + ",".join(records) + "]"


def _pages(batches: Iterator[pa.RecordBatch], page_size: int, pretty: bool) -> Iterator[pa.RecordBatch]:
    """Runs of ``page_size`` object texts of a partition as pages, numbered within it."""
    first, number, held = TaskContext.get().partitionId() << 33, 0, []

    def out(full: list[list[str]]) -> pa.RecordBatch:
        nonlocal number
        keys = [str(first + number + i) for i in range(len(full))]
        number += len(full)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array([_page(p, pretty) for p in full])], names=["key", "value"])

    for batch in batches:
        held += batch.column(0).to_pylist()
        whole = len(held) - len(held) % page_size
        if whole:
            yield out([held[i: i + page_size] for i in range(0, whole, page_size)])
            held = held[whole:]
    if held:
        yield out([held])


def encode_pages(records: DataFrame, page_size: int = 1000, topic: str = DEFAULT_TOPIC,
                 pretty: bool = False) -> DataFrame:
    """Feed records as pages of at most ``page_size``, each one message: key, value (UTF-8 JSON array), topic.

    Pages are runs of rows of one partition, so no record is shuffled and a
    page never exceeds ``page_size`` however the data is skewed. Records are
    encoded by the JVM and sorted inside their partition first: what a
    partition holds is the same on a retry, its order need not be, so a task
    that runs again makes the same pages under the same keys.
    """
    cols = [c for c in COUNT_JSON_COLUMNS if c in records.columns]
    encoded = records.select(record_json(*cols, pretty=pretty).alias("record")).sortWithinPartitions("record")
    pages = encoded.mapInArrow(lambda batches: _pages(batches, page_size, pretty), "key string, value string")
    return pages.select(encode_utf8("key").alias("key"), encode_utf8("value").alias("value"), F.lit(topic).alias("topic"))


def kafka_sink_options(bootstrap_servers: str, topic: str = DEFAULT_TOPIC, **extra) -> dict:
    """Options for ``df.write.format('kafka')`` / ``writeStream.format('kafka')``."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def publish(messages: DataFrame, options: dict) -> None:
    """Send encoded pages to a topic (needs the Kafka connector on the classpath)."""
    messages.select("key", "value").write.format("kafka").options(**options).save()

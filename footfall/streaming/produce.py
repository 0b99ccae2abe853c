"""Producer side as a stream (SRC-6 -> SNK-6, STR-1/5).

The poller's loop — fetch the next pages, send each page as one message —
becomes a streaming query: a record stream (typically the ``paged``
source) is re-paged in every micro-batch and written as Kafka-shaped rows,
either to a topic or to a file inbox with the same columns. Delivery is
at-least-once, like the topic itself: a re-run micro-batch may send its
pages again, which the consumer's dedup (by record id) absorbs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.messages import DEFAULT_TOPIC, encode_pages
from .ingest import trigger_args

def _batch_messages(batch: DataFrame, batch_id: int, page_size: int, topic: str) -> DataFrame:
    """Pages of a micro-batch. In a file inbox the batch stands as partition and the
    page as offset, so no two messages share both; a topic gives its own."""
    pages = encode_pages(batch, page_size=page_size, topic=topic)
    return pages.select(
        "key", "value", "topic", F.lit(batch_id).cast("int").alias("partition"),
        F.col("key").cast("string").cast("bigint").alias("offset"))


def forward_pages(records: DataFrame, checkpoint: str, *, kafka: dict | None = None,
                  inbox: str | None = None, page_size: int = 1000, topic: str = DEFAULT_TOPIC,
                  trigger: str | None = "availableNow") -> StreamingQuery:
    """Send a stream of feed records as pages of at most ``page_size``.

    ``kafka``: options for ``write.format('kafka')`` (see
    ``sinks.messages.kafka_sink_options``); ``inbox``: a folder receiving
    the same rows as JSON lines (what ``ingest.read_message_files`` reads).
    """
    if (kafka is None) == (inbox is None):
        raise ValueError("give exactly one of kafka= or inbox=")

    def send(batch: DataFrame, batch_id: int) -> None:
        msgs = _batch_messages(batch, batch_id, page_size, topic)
        if kafka is not None:
            msgs.select("key", "value").write.format("kafka").options(**kafka).save()
        else:
            (msgs.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                         "topic", "partition", "offset")
             .write.mode("append").json(inbox))

    return (records.writeStream
            .option("checkpointLocation", checkpoint)
            .foreachBatch(send)
            .trigger(**trigger_args(trigger))
            .start())

"""Streaming queries over the ``events`` stand-in (STR-1..7, SNK-5).

Each query builds a message inbox from ``events`` (every page delivered
twice, in separate files, so duplicates span micro-batches), runs the
checkpointed streaming jobs to completion with ``availableNow`` and returns
the sink table as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_dir
from ..streaming import ingest as ing
from ..streaming import totals as tot
from ..streaming.ingest import LANDED_SCHEMA
from . import sql as S
from .io import EVENT_RECORDS_SQL, _event_messages, _records
from .registry import query
from ..operators.rank import top_n_per_period

TOP_SCHEMA = tot.top_schema("day")


def build_inbox(spark, sf_dir) -> str:
    """Write the events as message files twice: a first delivery and a replay."""
    msgs = _event_messages(spark, sf_dir).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset")
    inbox = shared_dir(spark, "inbox")
    # Staged, as each branch of the union would number its pages anew: encoded
    # once, a message has the same offset in both deliveries. They are in
    # separate files.
    msgs = ing.stage(msgs, shared_dir(spark, "messages"))
    msgs.unionByName(msgs).write.json(inbox)
    return inbox


def run_ingest(spark, sf_dir) -> str:
    """inbox -> deduplicated landing table; returns the landing path."""
    inbox = build_inbox(spark, sf_dir)
    landing = shared_dir(spark, "landing")
    q = ing.ingest(ing.read_message_files(spark, inbox, max_files_per_trigger=4),
                   landing, shared_dir(spark, "ingest-ckpt"))
    q.awaitTermination()
    return landing


def run_totals(spark, sf_dir, with_top: bool):
    """landing (as a stream, several micro-batches) -> totals [+ top-10] tables."""
    landing = run_ingest(spark, sf_dir)
    totals, top = shared_dir(spark, "totals"), shared_dir(spark, "top10") if with_top else None
    counts = ing.landing_stream(spark, landing, LANDED_SCHEMA, max_files_per_trigger=32)
    q = tot.maintain_totals_and_top_n(counts, totals, shared_dir(spark, "totals-ckpt"), top_path=top)
    q.awaitTermination()
    return totals, top


@query("stream_ingest_dedup", EVENT_RECORDS_SQL)
def stream_ingest_dedup(spark, sf_dir):
    landing = run_ingest(spark, sf_dir)
    return _records(spark.read.schema(LANDED_SCHEMA).parquet(landing))


@query("stream_restart_replay", EVENT_RECORDS_SQL)
def stream_restart_replay(spark, sf_dir):
    """Ingest, stop; every message is delivered again; a restart from the same checkpoint adds nothing."""
    inbox = build_inbox(spark, sf_dir)
    landing, checkpoint = shared_dir(spark, "landing"), shared_dir(spark, "ingest-ckpt")
    ing.ingest(ing.read_message_files(spark, inbox), landing, checkpoint).awaitTermination()
    again = spark.read.schema(ing.MESSAGE_FILE_SCHEMA).json(inbox).dropDuplicates(["topic", "partition", "offset"])
    ing.stage(again, shared_dir(spark, "replay")).write.mode("append").json(inbox)
    ing.ingest(ing.read_message_files(spark, inbox), landing, checkpoint).awaitTermination()
    return _records(spark.read.schema(LANDED_SCHEMA).parquet(landing))


@query("stream_ingest_ledger", EVENT_RECORDS_SQL)
def stream_ingest_ledger(spark, sf_dir):
    """Ingest with the key ledger as memory, every message delivered twice in other micro-batches."""
    inbox, landing = build_inbox(spark, sf_dir), shared_dir(spark, "landing")
    q = ing.ingest(ing.read_message_files(spark, inbox, max_files_per_trigger=4), landing, shared_dir(spark, "ingest-ckpt"), mode="ledger", buckets=8)
    q.awaitTermination()
    return _records(spark.read.schema(LANDED_SCHEMA).parquet(landing))


DAY_EVENT_TOTALS = f"""
WITH e AS ({S.EVENT_RECORDS})
SELECT year, month, mdate, sensor_id, CAST(SUM(hourly_counts) AS BIGINT) AS hourly_counts
FROM e GROUP BY year, month, mdate, sensor_id
"""


@query("stream_running_sum", DAY_EVENT_TOTALS)
def stream_running_sum(spark, sf_dir):
    totals, _ = run_totals(spark, sf_dir, with_top=False)
    return tot.read_totals(spark, totals, "day")


@query("stream_top10", f"""
WITH t AS ({DAY_EVENT_TOTALS}),
r AS (SELECT *, row_number() OVER (PARTITION BY year, month, mdate
        ORDER BY hourly_counts DESC NULLS LAST, sensor_id ASC NULLS FIRST) AS rn FROM t)
SELECT year, month, mdate, sensor_id, hourly_counts FROM r WHERE rn <= 10
""")
def stream_top10(spark, sf_dir):
    _, top = run_totals(spark, sf_dir, with_top=True)
    return tot.read_top_n(spark, top, "day")


@query("stream_top10_per_month", f"""
WITH d AS ({DAY_EVENT_TOTALS}),
t AS (SELECT year, month, sensor_id, CAST(SUM(hourly_counts) AS BIGINT) AS hourly_counts
      FROM d GROUP BY year, month, sensor_id),
r AS (SELECT *, row_number() OVER (PARTITION BY year, month
        ORDER BY hourly_counts DESC NULLS LAST, sensor_id ASC NULLS FIRST) AS rn FROM t)
SELECT year, month, sensor_id, hourly_counts FROM r WHERE rn <= 10
""")
def stream_top10_per_month(spark, sf_dir):
    """Month ranking answered from the day totals the streaming job keeps."""
    totals, _ = run_totals(spark, sf_dir, with_top=False)
    return top_n_per_period(tot.read_totals(spark, totals, "day"), None, "month")


@query("stream_log_totals", DAY_EVENT_TOTALS)
def stream_log_totals(spark, sf_dir):
    """Messages -> landing log, compacted while a follower is half way -> day totals (STR-7)."""
    inbox, log = build_inbox(spark, sf_dir), ing.landing_log(spark, shared_dir(spark, "landing-log"))
    totals, checkpoint = shared_dir(spark, "totals"), shared_dir(spark, "follow-ckpt")
    ing.ingest_to_log(ing.read_message_files(spark, inbox, max_files_per_trigger=4), log.path, shared_dir(spark, "ingest-ckpt"), buckets=8).awaitTermination()
    log.compact(least=2)
    tot.follow_landing(log, totals, checkpoint, most=1)
    return tot.read_totals(spark, totals, "day")

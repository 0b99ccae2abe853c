"""Sources, sinks, message coding and scalar-function queries over the
stand-in tables (SRC-1..5/8, SNK-1/3/4/6, FN-1..12, T14/T18/T19).

Queries that write files use a fresh folder under the session's shared
checkpoint folder (``spark.checkpoint.dir``); see ``session.checkpoint_root``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import time as tf
from ..sinks.files import write_csv, write_pages_json
from ..sinks.messages import encode_pages, to_feed_records
from ..session import shared_dir
from ..sources import tables as tb
from ..sources.counts import read_counts_csv, read_counts_json, read_sensors, split_counts_csv, split_counts_json
from ..sources.messages import decode_pages, dedup_messages, dedup_records, page_rejects
from ..streaming.ingest import stage
from ..schemas import COUNT_CSV_COLUMNS, SENSOR_COLUMNS
from . import sql as S
from .registry import query

PAGE_SIZE = 500

# Columns compared after a trip through text: the feed's date_time text has
# second precision, so the oracle truncates to the second.
RECORD_COLUMNS = ["id", "date_time", "year", "month", "mdate", "day", "time",
                  "sensor_id", "sensor_name", "hourly_counts"]

EVENT_RECORDS_SQL = f"""
WITH e AS ({S.EVENT_RECORDS})
SELECT id, date_trunc('second', date_time) AS date_time, year, month, mdate,
       dayname(date_time) AS day, time, sensor_id, sensor_name, hourly_counts
FROM e
"""


def _records(df):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "date_time" else F.col(c)
                       for c in RECORD_COLUMNS])


def _event_messages(spark, sf_dir):
    """events -> feed records -> pages -> Kafka-shaped rows on partition 0."""
    records = to_feed_records(tb.event_counts(spark, sf_dir))
    pages = encode_pages(records, page_size=PAGE_SIZE)
    return pages.select("key", "value", "topic", F.lit(0).alias("partition"),
                        F.col("key").cast("string").cast("bigint").alias("offset"))


@query("json_roundtrip", EVENT_RECORDS_SQL)
def json_roundtrip(spark, sf_dir):
    """Encode every event into pages and decode them again (FN-8..10, FN-12)."""
    return _records(decode_pages(_event_messages(spark, sf_dir)))


@query("page_decode_replayed", EVENT_RECORDS_SQL)
def page_decode_replayed(spark, sf_dir):
    """Every message delivered twice (T18) -> dedup by provenance, then by id."""
    msgs = _event_messages(spark, sf_dir)
    replayed = msgs.unionByName(msgs)
    records = decode_pages(dedup_messages(replayed))
    return _records(dedup_records(records.drop("message_id", "topic", "partition", "offset")))


@query("csv_roundtrip", f"""
WITH s AS ({S.DAY_SENSORS})
SELECT sensor_id, sensor_description, sensor_name,
       CAST(NULL AS VARCHAR) AS installation_date, CAST(NULL AS VARCHAR) AS status,
       CAST(NULL AS VARCHAR) AS note, CAST(NULL AS VARCHAR) AS direction_1,
       CAST(NULL AS VARCHAR) AS direction_2, CAST(NULL AS VARCHAR) AS latitude,
       CAST(NULL AS VARCHAR) AS longitude,
       'nation ' || CAST(s_nationkey AS VARCHAR) AS location
FROM s JOIN supplier ON CAST(s_suppkey AS VARCHAR) = s.sensor_id
""")
def csv_roundtrip(spark, sf_dir):
    """Dimension -> single CSV with header (SNK-1) -> schema-checked read (SRC-1)."""
    path = shared_dir(spark, "sensors-csv")
    write_csv(tb.day_sensors(spark, sf_dir), path, single=True)
    return read_sensors(spark, path).select(*SENSOR_COLUMNS)


def _feed_csv(spark, sf_dir):
    """lineitem counts written in the feed's CSV layout (SNK-3), returns path."""
    rec = to_feed_records(tb.day_counts(spark, sf_dir))
    csv = rec.select(
        F.col("id").alias("ID"), F.col("date_time").alias("Date_Time"), F.col("year").alias("Year"),
        F.col("month").alias("Month"), F.col("mdate").alias("Mdate"), F.col("day").alias("Day"),
        F.col("time").alias("Time"), F.col("sensor_id").alias("Sensor_ID"),
        F.col("sensor_name").alias("Sensor_Name"), F.col("hourly_counts").alias("Hourly_Counts"))
    path = shared_dir(spark, "counts-csv")
    write_csv(csv, path, single=False)
    return path


DAY_RECORDS_SQL = f"""
WITH c AS ({S.DAY_COUNTS})
SELECT id, year, month, mdate, sensor_id, hourly_counts FROM c
"""


@query("counts_csv_scan", DAY_RECORDS_SQL)
def counts_csv_scan(spark, sf_dir):
    """Feed CSV with header -> explicit all-string schema -> typed (SRC-2)."""
    counts = read_counts_csv(spark, _feed_csv(spark, sf_dir))
    return counts.select("id", "year", "month", "mdate", "sensor_id", "hourly_counts")


@query("counts_csv_infer", DAY_RECORDS_SQL)
def counts_csv_infer(spark, sf_dir):
    """Same file read with schema inference (SRC-4); normalised to the same types."""
    counts = read_counts_csv(spark, _feed_csv(spark, sf_dir), infer=True)
    return counts.select("id", "year", "month", "mdate", "sensor_id", "hourly_counts")


@query("json_scan", EVENT_RECORDS_SQL)
def json_scan(spark, sf_dir):
    """Pages landed as JSON array files, read back as multi-line JSON (SRC-3/8)."""
    records = to_feed_records(tb.event_counts(spark, sf_dir))
    pages = encode_pages(records, page_size=PAGE_SIZE, pretty=True).select(
        F.col("value").cast("string").alias("value"))
    path = shared_dir(spark, "pages-json")
    # One page per file, as a multi-line JSON file must hold exactly one
    # array (T16): ``maxRecordsPerFile=1`` splits each task's output into
    # one file per page in a flat folder (no directory per page).
    pages.write.option("maxRecordsPerFile", 1).text(path)
    return _records(read_counts_json(spark, path, multi_line=True))


@query("json_lines_scan", EVENT_RECORDS_SQL)
def json_lines_scan(spark, sf_dir):
    """Pages written one per line (the scalable landing layout), read as JSON lines."""
    records = to_feed_records(tb.event_counts(spark, sf_dir))
    pages = encode_pages(records, page_size=PAGE_SIZE).select(F.col("value").cast("string").alias("value"))
    path = shared_dir(spark, "pages-jsonl")
    write_pages_json(pages, path)
    return _records(read_counts_json(spark, path, multi_line=False))


@query("file_rejects", """
SELECT 'json' AS format, CAST(count(*) AS BIGINT) AS good_records, true AS one_reject_per_page FROM events
UNION ALL
SELECT 'csv', CAST(count(*) AS BIGINT), true FROM lineitem
""")
def file_rejects(spark, sf_dir):
    """Files in which every whole page or line is followed by a torn one: good rows and rejects of one scan each (SRC-2, SRC-3)."""
    def with_torn(df, torn):
        return df.select(F.explode(F.array("value", torn)).alias("value"))

    pages = encode_pages(to_feed_records(tb.event_counts(spark, sf_dir)), page_size=PAGE_SIZE).select(F.col("value").cast("string").alias("value"))
    pages = stage(pages, shared_dir(spark, "pages"))  # encoded once, read twice
    at = shared_dir(spark, "torn-json")
    with_torn(pages, F.expr("substring(value, 1, char_length(value) - 2)")).write.text(at)
    parts = [("json", pages, *split_counts_json(spark, at, multi_line=False))]
    header = ",".join(COUNT_CSV_COLUMNS)
    lines = spark.read.text(_feed_csv(spark, sf_dir)).filter(F.col("value") != header)
    at = shared_dir(spark, "torn-csv")
    with_torn(lines, F.substring_index("value", ",", 4)).select(F.col("value").alias(header)).write.option("header", True).option("sep", "\u0001").option("quote", "").csv(at)
    parts.append(("csv", lines, *split_counts_csv(spark, at)))
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("format"), F.lit(i).alias("part"), "n")
              for name, *frames in parts for i, df in enumerate(frames)]
    whole, good, rejects = (F.sum(F.when(F.col("part") == i, F.col("n"))) for i in range(3))
    return reduce(DataFrame.unionByName, counts).groupBy("format").agg(good.alias("good_records"), (whole == rejects).alias("one_reject_per_page"))


@query("parse_datetime", """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       o_orderdate AS date_time,
       CAST(o_orderdate AS DATE) AS day,
       CAST(epoch(o_orderdate) AS BIGINT) AS epoch,
       strftime(o_orderdate, '%m') AS month
FROM orders
""")
def parse_datetime(spark, sf_dir):
    """Timestamp -> feed text -> parsed back (FN-1, FN-3, FN-4, FN-5)."""
    o = tb.table(spark, sf_dir, "orders")
    text = o.select(F.col("o_orderkey").cast("string").alias("id"),
                    tf.format_date_time(F.col("o_orderdate").cast("timestamp")).alias("t"))
    epoch = tf.epoch_seconds("t", tf.DATE_TIME_PATTERN)
    return text.select(
        "id",
        tf.parse_date_time("t").cast("timestamp_ntz").alias("date_time"),
        tf.to_day(tf.parse_date_time("t")).alias("day"),
        epoch.alias("epoch"),
        tf.format_epoch(epoch, "MM").alias("month"),
    )


@query("month_number", """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       strftime(o_orderdate, '%m') AS month,
       CAST(month(o_orderdate) AS INTEGER) AS month_number,
       strftime(o_orderdate, '%m') AS month_via_epoch
FROM orders
""")
def month_number(spark, sf_dir):
    """Month name text -> 'MM' and -> month number (FN-2, FN-6)."""
    o = tb.table(spark, sf_dir, "orders")
    names = o.select(F.col("o_orderkey").cast("string").alias("id"),
                     F.date_format(F.col("o_orderdate").cast("timestamp"), "MMMM").alias("m"))
    return names.select("id", tf.month_name_to_mm("m").alias("month"),
                        tf.month_name_to_number("m").alias("month_number"),
                        tf.month_name_to_mm_via_epoch("m").alias("month_via_epoch"))


@query("provenance_keys", """
SELECT CAST(event_id AS VARCHAR) AS id, 'events-0-' || CAST(event_id AS VARCHAR) AS message_id
FROM events
""")
def provenance_keys(spark, sf_dir):
    """One message per event (offset = event id): decoded records carry the
    colon-free ``topic-partition-offset`` provenance key (FN-11, T15)."""
    records = to_feed_records(tb.event_counts(spark, sf_dir))
    msgs = records.select(
        F.to_json(F.array(F.struct(*records.columns))).alias("value"),
        F.lit("events").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").cast("bigint").alias("offset"))
    return decode_pages(msgs).select("id", "message_id")


@query("page_rejects", """
SELECT CAST(count(*) AS BIGINT) AS good_records, true AS one_reject_per_page FROM events
""")
def page_rejects_q(spark, sf_dir):
    """Every event page is followed by a truncated twin: all records decode, every twin is a reject."""
    pages = _event_messages(spark, sf_dir)
    cut = pages.withColumn("value", F.expr("substring(value, 1, octet_length(value) - 2)"))
    both = pages.unionByName(cut)
    n = F.count(F.lit(1)).alias("n")
    parts = [decode_pages(both, malformed="reject").agg(n), pages.agg(n), page_rejects(both).agg(n)]
    rows = reduce(DataFrame.unionByName, [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)])
    good, whole, rejects = (F.sum(F.when(F.col("part") == i, F.col("n"))) for i in range(3))
    return rows.agg(good.alias("good_records"), (whole == rejects).alias("one_reject_per_page"))

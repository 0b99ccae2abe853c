"""Scalar column functions (FN-3, FN-4, FN-9, FN-12, value conversions)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from footfall.functions import messages as fm
from footfall.functions import time as tf
from footfall.functions.values import clean_key, try_int, try_long


def test_epoch_round_trip(spark):
    df = spark.createDataFrame([("January 02, 2020 01:30:00 PM",), ("junk",)], "t string")
    r = df.select(tf.epoch_seconds("t", tf.DATE_TIME_PATTERN).alias("e")).collect()
    assert r[0].e == 1577971800 and r[1].e is None
    back = df.select(tf.format_epoch(tf.epoch_seconds("t", tf.DATE_TIME_PATTERN), "yyyy-MM-dd HH:mm").alias("x"))
    assert [x.x for x in back.collect()] == ["2020-01-02 13:30", None]


def test_month_via_epoch_equals_direct(spark):
    import calendar

    df = spark.createDataFrame([(m,) for m in list(calendar.month_name)[1:]] + [("Nope",)], "m string")
    rows = df.select(tf.month_name_to_mm("m").alias("a"), tf.month_name_to_mm_via_epoch("m").alias("b")).collect()
    assert all(r.a == r.b for r in rows) and rows[-1].a is None


def test_format_and_parse_are_inverse(spark):
    df = spark.createDataFrame([("2021-07-04 23:05:09",)], "s string").select(F.to_timestamp("s").alias("ts"))
    r = df.select(tf.parse_date_time(tf.format_date_time("ts")).alias("back"), "ts").first()
    assert r.back == r.ts
    assert df.select(tf.format_date_time("ts").alias("t")).first().t == "July 04, 2021 11:05:09 PM"


def test_value_conversions(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("x",), (None,), ("99999999999",)], "v string")
    r = df.select(try_int("v").alias("i"), try_long("v").alias("l"), clean_key("v").alias("k")).collect()
    assert [x.i for x in r] == [12, 7, None, None, None]
    assert [x.l for x in r] == [12, 7, None, None, 99999999999]
    assert [x.k for x in r] == ["12", "7", "x", None, "99999999999"]


def test_utf8_and_pretty_pages(spark):
    df = spark.createDataFrame([("ä-1", "5"), ("b", None)], "id string, hourly_counts string")
    one = df.groupBy(F.lit(1)).agg(fm.encode_page(fm.encode_record("id", "hourly_counts"), pretty=True).alias("p"))
    text = one.first().p
    assert "\n" in text and sorted(r["id"] for r in json.loads(text)) == ["b", "ä-1"]
    raw = one.select(fm.encode_utf8("p").alias("b"))
    back = raw.select(fm.decode_utf8("b").alias("t")).first().t
    assert back == text
    decoded = raw.select(fm.page_records(fm.decode_page("b"))).collect()
    assert sorted(r.id for r in decoded) == ["b", "ä-1"]

"""Streaming ingest: replay across micro-batches, restart, stream/batch parity,
idempotent re-runs of a micro-batch."""

from __future__ import annotations

import json
import os

import pytest

from footfall.operators.rank import top_n_per_period
from footfall.sources.messages import decode_pages
from footfall.streaming import ingest as ing
from footfall.streaming import totals as tot
from footfall.streaming.ingest import LANDED_SCHEMA


def _message(offset, ids, mdate=1):
    page = [{"id": str(i), "sensor_id": "s", "hourly_counts": 1, "year": 2020, "month": "May",
             "mdate": mdate, "date_time": "May 01, 2020 01:00:00 PM"} for i in ids]
    return json.dumps({"key": None, "value": json.dumps(page), "topic": "get-data",
                       "partition": 0, "offset": offset})


def _run(spark, inbox, landing, ckpt, mode="table"):
    q = ing.ingest(ing.read_message_files(spark, str(inbox), max_files_per_trigger=1),
                   str(landing), str(ckpt), mode=mode)
    q.awaitTermination()
    return [p["numInputRows"] for p in q.recentProgress]


def _landed(spark, landing):
    return spark.read.schema(LANDED_SCHEMA).parquet(str(landing))


def test_replayed_id_across_micro_batches_and_restart(spark, tmp_path):
    inbox, landing, ckpt = tmp_path / "inbox", tmp_path / "landing", tmp_path / "ckpt"
    inbox.mkdir()
    # ids 0, 1, 0 in three files, at three different offsets.
    for n, (off, i) in enumerate([(0, 0), (1, 1), (2, 0)]):
        f = inbox / f"m{n}.json"
        f.write_text(_message(off, [i]) + "\n")
        os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))  # file source orders by mtime
    sizes = _run(spark, inbox, landing, ckpt)
    assert sizes == [1, 1, 1]  # three micro-batches, one record each
    rows = _landed(spark, landing).collect()
    # First delivery of 0, then 1, then nothing new: 0 stays from offset 0.
    assert {r.offset: r.id for r in rows} == {0: "0", 1: "1"}
    # Restart from the checkpoint: nothing is re-read, nothing is added.
    assert sum(_run(spark, inbox, landing, ckpt)) == 0
    assert _landed(spark, landing).count() == 2
    # A re-delivered message (same offset) in a new file is dropped too.
    (inbox / "m3.json").write_text(_message(1, [1]) + "\n")
    _run(spark, inbox, landing, ckpt)
    assert _landed(spark, landing).count() == 2


def test_stateful_mode_matches(spark, tmp_path):
    inbox, landing = tmp_path / "inbox", tmp_path / "landing"
    inbox.mkdir()
    # pages of several records; the same message twice; an id repeated in a later page
    for n, (off, ids) in enumerate([(0, [0, 5, 6]), (1, [1, 7]), (2, [0, 8]), (1, [1, 7])]):
        f = inbox / f"m{n}.json"
        f.write_text(_message(off, ids) + "\n")
        os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    _run(spark, inbox, landing, tmp_path / "ckpt", mode="state")
    assert sorted(r.id for r in _landed(spark, landing).collect()) == ["0", "1", "5", "6", "7", "8"]


def test_rerun_of_a_batch_is_idempotent(spark, tmp_path):
    landing = tmp_path / "landing"
    ing.ensure_table(spark, str(landing), LANDED_SCHEMA, ing.LANDING_PARTITIONS)
    msgs = spark.read.schema(ing.MESSAGE_FILE_SCHEMA).json(
        spark.sparkContext.parallelize([_message(0, [1, 2]), _message(1, [2, 3], mdate=2)]))
    from footfall.sources.messages import decode_pages

    recs = decode_pages(msgs)
    ing.land_new_records(recs, str(landing))
    ing.land_new_records(recs, str(landing))  # same batch again
    assert sorted(r.id for r in _landed(spark, landing).collect()) == ["1", "2", "3"]

    totals, stage = tmp_path / "totals", tmp_path / "stage"
    ing.ensure_table(spark, str(totals), tot.totals_schema(), ["year", "month", "mdate"])
    counts = _landed(spark, landing)
    tot.merge_batch(counts, 0, str(totals), str(stage))
    tot.merge_batch(counts, 0, str(totals), str(stage))  # re-run of batch 0
    got = sorted((r.mdate, r.hourly_counts) for r in tot.read_totals(spark, str(totals)).collect())
    assert got == [(1, 2), (2, 1)]
    tot.merge_batch(counts.filter("mdate = 2"), 1, str(totals), str(stage))  # a later batch adds
    got = sorted((r.mdate, r.hourly_counts) for r in tot.read_totals(spark, str(totals)).collect())
    assert got == [(1, 2), (2, 2)]


def test_stream_top_n_equals_batch(spark, tmp_path):
    inbox, landing = tmp_path / "inbox", tmp_path / "landing"
    inbox.mkdir()
    ids = iter(range(10_000))
    for f in range(4):
        lines = []
        for off in range(3):
            page = [{"id": str(next(ids)), "sensor_id": str(s % 13), "hourly_counts": (s * 7 + f) % 11,
                     "year": 2021, "month": "June", "mdate": 1 + (s + off) % 3,
                     "date_time": "June 01, 2021 01:00:00 AM"} for s in range(20)]
            lines.append(json.dumps({"key": None, "value": json.dumps(page), "topic": "t",
                                     "partition": 0, "offset": f * 10 + off}))
        (inbox / f"f{f}.json").write_text("\n".join(lines) + "\n")
    # replay one file completely
    (inbox / "f9.json").write_text((inbox / "f1.json").read_text())
    _run(spark, inbox, landing, tmp_path / "c1")
    counts = ing.landing_stream(spark, str(landing), max_files_per_trigger=1)
    totals, top = tmp_path / "totals", tmp_path / "top"
    q = tot.maintain_totals_and_top_n(counts, str(totals), str(tmp_path / "c2"), top_path=str(top), n=5)
    q.awaitTermination()
    assert len(q.recentProgress) > 1  # several merges
    streamed = tot.read_top_n(spark, str(top))
    batch = top_n_per_period(_landed(spark, landing), None, "day", n=5,
                             ordered=False).select(*streamed.columns)
    assert streamed.count() == batch.count() == 15
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert tot.read_totals(spark, str(totals)).agg({"hourly_counts": "sum"}).first()[0] == \
        _landed(spark, landing).agg({"hourly_counts": "sum"}).first()[0]


def test_trigger_args():
    assert ing.trigger_args(None) == {"availableNow": True}
    assert ing.trigger_args("1 hour") == {"processingTime": "1 hour"}
    assert ing.trigger_args("once") == {"once": True}


def test_read_touched_partitions(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    schema = StructType([StructField("v", StringType()), StructField("year", IntegerType()),
                         StructField("month", StringType())])
    path = str(tmp_path / "t")
    ing.ensure_table(spark, path, schema, ["year", "month"])
    keys = ["year", "month"]
    assert ing.read_touched(spark, path, schema, keys, [(2020, "01")]).count() == 0  # nothing yet
    rows = [("a", 2020, "01"), ("b", 2020, "02"), ("c", 2021, "01"), ("d", None, None)]
    spark.createDataFrame(rows, schema).write.mode("append").partitionBy(*keys).parquet(path)
    got = ing.read_touched(spark, path, schema, keys, [(2020, "01"), (2021, "01")])
    assert sorted(r.v for r in got.collect()) == ["a", "c"]  # (2021, "02")-style over-match filtered out
    got = ing.read_touched(spark, path, schema, keys, [(None, None), (2020, "02"), (1999, "12")])
    assert sorted(r.v for r in got.collect()) == ["b", "d"]
    assert got.filter("v = 'b'").first().month == "02"  # month stays a two-digit string


def test_compact_partitions_keeps_rows(spark, tmp_path):
    import glob

    path = str(tmp_path / "landing")
    ing.ensure_table(spark, path, LANDED_SCHEMA, ing.LANDING_PARTITIONS)
    msgs = [_message(k, [k * 10 + j for j in range(3)], mdate=1 + k % 2) for k in range(6)]
    from footfall.sources.messages import decode_pages

    for m in msgs:  # one append per message: many small files
        recs = decode_pages(spark.read.schema(ing.MESSAGE_FILE_SCHEMA).json(spark.sparkContext.parallelize([m])))
        ing.land_new_records(recs, path)
    before = sorted(tuple(r) for r in _landed(spark, path).collect())
    day1 = f"{path}/year=2020/month=05/mdate=1/*.parquet"
    assert len(glob.glob(day1)) == 3
    small = str(tmp_path / "compact")
    ing.compact_partitions(spark, path, LANDED_SCHEMA, ing.LANDING_PARTITIONS, [(2020, "05", 1), (2020, "05", 2)], small)
    assert len(glob.glob(f"{small}/year=2020/month=05/mdate=1/*.parquet")) == 1
    assert len(glob.glob(day1)) == 3  # the streamed table keeps its files
    assert sorted(tuple(r) for r in _landed(spark, path).collect()) == before
    assert sorted(tuple(r) for r in _landed(spark, small).collect()) == before
    with pytest.raises(ValueError, match="target"):
        ing.compact_partitions(spark, path, LANDED_SCHEMA, ing.LANDING_PARTITIONS, [(2020, "05", 1)], path)


def test_compaction_leaves_the_totals_alone(spark, tmp_path):
    landing, totals = str(tmp_path / "landing"), str(tmp_path / "totals")
    ing.ensure_table(spark, landing, LANDED_SCHEMA, ing.LANDING_PARTITIONS)
    ing.land_new_records(_records(spark, _message(0, [1, 2, 3])), landing)

    def run():
        tot.maintain_totals_and_top_n(ing.landing_stream(spark, landing), totals, str(tmp_path / "c")).awaitTermination()
        return tot.read_totals(spark, totals).agg({"hourly_counts": "sum"}).first()[0]

    assert run() == 3
    ing.compact_partitions(spark, landing, LANDED_SCHEMA, ing.LANDING_PARTITIONS, [(2020, "05", 1)], str(tmp_path / "small"))
    assert run() == 3


def _records(spark, *messages):
    return decode_pages(spark.read.schema(ing.MESSAGE_FILE_SCHEMA).json(spark.sparkContext.parallelize(list(messages))))


@pytest.mark.parametrize("mode", ["table", "state"])
def test_one_record_rule_in_both_modes(spark, tmp_path, mode):
    inbox, landing, ckpt = tmp_path / "inbox", tmp_path / "landing", tmp_path / "ckpt"
    inbox.mkdir()

    def put(name, offset, page):
        (inbox / name).write_text(json.dumps({"key": None, "value": json.dumps(page), "topic": "t", "partition": 0, "offset": offset}) + "\n")
        _run(spark, inbox, landing, ckpt, mode)

    base = {"sensor_id": "s", "hourly_counts": 1, "year": 2020, "month": "May"}
    page = [base | {"id": "1"}, base | {"mdate": 3}, base | {"mdate": 4}, base | {"hourly_counts": 2}]
    put("a.json", 0, page)  # null mdate, and three records without an id
    assert _landed(spark, landing).count() == 4
    put("b.json", 0, page)  # the same message again
    put("c.json", 1, [base | {"id": "1", "mdate": 9}])  # a known id on another day
    assert _landed(spark, landing).count() == 4
    put("d.json", 2, [base | {"mdate": 3}])  # another message's record without an id
    assert _landed(spark, landing).count() == 5


def test_malformed_pages_are_not_lost(spark, tmp_path):
    inbox, landing, rejects = tmp_path / "inbox", tmp_path / "landing", tmp_path / "rejects"
    inbox.mkdir()
    good = _message(0, [1, 2])
    torn = json.dumps(json.loads(good) | {"value": json.loads(good)["value"][:-5], "offset": 1})
    junk = json.dumps(json.loads(good) | {"value": "junk", "offset": 2})
    none = json.dumps(json.loads(good) | {"value": None, "offset": 3})
    (inbox / "a.json").write_text("\n".join([good, torn, junk, none]) + "\n")
    with pytest.raises(Exception, match="malformed page"):
        _run(spark, inbox, landing, tmp_path / "c1")
    ing.ingest(ing.read_message_files(spark, str(inbox)), str(landing), str(tmp_path / "c2"), rejects_path=str(rejects)).awaitTermination()
    assert _landed(spark, landing).count() == 2
    assert sorted(r.offset for r in spark.read.json(f"{rejects}/*").collect()) == [1, 2, 3]


def _day(spark, *rows):
    return spark.createDataFrame(list(rows), "year int, month string, mdate int, sensor_id string, hourly_counts bigint")


def test_null_day_retry_and_staging(spark, tmp_path):
    totals, stage = str(tmp_path / "totals"), tmp_path / "stage"
    ing.ensure_table(spark, totals, tot.totals_schema(), ["year", "month", "mdate"])
    counts = _day(spark, (2020, "05", None, "s", 5), (None, None, None, None, 1))
    for _ in range(2):
        tot.merge_batch(counts, 0, totals, str(stage))
    assert sorted(r.hourly_counts for r in tot.read_totals(spark, totals).collect()) == [1, 5]
    tot.merge_batch(counts, 1, totals, str(stage))
    assert sorted(r.hourly_counts for r in tot.read_totals(spark, totals).collect()) == [2, 10]
    assert not stage.exists() or not list(stage.iterdir())


def test_new_checkpoint_over_an_old_table(spark, tmp_path):
    totals = str(tmp_path / "totals")
    for i, n in enumerate((5, 7)):
        src = str(tmp_path / f"src{i}")
        _day(spark, (2020, "05", 1, "s", n)).write.parquet(src)
        stream = spark.readStream.schema("year int, month string, mdate int, sensor_id string, hourly_counts bigint").parquet(src)
        tot.maintain_totals_and_top_n(stream, totals, str(tmp_path / f"c{i}")).awaitTermination()
    assert [r.hourly_counts for r in tot.read_totals(spark, totals).collect()] == [12]


def test_crash_between_totals_and_ranking(spark, tmp_path, monkeypatch):
    totals, top, stage = (str(tmp_path / x) for x in ("totals", "top", "stage"))
    for path, schema in ((totals, tot.totals_schema()), (top, tot.top_schema())):
        ing.ensure_table(spark, path, schema, ["year", "month", "mdate"])
    counts = _day(spark, (2020, "05", 1, "s", 5), (2020, "05", None, "t", 2))
    tot.merge_batch(counts, 0, totals, stage)  # the ranking was never written
    tot.merge_batch(counts, 0, totals, stage, top)
    assert sorted(r.hourly_counts for r in tot.read_top_n(spark, top).collect()) == [2, 5]
    assert sorted(r.hourly_counts for r in tot.read_totals(spark, totals).collect()) == [2, 5]


def test_month_grain_totals_merge(spark, tmp_path):
    rows = [(2021, "01", d, str(s), s + d) for d in (1, 2, 3) for s in range(6)]
    rows += [(2021, "02", 1, "0", 100)]
    counts = spark.createDataFrame(rows, "year int, month string, mdate int, sensor_id string, hourly_counts bigint")
    totals, top = str(tmp_path / "totals"), str(tmp_path / "top")
    ing.ensure_table(spark, totals, tot.totals_schema("month"), ["year", "month"])
    tot.merge_batch(counts.filter("mdate = 1"), 0, totals, str(tmp_path / "s"), top, period="month", n=2)
    tot.merge_batch(counts.filter("mdate > 1"), 1, totals, str(tmp_path / "s"), top, period="month", n=2)
    got = sorted(tuple(r) for r in tot.read_top_n(spark, top, "month").collect())
    want = sorted(tuple(r) for r in top_n_per_period(counts, None, "month", n=2, ordered=False).collect())
    assert got == want == [(2021, "01", "4", 18), (2021, "01", "5", 21), (2021, "02", "0", 100)]


def test_four_reports_from_streamed_totals_equal_batch(spark, tmp_path):
    from footfall.plans.reports import build_reports, reports_from_day_totals

    inbox, landing = tmp_path / "inbox", tmp_path / "landing"
    inbox.mkdir()
    months = ["January", "June", "December"]
    rid = iter(range(100_000))
    for f, year in enumerate((2020, 2021, 2022)):
        lines = []
        for off in range(4):
            page = [{"id": str(next(rid)), "sensor_id": str(s), "hourly_counts": (s * 37 + year * off) % 50,
                     "year": year, "month": months[(s + off) % 3], "mdate": 1 + (s * off) % 5,
                     "date_time": f"{months[(s + off) % 3]} 01, {year} 01:00:00 AM"}
                    for s in range(12) if not (year == 2022 and s == 3)]
            lines.append(json.dumps({"key": None, "value": json.dumps(page), "topic": "t",
                                     "partition": 0, "offset": f * 10 + off}))
        (inbox / f"f{f}.json").write_text("\n".join(lines) + "\n")
    (inbox / "replay.json").write_text((inbox / "f1.json").read_text())
    _run(spark, inbox, landing, tmp_path / "c1")
    totals = str(tmp_path / "totals")
    tot.maintain_totals_and_top_n(ing.landing_stream(spark, str(landing), max_files_per_trigger=2),
                                  totals, str(tmp_path / "c2")).awaitTermination()

    sensors = spark.createDataFrame([(str(s), f"d{s}", f"n{s}") for s in range(12)],
                                    "sensor_id string, sensor_description string, sensor_name string")
    kw = dict(decline_years=(2020, 2021, 2022), growth_years=(2021, 2022))
    streamed = reports_from_day_totals(tot.read_totals(spark, totals), sensors, **kw)
    batch = build_reports(_landed(spark, landing), sensors, share_day_totals=False, **kw)
    for key in batch:
        a, b = streamed[key], batch[key]
        assert a.count() == b.count() > 0, key
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), key


def test_restart_replay_writes_what_it_reads(spark, tmp_path, monkeypatch):
    """A first delivery, a re-delivery and, for the restart, a replay of every message; none after it."""
    from footfall.plans import streams

    spark.sql("select id as event_id, timestamp_ntz'2020-05-01 13:00:00' as ts, id % 3 as user_id, 'a' as event_type, 1.5D as value from range(0, 1200, 1, 1)").write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(streams, "shared_dir", lambda spark, name: str(tmp_path / name))
    got = streams.stream_restart_replay(spark, str(tmp_path))
    assert sorted(int(r.id) for r in got.collect()) == list(range(1200))
    sent = spark.read.schema(ing.MESSAGE_FILE_SCHEMA).json(str(tmp_path / "inbox")).groupBy("topic", "partition", "offset").count()
    assert [r["count"] for r in sent.collect()] == [3, 3, 3]


def test_deduplication_shuffles_each_column_once(spark):
    from footfall.sources.messages import dedup_records, identified_records, record_identity

    rows = [("1", "b", "t", 0, 2), ("1", "a", "t", 0, 1), ("", "c", "t", 0, 1), (None, "c", "t", 0, 1), (None, "c", "t", 0, 1), (None, "c", "t", 0, 2), ("1", "A", None, None, None)]
    df = spark.createDataFrame(rows, "id string, day string, topic string, partition int, offset bigint").repartition(3)
    assert sorted(map(str, (tuple(r) for r in dedup_records(df).collect()))) == sorted(map(str, [rows[6], rows[2], rows[3], rows[5]]))
    shuffled = dedup_records(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in shuffled
    batch, landed = identified_records(df), df.select(*record_identity(df))
    plan = batch.join(landed.hint("merge"), ["_same_id", "_same_row"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # of the aggregate and of what has landed

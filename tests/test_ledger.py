"""The key ledger: same rows as the landing table gives, few files read, no row lost or doubled by a crash."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.sources.messages import record_identity
from footfall.streaming import ingest as ing
from footfall.streaming.ingest import LANDED_COLUMNS, LANDED_SCHEMA, LANDING_PARTITIONS
from footfall.streaming.ledger import KeyLedger, make_filter, may_hold, with_keys


class Killed(Exception):
    pass


def records(spark, *rows):
    """(id, mdate, offset, count) rows as landed records."""
    df = spark.createDataFrame([(r[0], r[1], r[2], r[3] if len(r) > 3 else 1) for r in rows], "id string, mdate int, offset long, hourly_counts long")
    fixed = {"year": F.lit(2020), "month": F.lit("05"), "topic": F.lit("t"), "partition": F.lit(0)}
    types = {f.name: f.dataType for f in LANDED_SCHEMA.fields}
    return df.withColumns(fixed).select(*[F.col(c).cast(types[c]) if c in (*df.columns, *fixed) else F.lit(None).cast(types[c]).alias(c) for c in LANDED_COLUMNS])


def landing(spark, tmp_path, name="landing"):
    path = str(tmp_path / name)
    ing.ensure_table(spark, path, LANDED_SCHEMA, LANDING_PARTITIONS)
    return path


def rows(spark, path):
    return sorted(((r.id, r.mdate, r.hourly_counts) for r in spark.read.schema(LANDED_SCHEMA).parquet(path).collect()), key=str)


def test_filters_hold_their_keys():
    rng = np.random.default_rng(5)
    for n in (0, 1, 300, 40_000):
        keys = rng.integers(-2 ** 63, 2 ** 63 - 1, n)
        assert may_hold(make_filter(keys), keys).all()
    others = rng.integers(-2 ** 63, 2 ** 63 - 1, 400_000)
    assert may_hold(make_filter(keys), others).mean() < 2e-3


def test_same_rows_as_the_table_mode(spark, tmp_path):
    rnd = random.Random(4)
    a, b = landing(spark, tmp_path, "a"), landing(spark, tmp_path, "b")
    ledger = KeyLedger(spark, str(tmp_path / "ledger"), buckets=4)
    for batch in range(5):
        got = records(spark, *((rnd.choice([None] * 8 + [str(i) for i in range(30)]), rnd.randint(1, 3), rnd.randint(0, 8), rnd.randint(1, 3)) for _ in range(25)))
        ing.land_new_records(got, a)
        for _ in range(2):  # a re-run adds nothing
            ing.land_through_ledger(got, b, ledger, "w", batch, str(tmp_path / "stage"))
    one, two = (spark.read.schema(LANDED_SCHEMA).parquet(x).select("id", "offset", "mdate", "hourly_counts") for x in (a, b))
    assert one.count() > 30 and one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_a_batch_opens_only_files_that_can_hold_its_ids(spark, tmp_path):
    path, ledger = landing(spark, tmp_path), KeyLedger(spark, str(tmp_path / "ledger"), buckets=16)
    for batch in range(4):
        ing.land_through_ledger(records(spark, *((str(i), 1, batch) for i in range(batch * 500, batch * 500 + 500))), path, ledger, "w", batch, str(tmp_path / "s"))
    state = ledger.state()
    assert len(state.segments) == 4 and sum(map(len, state.segments.values())) == 64

    def opened(*new):
        df = records(spark, *new)
        return ledger.candidate_files(with_keys(df, record_identity(df), state.buckets), state)

    known = opened(("700", 1, 9))
    assert len(known) == 1 and ledger.read_keys(known).filter("_same_id = '700'").count() == 1  # one file of 64
    assert len(opened(*((f"new {i}", 1, 9) for i in range(40)))) <= 2  # new ids: none but by chance
    assert len(opened(("3", 1, 9), ("3", 2, 9), ("1999", 1, 9))) == 2
    # records without an id: above the mark none is looked up
    df = records(spark, (None, 1, 100, 5))
    keyed = with_keys(df, record_identity(df), state.buckets)
    assert state.marks == {"t/0": 3} and ledger.unseen(keyed, state).count() == 1
    plan = ledger.unseen(keyed, state)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("step", ["intent", "append", "segment", "publish", "published"])
def test_killed_at_any_step(spark, tmp_path, monkeypatch, step):
    path, ledger = landing(spark, tmp_path), KeyLedger(spark, str(tmp_path / "ledger"), buckets=4)

    def land(batch, *new):
        ing.land_through_ledger(records(spark, *new), path, ledger, "w", batch, str(tmp_path / "s"))

    land(0, ("1", 1, 0), (None, 1, 0))
    target = {"intent": "unseen", "append": "_add", "segment": "_write", "publish": "_publish", "published": "_publish"}[step]
    plain = getattr(KeyLedger, target)

    def dies(self, *a, **k):
        if step == "published":
            plain(self, *a, **k)
        raise Killed(step)

    monkeypatch.setattr(KeyLedger, target, dies)
    with pytest.raises(Killed):
        land(1, ("1", 2, 1), ("2", 2, 1), (None, 2, 1), (None, 2, 1, 7))
    monkeypatch.undo()
    for _ in range(2):
        land(1, ("1", 2, 1), ("2", 2, 1), (None, 2, 1), (None, 2, 1, 7))
        assert rows(spark, path) == sorted([("1", 1, 1), (None, 1, 1), ("2", 2, 1), (None, 2, 1), (None, 2, 7)], key=str)
    land(2, ("2", 3, 2), ("3", 3, 2))
    assert len(rows(spark, path)) == 6


def test_compaction_keeps_the_keys(spark, tmp_path, monkeypatch):
    path, ledger = landing(spark, tmp_path), KeyLedger(spark, str(tmp_path / "ledger"), buckets=4)
    for batch in range(3):
        ing.land_through_ledger(records(spark, *((str(i), 1, batch) for i in range(batch * 10, batch * 10 + 12))), path, ledger, "w", batch, str(tmp_path / "s"))
    assert ledger.compact(most=3) and len(ledger.state().segments) == 1
    ing.land_through_ledger(records(spark, *((str(i), 1, 9) for i in range(33))), path, ledger, "w", 3, str(tmp_path / "s"))
    assert [int(r[0]) for r in sorted(rows(spark, path), key=lambda r: int(r[0]))] == list(range(33))
    assert ledger.vacuum(grace_hours=-1) == 0

"""The landing log: only new records are read, compaction may run under a follower, crashes neither lose nor double."""

from __future__ import annotations

import json

import pytest

from footfall.streaming import ingest as ing
from footfall.streaming import totals as tot

from .test_ledger import records


class Killed(Exception):
    pass


def ids(df):
    return sorted(int(r.id) for r in df.select("id").collect())


def test_records_are_followed_and_compacted_under_the_follower(spark, tmp_path):
    log, seen = ing.landing_log(spark, str(tmp_path / "log")), []
    checkpoint = str(tmp_path / "c")

    def take(rows, version):
        seen.append((version, ids(rows)))

    for b in range(3):
        assert log.append(records(spark, (str(2 * b), 1, b), (str(2 * b + 1), 2, b)), "w", b) == b + 1
    assert log.append(records(spark, ("9", 1, 0)), "w", 2) is None  # a re-run of a batch
    assert log.follow(checkpoint, take, most=2) == 2
    assert seen == [(2, [0, 1, 2, 3]), (3, [4, 5])]
    log.append(records(spark, ("6", 1, 3)), "w", 3)
    log.append(records(spark, ("7", 1, 3)), "other", 0)
    assert log.compact(least=5) == 5 and log.compact(least=2) == 0  # some of it seen, some not
    log.append(records(spark, ("8", 1, 4)), "w", 4)
    assert log.vacuum(grace_hours=-1) == 5
    seen.clear()
    assert log.follow(checkpoint, take, most=2) == 2
    assert seen == [(5, [6, 7]), (7, [8])]
    assert log.follow(checkpoint, take) == 0
    assert ids(log.read()) == list(range(9))
    assert len(log.state().homes) == 2


def test_cost_of_a_trigger_does_not_grow(spark, tmp_path):
    log = ing.landing_log(spark, str(tmp_path / "log"))
    for b in range(5):
        log.append(records(spark, (str(b), b, b)), "w", b)
    opened = []
    plain = type(log)._record
    log._record = lambda v: (opened.append(v), plain(log, v))[1]
    at, rows = log.since(4)
    assert at == 5 and ids(rows) == [4] and len(rows.inputFiles()) == 1 and opened[0] == 5


@pytest.mark.parametrize("step", ["before record", "after record"])
def test_killed_between_landing_and_ledger(spark, tmp_path, monkeypatch, step):
    inbox, path, ckpt = tmp_path / "inbox", str(tmp_path / "log"), str(tmp_path / "c")
    inbox.mkdir()

    def message(offset, *numbers):
        page = [{"id": str(i), "sensor_id": "s", "hourly_counts": 1, "year": 2020, "month": "May", "mdate": 1} for i in numbers]
        (inbox / f"{offset}.json").write_text(json.dumps({"key": None, "value": json.dumps(page), "topic": "t", "partition": 0, "offset": offset}) + "\n")

    def run():
        ing.ingest_to_log(ing.read_message_files(spark, str(inbox)), path, ckpt, buckets=2).awaitTermination()

    message(0, 1, 2)
    run()
    from footfall.streaming.landing import LandingLog
    from footfall.streaming.ledger import KeyLedger

    def dies(*a, **k):
        raise Killed

    monkeypatch.setattr(*((LandingLog, "_publish", dies) if step == "before record" else (KeyLedger, "_publish", dies)))
    message(1, 2, 3, 4)
    with pytest.raises(Exception, match="Killed"):
        run()
    monkeypatch.undo()
    run()
    message(2, 4, 5)
    run()
    log = ing.landing_log(spark, path)
    assert ids(log.read()) == [1, 2, 3, 4, 5]
    totals = str(tmp_path / "totals")
    assert tot.follow_landing(log, totals, str(tmp_path / "f")) == 1
    assert [r.hourly_counts for r in tot.read_totals(spark, totals).collect()] == [5]
    message(3, 6)
    run()
    assert tot.follow_landing(log, totals, str(tmp_path / "f")) == 1 == len(tot.read_totals(spark, totals).collect())
    assert [r.hourly_counts for r in tot.read_totals(spark, totals).collect()] == [6]


def test_a_broken_off_batch_is_taken_again_up_to_the_same_record(spark, tmp_path):
    log, checkpoint, seen = ing.landing_log(spark, str(tmp_path / "log")), str(tmp_path / "c"), []
    log.append(records(spark, ("1", 1, 0)), "w", 0)

    def dies(rows, version):
        raise Killed

    with pytest.raises(Killed):
        log.follow(checkpoint, dies)
    log.append(records(spark, ("2", 1, 1)), "w", 1)  # came after the batch was planned
    assert log.follow(checkpoint, lambda rows, version: seen.append((version, ids(rows)))) == 2
    assert seen == [(1, [1]), (2, [2])]

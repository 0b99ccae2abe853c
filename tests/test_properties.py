"""Property tests: operators against brute force in plain Python on random
small inputs (nulls, ties and missing years included)."""

from __future__ import annotations

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from footfall.operators import change as ch
from footfall.operators.rank import top_n_per_period
from footfall.sources.messages import dedup_records

SETTINGS = settings(max_examples=12, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

sensor = st.sampled_from(["1", "2", "10", "11", "9", None])
count = st.one_of(st.none(), st.integers(min_value=0, max_value=20))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(2020, 2021), st.sampled_from(["01", "02"]),
                               st.integers(1, 2), sensor, count), max_size=40),
       n=st.integers(1, 4))
def test_top_n_matches_brute_force(spark, rows, n):
    df = spark.createDataFrame(rows, "year int, month string, mdate int, sensor_id string, hourly_counts bigint")
    got = [tuple(r) for r in top_n_per_period(df, None, "day", n=n).collect()]

    sums: dict = {}
    for y, m, d, s, c in rows:
        k = (y, m, d, s)
        prev = sums.get(k, "missing")
        sums[k] = c if prev == "missing" else (prev if c is None else (c if prev is None else prev + c))
    groups = defaultdict(list)
    for (y, m, d, s), v in sums.items():
        groups[(y, m, d)].append((s, v))
    want = []
    for key in sorted(groups):
        # value desc (nulls last), then sensor id asc (nulls first), string order
        ranked = sorted(groups[key], key=lambda sv: (sv[1] is None, -(sv[1] or 0), sv[0] is not None, sv[0] or ""))
        want += [(*key, s, v) for s, v in ranked[:n]]
    assert got == want


def _brute_change(rows, years):
    present, sums = defaultdict(set), {}
    for s, y, c in rows:
        if s is None or y not in years:
            continue
        present[s].add(y)
        k = (s, y)
        prev = sums.get(k, "missing")
        sums[k] = c if prev == "missing" else (prev if c is None else (c if prev is None else prev + c))
    pairs = ch.default_pairs(years)
    out = {}
    for s, ys in present.items():
        for a, b in pairs:
            if a in ys and b in ys:
                va, vb = sums[(s, a)], sums[(s, b)]
                out[s] = (None if va is None or vb is None else va - vb, f"{a}-{b}")
                break
    return out


@SETTINGS
@given(rows=st.lists(st.tuples(sensor, st.integers(2019, 2023), count), max_size=40),
       three=st.booleans())
def test_period_change_and_extremum_match_brute_force(spark, rows, three):
    years = (2020, 2021, 2022) if three else (2021, 2022)
    df = spark.createDataFrame(rows, "sensor_id string, year int, hourly_counts bigint")
    got = {r.sensor_id: (r.hourly_counts, r.basis) for r in ch.period_change(df, years).collect()}
    want = _brute_change(rows, years)
    assert got == want

    values = [v for v, _ in want.values() if v is not None]
    for how, pick in (("max", max), ("min", min)):
        ext = sorted(r.sensor_id for r in ch.extremum(ch.period_change(df, years), how).collect())
        best = pick(values) if values else None
        assert ext == sorted(s for s, (v, _) in want.items() if values and v == best)
        first = [r.sensor_id for r in ch.extremum(ch.period_change(df, years), how, ties="first").collect()]
        assert first == (ext[:1] if ext else [])


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(0, 9)),
                     max_size=30))
def test_dedup_records_keeps_earliest_copy(spark, rows):
    df = spark.createDataFrame([("t", 0, off, i, v) for i, off, v in rows],
                               "topic string, partition int, offset long, id string, hourly_counts long")
    got = {r.id: (r.offset, r.hourly_counts) for r in dedup_records(df).collect()}
    want = {}
    for i, off, v in rows:
        if i not in want or (off, v) < want[i]:
            want[i] = (off, v)
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(sensor, st.integers(2019, 2023), count), max_size=40))
def test_present_only_and_aligned_difference_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "sensor_id string, year int, hourly_counts bigint")
    years_of = defaultdict(set)
    sums = {}
    for s, y, c in rows:
        if s is None:
            continue
        years_of[s].add(y)
        prev = sums.get((s, y), "missing")
        sums[(s, y)] = c if prev == "missing" else (prev if c is None else (c if prev is None else prev + c))

    got = sorted(r.sensor_id for r in ch.present_only(df, present=(2020, 2021), absent=(2022,)).collect())
    want = sorted(s for s, ys in years_of.items() if {2020, 2021} <= ys and 2022 not in ys)
    assert got == want

    got = {r.sensor_id: r.hourly_counts for r in ch.aligned_difference(df, 2020, 2022).collect()}
    want = {}
    for s, ys in years_of.items():
        if 2020 in ys or 2022 in ys:
            a, b = sums.get((s, 2020)), sums.get((s, 2022))
            want[s] = None if a is None or b is None else a - b
    assert got == want

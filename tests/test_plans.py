"""Plan-shape checks: the physical plans we rely on for scale."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from footfall.operators import change as ch
from footfall.operators.enrich import enrich
from footfall.operators.rank import top_n_per_period
from footfall.sources import tables as tb

from .conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_n_uses_window_group_limit(spark):
    p = plan(top_n_per_period(tb.day_counts(spark, SF_SMALL), None, "day", ordered=False))
    assert p.count("WindowGroupLimit") >= 2  # partial before the shuffle, final after
    assert "Partial" in p and "Final" in p


def test_change_is_one_scan_one_shuffle(spark):
    p = plan(ch.period_change(tb.change_counts(spark, SF_SMALL), (1998, 1999, 2000), ts_col="date_time"))
    tree = p.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    assert tree.count("Exchange") == 1
    assert "Join" not in tree and "Union" not in tree


def test_year_window_reaches_parquet_scan(spark):
    p = plan(ch.period_change(tb.change_counts(spark, SF_SMALL), (1998, 1999, 2000), ts_col="date_time"))
    pushed = [ln for ln in p.splitlines() if ln.startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(o_orderdate" in ln and "LessThan(o_orderdate" in ln for ln in pushed)


def test_scan_prunes_columns(spark):
    p = plan(top_n_per_period(tb.day_counts(spark, SF_SMALL), None, "day", ordered=False))
    schema = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")]
    assert schema and all("l_comment" not in s and "l_tax" not in s for s in schema)
    assert "l_suppkey" in schema[0] and "l_quantity" in schema[0] and "l_shipdate" in schema[0]


def test_planner_chooses_the_enrich_join(spark):
    dim = tb.day_sensors(spark, SF_SMALL)
    totals = top_n_per_period(tb.day_counts(spark, SF_SMALL), None, "month", ordered=False)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        assert "BroadcastHashJoin" in plan(enrich(totals, dim))
        assert "SortMergeJoin" in plan(enrich(totals, dim, broadcast=False))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "SortMergeJoin" in plan(enrich(totals, dim))
        assert "BroadcastHashJoin" in plan(enrich(totals, dim, broadcast=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_enrich_runs_no_job(spark):
    dim, totals = tb.day_sensors(spark, SF_SMALL), tb.day_counts(spark, SF_SMALL)
    sc = spark.sparkContext
    sc.setJobGroup("enrich-plan", "")
    try:
        enrich(totals, dim).schema
        assert not sc.statusTracker().getJobIdsForGroup("enrich-plan")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_single_csv_exchanges_after_the_aggregate(spark):
    change = ch.most_decline(tb.change_counts(spark, SF_SMALL), tb.change_sensors(spark, SF_SMALL), (1998, 1999, 2000))
    tree = plan(change.repartition(1)).split("\n\n")[0]
    assert tree.index("Exchange") < tree.index("HashAggregate")


def test_extremum_ties_first_is_bounded_top_1(spark):
    change = ch.period_change(tb.change_counts(spark, SF_SMALL), (1998, 1999, 2000))
    p = plan(ch.extremum(change, "max", ties="first"))
    assert "TakeOrderedAndProject" in p


def _before_first_exchange(p: str) -> str:
    tree = p.split("\n\n")[0]
    lines = tree.splitlines()
    idx = max(i for i, ln in enumerate(lines) if "Exchange" in ln)  # deepest exchange (closest to scan)
    return "\n".join(lines[idx:])


def test_partial_aggregation_before_the_shuffle(spark):
    # A hot key collapses map-side: each aggregation shuffles partial results.
    from footfall.sources.messages import dedup_records

    checks = {
        "top_n": top_n_per_period(tb.day_counts(spark, SF_SMALL), None, "day", ordered=False),
        "change": ch.period_change(tb.change_counts(spark, SF_SMALL), (1998, 1999, 2000)),
        "dedup": dedup_records(tb.event_counts(spark, SF_SMALL)),
    }
    for name, df in checks.items():
        p = plan(df)
        # Hash- or (for min_by over a struct) sort-based: either way map-side.
        assert "Aggregate" in _before_first_exchange(p), name
        assert "partial_" in p, name


def test_hot_keys_give_exact_results(spark):
    # One sensor, one day and one id each hold a third of all rows.
    from pyspark.sql import functions as F

    from footfall.sources.messages import dedup_records

    n = 30_000
    base = spark.range(n).select(
        F.lit(2021).alias("year"), F.lit("03").alias("month"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 28 + 1)).cast("int").alias("mdate"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("sensor_id"),
        F.lit(1).cast("bigint").alias("hourly_counts"),
        F.when(F.col("id") % 3 == 0, F.lit("dup")).otherwise(F.col("id").cast("string")).alias("rid"),
    ).repartition(16)
    top = top_n_per_period(base, None, "day", n=3, ordered=False).collect()
    hot = [r for r in top if r.mdate == 1]
    assert hot[0].sensor_id == "hot" and hot[0].hourly_counts == n // 3
    total = base.groupBy().sum("hourly_counts").first()[0]
    assert sum(r.hourly_counts for r in ch.yearly_totals(base, [2021]).collect()) == total
    deduped = dedup_records(base.withColumnRenamed("id", "x").withColumnRenamed("rid", "id"))
    assert deduped.count() == n - n // 3 + 1



def test_pages_are_made_without_a_shuffle(spark):
    from footfall.sinks.messages import encode_pages

    records = spark.range(0, 2500, 1, 3).select(F.col("id").cast("string").alias("id"), F.lit("s").alias("sensor_id"))
    pages = encode_pages(records, page_size=100)
    assert "Exchange" not in pages._jdf.queryExecution().executedPlan().toString()
    once = sorted(tuple(r) for r in pages.collect())
    assert once == sorted(tuple(r) for r in pages.collect())  # a task that runs again makes the same pages
    assert len({r[0] for r in once}) == len(once) == 27 and max(r[1].count(b"{") for r in once) == 100


def test_page_keys_survive_another_order_in_the_partition(spark):
    from footfall.sinks.messages import encode_pages

    rows = [(str(i), str(i % 7)) for i in range(500)]
    a = spark.createDataFrame(rows, "id string, sensor_id string").coalesce(1)
    b = spark.createDataFrame(rows[::-1], "id string, sensor_id string").coalesce(1)
    pages = [sorted(tuple(r) for r in encode_pages(x, page_size=64).collect()) for x in (a, b)]
    assert pages[0] == pages[1]


def test_single_csv_is_written_range_by_range(spark, tmp_path):
    import glob

    from footfall.sinks.files import write_csv

    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 3 == 0, F.lit("a, b")).alias("v"))
    plain, ranged = str(tmp_path / "a"), str(tmp_path / "b")
    df.repartition(1).sortWithinPartitions("k").write.option("header", True).csv(plain)
    write_csv(df, ranged, order_by=["k"])
    (one,), (two,) = glob.glob(f"{plain}/part-*"), glob.glob(f"{ranged}/part-*")
    with open(one, "rb") as f, open(two, "rb") as g:
        assert f.read() == g.read()
    plan = df.orderBy("k").coalesce(1)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan

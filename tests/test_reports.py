"""End to end: files in the feed's formats -> four reports -> CSV outputs,
equal to the operators run directly on the tables."""

from __future__ import annotations

from footfall.operators import change as ch
from footfall.operators.rank import top_n_per_period
from footfall.plans.reports import REPORT_NAMES, run_reports
from footfall.sinks.files import write_csv, write_pages_json
from footfall.sinks.messages import encode_pages, to_feed_records
from footfall.sources import tables as tb

from .conftest import SF_SMALL


def test_run_reports_matches_operators(spark, tmp_path):
    counts = tb.change_counts(spark, SF_SMALL)
    sensors = tb.change_sensors(spark, SF_SMALL)
    write_csv(sensors, str(tmp_path / "sensors"), single=True)
    pages = encode_pages(to_feed_records(counts), page_size=200)
    write_pages_json(pages.selectExpr("CAST(value AS STRING) AS value"), str(tmp_path / "counts"))

    years, growth = (1998, 1999, 2000), (1999, 2000)
    out = run_reports(spark, str(tmp_path / "sensors"), str(tmp_path / "counts"), str(tmp_path / "out"),
                      counts_format="jsonl", decline_years=years, growth_years=growth)
    assert set(out) == set(REPORT_NAMES)

    def read(key, like):
        df = spark.read.option("header", True).csv(out[key])
        return df.select(*[df[c].cast(like.schema[c].dataType).alias(c) for c in like.columns])

    expected = {
        "top10_per_day": top_n_per_period(counts, sensors, "day"),
        "top10_per_month": top_n_per_period(counts, sensors, "month"),
        "most_decline": ch.most_decline(counts, sensors, years, ts_col="date_time"),
        "most_growth": ch.most_growth(counts, sensors, growth, ts_col="date_time"),
    }
    for key, want in expected.items():
        got = read(key, want)
        assert got.columns == want.columns
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), key
    # Single ordered CSV: rows come back in report order.
    day = [tuple(r)[:4] for r in read("top10_per_day", expected["top10_per_day"]).collect()]
    assert day == [tuple(r)[:4] for r in expected["top10_per_day"].collect()]


def test_shared_day_totals_give_the_same_reports(spark):
    from footfall.plans.reports import build_reports

    counts = tb.change_counts(spark, SF_SMALL)
    sensors = tb.change_sensors(spark, SF_SMALL)
    kw = dict(decline_years=(1998, 1999, 2000), growth_years=(1999, 2000))
    shared = build_reports(counts, sensors, share_day_totals=True, **kw)
    direct = build_reports(counts, sensors, share_day_totals=False, **kw)
    for key in direct:
        a, b = shared[key], direct[key]
        assert a.columns == b.columns
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), key


def test_run_reports_integrity_failure(spark, tmp_path):
    import pytest

    counts = tb.change_counts(spark, SF_SMALL)
    sensors = tb.change_sensors(spark, SF_SMALL)
    # A dimension that misses most sensors: the reports must be flagged.
    write_csv(sensors.filter("sensor_id < '2'"), str(tmp_path / "sensors"), single=True)
    write_csv(counts.selectExpr("id AS ID", "CAST(date_time AS STRING) AS Date_Time", "year AS Year",
                                "'January' AS Month", "mdate AS Mdate", "day AS Day", "time AS Time",
                                "sensor_id AS Sensor_ID", "sensor_name AS Sensor_Name",
                                "hourly_counts AS Hourly_Counts"),
              str(tmp_path / "counts"), single=False)
    with pytest.raises(ValueError, match="not in the dimension"):
        run_reports(spark, str(tmp_path / "sensors"), str(tmp_path / "counts"), str(tmp_path / "out"),
                    counts_format="csv", decline_years=(1998, 1999, 2000), growth_years=(1999, 2000))


def test_unknown_ids_raise_after_all_reports_are_written(spark, tmp_path):
    import pytest

    counts = spark.createDataFrame(
        [(y, m, "1", s, str(10 * y % 7 + len(s or ""))) for y in (2020, 2021, 2022) for m in ("May", "07") for s in ("a", "b", None)],
        "year int, month string, mdate string, sensor_id string, hourly_counts string")
    counts.write.parquet(str(tmp_path / "counts"))
    sensors = spark.createDataFrame([("a",), ("b",)], "sensor_id string")
    columns = [c for c in tb.day_sensors(spark, SF_SMALL).columns]
    for name, rows in (("all", sensors), ("some", sensors.filter("sensor_id = 'a'"))):
        full = rows.selectExpr(*[c if c == "sensor_id" else f"'x' AS {c}" for c in columns])
        write_csv(full, str(tmp_path / name), single=True)
    # The null sensor stays in the rankings and is no unknown id.
    out = run_reports(spark, str(tmp_path / "all"), str(tmp_path / "counts"), str(tmp_path / "out"), counts_format="parquet")
    day = spark.read.option("header", True).csv(out["top10_per_day"])
    assert day.count() == 18 and day.filter("sensor_id is null").count() == 6
    assert sorted({r.month for r in day.collect()}) == ["05", "07"]
    with pytest.raises(ValueError, match="'b'"):
        run_reports(spark, str(tmp_path / "some"), str(tmp_path / "counts"), str(tmp_path / "out2"), counts_format="parquet")
    assert all((tmp_path / "out2" / name).is_dir() for name in REPORT_NAMES.values())


def test_shared_folder_is_required_off_local_masters():
    import pytest

    from footfall.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())

"""The four reports of the batch job, end to end: read the sensor dimension
and the count feed, answer the questions, write one CSV per answer.

Equivalent of the reference's main script, parameterised: input format and
paths, the ranking size, the year triple for the decline and the year pair
for the growth. Outputs go straight from executors to ``out_dir`` (any
Hadoop URI, e.g. an object-store bucket).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.change import most_decline, most_growth
from ..operators.enrich import KEY, orphans
from ..operators.rank import period_keys, period_totals, rank_order, top_n_per_period
from ..session import delete_path, shared_dir
from ..sinks.files import write_csv
from ..sources.counts import normalize_counts, read_counts_csv, read_counts_json, read_sensors

# Output names of the four answers.
REPORT_NAMES = {
    "top10_per_day": "Top10PerDay",
    "top10_per_month": "Top10PerMonth",
    "most_decline": "MostDeclineLast2Year",
    "most_growth": "MostGrowthLastYear",
}


def shared_day_totals(counts: DataFrame, path: str) -> DataFrame:
    """Sums per (day, sensor), written once as parquet by year and read back.

    About 1/24 of hourly rows. Every report is answered from it with column
    and year pruning, so the raw input is scanned once instead of four times.
    Sums of day sums equal sums of rows (nulls included), and a sensor has a day
    total in a year exactly when it has a row in that year.
    """
    day = period_totals(counts, "day")
    day.hint("rebalance", "year").write.partitionBy("year").parquet(path)
    return counts.sparkSession.read.schema(day.schema).parquet(path).select(*day.columns)


def build_reports(counts: DataFrame, sensors: DataFrame, n: int = 10,
                  decline_years=(2020, 2021, 2022), growth_years=(2021, 2022),
                  ties: str = "all", share_day_totals: bool = True) -> dict[str, DataFrame]:
    """The four answers as DataFrames.

    With ``share_day_totals`` they are answered from ``shared_day_totals`` in the
    shared folder (which the caller's session names; the table stays there as
    long as the DataFrames may be used).
    """
    if share_day_totals:
        day = shared_day_totals(counts, shared_dir(counts.sparkSession, "day-totals"))
        return reports_from_day_totals(day, sensors, n, decline_years, growth_years, ties)
    return {
        "top10_per_day": top_n_per_period(counts, sensors, "day", n),
        "top10_per_month": top_n_per_period(counts, sensors, "month", n),
        "most_decline": most_decline(counts, sensors, decline_years, ties=ties),
        "most_growth": most_growth(counts, sensors, growth_years, ties=ties),
    }


def reports_from_day_totals(day_totals: DataFrame, sensors: DataFrame, n: int = 10,
                            decline_years=(2020, 2021, 2022), growth_years=(2021, 2022),
                            ties: str = "all") -> dict[str, DataFrame]:
    """The four answers from a table of (year, month, mdate, sensor_id,
    hourly_counts) day totals — a batch aggregate or the totals table the
    streaming job maintains — so batch and stream agree."""
    return {
        "top10_per_day": top_n_per_period(day_totals, sensors, "day", n, pre_aggregated=True),
        "top10_per_month": top_n_per_period(day_totals, sensors, "month", n),
        "most_decline": most_decline(day_totals, sensors, decline_years, ties=ties),
        "most_growth": most_growth(day_totals, sensors, growth_years, ties=ties),
    }


def _order(key: str) -> list:
    period = {"top10_per_day": "day", "top10_per_month": "month"}.get(key)
    return [] if period is None else [*(F.col(k).asc_nulls_first() for k in period_keys(period)), *rank_order()]


def read_inputs(spark: SparkSession, sensors_path: str, counts_path: str,
                counts_format: str = "json") -> tuple[DataFrame, DataFrame]:
    sensors = read_sensors(spark, sensors_path)
    if counts_format == "json":
        counts = read_counts_json(spark, counts_path)
    elif counts_format == "jsonl":
        counts = read_counts_json(spark, counts_path, multi_line=False)
    elif counts_format == "csv":
        counts = read_counts_csv(spark, counts_path)
    elif counts_format == "parquet":
        counts = normalize_counts(spark.read.parquet(counts_path))
    else:
        raise ValueError("counts_format must be json, jsonl, csv or parquet")
    return counts, sensors


def run_reports(spark: SparkSession, sensors_path: str, counts_path: str, out_dir: str,
                counts_format: str = "json", check_integrity: bool = True, n: int = 10,
                decline_years=(2020, 2021, 2022), growth_years=(2021, 2022), ties: str = "all") -> dict[str, str]:
    """Write the four reports as single CSV files under ``out_dir``.

    With ``check_integrity`` the sensor ids of the written reports are checked
    against the dimension (the reference's tests run on its published outputs
    too). All four are written first; then unknown ids raise, at most five of
    each report named. A null id, which the rankings keep, is no unknown id.
    """
    counts, sensors = read_inputs(spark, sensors_path, counts_path, counts_format)
    folder = shared_dir(spark, "day-totals")
    reports = reports_from_day_totals(shared_day_totals(counts, folder), sensors, n, decline_years, growth_years, ties)
    written = {}
    for key, df in reports.items():
        written[key] = f"{out_dir.rstrip('/')}/{REPORT_NAMES[key]}"
        write_csv(df, written[key], single=True, order_by=_order(key))
    delete_path(spark, folder)
    if check_integrity:
        unknown = {}
        for key, path in written.items():
            ids = spark.read.option("header", True).csv(path).select(KEY).filter(F.col(KEY).isNotNull())  # text columns
            found = orphans(ids, sensors).limit(5).collect()
            if found:
                unknown[key] = sorted(r[0] for r in found)
        if unknown:
            raise ValueError(f"sensor ids not in the dimension: {unknown}")
    return written

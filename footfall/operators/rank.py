"""Busiest sensors per period (Q-1, Q-2; AGG-1/2, WIN-1..3, FLT-3, SRT-3).

Plan shape (checked with explain): partial sum -> shuffle on
(period, sensor) -> final sum -> partial ``WindowGroupLimit`` -> shuffle on
period -> final ``WindowGroupLimit`` -> ``row_number``. The second shuffle
carries at most ``n`` rows per period per task, so a period holding a third
of all rows costs no more than any other; the aggregation itself is
map-side combined, so a hot sensor collapses before the first shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .enrich import enrich

# Period grains and their keys.
PERIOD_KEYS = {
    "day": ["year", "month", "mdate"],
    "month": ["year", "month"],
    "year": ["year"],
}
MEASURE = "hourly_counts"
KEY = "sensor_id"


def period_keys(period: str) -> list[str]:
    try:
        return list(PERIOD_KEYS[period])
    except KeyError:
        raise ValueError(f"unknown period {period!r}; use one of {sorted(PERIOD_KEYS)}") from None


def period_totals(counts: DataFrame, period: str = "day") -> DataFrame:
    """Sum of the measure per period and sensor (AGG-1 / AGG-2 / AGG-3)."""
    keys = period_keys(period)
    return counts.groupBy(*keys, KEY).agg(F.sum(MEASURE).alias(MEASURE))


def rank_order():
    """Measure descending, then sensor id ascending as a deterministic tie-break."""
    return [F.col(MEASURE).desc_nulls_last(), F.col(KEY).asc_nulls_first()]


def top_n(totals: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows per ``keys`` group by ``rank_order`` (WIN-*, FLT-3)."""
    w = Window.partitionBy(*keys).orderBy(*rank_order())
    return (totals.withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") <= n)
            .drop("_rank"))


def top_n_per_period(counts: DataFrame, sensors: DataFrame | None = None,
                     period: str = "day", n: int = 10, ordered: bool = True,
                     broadcast: bool | None = None, pre_aggregated: bool = False) -> DataFrame:
    """The ``n`` busiest sensors of every period, enriched from ``sensors``.

    Output: period keys, sensor_id, hourly_counts[, sensor_description,
    sensor_name]; ordered by period ascending then rank when ``ordered``.
    ``pre_aggregated`` states that ``counts`` already holds one total per
    (period, sensor), so no aggregation (and no shuffle for it) is added.
    """
    keys = period_keys(period)
    totals = counts.select(*keys, KEY, MEASURE) if pre_aggregated else period_totals(counts, period)
    best = top_n(totals, keys, n)
    if sensors is not None:
        best = enrich(best, sensors, broadcast=broadcast)
    if ordered:
        best = best.orderBy(*[F.col(k).asc_nulls_first() for k in keys], *rank_order())
    return best

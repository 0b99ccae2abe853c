"""Change between years (Q-3 .. Q-6; AGG-3..7, JN-3..5, SET-1..3, FLT-1/4/5/6).

The reference builds one frame per year, self-joins them pairwise, removes
overlaps with anti-joins and unions the pieces. Here all of it is a single
conditional aggregation per sensor: one scan, one shuffle (map-side
combined), with *presence flags* so that a year whose sum is null still
counts as present and blocks the fallback, exactly like the join form.

Sign convention (kept from the reference): change = earlier - later, so a
decline is a large positive number and growth is negative.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import year_window
from .enrich import enrich

KEY = "sensor_id"
MEASURE = "hourly_counts"


def _has(y: int) -> str:
    return f"has_{y}"


def _sum(y: int) -> str:
    return f"y{y}"


def default_pairs(years) -> list[tuple[int, int]]:
    """(y0, y1, y2) -> y0->y2, else y0->y1, else y1->y2; (y1, y2) -> y1->y2."""
    ys = [int(y) for y in years]
    if len(ys) == 2:
        return [(ys[0], ys[1])]
    if len(ys) == 3:
        return [(ys[0], ys[2]), (ys[0], ys[1]), (ys[1], ys[2])]
    raise ValueError("years must hold two or three years")


def _in_years(counts: DataFrame, years, ts_col: str | None) -> DataFrame:
    ys = sorted({int(y) for y in years})
    cond = F.col("year").isin(ys) & F.col(KEY).isNotNull()
    if ts_col is not None:
        # Redundant with the year test when year derives from ts_col, but
        # unlike year(ts) it reaches the parquet scan as a pushed filter.
        cond = year_window(ts_col, ys) & cond
    return counts.filter(cond)


def year_matrix(counts: DataFrame, years, ts_col: str | None = None) -> DataFrame:
    """One row per sensor: presence flag and sum per year (AGG-7 pivot).

    Null sensor ids are dropped: they can never be paired by key.
    ``ts_col`` names the timestamp the year was derived from, if any.
    """
    ys = sorted({int(y) for y in years})
    aggs = []
    for y in ys:
        is_y = F.col("year") == F.lit(y)
        aggs.append(F.bool_or(is_y).alias(_has(y)))
        aggs.append(F.sum(F.when(is_y, F.col(MEASURE))).alias(_sum(y)))
    return _in_years(counts, ys, ts_col).groupBy(KEY).agg(*aggs)


def _pair_cases(pairs) -> tuple[Column, Column]:
    value = None
    basis = None
    for a, b in pairs:
        cond = F.col(_has(a)) & F.col(_has(b))
        diff = F.col(_sum(a)) - F.col(_sum(b))
        label = F.lit(f"{a}-{b}")
        value = F.when(cond, diff) if value is None else value.when(cond, diff)
        basis = F.when(cond, label) if basis is None else basis.when(cond, label)
    return value, basis


def period_change(counts: DataFrame, years=(2020, 2021, 2022), pairs=None,
                  ts_col: str | None = None, keep_sums: bool = False) -> DataFrame:
    """Change per sensor over the first year pair it has data for (Q-5).

    Output: sensor_id, hourly_counts (earlier - later, null when a present
    year summed to null), basis ('YYYY-YYYY' of the chosen pair). Sensors
    with no complete pair are absent.
    """
    pairs = pairs or default_pairs(years)
    ys = sorted({y for p in pairs for y in p})
    m = year_matrix(counts, ys, ts_col)
    value, basis = _pair_cases(pairs)
    cols = [F.col(KEY), value.alias(MEASURE), basis.alias("basis")]
    if keep_sums:
        cols += [F.col(_sum(y)) for y in ys]
    return m.select(*cols).filter(F.col("basis").isNotNull())


def extremum(df: DataFrame, how: str = "max", ties: str = "all",
             value: str = MEASURE, key: str = KEY) -> DataFrame:
    """Rows whose ``value`` equals the max/min (AGG-4/5, FLT-4, AGG-6).

    ``ties='all'`` keeps every row equal to the extremum (scalar subquery;
    nulls skipped, empty in -> empty out). ``ties='first'`` keeps the one with
    the smallest key: a per-task top-1 merged on one task, so it is bounded.
    """
    if how not in ("max", "min"):
        raise ValueError("how must be 'max' or 'min'")
    if ties == "all":
        agg = F.max(value) if how == "max" else F.min(value)
        return df.filter(F.col(value) == df.select(agg).scalar())
    if ties == "first":
        order = F.col(value).desc() if how == "max" else F.col(value).asc()
        return df.filter(F.col(value).isNotNull()).orderBy(order, F.col(key).asc_nulls_first()).limit(1)
    raise ValueError("ties must be 'all' or 'first'")


RESULT_COLUMNS = [KEY, MEASURE, "sensor_description", "sensor_name"]


def most_decline(counts: DataFrame, sensors: DataFrame, years=(2020, 2021, 2022),
                 ties: str = "all", ts_col: str | None = None,
                 broadcast: bool | None = None) -> DataFrame:
    """Sensor(s) with the largest decline over the first available pair (Q-3)."""
    change = period_change(counts, years, ts_col=ts_col)
    return enrich(extremum(change, "max", ties), sensors, broadcast=broadcast).select(*RESULT_COLUMNS)


def most_growth(counts: DataFrame, sensors: DataFrame, years=(2021, 2022),
                ties: str = "all", ts_col: str | None = None,
                broadcast: bool | None = None) -> DataFrame:
    """Sensor(s) with the largest growth (most negative change) (Q-4)."""
    change = period_change(counts, years, ts_col=ts_col)
    return enrich(extremum(change, "min", ties), sensors, broadcast=broadcast).select(*RESULT_COLUMNS)


def present_only(counts: DataFrame, present, absent=(), ts_col: str | None = None) -> DataFrame:
    """Sensors with data in every ``present`` year and none in ``absent`` (Q-6,
    SET-3): the key-set difference as one aggregation instead of EXCEPT."""
    present = [int(y) for y in present]
    absent = [int(y) for y in absent]
    m = year_matrix(counts, present + absent, ts_col)
    conds = [F.col(_has(y)) for y in present] + [~F.col(_has(y)) for y in absent]
    return m.filter(reduce(lambda a, b: a & b, conds)).select(KEY)


def aligned_difference(counts: DataFrame, year_a: int, year_b: int,
                       both_only: bool = False, ts_col: str | None = None) -> DataFrame:
    """Per-sensor sum(year_a) - sum(year_b), aligned by key (JN-5).

    Like index-aligned series subtraction (a full outer join), a sensor seen
    in only one year gets a null difference; ``both_only`` applies the
    not-null mask (FLT-5).
    """
    m = year_matrix(counts, [year_a, year_b], ts_col)
    out = m.select(KEY, (F.col(_sum(year_a)) - F.col(_sum(year_b))).alias(MEASURE))
    return out.filter(F.col(MEASURE).isNotNull()) if both_only else out


def yearly_totals(counts: DataFrame, years, ts_col: str | None = None) -> DataFrame:
    """Sum per (year, sensor) for the listed years (AGG-3, FLT-1)."""
    return (_in_years(counts, years, ts_col)
            .groupBy("year", KEY).agg(F.sum(MEASURE).alias(MEASURE)))


def change_extremes(counts: DataFrame, years=(2020, 2021, 2022), ts_col: str | None = None) -> DataFrame:
    """Scalar max and min change as one row (AGG-4, AGG-5)."""
    change = period_change(counts, years, ts_col=ts_col)
    return change.agg(F.max(MEASURE).alias("max_change"), F.min(MEASURE).alias("min_change"))

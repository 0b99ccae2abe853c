"""The four product queries and the relational building blocks they use,
registered over the stand-in tables (SURVEY §7.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import change as ch
from ..operators.enrich import duplicate_keys, enrich, orphans, wide_enrich
from ..operators.rank import top_n_per_period
from ..sources import tables as tb
from . import sql as S
from .registry import query
from .reports import build_reports

TS = "date_time"  # the change stand-in derives year from this timestamp
Y0, Y1, Y2 = S.DECLINE_YEARS


def _top10_sql(keys: list[str]) -> str:
    k = ", ".join(keys)
    rk = ", ".join(f"r.{c}" for c in keys)
    return f"""
WITH c AS ({S.DAY_COUNTS}),
s AS ({S.DAY_SENSORS}),
t AS (SELECT {k}, sensor_id, SUM(hourly_counts) AS hourly_counts FROM c GROUP BY {k}, sensor_id),
r AS (SELECT *, row_number() OVER (PARTITION BY {k}
        ORDER BY hourly_counts DESC NULLS LAST, sensor_id ASC NULLS FIRST) AS rn FROM t)
SELECT {rk}, r.sensor_id, CAST(r.hourly_counts AS BIGINT) AS hourly_counts,
       s.sensor_description, s.sensor_name
FROM r LEFT JOIN s ON r.sensor_id = s.sensor_id
WHERE r.rn <= 10
"""


@query("top10_per_day", _top10_sql(["year", "month", "mdate"]))
def top10_per_day(spark, sf_dir):
    return top_n_per_period(tb.day_counts(spark, sf_dir), tb.day_sensors(spark, sf_dir),
                            period="day", n=10)


@query("top10_per_month", _top10_sql(["year", "month"]))
def top10_per_month(spark, sf_dir):
    return top_n_per_period(tb.day_counts(spark, sf_dir), tb.day_sensors(spark, sf_dir),
                            period="month", n=10)


def _extremum_sql(years, agg: str) -> str:
    return f"""
WITH {S.change_cte(years)},
s AS ({S.CHANGE_SENSORS})
SELECT ch.sensor_id, CAST(ch.d AS BIGINT) AS hourly_counts, s.sensor_description, s.sensor_name
FROM ch LEFT JOIN s ON ch.sensor_id = s.sensor_id
WHERE ch.d = (SELECT {agg}(d) FROM ch)
"""


@query("most_decline", _extremum_sql(S.DECLINE_YEARS, "max"))
def most_decline(spark, sf_dir):
    return ch.most_decline(tb.change_counts(spark, sf_dir), tb.change_sensors(spark, sf_dir),
                           years=S.DECLINE_YEARS, ts_col=TS)


@query("most_growth", _extremum_sql(S.GROWTH_YEARS, "min"))
def most_growth(spark, sf_dir):
    return ch.most_growth(tb.change_counts(spark, sf_dir), tb.change_sensors(spark, sf_dir),
                          years=S.GROWTH_YEARS, ts_col=TS)


@query("change_table", f"""
WITH {S.change_cte(S.DECLINE_YEARS)}
SELECT sensor_id, CAST(d AS BIGINT) AS hourly_counts, basis FROM ch
""")
def change_table(spark, sf_dir):
    return ch.period_change(tb.change_counts(spark, sf_dir), S.DECLINE_YEARS, ts_col=TS)


@query("growth_change_table", f"""
WITH {S.change_cte(S.GROWTH_YEARS)}
SELECT sensor_id, CAST(d AS BIGINT) AS hourly_counts, basis FROM ch
""")
def growth_change_table(spark, sf_dir):
    return ch.period_change(tb.change_counts(spark, sf_dir), S.GROWTH_YEARS, ts_col=TS)


@query("only_first_pair", f"""
WITH {S.change_cte(S.DECLINE_YEARS)}
SELECT sensor_id FROM p{Y0}_{Y1} x
WHERE NOT EXISTS (SELECT 1 FROM p{Y0}_{Y2} z WHERE z.sensor_id = x.sensor_id)
""")
def only_first_pair(spark, sf_dir):
    return ch.present_only(tb.change_counts(spark, sf_dir), present=(Y0, Y1), absent=(Y2,), ts_col=TS)


@query("only_second_pair", f"""
WITH {S.change_cte(S.DECLINE_YEARS)}
SELECT sensor_id FROM p{Y1}_{Y2} x
WHERE NOT EXISTS (SELECT 1 FROM p{Y0}_{Y2} z WHERE z.sensor_id = x.sensor_id)
""")
def only_second_pair(spark, sf_dir):
    return ch.present_only(tb.change_counts(spark, sf_dir), present=(Y1, Y2), absent=(Y0,), ts_col=TS)


@query("missing_keys", f"""
WITH {S.yearly_cte(S.DECLINE_YEARS)}
SELECT sensor_id FROM y{Y0}
EXCEPT
SELECT sensor_id FROM y{Y2}
""")
def missing_keys(spark, sf_dir):
    return ch.present_only(tb.change_counts(spark, sf_dir), present=(Y0,), absent=(Y2,), ts_col=TS)


@query("aligned_difference", f"""
WITH {S.yearly_cte((Y0, Y2))}
SELECT COALESCE(y{Y0}.sensor_id, y{Y2}.sensor_id) AS sensor_id,
       CAST(y{Y0}.v - y{Y2}.v AS BIGINT) AS hourly_counts
FROM y{Y0} FULL OUTER JOIN y{Y2} ON y{Y0}.sensor_id = y{Y2}.sensor_id
""")
def aligned_difference(spark, sf_dir):
    return ch.aligned_difference(tb.change_counts(spark, sf_dir), Y0, Y2, ts_col=TS)


@query("aligned_difference_present", f"""
WITH {S.yearly_cte((Y0, Y2))}
SELECT sensor_id, hourly_counts FROM (
  SELECT COALESCE(y{Y0}.sensor_id, y{Y2}.sensor_id) AS sensor_id,
         CAST(y{Y0}.v - y{Y2}.v AS BIGINT) AS hourly_counts
  FROM y{Y0} FULL OUTER JOIN y{Y2} ON y{Y0}.sensor_id = y{Y2}.sensor_id)
WHERE hourly_counts IS NOT NULL
""")
def aligned_difference_present(spark, sf_dir):
    return ch.aligned_difference(tb.change_counts(spark, sf_dir), Y0, Y2, both_only=True, ts_col=TS)


@query("yearly_totals", f"""
WITH c AS ({S.CHANGE_COUNTS})
SELECT year, sensor_id, CAST(SUM(hourly_counts) AS BIGINT) AS hourly_counts
FROM c WHERE year IN ({Y0}, {Y1}, {Y2}) AND sensor_id IS NOT NULL
GROUP BY year, sensor_id
""")
def yearly_totals(spark, sf_dir):
    return ch.yearly_totals(tb.change_counts(spark, sf_dir), S.DECLINE_YEARS, ts_col=TS)


@query("year_pivot", f"""
WITH c AS ({S.CHANGE_COUNTS})
SELECT sensor_id,
       CAST(SUM(hourly_counts) FILTER (WHERE year = {Y0}) AS BIGINT) AS y{Y0},
       CAST(SUM(hourly_counts) FILTER (WHERE year = {Y1}) AS BIGINT) AS y{Y1},
       CAST(SUM(hourly_counts) FILTER (WHERE year = {Y2}) AS BIGINT) AS y{Y2}
FROM c WHERE year IN ({Y0}, {Y1}, {Y2}) AND sensor_id IS NOT NULL
GROUP BY sensor_id
""")
def year_pivot(spark, sf_dir):
    m = ch.year_matrix(tb.change_counts(spark, sf_dir), S.DECLINE_YEARS, ts_col=TS)
    return m.select("sensor_id", *[f"y{y}" for y in S.DECLINE_YEARS])


@query("semi_lookup", f"""
WITH {S.change_cte(S.DECLINE_YEARS)}
SELECT sensor_id, CAST(v AS BIGINT) AS hourly_counts FROM y{Y0}
WHERE sensor_id IN (
  SELECT sensor_id FROM p{Y0}_{Y1} x
  WHERE NOT EXISTS (SELECT 1 FROM p{Y0}_{Y2} z WHERE z.sensor_id = x.sensor_id))
""")
def semi_lookup(spark, sf_dir):
    counts = tb.change_counts(spark, sf_dir)
    keys = ch.present_only(counts, present=(Y0, Y1), absent=(Y2,), ts_col=TS)
    year0 = ch.yearly_totals(counts, [Y0], ts_col=TS).drop("year")
    return year0.join(keys, on="sensor_id", how="left_semi")


@query("change_extremes", f"""
WITH {S.change_cte(S.DECLINE_YEARS)}
SELECT CAST(max(d) AS BIGINT) AS max_change, CAST(min(d) AS BIGINT) AS min_change FROM ch
""")
def change_extremes(spark, sf_dir):
    return ch.change_extremes(tb.change_counts(spark, sf_dir), S.DECLINE_YEARS, ts_col=TS)


@query("first_extremum", f"""
WITH {S.change_cte(S.DECLINE_YEARS)},
s AS ({S.CHANGE_SENSORS})
SELECT x.sensor_id, CAST(x.d AS BIGINT) AS hourly_counts, s.sensor_description, s.sensor_name
FROM (SELECT * FROM ch WHERE d IS NOT NULL ORDER BY d DESC, sensor_id ASC LIMIT 1) x
LEFT JOIN s ON x.sensor_id = s.sensor_id
""")
def first_extremum(spark, sf_dir):
    return ch.most_decline(tb.change_counts(spark, sf_dir), tb.change_sensors(spark, sf_dir),
                           years=S.DECLINE_YEARS, ties="first", ts_col=TS)


@query("wide_enrich", f"""
WITH {S.change_cte(S.DECLINE_YEARS)},
s AS ({S.CHANGE_SENSORS_WIDE})
SELECT ch.sensor_id, CAST(ch.d AS BIGINT) AS hourly_counts, ch.basis,
       s.sensor_description, s.sensor_name, s.installation_date, s.status, s.note,
       s.direction_1, s.direction_2, s.latitude, s.longitude, s.location
FROM ch LEFT JOIN s ON ch.sensor_id = s.sensor_id
""")
def wide_enrich_q(spark, sf_dir):
    change = ch.period_change(tb.change_counts(spark, sf_dir), S.DECLINE_YEARS, ts_col=TS)
    return wide_enrich(change, tb.change_sensors(spark, sf_dir))


@query("orphan_keys", f"""
WITH r AS ({_top10_sql(["year", "month", "mdate"])}),
s AS ({S.DAY_SENSORS})
SELECT DISTINCT sensor_id FROM r
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.sensor_id = r.sensor_id)
""")
def orphan_keys(spark, sf_dir):
    sensors = tb.day_sensors(spark, sf_dir)
    result = top_n_per_period(tb.day_counts(spark, sf_dir), sensors, period="day", ordered=False)
    return orphans(result, sensors)


@query("decline_orphans", f"""
WITH {S.change_cte(S.DECLINE_YEARS)},
s AS ({S.CHANGE_SENSORS})
SELECT DISTINCT sensor_id FROM ch
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.sensor_id = ch.sensor_id)
""")
def decline_orphans(spark, sf_dir):
    change = ch.period_change(tb.change_counts(spark, sf_dir), S.DECLINE_YEARS, ts_col=TS)
    return orphans(change, tb.change_sensors(spark, sf_dir))


@query("duplicate_keys", f"""
WITH s AS ({S.CHANGE_SENSORS})
SELECT sensor_id, count(*) AS copies FROM s GROUP BY sensor_id HAVING count(*) > 1
""")
def duplicate_keys_q(spark, sf_dir):
    return duplicate_keys(tb.change_sensors(spark, sf_dir))


@query("frame_size", f"""
WITH c AS ({S.DAY_COUNTS})
SELECT count(*) AS n_rows, CAST(10 AS INTEGER) AS n_columns FROM c
""")
def frame_size(spark, sf_dir):
    counts = tb.day_counts(spark, sf_dir)
    return counts.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.lit(len(counts.columns)).cast("int").alias("n_columns"))


@query("head_n", f"""
WITH c AS ({S.CHANGE_COUNTS})
SELECT id, year, sensor_id, hourly_counts FROM c ORDER BY id LIMIT 20
""")
def head_n(spark, sf_dir):
    counts = tb.change_counts(spark, sf_dir)
    return counts.select("id", "year", "sensor_id", "hourly_counts").orderBy("id").limit(20)


@query("mixed_sort", f"""
WITH c AS ({S.CHANGE_COUNTS})
SELECT year, sensor_id, CAST(SUM(hourly_counts) AS BIGINT) AS hourly_counts
FROM c WHERE year IN ({Y0}, {Y1}, {Y2}) AND sensor_id IS NOT NULL
GROUP BY year, sensor_id
ORDER BY year ASC, hourly_counts DESC, sensor_id ASC
""")
def mixed_sort(spark, sf_dir):
    totals = ch.yearly_totals(tb.change_counts(spark, sf_dir), S.DECLINE_YEARS, ts_col=TS)
    return totals.orderBy(F.col("year").asc(), F.col("hourly_counts").desc(), F.col("sensor_id").asc())


@query("top10_per_month_shuffle_join", f"""
WITH r AS ({_top10_sql(["year", "month"])})
SELECT year, month, sensor_id, hourly_counts, sensor_description, sensor_name FROM r
""")
def top10_per_month_shuffle_join(spark, sf_dir):
    # Same answer as top10_per_month, but the join is forced to a shuffle
    # join: the result must not depend on the physical join choice.
    totals = top_n_per_period(tb.day_counts(spark, sf_dir), None, period="month", ordered=False)
    return enrich(totals, tb.day_sensors(spark, sf_dir), broadcast=False)


@query("customer_orphans", f"""
WITH c AS ({S.CHANGE_COUNTS}),
s AS ({S.DAY_SENSORS})
SELECT DISTINCT sensor_id FROM c
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.sensor_id = c.sensor_id)
""")
def customer_orphans(spark, sf_dir):
    """Keys of one fact table against the dimension of another: most of them are orphans."""
    return orphans(tb.change_counts(spark, sf_dir), tb.day_sensors(spark, sf_dir))


@query("duplicate_event_keys", """
SELECT CAST(user_id AS VARCHAR) AS sensor_id, count(*) AS copies
FROM events GROUP BY user_id HAVING count(*) > 1
""")
def duplicate_event_keys(spark, sf_dir):
    """A key column that repeats: every event's user as if it were a dimension key."""
    return duplicate_keys(tb.event_counts(spark, sf_dir))


def _reports(spark, sf_dir, which: str):
    """The report job's answer: from day totals written once (``build_reports``)."""
    ranked = which.startswith("top10")
    counts, sensors = (tb.day_counts, tb.day_sensors) if ranked else (tb.change_counts, tb.change_sensors)
    return build_reports(counts(spark, sf_dir), sensors(spark, sf_dir),
                         decline_years=S.DECLINE_YEARS, growth_years=S.GROWTH_YEARS)[which]


@query("report_top10_per_day", _top10_sql(["year", "month", "mdate"]))
def report_top10_per_day(spark, sf_dir):
    return _reports(spark, sf_dir, "top10_per_day")


@query("report_top10_per_month", _top10_sql(["year", "month"]))
def report_top10_per_month(spark, sf_dir):
    return _reports(spark, sf_dir, "top10_per_month")


@query("report_most_decline", _extremum_sql(S.DECLINE_YEARS, "max"))
def report_most_decline(spark, sf_dir):
    return _reports(spark, sf_dir, "most_decline")


@query("report_most_growth", _extremum_sql(S.GROWTH_YEARS, "min"))
def report_most_growth(spark, sf_dir):
    return _reports(spark, sf_dir, "most_growth")

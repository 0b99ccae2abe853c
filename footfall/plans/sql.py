"""DuckDB oracle building blocks: the stand-in mappings written as SQL.

They mirror ``footfall.sources.tables`` column for column, with explicit
casts so types agree (DuckDB ``year()`` is BIGINT and ``sum(bigint)`` is
HUGEINT; Spark gives INT and BIGINT).
"""

# Stand-in year sets for the change queries.
DECLINE_YEARS = (1998, 1999, 2000)
GROWTH_YEARS = (1999, 2000)

DAY_COUNTS = """
SELECT format('{}-{}', l_orderkey, l_linenumber) AS id,
       CAST(year(l_shipdate) AS INTEGER) AS year,
       strftime(l_shipdate, '%m') AS month,
       CAST(day(l_shipdate) AS INTEGER) AS mdate,
       CAST(l_suppkey AS VARCHAR) AS sensor_id,
       CAST(round(l_quantity) AS BIGINT) AS hourly_counts
FROM lineitem
"""

DAY_SENSORS = """
SELECT CAST(s_suppkey AS VARCHAR) AS sensor_id,
       'supplier in nation ' || CAST(s_nationkey AS VARCHAR) AS sensor_description,
       s_name AS sensor_name
FROM supplier
"""

CHANGE_COUNTS = """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       o_orderdate AS date_time,
       CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(o_custkey AS VARCHAR) AS sensor_id,
       CAST(round(o_totalprice * 100) AS BIGINT) AS hourly_counts
FROM orders
"""

CHANGE_SENSORS = """
SELECT CAST(c_custkey AS VARCHAR) AS sensor_id,
       c_mktsegment AS sensor_description,
       c_name AS sensor_name
FROM customer
"""

CHANGE_SENSORS_WIDE = """
SELECT CAST(c_custkey AS VARCHAR) AS sensor_id,
       c_mktsegment AS sensor_description,
       c_name AS sensor_name,
       CAST(NULL AS VARCHAR) AS installation_date,
       CAST(NULL AS VARCHAR) AS status,
       CAST(NULL AS VARCHAR) AS note,
       CAST(NULL AS VARCHAR) AS direction_1,
       CAST(NULL AS VARCHAR) AS direction_2,
       CAST(NULL AS VARCHAR) AS latitude,
       CAST(NULL AS VARCHAR) AS longitude,
       'nation ' || CAST(c_nationkey AS VARCHAR) AS location
FROM customer
"""

EVENT_RECORDS = """
SELECT CAST(event_id AS VARCHAR) AS id,
       ts AS date_time,
       CAST(year(ts) AS INTEGER) AS year,
       strftime(ts, '%m') AS month,
       CAST(day(ts) AS INTEGER) AS mdate,
       CAST(hour(ts) AS INTEGER) AS time,
       CAST(user_id AS VARCHAR) AS sensor_id,
       event_type AS sensor_name,
       CAST(round(value * 100) AS BIGINT) AS hourly_counts
FROM events
"""


def yearly_cte(years) -> str:
    """CTEs ``t`` (year, sensor, sum) and ``y<year>`` per year, join form."""
    ys = ", ".join(str(y) for y in years)
    parts = [
        f"c AS ({CHANGE_COUNTS})",
        f"t AS (SELECT year, sensor_id, SUM(hourly_counts) AS v FROM c "
        f"WHERE year IN ({ys}) AND sensor_id IS NOT NULL GROUP BY year, sensor_id)",
    ]
    for y in years:
        parts.append(f"y{y} AS (SELECT sensor_id, v FROM t WHERE year = {y})")
    return ",\n".join(parts)


def pair_cte(a: int, b: int) -> str:
    return (f"p{a}_{b} AS (SELECT y{a}.sensor_id, y{a}.v - y{b}.v AS d, '{a}-{b}' AS basis "
            f"FROM y{a} JOIN y{b} ON y{a}.sensor_id = y{b}.sensor_id)")


def change_cte(years) -> str:
    """CTE ``ch`` (sensor_id, d, basis) in the reference's join/anti/union form."""
    if len(years) == 2:
        a, b = years
        return f"{yearly_cte(years)},\n{pair_cte(a, b)},\nch AS (SELECT * FROM p{a}_{b})"
    a, b, c = years
    return f"""{yearly_cte(years)},
{pair_cte(a, c)},
{pair_cte(a, b)},
{pair_cte(b, c)},
ch AS (
  SELECT * FROM p{a}_{c}
  UNION ALL
  SELECT * FROM p{a}_{b} x WHERE NOT EXISTS (SELECT 1 FROM p{a}_{c} z WHERE z.sensor_id = x.sensor_id)
  UNION ALL
  SELECT * FROM p{b}_{c} x WHERE NOT EXISTS (SELECT 1 FROM p{a}_{c} z WHERE z.sensor_id = x.sensor_id)
)"""

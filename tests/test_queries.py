"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver does the same at sf0.01)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from footfall.plans import catalog
from tools.oracle_check import canon

from .conftest import SF_SMALL

NAMES = sorted(catalog.QUERIES)


def test_every_query_has_an_oracle_or_is_listed():
    # Only genuinely non-SQL queries may lack an oracle.
    missing = set(catalog.QUERIES) - set(catalog.ORACLE_SQL)
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "mdate", "sensor_id", "hourly_counts",
                          "sensor_description", "sensor_name"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, rows) == canon(cols, res.fetchall())

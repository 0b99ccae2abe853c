"""Each registered query of the subpackage on a small table, against its SQL where it has one."""

from __future__ import annotations

import pytest

from footfall.llm import queries
from tools.oracle_check import canon

SF = "/root/testdata/sf0.001"

TABLE = {"op1_revisits": ("pages", 2), "op3_page_difference": ("pages", 1)}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    table, times = TABLE.get(name, ("documents", 1))
    if name != "op11_collocations":  # rows of phrases
        assert len(rows) == times * spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name in queries.ORACLE_SQL:
        res = duck.execute(queries.ORACLE_SQL[name])
        cols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(cols)
        assert canon(df.columns, rows) == canon(cols, res.fetchall())


def test_entry_holds_them():
    import __spark_entry__ as entry

    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE_SQL) <= set(entry.oracle_sql())

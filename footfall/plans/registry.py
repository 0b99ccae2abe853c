"""Registry of named queries over the stand-in tables.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` and may carry an
equivalent DuckDB SQL text (the oracle) that the correctness gate runs on
the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL text."""

    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return wrap

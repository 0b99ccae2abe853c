"""Stand-in adapters: map the provided parquet tables onto the count model.

The reference ships no data, so the driver's tables play its roles:

* ``lineitem`` -> counts for ranking (ship date, supplier, integral quantity)
* ``supplier`` -> sensors for ranking
* ``orders``   -> counts for the change queries (order date, customer, cents)
* ``customer`` -> sensors for the change queries
* ``events``   -> message records (id, time, user, value)

Each adapter is a projection only, so column pruning and filter pushdown
reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SENSOR_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _counts(ts, sensor, measure, ident, name=None) -> list:
    t = F.col(ts).cast("timestamp")
    return [
        ident.alias("id"),
        t.alias("date_time"),
        F.year(ts).alias("year"),
        F.lpad(F.month(ts).cast("string"), 2, "0").alias("month"),
        F.dayofmonth(ts).alias("mdate"),
        F.date_format(t, "EEEE").alias("day"),
        F.hour(ts).alias("time"),
        F.col(sensor).cast("string").alias("sensor_id"),
        (F.lit(None).cast("string") if name is None else F.col(name)).alias("sensor_name"),
        measure.alias("hourly_counts"),
    ]


def counts_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(*_counts(
        "l_shipdate", "l_suppkey",
        F.round("l_quantity").cast("bigint"),
        F.format_string("%d-%d", "l_orderkey", "l_linenumber"),
    ))


def counts_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(*_counts(
        "o_orderdate", "o_custkey",
        F.round(F.col("o_totalprice") * 100).cast("bigint"),
        F.col("o_orderkey").cast("string"),
    ))


def counts_from_events(events: DataFrame) -> DataFrame:
    return events.select(*_counts(
        "ts", "user_id",
        F.round(F.col("value") * 100).cast("bigint"),
        F.col("event_id").cast("string"),
        name="event_type",
    ))


def _sensors(key: str, description, name: str, nation: str) -> DataFrame:
    values = {
        "sensor_id": F.col(key).cast("string"),
        "sensor_description": description,
        "sensor_name": F.col(name),
        "location": F.concat(F.lit("nation "), F.col(nation).cast("string")),
    }
    return [values.get(c, F.lit(None).cast("string")).alias(c) for c in SENSOR_COLUMNS]


def sensors_from_supplier(supplier: DataFrame) -> DataFrame:
    return supplier.select(*_sensors(
        "s_suppkey",
        F.concat(F.lit("supplier in nation "), F.col("s_nationkey").cast("string")),
        "s_name", "s_nationkey",
    ))


def sensors_from_customer(customer: DataFrame) -> DataFrame:
    return customer.select(*_sensors("c_custkey", F.col("c_mktsegment"), "c_name", "c_nationkey"))


def day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_from_lineitem(table(spark, sf_dir, "lineitem"))


def day_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors_from_supplier(table(spark, sf_dir, "supplier"))


def change_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_from_orders(table(spark, sf_dir, "orders"))


def change_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors_from_customer(table(spark, sf_dir, "customer"))


def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts_from_events(table(spark, sf_dir, "events"))

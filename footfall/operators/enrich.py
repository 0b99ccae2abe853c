"""Dimension enrichment and integrity checks (JN-1, JN-2, JN-6, Q-7, T20).

The join is left to the planner: Spark's statistics and AQE broadcast the
dimension if it is within ``spark.sql.autoBroadcastJoinThreshold``. The caller
may ask for one form (``broadcast=True`` or ``False``). No job runs here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "sensor_id"
ENRICH_COLUMNS = ("sensor_description", "sensor_name")


def dimension_side(sensors: DataFrame, columns, broadcast: bool | None = None) -> DataFrame:
    """The projected dimension, hinted only if the caller decides."""
    dim = sensors.select(KEY, *[c for c in columns if c != KEY])
    if broadcast is None:
        return dim
    return F.broadcast(dim) if broadcast else dim.hint("merge")


def enrich(result: DataFrame, sensors: DataFrame, columns=ENRICH_COLUMNS,
           broadcast: bool | None = None) -> DataFrame:
    """Left join ``result`` to the dimension on sensor_id (JN-1).

    Columns of ``result`` that clash with requested dimension columns are
    replaced by the dimension's (JN-2 clash rule). Unknown sensors keep their
    row with null attributes; a duplicated dimension key fans out (see
    ``duplicate_keys``).
    """
    columns = [c for c in columns if c != KEY]
    left = result.drop(*[c for c in columns if c in result.columns])
    joined = left.join(dimension_side(sensors, columns, broadcast), on=KEY, how="left")
    return joined.select(*left.columns, *columns)  # keep the result's column order


def wide_enrich(result: DataFrame, sensors: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """Enrich with every dimension column (JN-2)."""
    return enrich(result, sensors, columns=[c for c in sensors.columns if c != KEY],
                  broadcast=broadcast)


def orphans(result: DataFrame, sensors: DataFrame) -> DataFrame:
    """Distinct result keys missing from the dimension (Q-7, JN-6, SET-4).

    Empty means the result is referentially intact. Null keys are orphans too:
    they can never match a dimension row.
    """
    keys = result.select(KEY).distinct()
    return keys.join(sensors.select(KEY), on=KEY, how="left_anti")


def is_subset(result: DataFrame, sensors: DataFrame) -> bool:
    """The reference's integrity assertion: every result key is a sensor."""
    return orphans(result, sensors).isEmpty()


def duplicate_keys(sensors: DataFrame) -> DataFrame:
    """Dimension keys that occur more than once (T20): must be empty."""
    return (sensors.groupBy(KEY).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))

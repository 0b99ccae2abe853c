"""Schemas of the sensor-count data model.

Raw schemas are all-string on purpose: numbers may arrive quoted or bare, and
timestamps/month names as text. Typing happens afterwards with ``try_cast`` /
``try_to_timestamp`` so that ANSI mode never aborts a whole job on one bad row.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Dimension columns, in file order.
SENSOR_COLUMNS = [
    "sensor_id",
    "sensor_description",
    "sensor_name",
    "installation_date",
    "status",
    "note",
    "direction_1",
    "direction_2",
    "latitude",
    "longitude",
    "location",
]

# Count record fields as delivered by the paged API / JSON files.
COUNT_JSON_COLUMNS = [
    "date_time",
    "day",
    "hourly_counts",
    "id",
    "mdate",
    "month",
    "sensor_id",
    "sensor_name",
    "time",
    "year",
]

# Count CSV header, in file order.
COUNT_CSV_COLUMNS = [
    "ID",
    "Date_Time",
    "Year",
    "Month",
    "Mdate",
    "Day",
    "Time",
    "Sensor_ID",
    "Sensor_Name",
    "Hourly_Counts",
]


def _all_strings(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


SENSOR_SCHEMA = _all_strings(SENSOR_COLUMNS)
RAW_COUNT_JSON_SCHEMA = _all_strings(COUNT_JSON_COLUMNS)
RAW_COUNT_CSV_SCHEMA = _all_strings(COUNT_CSV_COLUMNS)

# One message value = one page = a JSON array of count records.
PAGE_SCHEMA = ArrayType(RAW_COUNT_JSON_SCHEMA)

# Canonical, typed fact table every operator consumes.
COUNTS_SCHEMA = StructType(
    [
        StructField("id", StringType(), True),
        StructField("date_time", TimestampType(), True),
        StructField("year", IntegerType(), True),
        StructField("month", StringType(), True),  # two-digit 'MM'
        StructField("mdate", IntegerType(), True),  # day of month
        StructField("day", StringType(), True),  # weekday name
        StructField("time", IntegerType(), True),  # hour of day
        StructField("sensor_id", StringType(), True),
        StructField("sensor_name", StringType(), True),
        StructField("hourly_counts", LongType(), True),
    ]
)
COUNT_COLUMNS = [f.name for f in COUNTS_SCHEMA.fields]

# The feed's default topic name.
DEFAULT_TOPIC = "get-data"

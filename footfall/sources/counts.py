"""Readers for the sensor dimension and the hourly count facts
(SRC-1 .. SRC-4, SRC-8) and the normaliser every reader ends in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.messages import decode_page, page_rows
from ..functions.time import month_name_to_mm, parse_date_time
from ..functions.values import clean_key, try_int, try_long
from ..schemas import (
    COUNT_COLUMNS,
    COUNT_JSON_COLUMNS,
    PAGE_SCHEMA,
    RAW_COUNT_CSV_SCHEMA,
    SENSOR_COLUMNS,
    SENSOR_SCHEMA,
)
from ..session import shared_dir


def read_sensors(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Sensor dimension from CSV with a header (SRC-1).

    ``enforceSchema=False`` makes Spark validate the header against the
    schema instead of binding columns by position, so a reordered file fails
    loudly instead of silently swapping columns.
    """
    return (
        spark.read.schema(SENSOR_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
        .withColumn("sensor_id", clean_key("sensor_id"))
    )


def _month(text):
    """A month name, or its number as in tables that were normalised before, -> MM."""
    digits = F.when(text.rlike("^(0?[1-9]|1[0-2])$"), F.lpad(text, 2, "0"))
    return F.coalesce(month_name_to_mm(text), digits)


def normalize_counts(raw: DataFrame, keep=()) -> DataFrame:
    """Raw (text) count records -> the canonical typed fact table.

    Accepts any frame carrying the lower-case feed fields; missing ones become
    null. Bad timestamps, month names and numbers become null (ANSI-safe).
    ``keep`` names extra columns (e.g. message provenance) carried through.
    """
    present = {c.lower(): c for c in raw.columns}

    def field(name: str):
        return F.col(present[name]) if name in present else F.lit(None).cast("string")

    return raw.select(
        field("id").cast("string").alias("id"),
        parse_date_time(field("date_time").cast("string")).alias("date_time"),
        try_int(field("year")).alias("year"),
        _month(field("month").cast("string")).alias("month"),
        try_int(field("mdate")).alias("mdate"),
        field("day").cast("string").alias("day"),
        try_int(field("time")).alias("time"),
        clean_key(field("sensor_id")).alias("sensor_id"),
        field("sensor_name").cast("string").alias("sensor_name"),
        try_long(field("hourly_counts")).alias("hourly_counts"),
        *[F.col(c) for c in keep],
    )


#: Where a reject comes from and what it says.
REJECT_COLUMNS = ["file", "text"]
_CORRUPT = "_corrupt_record"


def _csv_rows(spark: SparkSession, path: str | list[str], infer: bool) -> DataFrame:
    """Text fields of a CSV, and ``file`` and the line in ``text`` where it has too few or too many fields.

    Every column is parsed whatever is selected later: with pruning, a line
    would be bad or good depending on the query. ``file`` is no metadata column:
    the scan would copy every row once more to append it.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnPruning", False)
    schema = RAW_COUNT_CSV_SCHEMA
    if infer:
        schema = reader.option("inferSchema", True).csv(path).schema
    schema = StructType([*schema.fields, StructField(_CORRUPT, StringType(), True)])
    raw = reader.schema(schema).option("enforceSchema", False).option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    # In the form of _metadata.file_path.
    file = F.when(F.col(_CORRUPT).isNotNull(), F.replace(F.input_file_name(), F.lit(":///"), F.lit(":/")))
    return raw.select(*(F.col(f.name).alias(f.name.lower()) for f in schema.fields[:-1]), file.alias("file"), F.col(_CORRUPT).alias("text"))


def _json_pages(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    """``file``, ``text`` and its records in ``page`` (null if it can't be decoded); a file or a line may hold an array or one object."""
    lines = spark.read.text(path, wholetext=multi_line).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    lines = lines.filter(~F.col("text").rlike(r"\A\s*\z"))
    array = F.when(F.col("text").rlike(r"\A\s*\{"), F.concat(F.lit("["), "text", F.lit("]"))).otherwise(F.col("text"))
    return lines.withColumn("page", decode_page(array))


def _split(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects of one scan: written once, with a flag, and read twice.

    The flag is a plain column: a folder per value would sort the rows of each
    task by it. Of a reject only ``REJECT_COLUMNS`` are written.
    """
    path = shared_dir(rows.sparkSession, name)
    rejected = F.col("text").isNotNull()
    kept = [F.col(c) if c in REJECT_COLUMNS else F.when(~rejected, F.col(c)).alias(c) for c in rows.columns]
    flagged = rows.select(*kept, rejected.alias("rejected"))
    flagged.write.parquet(path)
    kept = rows.sparkSession.read.schema(flagged.schema).parquet(path)
    return kept.filter(~F.col("rejected")), kept.filter("rejected").select(*REJECT_COLUMNS)


def _malformed() -> Column:
    """An error that names the file of a bad record."""
    return F.raise_error(F.concat(F.lit("malformed record in "), "file", F.lit(": "), F.substring("text", 1, 80)))


def read_counts_csv(spark: SparkSession, path: str | list[str], infer: bool = False, malformed: str = "raise") -> DataFrame:
    """Count facts from CSV with a header (SRC-2; ``infer=True`` is SRC-4).

    The explicit all-string schema is the default: inference costs a full
    extra pass over the input and guesses types per file. A line with too few
    or too many fields fails the query, or is left out with
    ``malformed="reject"`` (``split_counts_csv`` gives such lines).
    """
    rows = _csv_rows(spark, path, infer)
    first = F.col(rows.columns[0]).cast("string")
    # Always true of the first field, which so is read too: Spark refuses to read the bad lines' column alone.
    good = F.col("text").isNull() & (first.isNull() | (F.length(first) >= 0))
    return normalize_counts(rows.filter(F.when(good, F.lit(True)).otherwise(_malformed().cast("boolean")) if _raises(malformed) else good))


def read_counts_json(spark: SparkSession, path: str | list[str], multi_line: bool = True, malformed: str = "raise") -> DataFrame:
    """Count facts from JSON (SRC-3, SRC-8 for one object path).

    ``multi_line=True`` reads files that each hold one JSON array (a landed
    page) or one object, held whole by a task; ``False`` reads lines of either,
    which split across tasks. What is not whole fails the query, with the
    file's name, or is left out as a whole with ``malformed="reject"``
    (``split_counts_json`` gives it): no record of a cut file is lost silently.
    """
    pages = _json_pages(spark, path, multi_line)
    page = F.coalesce("page", _malformed().cast(PAGE_SCHEMA)) if _raises(malformed) else F.col("page")
    return normalize_counts(page_rows(pages, page))


def _raises(malformed: str) -> bool:
    if malformed not in ("raise", "reject"):
        raise ValueError("malformed must be 'raise' or 'reject'")
    return malformed == "raise"


def split_counts_csv(spark: SparkSession, path: str | list[str], infer: bool = False) -> tuple[DataFrame, DataFrame]:
    """Counts of the good lines, and the bad lines (file, text), from one scan."""
    good, rejects = _split(_csv_rows(spark, path, infer), "csv-read")
    return normalize_counts(good), rejects


def split_counts_json(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Counts of the good files or lines, and the bad ones (file, text), from one scan."""
    pages = _json_pages(spark, path, multi_line)
    good, rejects = _split(pages.withColumn("text", F.when(F.col("page").isNull(), F.col("text"))), "json-read")
    return normalize_counts(page_rows(good, F.col("page"))), rejects


__all__ = [
    "COUNT_COLUMNS",
    "COUNT_JSON_COLUMNS",
    "REJECT_COLUMNS",
    "SENSOR_COLUMNS",
    "normalize_counts",
    "read_counts_csv",
    "read_counts_json",
    "read_sensors",
    "split_counts_csv",
    "split_counts_json",
]

"""Date/time column functions (all JVM-side, codegen-friendly).

Every parse is a ``try_`` variant: under ANSI mode a single malformed value
would otherwise fail the whole job; here it becomes null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the count feed.
DATE_TIME_PATTERN = "MMMM dd, yyyy hh:mm:ss a"  # e.g. November 01, 2019 05:00:00 PM
MONTH_NAME_PATTERN = "MMMM"  # full English month name
MONTH_DIGITS_PATTERN = "MM"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date_time(col: Column | str) -> Column:
    """Long 12-hour text first, ISO-8601 text second, else null (FN-1)."""
    c = _c(col)
    return F.coalesce(
        F.try_to_timestamp(c, F.lit(DATE_TIME_PATTERN)),
        F.try_to_timestamp(c),
    )


def month_name_to_mm(col: Column | str) -> Column:
    """'January' -> '01'; junk or null -> null (FN-2)."""
    return F.date_format(F.try_to_timestamp(_c(col), F.lit(MONTH_NAME_PATTERN)),
                         MONTH_DIGITS_PATTERN)


def month_name_to_number(col: Column | str) -> Column:
    """'January' -> 1; junk or null -> null (FN-6)."""
    return F.month(F.try_to_timestamp(_c(col), F.lit(MONTH_NAME_PATTERN)))


def epoch_seconds(col: Column | str, pattern: str) -> Column:
    """Text -> seconds since epoch, null on a bad value (FN-3)."""
    return F.unix_timestamp(F.try_to_timestamp(_c(col), F.lit(pattern)))


def format_epoch(col: Column | str, pattern: str) -> Column:
    """Seconds since epoch -> text in the session zone (FN-4)."""
    return F.from_unixtime(_c(col), pattern)


def month_name_to_mm_via_epoch(col: Column | str) -> Column:
    """The epoch round trip of FN-2, kept for parity; equals ``month_name_to_mm``."""
    return format_epoch(epoch_seconds(col, MONTH_NAME_PATTERN), MONTH_DIGITS_PATTERN)


def to_day(col: Column | str) -> Column:
    """Timestamp -> date (FN-5)."""
    return F.to_date(_c(col))


def format_date_time(col: Column | str) -> Column:
    """Timestamp -> the feed's long text form (inverse of FN-1)."""
    return F.date_format(_c(col), DATE_TIME_PATTERN)


def year_window(ts_col: Column | str, years) -> Column:
    """``ts`` inside [min(years)-01-01, max(years)+1-01-01).

    ``year(ts) IN (...)`` is not pushed into a parquet scan, a plain range on
    the timestamp is, so callers whose year key is derived from ``ts`` add
    this predicate next to the year filter to get row-group skipping.
    """
    ys = sorted(int(y) for y in years)
    lo = F.make_timestamp_ntz(F.lit(ys[0]), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    hi = F.make_timestamp_ntz(F.lit(ys[-1] + 1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    c = _c(ts_col)
    return (c >= lo) & (c < hi)

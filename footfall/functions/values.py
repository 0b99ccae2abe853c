"""Safe value conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def try_int(col: Column | str) -> Column:
    """Quoted or bare integer text -> int, junk -> null."""
    return _c(col).cast("string").try_cast("int")


def try_long(col: Column | str) -> Column:
    """Quoted or bare integer text -> bigint, junk -> null."""
    return _c(col).cast("string").try_cast("bigint")


def clean_key(col: Column | str) -> Column:
    """Keys are strings; surrounding blanks are not part of a key."""
    return F.trim(_c(col).cast("string"))

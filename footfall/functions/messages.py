"""Message payload functions: a message value is one page, i.e. a JSON array
of count records (FN-8 .. FN-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..schemas import PAGE_SCHEMA


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decode_utf8(col: Column | str) -> Column:
    """Binary message bytes -> text (FN-12)."""
    return F.decode(_c(col), "UTF-8")


def encode_utf8(col: Column | str) -> Column:
    """Text -> binary message bytes (FN-12)."""
    return F.encode(_c(col), "UTF-8")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def decode_page(col: Column | str) -> Column:
    """JSON array text or bytes -> array<struct<all-string record>> (FN-8).

    Quoted and bare numbers both land as text; typing happens later with
    ``try_cast``. Of a key given twice the last value counts, as in most
    readers. A page that is no JSON array of objects, whole and with nothing
    after it, gives null, never some of its records: a page cut anywhere, two
    arrays in a row, a null or a number among the records, a bare object.
    Pages may be as long as a string may be; each is parsed once, as first
    element of an array whose second names the page's hash. Text that closes
    the array early, or goes on after it, can't bring that second element to
    its place.
    """
    # Casting binary to string decodes UTF-8; text passes through unchanged.
    text = _c(col).cast("string")

    def parsed(t: Column) -> Column:
        mark = F.xxhash64(t).cast("string")
        both = F.from_json(F.concat(F.lit("["), t, F.lit(',[{"id":"'), mark, F.lit('"}]]')), ArrayType(PAGE_SCHEMA), {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
        return _let(both, lambda p: F.when(
            (F.size(p) == 2) & (F.get(F.get(p, F.lit(1)), F.lit(0))["id"] == mark) & ~F.exists(F.get(p, F.lit(0)), lambda r: r.isNull()), F.get(p, F.lit(0))))

    return _let(text, parsed)


def strict_page(col: Column | str) -> Column:
    """``decode_page`` that raises on a malformed page."""
    start = F.substring(F.coalesce(_c(col).cast("string"), F.lit("null")), 1, 80)
    return F.coalesce(decode_page(col), F.raise_error(F.concat(F.lit("malformed page: "), start)).cast(PAGE_SCHEMA))


def page_records(col: Column | str) -> Column:
    """Generator: one row per record of a decoded page (FN-10); use in select."""
    return F.inline(_c(col))


def page_rows(pages: DataFrame, page: Column, *keep: str) -> DataFrame:
    """One row per record of the decoded pages, with the columns ``keep`` (FN-10); null and empty pages have none.

    The outer form of the generator: for the inner one the optimizer adds a
    filter on the generator's input, which would parse each page twice more.
    """
    rows = pages.select(*keep, F.posexplode_outer(page).alias("_at", "_record"))
    return rows.filter(F.col("_at").isNotNull()).select(*keep, "_record.*")


def encode_record(*cols: Column | str) -> Column:
    """Struct of the given columns; input to ``encode_page``."""
    return F.struct(*[_c(c) for c in cols])


def record_json(*cols: Column | str, pretty: bool = False) -> Column:
    """The given columns as one JSON object text; null fields are left out (FN-9)."""
    return F.to_json(encode_record(*cols), {"pretty": "true"} if pretty else {})


def encode_page(record: Column, pretty: bool = False) -> Column:
    """Aggregate: the records of a group as one JSON array text (FN-9).

    Used inside ``groupBy(page_key).agg(...)``: the page key must bound the
    page size, so a page never grows with the data. ``sinks.messages.encode_pages``
    makes pages without grouping.
    """
    opts = {"pretty": "true"} if pretty else {}
    return F.to_json(F.collect_list(record), opts)


def provenance_key(topic: Column | str, partition: Column | str, offset: Column | str) -> Column:
    """``topic-partition-offset``: a file-system-safe message id (FN-11).

    A colon separator would make the landed names unreadable by Hadoop path
    globbing, so a dash is used.
    """
    return F.format_string("%s-%d-%d", _c(topic), _c(partition), _c(offset))

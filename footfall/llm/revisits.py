"""Not-modified revisits of a web archive, resolved by an as-of join.

A revisit record ("server not modified") holds the headers of a 304 answer and
no body. It is resolved to the latest full response of the same canonical URL
captured strictly earlier. Its validators must agree with that response's:
entity tags if both have one (weak comparison), else modification dates. The
resolved record has the response's body and its headers, updated by those of
the 304 that a cache may take over: not hop-by-hop ones, not those that a
Connection header names, and none that describe the stored body.

The as-of join aggregates before it orders: captures are first reduced to one
row per (URL, instant) with map-side combining, so repeated captures of an
instant cost nothing. Instants are then ordered within (URL, time bucket), and
the last response of each bucket is carried to later ones over one row per
bucket. With whole-second dates a window group holds at most
``BUCKET_SECONDS`` rows however often a URL was captured.

Bodies are not moved: a resolved record names the record that holds its body.

Defined results: ``resolution`` is full (a response), resolved, mismatch
(validators differ), unverified (nothing to compare) or missing (no earlier
response). Equal instants: the response with the largest record_id counts. A
null URL or date matches nothing, and neither does a URL without scheme and
host (its canonical URL is null). Repeated records are answered each. Empty
tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a time bucket.
BUCKET_SECONDS = 6 * 3600

#: Headers that a 304 answer may not change in a stored response.
HOP_BY_HOP = ("connection", "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
OF_BODY = ("content-encoding", "content-length", "content-range", "content-type")

#: Query parameters that do not change a page.
_TRACKING = r"(?i)(utm_[a-z]+|ref|gclid|fbclid|sessionid)=[^&]*"

#: Columns of a record: headers are "name: value" lines.
RECORD_SCHEMA = "record_id string, url string, captured timestamp, kind string, headers array<string>, body_digest string"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without its last slash, sorted query without tracking, no scheme or fragment."""
    rest = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"\?(.*)$", 1)
    asked = F.sort_array(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{_TRACKING}$")))
    return F.concat(host, path, F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&"))).otherwise(""))


def _key(url: Column) -> Column:
    """Canonical URL; null without scheme and host, so that such URLs match no other."""
    return F.when(F.trim(url).rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]"), canonical_url(url))


def _name(line: Column) -> Column:
    return F.lower(F.trim(F.substring_index(line, ":", 1)))


def _value(headers: Column, name: str) -> Column:
    line = F.try_element_at(F.filter(headers, lambda x: _name(x) == name), F.lit(-1))
    return F.nullif(F.trim(F.regexp_replace(line, r"^[^:]*:", "")), F.lit(""))


def _weak(tag: Column) -> Column:
    return F.regexp_replace(tag, r"^W/", "")


def merge_headers(stored: Column, update: Column) -> Column:
    """``stored`` headers with the permitted ones of ``update`` in place of those of the same name, sorted."""
    named = F.transform(F.split(F.coalesce(_value(update, "connection"), F.lit("")), ","), lambda x: F.lower(F.trim(x)))
    banned = F.concat(F.array(*map(F.lit, HOP_BY_HOP + OF_BODY)), named)
    new = F.filter(update, lambda x: ~F.array_contains(banned, _name(x)))
    names = F.transform(new, _name)
    return F.sort_array(F.concat(F.filter(stored, lambda x: ~F.array_contains(names, _name(x))), new))


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Every record: record_id, canonical_url, captured, resolution, source_id, body_digest, headers.

    ``kind`` is "response" or "revisit"; ``source_id`` is the record that holds the body.
    """
    rec = records.select(
        "record_id", _key(F.col("url")).alias("canonical_url"), F.col("captured").cast("timestamp").alias("captured"),
        "kind", F.coalesce("headers", F.array().cast("array<string>")).alias("headers"), "body_digest")
    micros = F.unix_micros("captured")
    rec = rec.withColumn("t", micros).withColumn("bucket", F.floor(F.col("t") / F.lit(bucket_seconds * 1_000_000)))
    full = F.when(F.col("kind") == "response", F.struct("t", "record_id", "headers", "body_digest"))
    instants = rec.filter("canonical_url is not null and t is not null").groupBy("canonical_url", "bucket", "t").agg(F.max(full).alias("full"))
    in_bucket = Window.partitionBy("canonical_url", "bucket").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("canonical_url").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        instants.groupBy("canonical_url", "bucket").agg(F.max("full").alias("last"))
        .select("canonical_url", "bucket", F.max("last").over(earlier).alias("carried"))
    )
    as_of = (
        instants.withColumn("inside", F.max("full").over(in_bucket))
        .join(carried, ["canonical_url", "bucket"])
        .select("canonical_url", "t", F.coalesce("inside", "carried").alias("found"))
    )
    revisit = F.col("kind") == "revisit"
    joined = rec.filter(revisit).join(as_of, ["canonical_url", "t"], "left")
    has = F.col("found").isNotNull()
    found = F.col("found.headers")
    tag, tag0 = _value(F.col("headers"), "etag"), _value(found, "etag")
    day, day0 = _value(F.col("headers"), "last-modified"), _value(found, "last-modified")
    same = F.when(tag.isNotNull() & tag0.isNotNull(), _weak(tag) == _weak(tag0)).when(day.isNotNull() & day0.isNotNull(), day == day0)
    state = F.when(~has, "missing").when(same.isNull(), "unverified").when(same, "resolved").otherwise("mismatch")
    done = F.col("resolution") == "resolved"
    answered = joined.withColumn("resolution", state).select(
        "record_id", "canonical_url", "captured", "resolution",
        F.when(done, F.col("found.record_id")).alias("source_id"),
        F.when(done, F.col("found.body_digest")).alias("body_digest"),
        F.when(done, merge_headers(found, F.col("headers"))).otherwise(F.sort_array("headers")).alias("headers"))
    whole = rec.filter(~revisit | F.col("kind").isNull()).select(
        "record_id", "canonical_url", "captured", F.lit("full").alias("resolution"), F.col("record_id").alias("source_id"),
        "body_digest", F.sort_array("headers").alias("headers"))
    return whole.unionByName(answered)


def records_from_pages(pages: DataFrame) -> DataFrame:
    """Archive records for raw pages: a full response of each page, and a later revisit of it.

    The page number sets the dates and which validators the records carry:
    in turn the same tag, only a date, a weak tag, and a tag that has changed.
    """
    n = F.coalesce(F.col("page_id").cast("long"), F.lit(0))
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")), 256)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    at = F.lit(1_700_000_000) + n * 37
    modified = F.concat(F.lit("Last-Modified: day "), F.pmod(n, F.lit(97)).cast("string"))
    size = F.concat(F.lit("Content-Length: "), F.coalesce(F.octet_length("html"), F.lit(0)).cast("string"))
    turn = F.pmod(n, F.lit(4))
    response = F.array(F.concat(F.lit("ETag: "), tag), modified, size, F.lit("Content-Type: text/html"), F.lit("Cache-Control: max-age=60"))
    again = F.filter(F.array(
        F.when(turn == 0, F.concat(F.lit("ETag: "), tag)).when(turn == 2, F.concat(F.lit("etag: W/"), tag)).when(turn == 3, F.lit('ETag: "changed"')),
        modified, F.lit("Content-Length: 0"), F.lit("Cache-Control: max-age=3600"), F.lit("Connection: close, X-Trace"), F.lit("X-Trace: 1")), lambda x: x.isNotNull())
    both = F.array(
        F.struct(F.concat(F.lit("r"), n.cast("string")).alias("record_id"), F.timestamp_seconds(at).alias("captured"), F.lit("response").alias("kind"), response.alias("headers"), F.col("d").alias("body_digest")),
        F.struct(F.concat(F.lit("v"), n.cast("string")).alias("record_id"), F.timestamp_seconds(at + 86400 * 7).alias("captured"), F.lit("revisit").alias("kind"), again.alias("headers"), F.lit(None).cast("string").alias("body_digest")))
    return pages.withColumn("d", digest).select("url", F.explode(both).alias("r")).select("r.record_id", "url", "r.captured", "r.kind", "r.headers", "r.body_digest")

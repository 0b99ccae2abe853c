"""Benchmark decontamination by winnowing.

Of every window of ``SPAN - GRAM + 1`` consecutive word k-grams the least hash
is kept (the rightmost of equal ones), in documents and in benchmark items.
Any shared run of ``SPAN`` words holds one such window whole, so both sides
keep the same gram of it: joining the kept grams misses no shared run. Each
match carries the words up to ``SPAN - GRAM`` to either side and is extended
word by word; a run of ``SPAN`` equal words or more is a hit. Items of fewer
words than ``SPAN`` have no guaranteed gram, so documents are scanned for all
runs of just those lengths.

Places of a text at which a gram has the same surroundings extend alike. They
are one entry on either side of the join, so a text of one repeated word (or of
a repeated phrase) gives a few entries, and two such texts a few matches, not
one for each pair of places. The places wait with their document.

A bitmap of fixed size (``FILTER_BITS``), filled from the benchmark's grams by
an aggregation, lets tasks drop grams that no item has before anything is
shuffled. Its false positives cost rows in the join, never results, and its
size does not grow with the benchmark.

Defined results: null and empty texts have no words, hit nothing and, as
items, are ignored. An item with a null id counts as item "". Repeated rows
are answered each on its own; repeated items count once. Empty tables give
an empty result (documents) or no hits (benchmark). Extra columns are ignored
by ``scan_hits`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, IDENTITY, gram_hashes, identity, mix, pieces, staged, text_key, utf8, with_identity, word_hashes, words

#: Contract value: words of a window. GRAM is free between 1 and SPAN.
SPAN, GRAM = 10, 5
#: Bits of the benchmark bitmap (one megabyte).
FILTER_BITS = 23

_GRAMS = "array<struct<span:int,fp:long,left:int,ctx:string,places:array<int>>>"
_GRAM_TYPE = pa.struct([("span", pa.int32()), ("fp", pa.int64()), ("left", pa.int32()), ("ctx", pa.string()), ("places", pa.list_(pa.int32()))])


def _winnow(g: np.ndarray, doc: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Places of the grams kept from every window of ``span`` words within one text."""
    first = np.flatnonzero(doc[span - 1:] == doc[: len(doc) - span + 1]) if len(doc) >= span else np.zeros(0, np.int64)
    at, best = first.copy(), g[first]
    for j in range(1, span - gram + 1):
        cand = g[first + j]
        less = cand <= best
        at[less], best[less] = first[less] + j, cand[less]
    return np.unique(at)


def _slot(fp: np.ndarray, span: int, bits: int) -> np.ndarray:
    return (mix(fp + np.uint64(span)) >> np.uint64(64 - bits)).astype(np.int64)


def _scan(column: pa.Array, lengths: tuple[int, ...], short_whole: bool, bitmap: np.ndarray | None,
          span: int, gram: int, bits: int) -> tuple[np.ndarray, pa.Array]:
    """Words of each text, and its kept grams with their surroundings.

    ``short_whole``: texts shorter than ``span`` give one run, their whole
    (items); otherwise all texts give every run of each of ``lengths``.
    """
    data, offs = utf8(column)
    n = len(column)
    starts, ends, doc = words(data, offs, ALNUM)
    h = word_hashes(data, starts, ends, fold=True)
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    g = gram_hashes(h, gram)
    at = _winnow(g, doc, span, gram)
    found.append((span, at, g[at]))
    for k in range(1, span) if short_whole else lengths:
        g = gram_hashes(h, k)
        if short_whole:
            at = first[count == k]
        else:
            at = np.flatnonzero(doc[k - 1:] == doc[: len(doc) - k + 1]) if len(doc) >= k else np.zeros(0, np.int64)
        found.append((k, at, g[at]))
    if bitmap is not None:
        found = [(k, at[hit], fp[hit]) for k, at, fp in found for hit in [_has(bitmap, _slot(fp, k, bits))]]
    spans = np.concatenate([np.full(len(at), k, np.int32) for k, at, _ in found])
    at = np.concatenate([at for _, at, _ in found])
    fps = np.concatenate([fp for _, _, fp in found])
    side = np.where(spans == span, span - gram, 0)
    size = np.where(spans == span, gram, spans)
    lo = np.maximum(at - side, first[doc[at]])
    hi = np.minimum(at + size + side, first[doc[at]] + count[doc[at]])
    raw = data.tobytes().lower()
    same: dict[tuple, list[int]] = {}
    for d, k, fp, left, p, a, b in zip(*(x.tolist() for x in (doc[at], spans, fps.view(np.int64), at - lo, at - first[doc[at]], lo, hi)), strict=True):
        ctx = b" ".join([raw[s:e] for s, e in zip(starts[a:b], ends[a:b], strict=True)])
        same.setdefault((d, k, fp, left, ctx), []).append(p)
    found_in = np.array([key[0] for key in same], np.int64)
    order = np.argsort(found_in, kind="stable")
    keys, places = list(same), list(same.values())
    keys, places = [keys[i] for i in order], [places[i] for i in order]
    flat = pa.StructArray.from_arrays(
        [pa.array([x[1] for x in keys], pa.int32()), pa.array([x[2] for x in keys], pa.int64()), pa.array([x[3] for x in keys], pa.int32()),
         pa.array([x[4].decode() for x in keys], pa.string()), pa.array(places, pa.list_(pa.int32()))], fields=list(_GRAM_TYPE))
    per = np.concatenate(([0], np.cumsum(np.bincount(found_in, minlength=n)))).astype(np.int32)
    return count, pa.ListArray.from_arrays(pa.array(per), flat)


def _has(bitmap: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bitmap[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) != 0


def _scanned(df: DataFrame, id_column: str, id_type: str, **how) -> DataFrame:
    bitmap = how.pop("bitmap", None)  # a Spark broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                n, grams = _scan(part.column("text"), bitmap=None if bitmap is None else np.frombuffer(bitmap.value, np.uint64), **how)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("text_key"), pa.array(n, pa.int64()), grams], names=["id", "text_key", "n_words", "grams"])

    text = F.col("text").cast("string")
    light = df.select(F.col(id_column).cast(id_type).alias("id"), text.alias("text"), text_key(text).alias("text_key"))
    return light.mapInArrow(run, f"id {id_type}, text_key long, n_words long, grams {_GRAMS}")


def _bitmap(grams: DataFrame, bits: int) -> bytes:
    """Bitmap of all item grams: at most 2 ** (bits - 6) aggregated words are collected."""
    words_ = np.zeros(1 << (bits - 6), np.uint64)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            span = batch.column("span").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            slot = np.zeros(len(fp), np.int64)
            for k in np.unique(span):
                slot[span == k] = _slot(fp[span == k], int(k), bits)
            yield pa.RecordBatch.from_arrays([pa.array(slot)], names=["slot"])

    cell = grams.select("span", "fp").mapInArrow(slots, "slot long").select(
        F.shiftright("slot", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit"))
    for r in cell.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        words_[r["word"]] = np.uint64(r["bits"] & 0xFFFFFFFFFFFFFFFF)
    return words_.tobytes()


def _extend(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    """Extend each gram match over equal words to both sides; keep runs of the wanted length."""
    for batch in batches:
        rid, nth, item, before, after = [], [], [], [], []
        for r in batch.to_pylist():
            a, b, i, j = r["ctx"].split(" "), r["item_ctx"].split(" "), r["left"], r["item_left"]
            size = gram if r["span"] > r["short"] else r["span"]
            if a[i: i + size] != b[j: j + size]:
                continue
            left = 0
            while left < min(i, j) and a[i - left - 1] == b[j - left - 1]:
                left += 1
            right = size
            while i + right < len(a) and j + right < len(b) and a[i + right] == b[j + right]:
                right += 1
            if left + right >= r["span"]:
                rid.append(r["rid"])
                nth.append(r["nth"])
                item.append(r["item_id"])
                before.append(left)
                after.append(right)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rid, pa.int64()), pa.array(nth, pa.int32()), pa.array(item, pa.string()), pa.array(before, pa.int32()), pa.array(after, pa.int32())],
            names=["rid", "nth", "item_id", "before", "after"])


def scan_hits(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Documents (rid, doc_id, text_key, n_words, grams) and hits (rid, nth, item_id, before, after).

    A hit holds at every place p of ``grams[nth].places`` of document ``rid``: its words
    p - before to p + after - 1 are also the item's.
    """
    sc = docs.sparkSession.sparkContext
    how = {"span": span, "gram": gram, "bits": bits}
    items = staged(
        _scanned(benchmark, "item_id", "string", lengths=(), short_whole=True, **how)
        .select(F.coalesce("id", F.lit("")).alias("item_id"), F.inline("grams")).drop("places").distinct(), "winnow-items")
    bitmap = sc.broadcast(_bitmap(items, bits))
    short = tuple(sorted(r["span"] for r in items.filter(F.col("span") < span).select("span").distinct().collect()))  # below SPAN values
    scanned = staged(
        _scanned(docs, "doc_id", "long", lengths=short, short_whole=False, bitmap=bitmap, **how)
        .withColumn("rid", F.monotonically_increasing_id()).withColumnRenamed("id", "doc_id"), "winnow-documents")
    met = scanned.select("rid", F.posexplode("grams").alias("nth", "g")).select("rid", "nth", "g.span", "g.fp", "g.left", "g.ctx")
    other = items.select("item_id", "span", "fp", F.col("left").alias("item_left"), F.col("ctx").alias("item_ctx"))
    joined = met.join(other, ["span", "fp"]).withColumn("short", F.lit(span - 1))
    hits = joined.mapInArrow(lambda batches: _extend(batches, gram), "rid long, nth int, item_id string, before int, after int")
    return scanned, staged(hits, "winnow-hits")


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated."""
    scanned, hits = scan_hits(docs, benchmark, span, gram)
    # Of all hits at the same places the words before and after reach as far as the longest; each hit covers its place.
    reach = hits.groupBy("rid", "nth").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    spread = scanned.select("rid", F.posexplode("grams").alias("nth", "g")).select("rid", "nth", F.col("g.places").alias("places"))
    runs = spread.join(reach, ["rid", "nth"]).select("rid", F.explode("places").alias("p"), "before", "after")
    hit_words = (
        runs.select("rid", F.explode(F.sequence(F.col("p") - F.col("before"), F.col("p") + F.col("after") - 1)).alias("w"))
        .distinct().groupBy("rid").agg(F.count(F.lit(1)).alias("n_hit")))
    hit_items = hits.select("rid", "item_id").distinct().groupBy("rid").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return (
        scanned.drop("grams").join(hit_words, "rid", "left").join(hit_items, "rid", "left")
        .select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs``, unchanged, in which no benchmark window occurs."""
    scanned, hits = scan_hits(docs, benchmark, span, gram)
    bad = scanned.drop("grams").join(hits.select("rid").distinct(), "rid", "left_semi").select(*identity(F.col("doc_id"), F.col("text_key"))).distinct()
    return with_identity(docs).join(bad, IDENTITY, "left_anti").select(docs.columns)

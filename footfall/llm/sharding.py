"""Sharding by a minimax contiguous partition, in DataFrame operations only.

Groups of equal texts are atomic. They stand in the order of the SHA-256 of
their text, and the shards are runs of that order. The smallest shard capacity
that fits them into the given number of shards is found by binary search; a
capacity is checked greedily (fill a shard, cut, go on), and the cuts are made
at that capacity.

Running totals over all groups are split by the first bits of the hash, so no
task holds all groups. The greedy check needs only "the largest running total
not above x". The driver keeps a bounded list of known totals (one per hash
bin at first): rounded down they give a capacity that surely fits, rounded up
one that surely doesn't. The few stretches in which the cuts can still lie are
looked at again in ``FINE`` finer steps (one aggregation a round) until both
meet. Each round narrows the stretches ``FINE``-fold, so a handful of rounds
does for any input, and at most ``6 * shards * FINE`` rows a round are collected.

A row's shard follows from its own hash and the cut hashes: no join, texts are
not shuffled. Slots are numbered within (shard, id bin) and offset by the
counts of the bins before, so no shard is numbered in one task. With ``order``
the slots of a shard follow that order instead: rows are range-sorted by shard
and order, and numbered by what each range holds of a shard.

Defined results: a null text has size 1 and CRC 0 and forms a group of its own,
apart from the empty text. Equal rows share a shard and take different slots.
With fewer groups than shards the last shards stay empty. An empty table
gives an empty result. Extra columns are carried along on request.
"""

from __future__ import annotations

import bisect

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import placed, staged

#: Contract values.
SHARDS, LAW = 8, "bytes"
#: Finer steps of each stretch a round, and hexadecimal digits of the id hash that bin the numbering of slots.
FINE, SLOT_BIN_DIGITS = 512, 3


def _hash(text: Column) -> Column:
    """SHA-256 of the text; null stands first, as a group of its own."""
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def _bin(key: Column) -> Column:
    return F.coalesce(F.conv(F.substring(key, 1, 3), 16, 10).cast("int") + 1, F.lit(0))


class _Totals:
    """Sorted known running totals; no total lies in (total, clear_to]."""

    def __init__(self, totals: list[int]):
        self.at = sorted({0, *totals})
        self.clear = dict.fromkeys(self.at, -1)

    def down(self, x: int) -> int:
        return self.at[bisect.bisect_right(self.at, x) - 1]

    def up(self, x: int) -> int:
        """An upper bound of the largest total not above ``x``; exact where the gap above the known one is clear."""
        known = self.down(x)
        return known if known == x or x <= self.clear[known] else x

    def gaps(self, capacity: int, shards: int) -> set[tuple[int, int, int]]:
        """The unknown stretches that the greedy cuts fall into: known total below, first and last value."""
        out = set()
        for floor in (self.down, self.up):
            at = 0
            for _ in range(shards):
                x = min(at + capacity, self.at[-1])
                known = self.down(x)
                if x > max(known, self.clear[known]):
                    out.add((known, max(known, self.clear[known]) + 1, self.at[bisect.bisect_right(self.at, x)] - 1))
                at = floor(x)
        return out

    def add(self, total: int, clear_to: int) -> None:
        if total not in self.clear:
            bisect.insort(self.at, total)
            self.clear[total] = -1
        self.clear[total] = max(self.clear[total], clear_to)

    def cuts(self, capacity: int, shards: int, floor) -> list[int]:
        out, at = [], 0
        for _ in range(shards):
            at = floor(min(at + capacity, self.at[-1]))
            out.append(at)
        return out


def _smallest(low: int, high: int, fits) -> int:
    """Least value in (low, high] that fits; ``high`` does, ``low`` doesn't."""
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high


def minimax_cuts(totals: DataFrame, bin_ends: list[int], largest: int, shards: int, fine: int = FINE) -> tuple[int, list[int]]:
    """Smallest capacity, and the running totals at which the greedy shards end.

    ``totals``: one row per group with its running total ``upto``. ``bin_ends``:
    some of the totals, the last among them. ``largest``: the largest group.
    """
    known = _Totals(bin_ends)
    whole = known.at[-1]
    least = max(largest, -(-whole // shards)) - 1  # no smaller capacity can do
    most = -(-whole // shards) + largest
    while True:
        sure = _smallest(least, most, lambda c: known.cuts(c, shards, known.down)[-1] == whole)
        maybe = _smallest(least, sure, lambda c: known.cuts(c, shards, known.up)[-1] == whole)
        if maybe == sure and not known.gaps(sure, shards):
            return sure, known.cuts(sure, shards, known.down)
        least, most = maybe - 1, sure
        stretches = sorted(set().union(*(known.gaps(c, shards) for c in {maybe, (maybe + sure) // 2, sure})))
        cells = [(a, b, max(1, -(-(b - a + 1) // fine))) for _, a, b in stretches]
        hit = F.coalesce(*(
            F.when(F.col("upto").between(a, b), F.struct(F.lit(i).alias("i"), F.floor((F.col("upto") - a) / F.lit(w)).cast("long").alias("cell")))
            for i, (a, b, w) in enumerate(cells)))
        seen = totals.filter(F.col("upto").between(min(a for a, _, _ in cells), max(b for _, b, _ in cells)))
        rows = (
            seen.select("upto", hit.alias("h")).filter("h is not null")
            .groupBy("h.i", "h.cell").agg(F.max("upto").alias("top")).collect()
        )
        tops = {(r["i"], r["cell"]): r["top"] for r in rows}
        for i, (a, b, w) in enumerate(cells):
            last = stretches[i][0]
            for cell in range((b - a) // w + 1):
                last = tops.get((i, cell), last)
                known.add(last, min(a + (cell + 1) * w - 1, b))


def file_order(docs: DataFrame) -> tuple[Column, ...]:
    """Order in which the rows of a table read from Parquet stand in its files; nothing for other frames.

    Spark numbers the files of a written frame by its partitions, so a sorted frame
    that was written has its order again; a scan alone does not keep it.
    """
    try:
        meta = docs.metadataColumn("_metadata")
        name = meta["file_name"]
        order = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"), name, meta["row_index"]
        docs.select(*order)
    except AnalysisException:
        return ()
    return order


def shard(docs: DataFrame, shards: int = SHARDS, carry: tuple[str, ...] = (), slot_digits: int = SLOT_BIN_DIGITS,
          order: tuple[Column, ...] = ()) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot, and the columns ``carry`` of ``docs``.

    Sizes are UTF-8 bytes plus 1. Only rows without texts are shuffled, unless
    ``carry`` names them. Slots follow ``order``, or the bins of the id hash, then text hash and id.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    light = docs.select(
        *(docs[f"`{c}`"].alias(f"_carry_{i}") for i, c in enumerate(carry)),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        _hash(text).alias("key"),
        *(c.alias(f"_order_{i}") for i, c in enumerate(order)),
    )
    plain = light.select("doc_id", "size", "key")
    groups = staged(plain.groupBy("key").agg(F.sum("size").alias("size")).withColumn("bin", _bin(F.col("key"))), "shard-groups")
    # At most one row a bin, of which there are 4097.
    bins = groups.groupBy("bin").agg(F.sum("size").alias("total"), F.max("size").alias("largest")).orderBy("bin").collect()
    if not bins:
        return light.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                            *(F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)))
    starts, ends, at = [], [], 0
    for r in bins:
        starts.append((r["bin"], at))
        at += r["total"]
        ends.append(at)
    start = spark.createDataFrame(starts, "bin int, start long")
    upto = F.sum("size").over(Window.partitionBy("bin").orderBy("key")) + F.col("start")
    totals = staged(groups.join(F.broadcast(start), "bin").select("key", upto.alias("upto")), "shard-totals")
    _, cuts = minimax_cuts(totals, ends, max(r["largest"] for r in bins), shards)
    inner = sorted(set(cuts[:-1]))
    keys = {r["upto"]: r["key"] for r in totals.filter(F.col("upto").isin(inner)).collect()}  # shards - 1 rows at most
    cut_keys = [keys[c] for c in cuts[:-1]]
    number = sum((F.when(F.col("key") > k, 1).otherwise(0) for k in cut_keys), F.lit(0))
    if order:
        rows = placed(light.withColumn("shard", number), "shard", [f"_order_{i}" for i in range(len(order))], "shard-slots")
        return rows.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.col("place").alias("slot"),
                           *(F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)))
    slot_bin = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, slot_digits)
    dealt = light.withColumn("shard", number).withColumn("bin", slot_bin)
    counts = plain.select(number.alias("shard"), slot_bin.alias("bin")).groupBy("shard", "bin").count()
    first = F.sum("count").over(Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "bin", F.coalesce(first, F.lit(0)).cast("long").alias("first"))  # shards * 16 ** slot_digits rows
    place = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("key", "doc_id")) - 1
    return dealt.withColumn("place", place).join(F.broadcast(offsets), ["shard", "bin"]).select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("first") + F.col("place")).alias("slot"),
        *(F.col(f"_carry_{i}").alias(c) for i, c in enumerate(carry)))

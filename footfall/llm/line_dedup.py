"""Line deduplication by a sharded minimal perfect hash.

One aggregation over line hashes finds the lines held by at least
``MIN_DOCS`` documents, with their document count and largest document id.
These hashes are dealt to shards by their value; each shard becomes a minimal
perfect hash (levels of collision-free slots with ranks) that indexes compact
arrays: a 64-bit fingerprint, the count and the keeper. Documents send the
hashes of their lines, never the lines, past the arrays of the right shard:
one hash gives the array place, the fingerprint says whether the line is known.

A line is known by two 64-bit hashes of its key: one gives the place, the other
the shard and the fingerprint, so lines clash only if both agree in part. A
shard whose known lines occur more often than those of the mean shard (it has a
very common line) is copied and its probes split. A task holds one shard's
arrays at a time.

Defined results: a null or empty text is one empty line. Rows with a null
``doc_id`` count for no document and keep no shared line. Repeated rows are
one document and get equal answers. An empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IDENTITY, ascii_lower, identity, mix, staged, text_key

#: Contract values.
MIN_CHARS, MIN_DOCS = 20, 3
#: Lines of an index shard at most on average, and the least load for which a shard is copied.
SHARD_LINES, PROBES = 1 << 16, 1 << 12

_BLANK = " \t\n\x0b\x0c\r"
_GAMMA = 2


# A minimal perfect hash: at each level the keys left are hashed into GAMMA times
# as many slots; those alone in their slot stay, the others go to the next level.
# The place of a key is the rank of its slot among all taken ones.

def _level_slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)) % np.uint64(size)).astype(np.int64)


def build_index(keys: np.ndarray, fingerprints: np.ndarray, counts: np.ndarray, keepers: np.ndarray) -> bytes:
    """Pack distinct 64-bit ``keys`` into the perfect hash and its arrays."""
    levels, left = [], keys
    while len(left):
        size = max(64, -(-len(left) * _GAMMA // 64) * 64)
        slot = _level_slots(left, len(levels), size)
        alone = np.bincount(slot, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[slot]]
    place = _places([np.packbits(x) for x in levels], keys)
    out = [np.array([len(keys), len(levels), *(len(x) for x in levels)], np.int64).tobytes()]
    out += [np.packbits(x).tobytes() for x in levels]
    for values, kind in ((fingerprints, np.uint64), (np.minimum(counts, 2**32 - 1), np.uint32), (keepers, np.int64)):
        arr = np.zeros(len(keys), kind)
        arr[place] = values
        out.append(arr.tobytes())
    return b"".join(out)


def _places(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Place of each key; -1 if no level has it."""
    place, todo, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for i, packed in enumerate(levels):
        taken = np.unpackbits(packed).astype(bool)
        slot = _level_slots(keys[todo], i, len(taken))
        rank = np.cumsum(taken) - 1
        here = taken[slot]
        place[todo[here]] = base + rank[slot[here]]
        base += int(rank[-1]) + 1
        todo = todo[~here]
    return place


class LineIndex:
    def __init__(self, blob: bytes):
        n, k = np.frombuffer(blob, np.int64, 2)
        sizes = np.frombuffer(blob, np.int64, int(k), 16)
        at, self.levels = 16 + 8 * int(k), []
        for size in sizes:
            self.levels.append(np.frombuffer(blob, np.uint8, int(size) // 8, at))
            at += int(size) // 8
        self.fingerprints = np.frombuffer(blob, np.uint64, int(n), at)
        self.counts = np.frombuffer(blob, np.uint32, int(n), at + 8 * int(n))
        self.keepers = np.frombuffer(blob[at + 12 * int(n):], np.int64, int(n))

    def keeper(self, keys: np.ndarray, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each line is in the index, and the document that keeps it."""
        if not len(self.fingerprints):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        place = _places(self.levels, keys)
        known = (place >= 0) & (self.fingerprints[place] == fingerprints)
        return known, self.keepers[place]


def _line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(text: Column) -> Column:
    return F.transform(_line_array(text), lambda x: F.btrim(ascii_lower(x), F.lit(_BLANK)))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("fp")]


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """h, fp, n_docs, keeper of every line key found in at least ``min_docs`` documents."""
    keys = F.array_distinct(F.filter(_keys(F.col("text").cast("string")), lambda k: F.length(k) >= min_chars))
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(keys).alias("key"))
        .select("doc_id", *_hashes(F.col("key")))
        .groupBy("h", "fp").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
    )


def _build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    arr = {c: table.column(c).to_numpy() for c in ("h", "fp", "n_docs", "keeper")}
    fp, first = np.unique(arr["fp"], return_index=True)  # two lines of one shard and place hash: never seen; one of them would stay undropped
    blob = build_index(fp.view(np.uint64), arr["h"][first].view(np.uint64), arr["n_docs"][first], arr["keeper"][first])
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "load": pa.array([int(arr["n_docs"].sum())], pa.int64()), "arrays": pa.array([blob], pa.binary())})


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (shard, part, arrays first): load the arrays, then answer the probes that follow."""
    index, owner = None, None
    names = [*IDENTITY, "at"]
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        part = batch.column("part").to_numpy()
        borders = np.flatnonzero((np.diff(shard) != 0) | (np.diff(part) != 0)) + 1
        out = []
        for a, b in zip([0, *borders], [*borders, batch.num_rows], strict=True):
            if a == b:
                continue
            if owner != (shard[a], part[a]):
                index, owner = None, (shard[a], part[a])
            run = batch.slice(a, b - a)
            if run.column("arrays")[0].is_valid:
                index, run = LineIndex(run.column("arrays")[0].as_py()), run.slice(1)
            if index is None or not run.num_rows:
                continue
            h = run.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
            fp = run.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            known, keeper = index.keeper(fp, h)
            own = run.column("doc_id")
            none = own.is_null().to_numpy(zero_copy_only=False)
            drop = known & (none | (own.fill_null(0).to_numpy(zero_copy_only=False) != keeper))
            out.append(run.filter(pa.array(drop)).select(names))
        yield from out


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """_row_id, _row_key, at: the number of every line to drop."""
    spark = docs.sparkSession
    shared = staged(shared_lines(docs, min_chars, min_docs), "line-shared")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shared.count() // SHARD_LINES))
    of_hash = F.pmod("h", F.lit(shards)).cast("long")
    built = staged(
        shared.withColumn("shard", of_hash).groupBy("shard").applyInArrow(_build, "shard long, load long, arrays binary"), "line-index")
    total = built.agg(F.sum("load")).first()[0] or 0
    parts = (F.floor(F.col("load") / max(PROBES, total // shards)) + 1).cast("int")
    copies = built.select("shard", "arrays", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    text = F.col("text").cast("string")
    # The identity comes first: beside the explode it would be computed for every line.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *identity(F.col("doc_id").cast("long"), text_key(text)), text.alias("text"))
    probes = (
        rows.select("doc_id", *IDENTITY, F.posexplode(_keys(F.col("text"))).alias("at", "key"))
        .filter(F.length("key") >= min_chars)
        .select("doc_id", *IDENTITY, "at", *_hashes(F.col("key"))).withColumn("shard", of_hash)
        .join(built.select("shard", parts.alias("parts")), "shard")  # a row a shard
        .withColumn("part", F.pmod(F.xxhash64("_row_key", "at"), F.col("parts")).cast("int")).drop("parts")
    )
    lines = probes.withColumn("arrays", F.lit(None).cast("binary")).unionByName(copies, allowMissingColumns=True)
    dealt = lines.repartition(shards, "shard", "part").sortWithinPartitions("shard", "part", F.col("arrays").isNull())
    return dealt.mapInArrow(_probe, "_row_id string, _row_key long, at int")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the text without the dropped lines) of each document."""
    drops = dropped_lines(docs, min_chars, min_docs).groupBy(IDENTITY).agg(F.collect_set("at").alias("drop"))
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *identity(F.col("doc_id").cast("long"), text_key(text)))
    joined = rows.join(drops, IDENTITY, "left").withColumn("lines", _line_array(F.col("text")))
    n = F.size("lines")
    stay = F.array_except(F.sequence(F.lit(1), n), F.transform("drop", lambda i: i + 1))
    kept = F.when(F.col("drop").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.element_at("lines", i)), "\n"))
    return joined.select("doc_id", n.cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))

"""SimHash near-duplicates with pigeonring filtering.

The 64 fingerprint bits are cut into a ring of ``SEGMENTS`` segments. If two
fingerprints differ in at most ``max_bits`` bits, some segment starts a chain
in which, for every length l, the first l segments differ in at most
floor(l * max_bits / SEGMENTS) bits (pigeonring principle, strong form). The
lengths whose budget is zero make a join key: those segments must be equal.
The longer lengths prune pairs before the full Hamming check.

Only distinct fingerprints take part, so exact copies cost nothing. A key
held by more than ``PAIR_LIMIT`` fingerprints is split by further segments of
the ring: the longest chain with a budget of one bit becomes the key, own bits
on one side, own bits and each one flipped on the other. So a hot key meets the
chain's budget by its join, and its members are not paired with each other.
Nothing is capped or dropped, for any ``max_bits``.

Components are found by alternating large-star and small-star steps over the
links, each written to the shared folder.

Defined results: a text without words (null, empty) has fingerprint zero and
is linked like any other. Rows with a null ``doc_id`` are fingerprinted and
link others; they are named only if no member has an id (``component_id``
null). Repeated rows are one class. An empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IDENTITY, identity, pieces, release, staged, text_key, with_identity

#: Contract values.
SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Ring segments (five with two bits: two neighbouring segments, 25 or 26 bits, make the key).
SEGMENTS = 5
#: A key with more fingerprints than this is split by a longer chain.
PAIR_LIMIT = 16

_CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the word shingles of a UTF-8 text with A-Z lower-cased, as an unsigned integer."""
    w = text.lower().split()
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _CHUNK):
        raw = b"".join([digest(b" ".join(w[j: j + shingle]), seed) for j in range(i, min(n, i + _CHUNK))])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, text_key and fp (the 64 bits as a signed long) of each document; map only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                fps = np.array([fingerprint(x or b"", shingle, seed) for x in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(fps)], names=["doc_id", "text_key", "fp"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), text_key(text).alias("text_key")).mapInArrow(run, "doc_id long, text_key long, fp long")


def _ring(max_bits: int, segments: int) -> tuple[list[int], list[int]]:
    """Bit mask of each segment, and the budget of each chain length."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    masks = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(segments)]
    return masks, [length * max_bits // segments for length in range(1, segments + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _chain_masks(start: int, masks: list[int]) -> list[int]:
    """Mask of the first 1, 2, ... segments of the ring from ``start``."""
    out, m = [], 0
    for i in range(len(masks)):
        m |= masks[(start + i) % len(masks)]
        out.append(_signed(m))
    return out


def links(distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """All pairs a < b of the distinct fingerprints ``fp`` that differ in at most ``max_bits`` bits."""
    masks, budgets = _ring(max_bits, segments)
    zero = sum(b == 0 for b in budgets)
    if not zero:
        raise ValueError("more segments than bits are needed")
    chains = [_chain_masks(i, masks) for i in range(segments)]
    keyed = distinct.select(
        "fp",
        F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(c[zero - 1])) for c in chains))).alias("start", "key"),
    )
    load = keyed.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = staged(keyed.join(load, ["start", "key"]), "simhash-keys")  # few: keys of a single fingerprint go
    diff = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    chain = F.lit(False)
    for i, c in enumerate(chains):
        fits = F.col("l.start") == i
        for m, budget in zip(c[zero:-1], budgets[zero:-1], strict=True):
            fits &= F.bit_count(diff.bitwiseAND(F.lit(m))) <= budget
        chain |= fits

    def near(left: DataFrame, right: DataFrame) -> DataFrame:
        met = left.alias("l").join(right.alias("r"), ["start", "key"]).filter("l.fp < r.fp")
        return met.filter(chain).filter(F.bit_count(diff) <= max_bits).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))

    small = shared.filter(F.col("n") <= pair_limit)
    pairs = near(small, small)
    if max_bits:
        longest = sum(b <= 1 for b in budgets) - 1  # the last chain whose budget is one bit
        own = F.col("fp").bitwiseAND(F.element_at(F.array(*(F.lit(c[longest]) for c in chains)), F.col("start") + 1))
        flips = F.array(*(
            F.array(*(F.lit(_signed(x)) for x in (0, *(1 << i for i in range(64) if (c[longest] ^ c[zero - 1]) >> i & 1)))) for c in chains))
        hot = shared.filter(F.col("n") > pair_limit).select("fp", "start", own.alias("key"))
        flipped = hot.select("fp", "start", F.explode(
            F.transform(F.element_at(flips, F.col("start") + 1), lambda f: F.col("key").bitwiseXOR(f))).alias("key"))
        pairs = pairs.unionByName(near(hot, flipped))
    return pairs.distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root: least node reachable, for every node of the undirected ``edges`` (a, b).

    Large-star then small-star until nothing changes; groups are only
    aggregated and joined, never collected, and each round is written out.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b"), "components-0")
    for i in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(low, "b").select(F.explode(F.array(
                F.struct(F.col("m").alias("a"), F.col("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
            .select("e.a", "e.b").filter("a < b").distinct()
        )
        after = staged(small, f"components-{i + 1}")
        same = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        settled = edges.agg(F.count(F.lit(1)), same).first() == after.agg(F.count(F.lit(1)), same).first()
        release(edges)
        edges = after
        if settled:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _rooted(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """near_duplicates with ``root``, the fingerprint that tells components apart whatever their ids."""
    found = staged(fingerprints(docs, shingle), "simhash-fingerprints")
    classes = staged(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    tree = components(links(classes.select("fp"), max_bits))
    rooted = classes.join(tree, classes.fp == tree.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = rooted.join(named, "root").select("fp", "component_id", "root")
    return found.join(label, "fp").select(
        "doc_id", "text_key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, fingerprint (16 hex digits), component_id."""
    return _rooted(docs, shingle, max_bits).drop("root")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` from each component: the one with the least doc_id (nulls last), then text key."""
    marked = _rooted(docs, shingle, max_bits)
    id_ = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    best = marked.groupBy("root").agg(F.min(id_).alias("k")).select(*identity(F.col("k.doc_id"), F.col("k.text_key"))).distinct()
    kept = with_identity(docs).join(best, IDENTITY, "left_semi")
    return kept.dropDuplicates(IDENTITY).select(docs.columns)

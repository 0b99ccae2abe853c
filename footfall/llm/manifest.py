"""Merkle manifest of a dataset, with checkpointed levels and recomputed proofs.

Every document is a leaf; the leaves of a source form a tree by ``doc_id``,
and the trees' tops (subroots) form one more tree, whose top is the root of
the dataset. Runs of ``ARITY`` nodes are hashed into the node above them.

Only every ``STRIDE``-th level is written. A node of a written level stands for
an aligned subtree of ``ARITY ** STRIDE`` nodes of the written level below, so
building needs one grouping a stride, and the interior levels live only while
a subtree is hashed. Proofs go down the same way: the written nodes of a
subtree meet the proof of its top, its interior nodes are hashed again, each
written node gets its siblings in them, and they are dropped. No task ever
holds more than one subtree, however large a source is.

Defined results: null fields have their own mark, so null and empty differ.
Rows without an id come first in their source; rows equal in source and id are
ordered by their leaf, so repeated rows are leaves of their own with equal
columns up to their place. A null source is a source of its own, before all
others. One document is its own subroot and, alone, the root, with no
siblings. An empty table has no rows and no root. Extra columns are ignored
unless they are carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import group_starts, placed, release, staged, whole_groups

#: Contract values: fields of a leaf in their order, and nodes in a run.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
#: Levels from one written level to the next (subtrees of 243 nodes).
STRIDE = 5


def leaf_digest(**values: Column) -> Column:
    """Hash of a document: ``-`` for a null field, else its UTF-8 length, ``:`` and its text."""
    def marked(v: Column) -> Column:
        v = v.cast("string")
        return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))

    return F.sha2(F.concat(*(marked(values[f]) for f in FIELDS)), 256)


def digest_of(docs: DataFrame, **instead: Column) -> Column:
    """``leaf_digest`` of the rows of ``docs``, some fields replaced."""
    own = {f: docs[f].cast("long") if f in ("doc_id", "n_chars") else docs[f] for f in FIELDS}
    return leaf_digest(**own | instead)


def node_hash(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def subtree(nodes: list[str], alone: bool, arity: int = ARITY, stride: int = STRIDE) -> list[list[str]]:
    """``nodes`` and the levels above them: ``stride`` of them, or up to one node if they are ``alone`` in their tree."""
    out = [nodes]
    while len(out[-1]) > 1 if alone else len(out) <= stride:
        row = out[-1]
        out.append([node_hash(row[i: i + arity]) for i in range(0, len(row), arity)])
    return out


@dataclass
class Forest:
    """Written levels of trees: ``levels[j]`` has (tree, place, members, hash) and, of leaves, carried columns;
    ``tops[j]`` has (tree, hash) of the trees that end in the stride above it."""

    levels: list[DataFrame]
    tops: list[DataFrame]
    carry: tuple[str, ...] = ()
    arity: int = ARITY
    stride: int = STRIDE

    @property
    def span(self) -> int:
        return self.arity ** self.stride

    @property
    def subroots(self) -> DataFrame:
        out = self.tops[0]
        for t in self.tops[1:]:
            out = out.unionByName(t)
        return out


@dataclass
class Manifest:
    """Trees of the sources and the tree over their subroots."""

    sources: Forest
    summit: Forest
    _written: list[DataFrame] = field(default_factory=list)

    @property
    def root(self) -> DataFrame:
        """One row with the root, none for an empty dataset."""
        return self.summit.subroots.select(F.col("hash").alias("root"))

    def close(self) -> None:
        """Delete the written levels; nothing may read the manifest or its proofs any more."""
        for df in self._written:
            release(df)


def _climb(batches: Iterator[pa.RecordBatch], arity: int, stride: int) -> Iterator[pa.RecordBatch]:
    """Top of each subtree, from its nodes in order."""
    span = arity ** stride
    for table in whole_groups(batches, ["tree", "block"]):
        starts = group_starts(table, ["tree", "block"])
        hashes, members = table.column("hash").to_pylist(), table.column("members").to_pylist()
        tops, alone = [], []
        for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
            alone.append(members[a] <= span)
            tops.append(subtree(hashes[a:b], alone[-1], arity, stride)[-1][0])
        first = table.take(pa.array(starts))
        yield pa.RecordBatch.from_arrays(
            [first.column("tree").combine_chunks(), first.column("block").combine_chunks(), pa.array([-(-members[a] // span) for a in starts], pa.int64()),
             pa.array(tops, pa.string()), pa.array(alone, pa.bool_())], names=["tree", "place", "members", "hash", "alone"])


def _subtrees(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def grow(leaves: DataFrame, name: str, carry: tuple[str, ...] = (), arity: int = ARITY, stride: int = STRIDE) -> Forest:
    """Hash the trees of ``leaves`` (tree, place, members, hash; written), one grouping a stride."""
    forest = Forest([leaves], [], carry, arity, stride)
    largest = leaves.agg(F.max("members")).first()[0] or 0
    while True:
        nodes = forest.levels[-1].select("tree", "place", "members", "hash", F.expr(f"place div {forest.span}").alias("block"))
        step = staged(_subtrees(nodes).mapInArrow(
            lambda batches: _climb(batches, arity, stride), "tree string, place long, members long, hash string, alone boolean"), f"{name}-{len(forest.levels)}")
        top = step.filter("alone").select("tree", "hash")
        top._staged_at = step._staged_at
        forest.tops.append(top)
        if largest <= forest.span:
            return forest
        largest = -(-largest // forest.span)
        forest.levels.append(step.filter(~F.col("alone")).drop("alone"))


def build(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), arity: int = ARITY, stride: int = STRIDE) -> Manifest:
    """The manifest of ``docs``; ``carry`` names columns that proofs shall have beside the leaf."""
    source = docs["source"].cast("string")
    tree = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))  # null first, then bytewise
    digests = staged(docs.select(tree.alias("tree"), docs["doc_id"].cast("long").alias("_id"), digest_of(docs).alias("hash"), *(docs[c].alias(f"_carry_{c}") for c in carry)), "manifest-digests")
    ordered = placed(digests, "tree", ["_id", "hash"], "manifest-order")
    leaves = staged(ordered.drop("_id"), "manifest-leaves")
    release(ordered)
    release(digests)
    sources = grow(leaves, "manifest-sources", carry, arity, stride)
    named = staged(sources.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("_carry_tree"), "hash"), "manifest-subroots")
    ordered = placed(named, "tree", ["_carry_tree"], "manifest-subroot-order")
    summit_leaves = staged(ordered, "manifest-summit")
    release(ordered)
    release(named)
    summit = grow(summit_leaves, "manifest-summit", ("tree",), arity, stride)
    return Manifest(sources, summit, [leaves, summit_leaves, *sources.tops, *summit.tops])


def _spread(batches: Iterator[pa.RecordBatch], arity: int, stride: int) -> Iterator[pa.RecordBatch]:
    """Proof of each node of each subtree: its siblings up to the subtree's top, then the proof of the top.

    The first row of a subtree (place -1) brings that proof.
    """
    span = arity ** stride
    for table in whole_groups(batches, ["tree", "block"]):
        starts = group_starts(table, ["tree", "block"])
        hashes, members = table.column("hash").to_pylist(), table.column("members").to_pylist()
        above = table.take(pa.array(starts)).select(["lefts", "rights", "subroot", "root"]).to_pylist()
        lefts, rights, subroots, roots, keep = [], [], [], [], []
        for top, a, b in zip(above, starts, [*starts[1:], table.num_rows], strict=True):
            levels = subtree(hashes[a + 1: b], members[a + 1] <= span, arity, stride)
            for i in range(b - a - 1):
                left, right, at = [], [], i
                for row in levels[:-1]:
                    run = at - at % arity
                    left.append("".join(row[run: at]))
                    right.append("".join(row[at + 1: run + arity]))
                    at //= arity
                lefts.append(left + top["lefts"])
                rights.append(right + top["rights"])
                subroots.append(top["subroot"])
                roots.append(top["root"])
                keep.append(a + 1 + i)
        own = table.take(pa.array(keep, pa.int64()))
        text = pa.list_(pa.string())
        new = {"lefts": pa.array(lefts, text), "rights": pa.array(rights, text), "subroot": pa.array(subroots, pa.string()), "root": pa.array(roots, pa.string())}
        out = pa.Table.from_arrays([new.get(c, own.column(c)) for c in own.column_names], names=own.column_names)
        yield from out.to_batches()


def _descend(forest: Forest, above: DataFrame) -> DataFrame:
    """Proofs of the leaves, from the proofs ``above`` (tree, lefts, rights, subroot, root) of their trees' tops."""
    proof = ("lefts", "rights", "subroot", "root")
    arity, stride, found = forest.arity, forest.stride, None
    for j in range(len(forest.levels) - 1, -1, -1):
        extra = [f"_carry_{c}" for c in forest.carry] if j == 0 else []
        nodes = forest.levels[j].select("tree", "place", "members", "hash", *extra)
        tops = forest.tops[j].join(above, "tree").withColumn("block", F.lit(0).cast("long")).select("tree", "block", *proof)
        if found is not None:
            tops = tops.unionByName(found.select("tree", F.col("place").alias("block"), *proof))
        feed = tops.withColumn("place", F.lit(-1).cast("long")).unionByName(
            nodes.withColumn("block", F.expr(f"place div {forest.span}")), allowMissingColumns=True)
        kinds = ", ".join(f"`{c}` {t}" for c, t in feed.dtypes)
        found = _subtrees(feed).mapInArrow(lambda batches: _spread(batches, arity, stride), kinds)
    return found


def proofs(manifest: Manifest) -> DataFrame:
    """Per document: its carried columns, leaf, subroot, root, and per level the digests of its run before and after it.

    Interior nodes are hashed from the written levels and dropped.
    """
    whole = F.array().cast("array<string>")
    start = manifest.summit.subroots.select("tree", whole.alias("lefts"), whole.alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    up = _descend(manifest.summit, start).select(F.col("_carry_tree").alias("tree"), "lefts", "rights", F.col("hash").alias("subroot"), "root")
    found = _descend(manifest.sources, up)
    return found.select(*(F.col(f"_carry_{c}").alias(c) for c in manifest.sources.carry), F.col("hash").alias("leaf"), "subroot", "root", "lefts", "rights")


def fold(leaf: Column) -> Column:
    """The root that a leaf and the siblings in ``lefts`` and ``rights`` give."""
    steps = F.zip_with("lefts", "rights", lambda a, b: F.struct(a.alias("left"), b.alias("right")))
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def siblings_digest() -> Column:
    return F.sha2(F.array_join(F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b)), ""), 256)


def verify(found: DataFrame, suspect: Column) -> DataFrame:
    """Proof rows with folded_root (of the ``suspect`` leaf) and verified: whether it is the root."""
    folded = found.withColumn("folded_root", fold(suspect))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))

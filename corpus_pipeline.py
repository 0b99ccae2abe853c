"""The corpus pipeline: quality, near duplicates, decontamination, mix, shards.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. ``run`` applies them to ``documents``; every stage is written to the
shared folder and read again as the next one's input, which is then deleted.

Defined results, besides the operators' own: null and empty texts fail the
quality rules. Rows with a null id are told apart by their text. Repeated rows
(equal id and text) are one document from the second stage on; the mix may
repeat it. Slots keep the training order of the mix within each shard; of a
frame that was not read from files the order isn't known, there the hash of the
id orders the slots. Null sources are mixed as one source. Extra columns are carried
through, except that the last stage's own columns (size, text_crc32, shard,
slot) replace columns of those names. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import mixing, quality, sharding, simhash, winnow
from footfall.llm.common import release, staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rules' posterior says good."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return winnow.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mixed_rows(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot; the slots of a shard follow the training order in which the mix was written."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "size", "text_crc32", "shard", "slot"))
    return sharding.shard(docs, carry=carry, order=sharding.file_order(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("sharding", shards),
]

#: EM and link components have no SQL form; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"pipeline-{i}")
        if i:
            release(before)
    return docs

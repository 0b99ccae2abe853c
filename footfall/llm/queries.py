"""Registered queries of the subpackage: each applies one operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_diff, line_dedup, manifest, mixing, phrases, pii, quality, revisits, secrets, sharding, simhash, tokens, winnow
from .common import table
from .oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """Place of the byte-level BPE tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = revisits.resolve_revisits(revisits.records_from_pages(table(spark, sf_dir, "pages")))
    return done.withColumns({"captured": F.col("captured").cast("timestamp_ntz"), "headers": F.array_join("headers", "\n")})


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op3_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.extract(table(spark, sf_dir, "pages"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(pii.personal_data(table(spark, sf_dir, "documents")))


@query
def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.with_positions(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", F.round(F.get("times", F.lit(0)), 6).alias("first_time"),
                        F.array_join("positions", ",").alias("positions"))


@query
def op10_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op12_nested_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    struck = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.col("text").contains("\n")
    tampered = manifest.digest_of(docs, text=F.when(struck, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    tree = manifest.build(docs.withColumn("suspect", tampered), carry=("doc_id", "suspect"))
    checked = manifest.verify(manifest.proofs(tree), F.col("suspect"))
    return checked.select("doc_id", "leaf", "subroot", "root", manifest.siblings_digest().alias("proof_sha256"), "folded_root", "verified")

"""The pipeline against its stages worked out by brute force."""

from __future__ import annotations

import corpus_pipeline
from footfall.llm import mixing, quality, sharding
from footfall.llm.common import staged
from pyspark.sql import functions as F

from . import brute

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: r for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = sorted(r["doc_id"] for r in quality.judge(docs).filter("kept").collect())
    comp = brute.components(kept, [brute.fingerprint(text[d]["text"]) for d in kept])
    kept = sorted(set(comp))
    kept = [r[0] for r in brute.contamination([(d, text[d]["text"]) for d in kept], items) if not r[-1]]
    sizes = {}
    for d in kept:
        sizes[text[d]["source"]] = sizes.get(text[d]["source"], 0) + len(text[d]["text"].split())
    goal = brute.targets(sizes)

    out = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF).persist()
        seen.append(out)
        if name != "sharding":
            assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in seen[2].select("doc_id").collect()) == kept
    mixed = seen[3].groupBy("source").agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).collect()
    longest = {}
    for d in kept:
        longest[text[d]["source"]] = max(longest.get(text[d]["source"], 0), len(text[d]["text"].split()))
    for s, n in mixed:
        assert abs(n - goal[s]) <= longest[s]
    rows = [(r["doc_id"], r["text"]) for r in seen[3].collect()]
    _, want = brute.shards(rows)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in seen[4].collect()) == sorted((d, *w) for (d, _), w in zip(rows, want))


def test_slots_follow_the_training_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.with_positions(mixing.mix(docs)).select("doc_id", F.explode("positions").alias("p")).orderBy("p").collect()
    mixed = staged(mixing.mixed_rows(docs).withColumn("_metadata", F.lit("x")), "test-mixed")  # a clashing name
    got = sharding.shard(mixed, carry=("text", "_metadata"), order=sharding.file_order(mixed)).collect()
    of = {r["doc_id"]: r["shard"] for r in got}
    want = {k: [] for k in range(sharding.SHARDS)}
    for r in plan:
        want[of[r["doc_id"]]].append(r["doc_id"])
    for k, ids in want.items():
        rows = sorted((r["slot"], r["doc_id"]) for r in got if r["shard"] == k)
        assert rows == list(enumerate(ids))
    assert {r["_metadata"] for r in got} == {"x"} and len(got) == len(plan)
    assert sharding.file_order(docs) and not sharding.file_order(docs.groupBy("doc_id").count())
    plain = sharding.shard(mixed).select("doc_id", "shard").distinct().collect()
    assert {r["doc_id"]: r["shard"] for r in plain} == of


def test_pipeline_on_no_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert not corpus_pipeline.run(spark, str(tmp_path)).count()


def test_stages_on_awkward_rows(spark):
    prose = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"else{i * 7}" for i in range(90))
    base = [(1, prose, "a"), (1, prose, "a"), (2, prose, None), (None, other, "a"), (None, other, "a"), (None, None, None),
            (3, "", "b"), (4, None, "b"), (5, prose.upper() + " " + other, None), (6, "x " * 40000, "c"), (7, " ".join(f"third{i * 3}" for i in range(200)) + "\n" + prose, "b"),
            (8, " ".join(f"long{i}" for i in range(60000)), "d")]
    columns = "doc_id long, text string, source string, size string, shard string, fp int, rid int, _c string"
    docs = spark.createDataFrame([(*r, "s", "h", 1, 2, "c") for r in base], columns)
    want = {(1, prose), (None, other), (5, base[8][1]), (7, base[10][1]), (8, base[11][1])}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).persist()
        if name == "sharding":
            assert {"doc_id", "text", "source", "fp", "rid", "_c", "size", "shard", "slot", "text_crc32"} == set(out.columns)
            assert out.filter("fp <> 1 or rid <> 2 or _c <> 'c'").count() == 0
        else:
            assert out.columns == docs.columns
        rows = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
        if name == "quality rules":
            assert set(rows) == want | {(2, prose)} and len(rows) == 8
        elif name in ("SimHash near-dedup", "benchmark decontamination"):
            assert sorted(rows, key=str) == sorted(want, key=str)
        else:
            assert set(rows) <= want and rows
        docs = out
        assert stage(spark, docs.limit(0), SF).count() == 0

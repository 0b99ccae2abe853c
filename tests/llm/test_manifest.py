"""The Merkle manifest against trees built in one list, on a given table and on awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from footfall.llm import manifest, queries

SF = "/root/testdata/sf0.001"
ROWS = [
    (0, "s0", "en", 3, "a\nb"), (1, "s0", None, None, None), (2, "s0", "en", 0, ""), (2, "s0", "en", 0, ""), (2, "s0", "en", 1, "x"),
    (3, None, "en", 5, "\n\n\n"), (None, None, None, None, None), (None, "s0", "de", 2, "é\n"), (4, "", "en", 1, "z"),
    (5, "é", "en", 9, "a" * 200_000 + "\n"), (6, "日本", "en", 1, "q"), (7, "Z", "en", 1, "q"),
    *((i, "big", "en", i, f"text {i}\nend") for i in range(100, 900)),
]
COLUMNS = "doc_id long, source string, lang string, n_chars int, text string, hash int, tree string, place int, block string, root string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(d, s, lang, n, t):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (d, s, lang, n, t)))


def levels(row):
    out = [row]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i: i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    """(before, after) of a node at each level"""
    out = []
    for row in tree[:-1]:
        run = i - i % 3
        out.append(("".join(row[run:i]), "".join(row[i + 1: run + 3])))
        i //= 3
    return out


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by["" if r[1] is None else "=" + r[1]].append(r)
    names = sorted(by, key=str.encode)
    trees = {}
    for k in names:
        by[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[k] = levels([leaf(*r) for r in by[k]])
    summit = levels([trees[k][-1][0] for k in names])
    out = []
    for j, k in enumerate(names):
        for i, r in enumerate(by[k]):
            steps = path(trees[k], i) + path(summit, j)
            t = r[4]
            if t is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                t = t.replace("\n", "")
            node = leaf(*r[:4], t)
            for a, b in steps:
                node = sha(a + node + b)
            root = summit[-1][0]
            out.append((r[0], leaf(*r), trees[k][-1][0], root, sha("".join(a + b for a, b in steps)), node, node == root))
    return out


def order(r):
    return tuple((x is not None, str(x)) for x in r)


def answer(spark, tmp_path, df):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in queries.QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()), key=order)


@pytest.mark.parametrize("n", [len(ROWS), 1, 0])
def test_awkward_rows(spark, tmp_path, n):
    rows = ROWS[:n]
    df = spark.createDataFrame([(*r, 1, "t", 2, "b", "r") for r in rows], COLUMNS).repartition(3)
    assert answer(spark, tmp_path, df) == sorted(brute(rows) if rows else [], key=order)


def test_given_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = sorted((tuple(r) for r in queries.QUERIES["op13_merkle_manifest"](spark, SF).collect()), key=order)
    assert got == sorted(brute([tuple(r) for r in docs.collect()]), key=order)
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("stride", [1, 7])
def test_stride_changes_what_is_stored_not_the_proofs(spark, stride):
    rows = [(i, f"s{i % 3}" if i % 5 else "s0", "en", i, str(i)) for i in range(130)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    tree = manifest.build(docs, stride=stride)
    found = manifest.verify(manifest.proofs(tree), manifest.F.col("leaf")).collect()
    want = {r[0]: r for r in brute(rows)}
    assert {r["doc_id"] for r in found} == set(want) and all(r["verified"] for r in found)
    assert all((r["leaf"], r["subroot"], r["root"]) == want[r["doc_id"]][1:4] for r in found)
    stored = sum(x.count() for x in tree.sources.levels[1:])
    nodes = sum(len(x) for x in levels([str(i) for i in range(130)])[1:-1])
    assert stored < nodes or stride == 1
    assert len(tree.sources.levels) == {1: 4, 2: 2, 7: 1}[stride]
    tree.close()


def test_any_other_change_is_found(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, f"t{i}") for i in range(40)], "doc_id long, source string, lang string, n_chars int, text string")
    F = manifest.F
    changed = {"source": F.lit("S"), "lang": F.lit(None).cast("string")}
    for name, value in changed.items():
        tree = manifest.build(docs.withColumn("other", manifest.digest_of(docs, **{name: value})), carry=("doc_id", "other"))
        assert manifest.verify(manifest.proofs(tree), F.col("other")).filter("verified").count() == 0
        tree.close()

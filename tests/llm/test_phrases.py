"""Collocations against plain counting; the counting quotient filter against a counter."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import phrases
from footfall.llm.phrases import QuotientFilter, permute, restore

from .brute import FOLD


def brute(docs, longest=5, least=100, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        held = {g[i:j] for g, a in cand.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1) if j - i < len(g) and 100 * a >= 100 * cand[g[i:j]]}
        rows = []
        for g, a in cand.items():
            if g not in held:
                cuts = [(1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts(rnd, n):
    words = ["the", "The", "of", "and", "é", "日本", "a\x01", "a-b", "a", "new", "york", "city", "in", "x" * 40, "#", "'s"]
    out = []
    for _ in range(n):
        lang = rnd.choice(["en", "en", "en", "fr", None, ""])
        w = [rnd.choice(words[: rnd.choice([4, 8, 16])]) for _ in range(rnd.randint(0, 60))]
        out.append((lang, "".join(x + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", " ! "]) for x in w)))
    return out


AWKWARD = [("en", None), (None, ""), (None, None), ("en", " \t\n.,;"), ("en", "new york " * 700), ("en", "New York city of the " * 300 + "end"),
           ("fr", "a b. a b, a b! a b"), ("en", "one two three four five six " * 3), ("und", "new york")]


@pytest.mark.parametrize("least, top", [(2, 2000), (5, 7)])
def test_awkward_rows(spark, monkeypatch, least, top):
    monkeypatch.setattr(phrases, "HEAD", 12)  # few words are sent along, others joined
    docs = AWKWARD * 2 + texts(random.Random(least), 150)
    df = spark.createDataFrame([(*r, "w", 1, 2, "g") for r in docs], "lang string, text string, word string, id int, f int, gram string").repartition(5)
    got = [tuple(r) for r in phrases.collocations(df, least=least, top=top).collect()]
    assert sorted(got) == brute(docs, least=least, top=top)


def test_blocks_hold_every_word_and_neighbour(monkeypatch):
    docs = [d for d in AWKWARD + texts(random.Random(1), 300)]
    batch = pa.RecordBatch.from_arrays([pa.array(["und" if d[0] is None else d[0] for d in docs]), pa.array([d[1] for d in docs], pa.string())], names=["lang", "text"])

    def pairs(block):
        monkeypatch.setattr(phrases, "BLOCK", block)
        words, found, n = Counter(), Counter(), 0
        for lang, distinct, which, at in phrases._blocks(iter([batch.slice(0, 100), batch.slice(100)])):
            n += 1
            w = [(lang, distinct[i].as_py()) for i in which]
            words.update(w)
            found.update((a, b) for a, b, x, y in zip(w, w[1:], at, at[1:], strict=False) if y == x + 1)
        return words, found, n

    small, large = pairs(500), pairs(1 << 20)
    assert small[:2] == large[:2] and small[2] > 3 * large[2]
    assert sum(small[0].values()) == sum(r[6] for r in {(r[0], 0, 0, 0, 0, 0, r[6]) for r in brute(docs, least=1)})


def test_no_rows(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_a_hot_phrase_and_a_long_text(spark):
    docs = [("en", "new york city hall, " * 30_000), ("en", "york " * 50_000)]
    got = [tuple(r) for r in phrases.collocations(spark.createDataFrame(docs, "lang string, text string")).collect()]
    assert got == brute(docs)


@pytest.mark.parametrize("n", [2, 3, 4, 5])
@pytest.mark.parametrize("bits", [20, 27, 31])
def test_permutation_is_one_to_one(n, bits):
    rng = np.random.default_rng(n * bits)
    ids = [rng.integers(0, 1 << bits, 5000, dtype=np.uint64) for _ in range(n)]
    ids = [np.concatenate((x, [0, (1 << bits) - 1])).astype(np.uint64) for x in ids]
    scrambled = permute(ids, bits)
    assert all(int(x.max()) < 1 << bits for x in scrambled)
    assert all((a == b).all() for a, b in zip(restore(scrambled, bits), ids, strict=True))


def test_small_permutation_covers_everything():
    a, b = np.meshgrid(np.arange(64, dtype=np.uint64), np.arange(64, dtype=np.uint64))
    out = permute([a.ravel(), b.ravel()], 6)
    assert len(set(zip(*(x.tolist() for x in out), strict=True))) == 64 * 64


@pytest.mark.parametrize("n", [2, 3, 5])
def test_filters_are_lossless_counters(n):
    rng, bits, range_bits = np.random.default_rng(n), 21, 5
    want, shards = Counter(), defaultdict(list)
    for size in (1, 7, 4000, 20_000):
        ids = [rng.integers(0, 12 if j else 300, size, dtype=np.uint64) for j in range(n)]
        counts = rng.integers(1, 2000, size)
        for g, c in zip(zip(*(x.tolist() for x in ids), strict=True), counts.tolist(), strict=True):
            want[g] += c
        for number, part in QuotientFilter.of(permute(ids, bits), counts, bits, range_bits).split():
            shards[number].append(part.dump())
    got = {}
    for number, dumps in shards.items():
        merged = QuotientFilter.merge([QuotientFilter.load(d, bits, range_bits, number) for d in dumps])
        again = QuotientFilter.load(merged.dump(), bits, range_bits, number)
        got |= dict(zip(zip(*(x.tolist() for x in again.ids()), strict=True), again.counts.tolist(), strict=True))
    assert got == want and len(shards) > 16


def test_filters_are_smaller_than_their_keys():
    rng, bits, range_bits = np.random.default_rng(1), 20, 5
    ids = [np.arange(200_000, dtype=np.uint64) % (1 << 18), rng.integers(0, 1 << 20, 200_000, dtype=np.uint64)]
    parts = [f.dump() for _, f in QuotientFilter.of(permute(ids, bits), np.ones(200_000, np.int64), bits, range_bits).split()]
    assert sum(map(len, parts)) < 200_000 * 5  # 40 bits of ids and a counter in less than 40 bits


def test_score_is_exact(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(300):
        a = rnd.randint(100, 10 ** rnd.randint(3, 13))
        n = rnd.randint(a, 10 ** 14)
        rows.append((a, rnd.randint(a, n), rnd.randint(a, n), n))
    rows += [(100, 100, 100, 10 ** 15), (3, 3, 1, 7), (10 ** 13,) * 4]
    df = spark.createDataFrame(rows, "a long, l long, r long, n long")
    F = phrases.F
    got = {tuple(r)[:4]: r["s"] for r in df.withColumn("s", phrases._score(F.col("a"), F.col("l"), F.col("r"), F.col("n"))).collect()}
    assert all(got[r] == 1000 * r[0] * r[3] // (r[1] * r[2]) for r in rows)

"""Each operator against a brute-force version, on a given table and on awkward rows."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import html_diff, line_dedup, mixing, pii, quality, queries, revisits, sharding, simhash, tokens, winnow

from . import brute

SF = "/root/testdata/sf0.001"

PROSE = "the quick brown fox jumps over the lazy dog and runs home again before night falls on quiet fields"
AWKWARD = [
    (0, None, "s0"), (1, "", "s1"), (2, " \t\n", None), (3, PROSE, "s0"), (4, PROSE, "s0"), (4, PROSE, "s0"),
    (5, PROSE.upper() + "\n" + PROSE, "s2"), (6, PROSE + " word", None), (7, "a" * 30000 + " " + PROSE, "é"),
    (None, PROSE, "s1"), (None, None, None), (8, "\n".join([PROSE] * 40), "s2"), (9, "x\r\n" + PROSE + "\x0b\n\n", "s3"),
    (10, "mail a.b@c.de_f@g.hi 1.2.3.4 999.1.1.1 4111 1111 1111 1111 +1 (017) 555-7713 é 12345678901234567890", "s3"),
    (11, "日本語 " * 60 + "٣ ²", "z"), (12, " ".join(f"w{i}" for i in range(400)), "z"), (13, "A@B..c @ +1+2 1.2.3 " * 30, "s1"),
    (14, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" iban DE89370400440532013000 phone 555-123-4567", "s1"),
]
COLUMNS = "doc_id long, text string, source string, fp int, bin string, shard string, at int, key string, size string, n_words int, _1 int"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, 1, "b", "s", 2, "k", "z", 3, 4) for r in AWKWARD], COLUMNS).repartition(3).persist()


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(params=["awkward", "given", "empty"])
def docs(request, awkward, given):
    return {"awkward": awkward, "given": given, "empty": awkward.limit(0)}[request.param]


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def texts(docs):
    return rows(docs, "doc_id", "text")


def same(a, b):
    def order(r):
        return tuple((x is not None, str(x)) for x in r)

    assert sorted(map(tuple, a), key=order) == sorted(map(tuple, b), key=order)


def test_token_counts(docs):
    path = queries.tokenizer_path()
    tok = tokens.Tokenizer.from_file(path)
    got = tokens.token_counts(docs, path).collect()
    want = []
    for d, t in texts(docs):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 512))
    same(got, want)


def test_token_counter_on_odd_texts():
    path = queries.tokenizer_path()
    with open(path, encoding="utf-8") as f:
        definition = f.read()
    c = tokens.TokenCounter(definition, tokens.prove_whole(definition), tokens.odd_characters(definition))
    rnd = random.Random(5)
    letters = "abc ABC  \n\t'19é日ñ!?<|endoftext|>" + "\x1c\x85 ՘\U0001F600　'll"
    for _ in range(3000):
        s = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        s += rnd.choice(["", "<|endoftext|>", "<|endoftext|> x", "<|endof"])
        assert c.count(s) == len(c.tok.encode(s, add_special_tokens=False).ids), repr(s)
    assert c.count("a" * 20000) == len(c.tok.encode("a" * 20000, add_special_tokens=False).ids)


def test_proven_strings_are_single_tokens():
    path = queries.tokenizer_path()
    with open(path, encoding="utf-8") as f:
        definition = f.read()
    tok = tokens.Tokenizer.from_str(definition)
    whole = sorted(tokens.prove_whole(definition))
    assert len(whole) > 40000
    assert all(len(e.ids) == 1 for e in tok.encode_batch(whole, add_special_tokens=False))


def test_line_dedup(docs):
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()
    same(got, brute.line_dedup(texts(docs)))


def test_line_dedup_splits_a_common_line(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "PROBES", 50)
    line = "this very common line is in every document"
    docs = spark.createDataFrame([(i, f"{line}\nown line number {i} of this document\n{line}") for i in range(300)], "doc_id long, text string")
    got = line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)).collect()
    same(got, brute.line_dedup(texts(docs)))


def test_perfect_hash_is_minimal():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 70000):
        keys = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        n = len(keys)
        index = line_dedup.LineIndex(line_dedup.build_index(keys, keys + np.uint64(1), np.arange(n), np.arange(n)))
        assert sorted(line_dedup._places(index.levels, keys).tolist()) == list(range(n))
        known, keeper = index.keeper(keys, keys + np.uint64(1))
        assert known.all() and keeper.tolist() == list(range(n))
        strange = rng.integers(0, 2**63, 500).astype(np.uint64)
        assert not index.keeper(strange, strange)[0].any()


def test_contamination(spark, docs):
    given = rows(spark.read.parquet(f"{SF}/benchmark.parquet"), "item_id", "text")
    items = given + [(900, "lazy DOG, and runs"), (901, ""), (902, None), (None, "brown fox"), (903, PROSE), (903, PROSE), (904, "word")]
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, fp int")
    got = winnow.contamination(docs, bench).drop("text_key").collect()
    same(got, brute.contamination(texts(docs), items))


def test_contamination_without_items(spark, awkward):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not winnow.contamination(awkward, bench).filter("contaminated").count()
    assert winnow.keep_clean(awkward, bench).count() == len(AWKWARD)


def test_winnowing_guarantee(spark):
    rnd = random.Random(2)
    items = [(i, " ".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 30)))) for i in range(20)]
    docs = [(i, " ".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 60))) + " " + rnd.choice(items)[1][: rnd.randint(0, 60)]) for i in range(200)]
    got = winnow.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    same(got.drop("text_key").collect(), brute.contamination(docs, items))


def test_matches_of_repeated_words_grow_with_the_words(spark):
    for phrase in ("same", "same old", "it goes on and on"):
        counts = []
        for n in (300, 1200):
            docs = [(1, " ".join([phrase] * n)), (2, f"a start {' '.join([phrase] * n)} an end"), (3, phrase)]
            items = [("i", " ".join([phrase] * n)), ("j", f"{' '.join([phrase] * 9)} x {' '.join([phrase] * n)} y")]
            a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
            counts.append(winnow.scan_hits(a, b)[1].count())
            same(winnow.contamination(a, b).drop("text_key").collect(), brute.contamination(docs, items))
        assert counts[0] == counts[1] < 2000, counts


def test_simhash(docs):
    got = simhash.near_duplicates(docs).drop("text_key").collect()
    pairs = texts(docs)
    fps = [brute.fingerprint(t) for _, t in pairs]
    same(got, [(d, f"{f:016x}", c) for (d, _), f, c in zip(pairs, fps, brute.components([d for d, _ in pairs], fps))])


def near_pairs(signed, max_bits):
    v = np.array(signed, np.int64).view(np.uint64)
    for i, x in enumerate(v):
        close = np.flatnonzero(np.bitwise_count(v[i + 1:] ^ x) <= max_bits) + i + 1
        yield from ((min(signed[i], signed[j]), max(signed[i], signed[j])) for j in close)


@pytest.mark.parametrize("max_bits,segments,limit", [(1, 4, 1), (2, 5, 1), (2, 5, 16), (2, 5, 1000), (3, 5, 1), (3, 7, 16), (5, 6, 1)])
def test_links_are_all_near_pairs(spark, max_bits, segments, limit):
    rnd = random.Random(7)
    centres = [rnd.getrandbits(64) for _ in range(20)]
    fps = {c ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for c in centres for _ in range(rnd.choice([1, 3, 60]))}
    signed = sorted(simhash._signed(x) for x in fps)
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), max_bits, segments, limit)
    assert sorted(map(tuple, found.collect())) == sorted(near_pairs(signed, max_bits))


@pytest.mark.parametrize("max_bits", [2, 3])
def test_links_of_a_key_with_ten_thousand_fingerprints(spark, max_bits):
    rnd = random.Random(9)
    high, signed = rnd.getrandbits(26) << 38, set()
    while len(signed) < 10_000:  # the last 26 bits of the ring are equal: one key holds them all
        signed.add(simhash._signed(high | rnd.getrandbits(38)))
    signed = sorted({*signed, *(simhash._signed(x % 2**64 ^ 1 << rnd.randrange(38) ^ 1 << rnd.randrange(38)) for x in list(signed)[:300])})
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), max_bits)
    want = sorted(near_pairs(signed, max_bits))
    assert len(want) > 200 and sorted(map(tuple, found.collect())) == want


def test_keep_one(awkward):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    left = texts(kept)
    fps = {x: brute.fingerprint(x[1]) for x in texts(awkward)}
    comp = brute.components([d for d, _ in texts(awkward)], [fps[x] for x in texts(awkward)])
    groups = {}
    for x, c in zip(texts(awkward), comp):
        groups.setdefault((c, fps[x] if c is None else 0), []).append(x)
    assert len(left) == len(groups) and set(left) <= set(texts(awkward))


def test_keep_one_by_component(spark):
    other = " ".join(f"else{i * 7}" for i in range(90))
    near = " ".join(f"word{i}" for i in range(4000))
    copies = [near, near + " end", near.replace("word2000", "new")]
    fps = [brute.fingerprint(x) for x in copies]
    assert len(set(fps)) > 1 and len(set(brute.components([0, 1, 2], fps))) == 1
    # Unrelated texts with one id both stay; near copies without an id are one.
    docs = spark.createDataFrame([(1, PROSE), (1, other), *((None, x) for x in copies)], "doc_id long, text string")
    left = texts(simhash.keep_one(docs))
    assert len(left) == 3 and {(1, PROSE), (1, other)} < set(left) and any((None, x) in left for x in copies)


def test_personal_data(docs):
    got = pii.span_digest(pii.personal_data(docs)).collect()
    want = {}
    for d, t in texts(docs):
        *n, base = brute.pii(t)
        want.setdefault((d, *n, brute.sha(base)), []).append(base)
    same([tuple(r)[:6] for r in got], [k for k, v in want.items() for _ in v])


def test_personal_data_patterns(spark):
    rnd = random.Random(11)
    letters = "aZ9 .-_@+()%1234567890é😀"
    docs = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80)))) for i in range(1500)]
    docs += [(5000, "1" * 50000), (5001, "a" * 50000 + "@"), (5002, "a@" * 20000), (5003, "+1 " * 20000), (5004, "4111111111111111 " * 500)]
    got = pii.span_digest(pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
    same([tuple(r)[:6] for r in got], [(d, *(x := brute.pii(t))[:4], brute.sha(x[4])) for d, t in docs])


def test_personal_data_with_very_many_matches(spark):
    docs = [(i, "é" + x * n) for i, (x, n) in enumerate((x, n) for x in ("a@b.cd ", "1.2.3.4 😀", "x 4111111111111111\n", "+123456789012 x") for n in (127, 128, 129, 30000))]
    got = pii.span_digest(pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string"))).collect()
    same([tuple(r)[:6] for r in got], [(d, *(x := brute.pii(t))[:4], brute.sha(x[4])) for d, t in docs])


def test_running_totals(spark):
    rnd = random.Random(3)
    values = spark.createDataFrame([([rnd.randint(0, 50) for _ in range(n)],) for n in (0, 1, 2, 3, 4, 5, 8, 9, 127, 128, 129, 1000)], "v array<int>")
    for block in (1, 3, 128):
        for v, total in values.select("v", pii._running(F.col("v"), block)).collect():
            assert total == list(itertools.accumulate(v))


def test_personal_data_further_kinds(awkward):
    found = {r["doc_id"]: r["spans"] for r in pii.span_digest(pii.personal_data(awkward)).collect()}
    assert [x.split(":")[0] for x in found[14].split(",")] == ["iban", "national_phone", "secret"]


def test_context_of_personal_data(spark):
    one, two, three = "555-111-2222", "555-333-4444", "555-555-6666"
    docs = [
        (0, f"phone {one} or {two}"), (1, f"{one} is my phone"), (2, f"call {one}, {two}, {three}, {one} and {two}"), (3, f"call {one}. Part numbers in stock of our shop are {two}"),
        (4, f"telephone{'x' * 30} {one}"), (5, f"{'x' * 300} phone {one} {'y ' * 30}{two}"), (6, f"{one} and then a long way to the word that is phone"), (7, f"tele{'-' * 36}phone {one}"),
        (8, f"{one} {'.' * 34} phones")]
    found = pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).select("doc_id", "spans_national_phone").collect()
    assert {d: [docs[d][1][s["start"]: s["stop"]] for s in spans] for d, spans in found} == {
        0: [one, two], 1: [one], 2: [one, two, three, one, two], 3: [one], 4: [], 5: [one], 6: [], 7: [one], 8: []}


def test_scores_by_brute_force(spark):
    rnd = random.Random(8)
    parts = ["555-111-2222", "(555) 111-2222", "a.b@c.de", "1.2.3.4", "+1 555 111 2222", "phone", "Tel:", "mail", "server", "😀", "words of no meaning here", ". ", "\n\n", ", ", " or ", "x" * 33,
             "abcdefghij0123456789ABCDEFGHIJ_-+/xyz", "access key", "password=", "\t", "telephone", "y" * 250]
    docs = [(i, "".join(rnd.choice(parts) + rnd.choice([" ", " ", ""]) for _ in range(rnd.randint(0, 40)))) for i in range(400)]
    found = pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    kinds = {k.name: k for k in pii.KINDS}
    for r in found:
        for name in ("email", "ip", "phone", "national_phone", "secret"):
            kind, text = kinds[name], docs[r["doc_id"]][1]
            want = [x for x in brute.pii_scores(text, kind) if kind.base or x[2] >= pii.THRESHOLD]
            if name == "secret":
                want = [x for x in want if any(c.isdigit() for c in text[x[0]: x[1]])]
            got = [(s["start"], s["stop"], round(s["score"], 6)) for s in r[f"spans_{name}"]]
            if kind.base:  # validators are tested elsewhere
                want = [x for x in want if x[:2] in {g[:2] for g in got}]
            assert got == [(a, b, round(c, 6)) for a, b, c in want], (name, got, want, text[max(0, got[0][0] - 45): got[0][1] + 45] if got else text)


def test_account_numbers_before_capital_words(spark):
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "FR14 2004 1010 0505 0001 3M02 606"]
    after = ["", " BIC COBADEFF", " 00 USD", " I paid", " X", " 12", ", B", " DE89 3704 0044 0532 0130 00", " AB12 " + ibans[0]]
    docs = [(i, f"pay {x}{y}") for i, (x, y) in enumerate(itertools.product(ibans, after))]
    docs += [(100, "pay AB12 DE89 3704 0044 0532 0130 00 X"), (101, "pay DE88 3704 0044 0532 0130 00 X"), (102, "DE89 3704 0044 0532 0130 000")]
    got = dict(pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).select(
        "doc_id", F.transform("spans_iban", lambda s: F.struct(s["start"], s["stop"]))).collect())
    for i, (x, y) in enumerate(itertools.product(ibans, after)):
        want = [(4, 4 + len(x))] + ([(len(docs[i][1]) - len(ibans[0]), len(docs[i][1]))] if y.endswith(ibans[0]) else [])
        assert [tuple(s) for s in got[i]] == want, docs[i]
    assert [tuple(s) for s in got[100]] == [(9, 36)] and not got[101] and not got[102]


def test_quality_counts(docs):
    got = quality.judge(docs).select("doc_id", *quality.COUNTS, "base_failed").collect()
    same(got, [(d, *brute.quality(t)) for d, t in texts(docs)])


def test_quality_verdicts(spark, docs):
    judged = quality.judge(docs)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    same(texts(kept), [(r["doc_id"], t) for r in judged.filter("kept").join(docs.select("doc_id", "text").distinct(), "doc_id").collect() for t in [r["text"]]])
    assert not judged.filter("kept and base_failed").count()


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n = {(r["quality"], r["kept"]): r["count"] for r in judged.filter("not base_failed").groupBy("quality", "kept").count().collect()}
    assert n.get((1, False), 0) == 0
    assert n.get((0, True), 0) <= 0.02 * (n.get((0, False), 0) + 1)


def test_quality_verdicts_by_brute_force(docs):
    votes = [brute.quality_votes(t) for _, t in texts(docs)]
    failed = [brute.quality(t)[-1] for _, t in texts(docs)]
    got = quality.judge(docs).select("doc_id", "kept").collect()
    same(got, [(d, not f and k) for (d, _), f, k in zip(texts(docs), failed, brute.em_kept(votes))])


def test_posterior_is_not_all_must_pass(spark):
    """Good documents that one rule alone calls bad are kept, junk that rules agree on goes."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    voted_bad = {d for d, t in texts(docs) if -1 in brute.quality_votes(t)}
    judged = [r for r in quality.judge(docs).collect() if not r["base_failed"]]
    rescued = [r["doc_id"] for r in judged if r["kept"] and r["doc_id"] in voted_bad]
    assert len(rescued) > 30 and {labels.get(d, 1) for d in rescued} == {1}
    assert all(r["kept"] for r in judged if r["doc_id"] not in voted_bad)


def test_em_keeps_documents_without_bad_votes():
    good = 3 ** len(quality.RULES) - 1
    for counts in ({good: 1000}, {good: 10, good - 2: 990}, {good // 2: 5}, {}):
        assert quality.fit(counts).good(good) >= 0.5


def test_em_weighs_rules_by_agreement():
    good, bad = 3 ** len(quality.RULES) - 1, [2 * 3 ** r for r in range(len(quality.RULES))]
    # The last rule errs on a third of all; two others agree on a tenth of them.
    model = quality.fit({good: 600, good - bad[0]: 300, good - bad[3] - bad[5]: 100})
    assert model.good(good - bad[0]) > 0.9 and model.good(good - bad[3] - bad[5]) < 0.1
    assert set(model.kinds) == {len(quality.RULES) - 1 - 3, len(quality.RULES) - 1 - 5}
    # A rule that no other bears out decides nothing, however rare its bad votes are.
    assert quality.fit({good: 990, good - bad[4]: 10}).good(good - bad[4]) > 0.5


def test_targets_and_taken(docs):
    got = mixing.mix(docs)
    sizes = {}
    by_row = {}
    for d, t, s in rows(docs, "doc_id", "text", "source"):
        n = len(brute.SPACED.findall(t or ""))
        sizes[s] = sizes.get(s, 0) + n
        by_row.setdefault((d, n), set()).add(s)
    want = brute.targets(sizes)
    taken = {}
    for r in got.collect():
        options = [s for s in by_row[r["doc_id"], r["size"]] if sizes[s] == r["source_size"] and abs(want[s] - r["target"]) < 1e-6 * (1 + want[s])]
        assert options
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert all(0 <= t <= 1 for t in r["times"]) and r["times"] == sorted(r["times"])
        if len(by_row[r["doc_id"], r["size"]]) == 1:
            taken[options[0]] = taken.get(options[0], 0) + r["taken"]
    if docs.count() == 200:
        assert all(abs(taken.get(s, 0) - want[s]) <= 1 for s in want)
    a, b = (sorted(mixing.mix(docs, bins=n).drop("times").collect(), key=str) for n in (1, 64))
    assert a == b


def test_targets_of_many_sources(spark):
    rnd = random.Random(3)
    sizes = {f"host{i}": rnd.choice([0, 1, 7, 50, 400, 10 ** 7]) for i in range(3000)} | {None: 90, "é": 1, "": 5}
    given = spark.createDataFrame([(s is None, s or "", n) for s, n in sizes.items()], "no_source boolean, source string, source_size long")
    want = brute.targets(sizes)
    plan = mixing.source_targets(given).collect()
    got = {None if r["no_source"] else r["source"]: r["target"] for r in plan}
    assert len(plan) == len(want) and all(abs(got[s] - want[s]) <= 1e-6 * (1 + want[s]) for s in want)
    assert sorted(r["rank"] for r in plan) == list(range(len(want)))


def test_rows_without_id_are_spread(spark):
    docs = spark.createDataFrame([(None, f"w{i} " * 3, "s") for i in range(3000)], "doc_id long, text string, source string")
    assert mixing._sized(docs, 64).select("bin").distinct().count() == 64
    assert mixing.mix(docs).agg(F.sum("taken")).first()[0] == 9000


def test_mix_order_follows_the_schedules(spark):
    docs = spark.createDataFrame([(i, "w " * 50, f"s{i % 3}") for i in range(3000)], "doc_id long, text string, source string")
    early = {r["source_size"]: r for r in []}
    out = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").withColumn("t", F.explode("times"))
    half = {(r["source"], r["late"]): r["count"] for r in out.groupBy("source", (F.col("t") > 0.5).alias("late")).count().collect()}
    # Falling, level and rising weights: 62.5 %, 50 % and 37.5 % of the words in the first half.
    for source, share in (("s0", 0.625), ("s1", 0.5), ("s2", 0.375)):
        n = half[source, False] + half[source, True]
        assert abs(half[source, False] / n - share) < 0.01, (source, half)
    assert not early


def test_positions(docs):
    mixed = mixing.mix(docs)
    got = mixing.with_positions(mixed).collect()
    assert sorted(str(tuple(r)[:-1]) for r in got) == sorted(str(tuple(r)) for r in mixed.collect())
    assert all(len(r["positions"]) == r["copies"] for r in got)
    copies = sorted((p, t, r["doc_id"]) for r in got for p, t in zip(r["positions"], r["times"]))
    assert [p for p, _, _ in copies] == list(range(len(copies)))
    order = [(t, d is not None, d or 0) for _, t, d in copies]
    assert order == sorted(order)


def test_mixed_rows(awkward):
    out = mixing.mixed_rows(awkward)
    assert out.columns == awkward.columns
    copies = {}
    for r in mixing.mix(awkward).collect():
        copies[r["doc_id"], r["text_key"]] = copies.get((r["doc_id"], r["text_key"]), 0) + r["copies"]
    got = out.withColumn("k", mixing.text_key(F.col("text"))).groupBy("doc_id", "k").count().collect()
    assert {(r["doc_id"], r["k"]): r["count"] for r in got} == {k: n for k, n in copies.items() if n}


def test_shards(docs):
    pairs = texts(docs)
    got = sharding.shard(docs, carry=("text",))
    if not pairs:
        assert not got.count()
        return
    _, want = brute.shards(pairs)
    same(rows(got, "doc_id", "text", "size", "text_crc32", "shard"), [(d, t, *w) for (d, t), w in zip(pairs, want)])
    slots = {}
    for s, i in rows(got, "shard", "slot"):
        slots.setdefault(s, []).append(i)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_capacity_search(spark):
    rnd = random.Random(4)
    for n, k, fine in ((1, 8, 4), (5, 8, 4), (400, 8, 4), (400, 3, 16), (3000, 8, 512)):
        sizes = [rnd.randint(1, 10 ** rnd.randint(1, 6)) for _ in range(n)]
        upto, at = [], 0
        for s in sizes:
            at += s
            upto.append(at)
        ends = [x for i, x in enumerate(upto) if i % 37 == 0 or x == at]
        totals = spark.createDataFrame([(x,) for x in upto], "upto long")
        cap, cuts = sharding.minimax_cuts(totals, ends, max(sizes), k, fine)
        want, run = brute.minimax(sizes, k)
        assert cap == want
        assert [sum(u > c for c in cuts[:-1]) for u in upto] == run


PAGES = [
    (1, "http://h.example/a/1", "<html><body><nav><a href=x>Menu</a></nav><article><h1>T&amp;t</h1><p>One  <b>bold</b>ly\n two<br>three</article><footer>f</footer>"),
    (2, "http://h.example/a/2", "<div>Top bar</div><div>Own text of page two, long enough to stand</div><div>Foot</div>"),
    (3, "http://h.example/a/3", "<div>Top bar</div><div>Another page with quite other words in it</div><div>Foot</div>"),
    (4, None, None), (5, "", ""), (None, "junk", "<p>just &lt;text&gt; &#233; &nbsp; x<script>var a='</p>';</script></p>"),
    (6, "http://h.example/b", "<main><p>Body</p><div class='comments'><p>nice!</p></div><form><p>f</p></form></main><aside>s</aside>"),
    (7, "http://h.example/b", "<main><p>Body</p><div class='comments'><p>nice!</p></div><form><p>f</p></form></main><aside>s</aside>"),
]
TEXTS = {
    1: "T&t One boldly two three", 2: "Own text of page two, long enough to stand", 3: "Another page with quite other words in it",
    4: "", 5: "", None: "just <text> é x", 6: "Body", 7: "Body",
}


def test_page_difference(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, text string")
    got = html_diff.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == TEXTS and len(got) == len(PAGES)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert not html_diff.extract(pages.limit(0)).count()


def test_lines_of_odd_markup():
    def text(page):
        return [x for _, x in html_diff.lines_of(page)]

    assert text("<p title=it's>one</p><p>don't</p>") == ["one", "don't"]
    assert text('<p title="a > b" data-x=\'>\'>one</p><p class="x>two</p>') == ["one", "two"]
    assert text("a <b and c") == ["a <b and c"] and text("<p>x</p><br") == ["x"]
    roles = dict((x, role) for role, x in html_diff.lines_of(
        '<p style="overflow:hidden" title="the hidden id=ad">seen</p><p hidden>not</p><p style="display: none">nor</p><p data-id="ad">data</p><p id=ad-1>ad</p>'))
    assert {x for x, role in roles.items() if role == html_diff.BOILER} == {"not", "nor", "ad"}
    for page in ("<div " * 50000, "a <b and c<d " * 50000, "<div>" * 50000 + "</p>" * 50000, "<a '" * 50001, "<! " * 50000):
        html_diff.lines_of(page)  # linear: quadratic steps would take minutes


def seen(page):
    return " ".join(x for role, x in html_diff.lines_of(page) if role != html_diff.BOILER)


def test_text_after_marked_elements():
    for page, text in (
        ("<article><p>A <a class=share>x</a> B</p><p>C</p></article>", "A B C"),
        ("<article><p>A <span class='ad'>x <span>y</span> z</span> B</p><p>C</p></article>", "A B C"),
        ("<article><p>A <span class=ad>x</p><p>B</p></article><p>C</p>", "A B C"),
        ("<article><a class=share><div>x</a>B</div><p>C</p></article>", "B C"),
        ("<div>A <a class=share>x <a href=y>B</a> C</div>", "A B C"),
        ("<article><p class=ad>x<p>B</article>", "B"), ("<article><p class=ad>x<div>B</div></article>", "B"),
        ("<ul><li class=ad>x<li>B</ul>", "B"), ("<ul><li class=ad><ul><li>x</li></ul>y</li><li>B</li></ul>", "B"),
        ("<dl><dt class=ad>x<dd>B</dl>", "B"), ("<table><tr><td class=ad>x<td>B<tr><td>C</table>", "B C"),
        ('<article><svg width="1"/>A<svg/><p>B</p><svg><text>x</text></svg>C</article>', "A B C"),
        ("<svg data-u=/x/>x</svg>A<script src=y /><p>B</p><script>x</script><script src=y />x</script>C", "A B C"),
        ("<div data-u=/x/>A<p hidden>x</p></div>B", "A B"),
    ):
        assert seen(page) == text, page
    for page in ("<a class=ad>" * 30000 + "<div>" * 30000 + "</a>" * 30000, "<li><ul>" + "<x>" * 30000 + "<li></li>" * 30000,
                 "<p class=ad><x>" * 30000, "<span class=ad>" * 30000 + "</span>" * 30000, "<svg/><script/><style/>" * 20000):
        html_diff.lines_of(page)  # linear: quadratic steps would take minutes


def test_articles_in_marked_elements():
    prose = "Whole clean article text"
    for page, text in (
        ("<body class='single has-sidebar'><article class='post comments-open'><p>A</p></article></body>", "A"),
        ("<body class=search><main id=search><article id=comment><p>A</p></article></main></body>", "A"),
        ("<body style='display: none'><p>A</p></body>", "A"), ("<div id='search-result'><article>A</article>B</div>", "A B"),
        ("<div class=search><b>x</b><article>A</article>x</div>", "A"), ("<form><article>A</article></form>", "A"),
        (f"<body><form id=aspnetForm><div>{prose}</div><div class=ad>x</div><button>x</button></form></body>", prose),
        (f"<p>{prose}</p><form>x</form>", prose), (f"<article>{prose}<form>x</form></article>", prose),
        ("<article>A<div class=comments><article>x</article></div></article>", "A"), ("<nav><span class=ad><article>x</article></span></nav>A", "A"),
        ("<article hidden>x</article><div hidden><article>x</article></div>A", "A"),
        ("<div class='cookie-banner'>x</div><div class='ad-1 has-sidebar'>x</div><div class='no-ads'>A</div>", "A"),
    ):
        assert seen(page) == text, page


def test_comments_and_menus_inside_articles():
    for word in ("comment-list", "comment-body", "comment_content", "menu-item", "main-menu", "share-buttons", "user-comments", "site-header", "topbar", "comments-area"):
        assert seen(f"<article><p>Own words</p>one<ul class='x {word}'><li>Nice post</ul><p>two</p></article>") == "Own words one two", word
        assert seen(f"<div>Own words</div><div class={word}><p>Nice post</p></div>") == "Own words", word
    for word in ("share-price", "related-work", "content-sidebar-wrap", "has-sidebar", "no-comments", "comment-free", "post-content", "entry-header", "post", "2-1"):
        assert seen(f"<article><div class='{word}'>Own words</div></article>") == "Own words", word
    assert seen("<div class=comment-list><article>Not in an article</article></div>") == "Not in an article"


def test_pages_cut_inside_a_tag():
    for page, text in (
        ('<p>Hello <a href="x', "Hello"), ('<p>Hello <a href="x y" ti', "Hello"), ("<p>Hello <a", "Hello"), ("<p>Hello</", "Hello"), ("<p>Hello <", "Hello"),
        ("<p>Hello <!-- x", "Hello"), ("<p>Hello <!DOC", "Hello"), ('<a href="x', ""), ("<p>1 < 2", "1 < 2"), ("<p>Hello</p", "Hello"), ("Hello <script>x", "Hello"),
    ):
        assert seen(page) == text, page


def test_differencing_decides_unmarked_lines_beside_articles(spark):
    def page(i):
        return f"<div>Shared top bar</div><div>Main text of page {i} in a plain div</div><article>Card {i}</article><article>Common card</article><div>Foot</div>"

    pages = spark.createDataFrame([(i, f"http://h.example/{i}", page(i)) for i in range(4)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_diff.extract(pages).collect()} == {
        i: f"Main text of page {i} in a plain div Card {i} Common card" for i in range(4)}


def test_partners_of_pages_of_one_path(spark):
    menu = "".join(f"<div>Menu entry {i}</div>" for i in range(12))

    def page(i):
        return f"{menu}<div>Short article of its own, number {i}, with some words {i * i}</div><div>Foot</div>"

    copy = f"{menu}<div>The same article under two addresses of one site</div><div>Foot</div>"
    urls = {i: f"http://a.example/index.php?id={i // 3}" for i in range(30)}  # each captured three times
    urls |= {i: "http://b.example/x" + "?utm_source=f" * (i % 2) for i in range(30, 60)} | {60: "http://b.example/y"} | {i: None for i in range(61, 70)}
    rows_ = [(i, u, page(i)) for i, u in urls.items()] + [(i, f"http://c.example/{i}", copy) for i in (70, 71)]
    pages = spark.createDataFrame(rows_, "page_id long, url string, html string")
    got = html_diff.extract(pages).collect()
    want = {i: f"Short article of its own, number {i}, with some words {i * i}" for i in urls}
    full = " ".join([*(f"Menu entry {i}" for i in range(12)), "The same article under two addresses of one site Foot"])
    assert {r["page_id"]: r["text"] for r in got} == want | {70: full, 71: full}
    assert all(r["partner"] == "http://b.example/y" for r in got if 30 <= r["page_id"] < 60)
    one = {tuple(r) for r in html_diff.extract(pages.repartition(5), ranges=1).collect()}
    assert one == {tuple(r) for r in got} and len(one) == len(rows_)


def test_long_runs_wait_in_a_file(monkeypatch):
    import pyarrow as pa
    import zlib

    monkeypatch.setattr(html_diff, "WAITING_MB", 0)
    blob = [zlib.compress(f"1Menu\n1Text of page {i}, in quite some words of its own".encode()) for i in range(40)]
    cols = [[0] * 40, [True] * 40, ["h"] * 40, ["/p"] * 40, [f"h/p?{i // 4:02}" for i in range(40)], list(range(40)), [f"u{i}" for i in range(40)], blob]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["area", "own", *html_diff._KEY, "blob"])
    out = [r for b in html_diff._walk(iter([batch])) for r in b.to_pylist()]
    assert [r["text"] for r in out] == [f"Text of page {i}, in quite some words of its own" for i in range(40)]


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    one = {tuple(r) for r in html_diff.extract(pages).collect()}
    many = {tuple(r) for r in html_diff.extract(pages.repartition(7), ranges=9).collect()}
    assert one == many and len(one) == pages.count()


def test_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ([rnd.randint(0, 5) for _ in range(rnd.randint(0, 30))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = html_diff.shared_lines(a, b)
        left = iter(b)
        assert len(got) == best[-1][-1] and all(any(a[i] == y for y in left) for i in got)


RECORDS = [
    ("a", "http://www.h.example/p/?utm_source=x", 100, "response", ['ETag: "1"', "Content-Length: 9", "X: old"], "d1"),
    ("b", "https://H.example/p#top", 200, "revisit", ['etag: W/"1"', "Content-Length: 0", "Connection: close, Y", "Y: 1", "X: new"], None),
    ("c", "http://h.example/p", 300, "revisit", ['ETag: "2"'], None),
    ("d", "http://h.example/p", 400, "response", ["Last-Modified: m1"], "d2"),
    ("e", "http://h.example/p", 400, "revisit", ["Last-Modified: m1"], None),
    ("f", "http://h.example/p", 90_000_000, "revisit", ["Last-Modified: m1"], None),
    ("f", "http://h.example/p", 90_000_000, "revisit", ["Last-Modified: m1"], None),
    ("g", "http://h.example/p", 500, "revisit", [], None), ("h", "http://h.example/q", 500, "revisit", None, None),
    ("i", None, 500, "revisit", [], None), ("j", "http://h.example/p", None, "revisit", [], None), ("k", None, None, None, None, None),
    ("l", "http://h.example/p", 50, "revisit", ['ETag: "1"'], None),
]


def test_revisits(spark):
    recs = spark.createDataFrame([(*r, 1) for r in RECORDS], "record_id string, url string, s long, kind string, headers array<string>, body_digest string, t int")
    recs = recs.withColumn("captured", F.timestamp_seconds("s"))
    got = revisits.resolve_revisits(recs, bucket_seconds=150).collect()
    assert len(got) == len(RECORDS)
    by = {r["record_id"]: r for r in got}
    assert {k: (r["resolution"], r["source_id"], r["body_digest"]) for k, r in by.items()} == {
        "a": ("full", "a", "d1"), "b": ("resolved", "a", "d1"), "c": ("mismatch", None, None), "d": ("full", "d", "d2"),
        "e": ("unverified", None, None), "f": ("resolved", "d", "d2"), "g": ("unverified", None, None), "h": ("missing", None, None),
        "i": ("missing", None, None), "j": ("missing", None, None), "k": ("full", "k", None), "l": ("missing", None, None)}
    assert by["b"]["headers"] == ["Content-Length: 9", "X: new", 'etag: W/"1"']
    assert not revisits.resolve_revisits(recs.limit(0)).count()


def test_urls_without_a_host_match_nothing(spark):
    urls = ["site-one.org/x", "other.net/y", "/x", "", "?q=1", "http:///x", "//h/x", "mailto:a@b", None]
    rows_ = [(f"{kind[0]}{i}", u, 100 + 100 * (kind == "revisit"), kind, ['ETag: "1"'], "d") for i, u in enumerate(urls) for kind in ("response", "revisit")]
    recs = spark.createDataFrame(rows_, "record_id string, url string, s long, kind string, headers array<string>, body_digest string").withColumn("captured", F.timestamp_seconds("s"))
    got = revisits.resolve_revisits(recs).collect()
    assert len(got) == len(rows_) and all(r["canonical_url"] is None for r in got)
    assert {r["resolution"] for r in got if r["source_id"] is None} == {"missing"}
    assert sum(r["resolution"] == "missing" for r in got) == len(urls)


def test_revisits_by_brute_force(spark):
    records = revisits.records_from_pages(spark.read.parquet(f"{SF}/pages.parquet")).withColumn("c", revisits.canonical_url(F.col("url")))
    # The same records with few URLs and few dates, so that many meet.
    records = records.withColumn("url", F.concat(F.lit("http://h.example/"), F.pmod(F.xxhash64("url"), F.lit(5)))).withColumn(
        "captured", F.timestamp_seconds(F.pmod(F.xxhash64("record_id"), F.lit(400)) * 100)).drop("c").persist()
    got = {r["record_id"]: r for r in revisits.resolve_revisits(records, bucket_seconds=3000).collect()}
    rows_ = records.collect()
    for r in rows_:
        if r["kind"] != "revisit":
            continue
        before = [x for x in rows_ if x["kind"] == "response" and x["url"] == r["url"] and x["captured"] < r["captured"]]
        if not before:
            assert got[r["record_id"]]["resolution"] == "missing"
            continue
        best = max(before, key=lambda x: (x["captured"], x["record_id"]))
        tag = [x[6:].replace("W/", "") for x in r["headers"] if re.match("etag", x, re.I)]
        tag0 = [x[6:] for x in best["headers"] if x.startswith("ETag")]
        day, day0 = ([x for x in h if x.startswith("Last")] for h in (r["headers"], best["headers"]))
        ok = tag == tag0 if tag else day == day0
        assert (got[r["record_id"]]["resolution"], got[r["record_id"]]["source_id"]) == (("resolved", best["record_id"]) if ok else ("mismatch", None))

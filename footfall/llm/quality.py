"""Quality rules as weak supervision.

Each rule votes good (+1), bad (-1) or abstains (0) on a document.
Expectation-maximisation estimates, without labels, the shares of good
documents and of the kinds of junk, and for each of them how often each rule
votes bad. The posterior probability of being good replaces all-must-pass
filtering: a rule whose bad votes no other rule bears out turns out to be wrong
on good documents, and a document that only such rules call bad is kept.

The data enter EM only as counts of vote patterns: at most 3 ** len(RULES)
of them, whatever the number of documents, counted over all rows by one
map-side combined aggregation. So what reaches the driver has a fixed bound.

Defined results: a null text has no words, an empty one too (``base_failed``
is true, since n_words < 50). Repeated rows are judged each on its own and
alike. An empty table gives an empty result. Extra columns are ignored by
``features`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, byte_class, gram_hashes, mix, per_text, pieces, staged, utf8, word_hashes, words

#: Fixed values of the base filter.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Fixed value: characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: name, value that counts as good below, value that counts as bad above; between them the rule abstains.
RULES = (
    ("symbols_per_word", 0.05, 0.30),
    ("repeat_share", 0.20, 0.40),
    ("duplicate_line_share", 0.15, 0.40),
    ("upper_share", 0.25, 0.60),
    ("bang_share", 0.08, 0.30),
    ("mark_word_share", 0.05, 0.20),
    ("word_length_excess", 0.0, 6.0),
    ("symbol_end_share", 0.02, 0.10),
    ("open_line_share", 0.05, 0.30),
    ("short_line_share", 0.15, 0.30),
)
#: Characters that end a line of prose, and the words that a line needs in order not to be short.
LINE_ENDS, SHORT_LINE = ".!?:;\"')\u2026\u3002\uff01\uff1f\u201d\u2019", 5
#: Lines from which shares of lines are judged.
MIN_LINES = 3

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURE_SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, pattern int"

_SYMBOL = byte_class(lambda b: chr(b) in SYMBOLS)
_UPPER = byte_class(lambda b: 0x41 <= b <= 0x5A)
_LOWER = byte_class(lambda b: 0x61 <= b <= 0x7A)
_SIGN = byte_class(lambda b: b >= 0x80 or chr(b).isalnum())
_HEAD = byte_class(lambda b: b & 0xC0 != 0x80)
_BLANK = " \t\n\x0b\x0c\r"


def _repeat_words(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Words of each text that lie in a three-word window found twice or more in it."""
    if len(h) < 3:
        return np.zeros(n, np.int64)
    at = np.flatnonzero(doc[2:] == doc[:-2])
    key = mix(gram_hashes(h, 3)[at] + mix(doc[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = at[order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]]
    hit = np.zeros(len(h), bool)
    for j in range(3):
        hit[twice + j] = True
    return np.bincount(doc[hit], minlength=n)


def _lines(text: str | None) -> tuple[int, int, int, int]:
    """Lines with a word; those of them that equal an earlier line, do not end as prose does, have few words."""
    if not text:
        return 0, 0, 0, 0
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    ends = sum(x.rstrip(_BLANK)[-1] not in LINE_ENDS for x in lines)
    short = sum(len(x.split(None, SHORT_LINE - 1)) < SHORT_LINE for x in lines)
    return len(lines), len(lines) - len(set(lines)), ends, short


def _measure(column: pa.Array) -> dict[str, np.ndarray]:
    data, offs = utf8(column)
    n = len(column)
    starts, ends, doc = words(data, offs, SPACED)
    n_words = np.bincount(doc, minlength=n)
    repeat = _repeat_words(word_hashes(data, starts, ends, fold=False), doc, n)
    sign = np.concatenate(([0], np.cumsum(_SIGN[data], dtype=np.int64)))
    lines = np.array([_lines(x) for x in column.to_pylist()], np.int64).reshape(n, 4)
    out = {
        "n_words": n_words,
        "word_chars": per_text(SPACED[data] & _HEAD[data], offs),
        "n_symbols": per_text(_SYMBOL[data], offs),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": repeat,
    }
    w = np.maximum(n_words, 1)
    upper, lower = per_text(_UPPER[data], offs), per_text(_LOWER[data], offs)
    length = out["word_chars"] / w
    line_share = np.where(lines[:, :1] >= MIN_LINES, lines[:, 1:] / np.maximum(lines[:, :1], 1), np.nan)
    value = {
        "symbols_per_word": out["n_symbols"] / w,
        "repeat_share": repeat / w,
        "duplicate_line_share": line_share[:, 0],
        "upper_share": np.where(upper + lower >= 20, upper / np.maximum(upper + lower, 1), np.nan),
        "bang_share": np.bincount(doc[data[ends - 1] == 0x21], minlength=n) / w,
        "mark_word_share": np.bincount(doc[sign[ends] == sign[starts]], minlength=n) / w,
        "word_length_excess": np.maximum(np.maximum(2.0 - length, length - 12.0), 0.0),
        "symbol_end_share": np.bincount(doc[_SYMBOL[data[ends - 1]]], minlength=n) / w,
        "open_line_share": line_share[:, 1],
        "short_line_share": line_share[:, 2],
    }
    pattern = np.zeros(n, np.int64)
    for name, good, bad in RULES:
        v = value[name]
        vote = np.where(np.isnan(v) | (n_words == 0), 0, np.where(v > bad, -1, np.where(v <= good, 1, 0)))
        pattern = pattern * 3 + vote + 1
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
    out["pattern"] = pattern
    return out


def features(docs: DataFrame) -> DataFrame:
    """Counts, base verdict and vote pattern of every document, from its whole text; map only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                m = _measure(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(m[c], pa.int64()) for c in COUNTS),
                     pa.array(m["base_failed"], pa.bool_()), pa.array(m["pattern"], pa.int32())],
                    names=["doc_id", *COUNTS, "base_failed", "pattern"])

    light = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return light.mapInArrow(run, FEATURE_SCHEMA)


@dataclass(frozen=True)
class VoteModel:
    """Class 0 is good, each other class a kind of junk.

    ``share``: of each class; ``bad[c][r]``: how often rule r, when it votes, says bad on class c;
    ``kinds``: of each kind of junk, the rule that it began with.
    """

    share: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]
    kinds: tuple[int, ...]

    def good(self, pattern: int) -> float:
        """Posterior probability that a document with these votes is good."""
        return float(_posterior(_votes([pattern]), np.array(self.share), np.array(self.bad))[0, 0])


def _votes(patterns: list[int]) -> np.ndarray:
    return np.array([[p // 3 ** (len(RULES) - 1 - r) % 3 - 1 for r in range(len(RULES))] for p in patterns]).reshape(-1, len(RULES))


def _posterior(votes: np.ndarray, share: np.ndarray, bad: np.ndarray) -> np.ndarray:
    log = np.log(share) + (votes == -1) @ np.log(bad).T + (votes == 1) @ np.log(1 - bad).T
    p = np.exp(log - log.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


#: Prior of the shares: nine good documents and one of junk; of a rule's false alarms: half a bad vote in fifty; of a kind's votes: a tenth of one.
PRIOR_GOOD, PRIOR_JUNK, PRIOR_FALSE, PRIOR_VOTES, PRIOR_KIND = 9.0, 1.0, 0.5, 50.0, 0.1


def _em(votes: np.ndarray, n: np.ndarray, kinds: list[int], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares and bad-vote rates of good documents and of ``kinds``, from the first guess that rule r finds kind r."""
    own = np.where(np.eye(len(RULES), dtype=bool)[kinds], 0.9, 0.1).reshape(len(kinds), len(RULES))
    prior = np.array([PRIOR_GOOD] + [PRIOR_JUNK / max(len(kinds), 1)] * len(kinds))
    share, bad = prior / prior.sum(), np.vstack([np.full(len(RULES), PRIOR_FALSE / PRIOR_VOTES), own])
    for _ in range(rounds):
        before = bad
        w = n[:, None] * _posterior(votes, share, bad)
        mass = w.sum(axis=0) + prior
        junk = mass[1:] * min(1.0, mass[0] / max(mass[1:].sum(), 1e-300))  # at most half of all
        share = np.concatenate((mass[:1], junk)) / (mass[0] + junk.sum())
        said, voted = w.T @ (votes == -1), w.T @ (votes != 0)
        false = np.clip((said[0] + PRIOR_FALSE) / (voted[0] + PRIOR_VOTES), 1e-6, 0.5)
        hit = np.clip((said[1:] + PRIOR_KIND * own) / (voted[1:] + PRIOR_KIND), false, 0.999)
        bad = np.vstack([false, hit])
        if np.abs(bad - before).max() < 1e-10:
            break
    return share, bad


def fit(counts: dict[int, int], rounds: int = 300) -> VoteModel:
    """EM over pattern counts, without labels.

    Junk comes in kinds that trip different rules, so EM begins with one kind
    per rule; votes are independent within a class. Nothing but votes tells a
    kind of junk from a rule's false alarms, so a kind must be borne out: some rule other
    than its own calls most of it bad. Kinds that none bears out are given up
    (their documents are good ones with a false alarm) and EM runs again
    on the others, until all left are borne out. Rules are held to be better than chance: on good
    documents at most half of a rule's votes are bad, on no kind of junk fewer
    than on good documents, and junk is at most half of all. So a document without any
    bad vote is always good.
    """
    patterns = sorted(counts)
    votes, n = _votes(patterns), np.array([counts[p] for p in patterns], float)
    kinds = list(range(len(RULES)))
    while True:
        share, bad = _em(votes, n, kinds, rounds)
        borne = [k for k, rates in zip(kinds, bad[1:], strict=True) if max(np.delete(rates, k)) > 0.5]
        if borne == kinds:
            break
        kinds = borne
    return VoteModel(tuple(map(float, share)), tuple(tuple(map(float, x)) for x in bad), tuple(kinds))


def _verdicts(measured: DataFrame) -> tuple[VoteModel, dict[int, float]]:
    """The model, and the posterior of each pattern that occurs (at most 3 ** len(RULES) rows collected)."""
    rows = measured.filter("n_words > 0").groupBy("pattern").count().collect()
    counts = {r["pattern"]: r["count"] for r in rows}
    model = fit(counts)
    return model, {p: model.good(p) for p in counts}


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Every document with its counts, ``base_failed``, ``p_good`` and ``kept``."""
    spark = docs.sparkSession
    measured = staged(features(docs), "quality-features")
    _, good = _verdicts(measured)
    posterior = spark.createDataFrame(sorted(good.items()), "pattern int, p_good double")
    p = F.coalesce(F.col("p_good"), F.lit(0.0))
    return (
        measured.join(F.broadcast(posterior), "pattern", "left")  # at most 3 ** len(RULES) rows
        .select("doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (p >= threshold)).alias("kept"), p.alias("p_good"))
    )


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, that ``judge`` keeps. Texts are read twice and never shuffled."""
    _, posterior = _verdicts(features(docs))
    passing = frozenset(p for p, x in posterior.items() if x >= threshold)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                m = _measure(part.column("text"))
                ok = ~m["base_failed"] & np.array([int(p) in passing for p in m["pattern"]], bool)
                yield part.select(names).filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)

"""Token counts with the whole-token shortcut.

A byte-level BPE first splits a text into pre-tokens and then merges bytes
inside each. ``prove_whole`` finds, once and before any text is read, the
vocabulary strings that stand as a single pre-token and that the merges turn
into a single token. A pre-token that is one of them counts as one token by
lookup alone; only the others are merged.

Strings of special tokens inside a text are one token each and split the text,
which is the library's default. Pre-tokens are found with ``regex``; a text
with a character that this Python's Unicode tables and the tokenizer's may
class differently is split by the tokenizer itself.

What goes to the tasks is the tokenizer file's content and the proven strings,
both bounded by the vocabulary. Defined results: null and empty texts have no
bytes and no tokens. Repeated rows are counted each; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import pieces

#: Fixed pattern of the byte-level pre-tokenizer.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Merged pre-tokens remembered by a task, and the longest of them.
MEMO, MEMO_CHARS = 300_000, 64


@lru_cache(1)
def _byte_letters() -> dict[int, str]:
    """Latin-1 letter to vocabulary letter: bytes without a visible form move to 256 and up, in order."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


def _spelled(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(_byte_letters())


def prove_whole(definition: str) -> frozenset[str]:
    """Strings that are one pre-token and encode alone as one token."""
    tok = Tokenizer.from_str(definition)
    back = {v: k for k, v in _byte_letters().items()}
    special = {t.content for t in tok.get_added_tokens_decoder().values()}
    split = regex.compile(PRE_TOKEN)
    out = set()
    for letters in tok.get_vocab(with_added_tokens=False):
        if letters in special:
            continue
        raw = bytes(back.get(c, ord(c)) for c in letters)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue  # part of a character: never a pre-token
        if split.findall(text) == [text] and len(tok.model.tokenize(letters)) == 1:
            out.add(text)
    return frozenset(out)


#: Code points that ``odd_characters`` looks at; beyond them no character is a letter or digit in any Unicode version so far.
_TESTED = (*range(0x80, 0xD800), *range(0xE000, 0x40000))


@lru_cache(1)
def odd_characters(definition: str) -> str:
    """Characters that the tokenizer's pattern and this Python's Unicode tables class differently."""
    tok = Tokenizer.from_str(definition)
    split = regex.compile(PRE_TOKEN)
    odd = []
    todo = [_TESTED[i: i + 4096] for i in range(0, len(_TESTED), 4096)]
    while todo:
        some = todo.pop()
        # Behind a letter and before a digit, and between marks: each class has its own borders.
        text = "".join(f"a{chr(c)}1!{chr(c)}!" for c in some)
        theirs = [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]
        if theirs != split.findall(text):
            if len(some) == 1:
                odd.append(chr(some[0]))
            else:
                todo += [some[: len(some) // 2], some[len(some) // 2:]]
    return "".join(sorted(odd))


def _ranges(chars: str) -> str:
    """A sorted string's characters as ranges of a character class."""
    out: list[list[int]] = []
    for c in map(ord, chars):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in out)


def _latin(text: str) -> bool:
    """Only Latin-1 characters, which all Unicode versions class alike."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Merged(dict):
    """Tokens of each pre-token: 1 for the proven ones, put in beforehand; the others are merged when first met."""

    def __init__(self, tok: Tokenizer, whole: frozenset[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.merge, self.room = tok.model.tokenize, len(whole) + MEMO

    def __missing__(self, piece: str) -> int:
        n = len(self.merge(_spelled(piece)))
        if len(piece) <= MEMO_CHARS and len(self) < self.room:
            self[piece] = n
        return n


class TokenCounter:
    def __init__(self, definition: str, whole: frozenset[str], odd: str = ""):
        self.tok = Tokenizer.from_str(definition)
        self.whole, self.split = whole, regex.compile(PRE_TOKEN).findall
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.odd = re.compile(f"[{_ranges(odd)}\U00040000-\U0010FFFF]")
        self.tokens = _Merged(self.tok, whole)

    def plain(self, text: str) -> int:
        if not _latin(text) and self.odd.search(text):
            parts = [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        else:
            parts = self.split(text)
        if len(self.tokens) >= self.tokens.room:  # full: forget the merged ones
            self.tokens = _Merged(self.tok, self.whole)
        return sum(map(self.tokens.__getitem__, parts))

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each document under the byte-level BPE tokenizer file at ``path``; map only."""
    with open(path, encoding="utf-8") as f:  # the tokenizer, on the driver; not a table
        definition = f.read()
    told = docs.sparkSession.sparkContext.broadcast((definition, prove_whole(definition), odd_characters(definition)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(*told.value)
        for batch in batches:
            for part in pieces(batch, "text"):
                texts = [x or "" for x in part.column("text").to_pylist()]
                n = [counter.count(x) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(n, pa.int64()),
                     pa.array([k > limit for k in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    light = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return light.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

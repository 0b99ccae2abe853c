"""Phrase collocations, counted in counting quotient filters.

Words that occur often enough get dense ids, and documents become rows of ids
cut at punctuation. An n-gram is its packed word ids. An invertible permutation
of that packed number spreads n-grams evenly; its high bits are the quotient,
and the whole rest is the remainder, so nothing is lost: the ids come back from
(quotient, remainder) by the inverse. A filter holds, by quotient, the sorted
runs of remainders and their counters. Every task counts what it reads into
filters, one a range of quotients; filters of one range are sorted alike, so
shards are merged by one pass that adds up the counters of equal entries.

Lengths are counted one after the other: an n-gram can be frequent only if
both (n - 1)-grams in it are. A fixed bitmap over the frequent (n - 1)-grams
drops most others before they are counted. It only saves work: what it lets
through by chance is counted exactly and found rare.

Sizes. The words that each hold over 1 / ``HEAD`` of all words (fewer than
``HEAD``, whatever the data's size) are sent to the tasks with their ids. All
others meet their ids by a join on (language, word) with one row a block of
text and word, in which no key is hot.
The quotient ranges follow the number of words, so a merge stays small. The
permutation leaves no hot range, and a repeated n-gram is one counter.

Defined results: null and empty texts have no words; a null language is
``und``. Repeated rows count again. Ties of score and frequency are broken by
the phrase's UTF-8 bytes. Languages without phrases have no rows; an empty
table gives an empty result. Extra columns are ignored. Texts of any length
are cut into blocks at piece ends, so memory does not grow with a text, but with
its longest piece. The table is read from files, so that a task run again
makes the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import FOLD, byte_class, group_starts, mix, placed, release, staged, utf8, whole_groups

#: Contract values: longest phrase, least frequency, phrases of a language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: At most HEAD words of HEAD_BYTES each, those that hold over 1 / HEAD of all words, are sent to the tasks.
HEAD, HEAD_BYTES = 1 << 20, 64
#: Bytes of text in a block; words for each range of quotients.
BLOCK, RANGE = 1 << 20, 1 << 21
#: The bitmap over frequent grams has 2 to this many bits (8 MB).
MAP_BITS = 26
#: Entries that a task gathers before it hands filters on.
GATHER = 1 << 20

_U = np.uint64
#: Bytes that end a piece, and bytes of words.
_BREAK = byte_class(lambda b: chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D)
_WORD = byte_class(lambda b: not _BREAK[b] and b not in (0x20, 0x09))


# ---------------------------------------------------------------- permutation

def _round(limbs: list[np.ndarray], i: int, turn: int, mask: np.uint64) -> np.ndarray:
    """A hash of all limbs but the i-th."""
    h = np.full(len(limbs[0]), _U(0x9E3779B97F4A7C15) * _U(turn + 1), _U)
    for j, x in enumerate(limbs):
        if j != i:
            h = mix(h ^ (x + _U(j + 1) * _U(0xC2B2AE3D27D4EB4F)))
    return h & mask


def permute(ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """One-to-one scrambling of columns of ``bits``-bit ids: each limb in turn is changed by a hash of the others, twice round and more."""
    mask, limbs = _U((1 << bits) - 1), [x.astype(_U) for x in ids]
    with np.errstate(over="ignore"):
        for turn in range(2 * len(limbs) + 2):
            i = turn % len(limbs)
            limbs[i] = limbs[i] ^ _round(limbs, i, turn, mask)
    return limbs


def restore(limbs: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """The inverse of ``permute``."""
    mask, ids = _U((1 << bits) - 1), list(limbs)
    with np.errstate(over="ignore"):
        for turn in reversed(range(2 * len(ids) + 2)):
            i = turn % len(ids)
            ids[i] = ids[i] ^ _round(ids, i, turn, mask)
    return ids


# --------------------------------------------------- counting quotient filters

def _pack(values: np.ndarray, width: int) -> bytes:
    """Each value in ``width`` bytes, high byte first."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width:].tobytes()


def _unpack(raw: bytes, width: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, 8 - width:] = np.frombuffer(raw, np.uint8).reshape(n, width)
    return out.reshape(-1).view(">u8").astype(_U)


def _width(bits: int) -> int:
    return -(-bits // 8)


class QuotientFilter:
    """Sorted n-grams of one range of quotients, each with a counter.

    ``limbs`` are permuted ids in ascending order. In bytes: which quotients of
    the range occur and where their runs end (a bit each), the remainders in
    full, and the counters, a byte each; larger ones are listed apart.
    """

    def __init__(self, limbs: list[np.ndarray], counts: np.ndarray, bits: int, range_bits: int):
        self.limbs, self.counts, self.bits, self.range_bits = limbs, counts, bits, range_bits

    @classmethod
    def of(cls, limbs: list[np.ndarray], counts: np.ndarray, bits: int, range_bits: int) -> QuotientFilter:
        """Sort entries in any order and add up equal ones."""
        order = np.lexsort(limbs[::-1])
        limbs, counts = [x[order] for x in limbs], counts[order]
        new = np.ones(len(counts), bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in limbs], axis=0)
        first = np.flatnonzero(new)
        return cls([x[first] for x in limbs], np.add.reduceat(counts, first) if len(counts) else counts, bits, range_bits)

    @classmethod
    def merge(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter with the counters of all added up."""
        a = filters[0]
        if len(filters) == 1:
            return a
        limbs = [np.concatenate([f.limbs[i] for f in filters]) for i in range(len(a.limbs))]
        return cls.of(limbs, np.concatenate([f.counts for f in filters]), a.bits, a.range_bits)

    def _head(self) -> np.ndarray:
        """The first two limbs as one number; its high bits are range and quotient."""
        return self.limbs[0] << _U(self.bits) | self.limbs[1]

    def dump(self) -> bytes:
        n = len(self.counts)
        low = 2 * self.bits - self.range_bits
        q = min(low - 1, max(1, n.bit_length() - 1))
        rest = low - q
        within = self._head() & _U((1 << low) - 1)
        quotient = within >> _U(rest)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        ends = np.ones(n, bool)
        ends[:-1] = quotient[1:] != quotient[:-1]
        small = np.minimum(self.counts, 255).astype(np.uint8)
        parts = [np.array([n, q, len(self.limbs)], np.int64).tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
                 _pack(within & _U((1 << rest) - 1), _width(rest)), *(_pack(x, _width(self.bits)) for x in self.limbs[2:]),
                 small.tobytes(), self.counts[small == 255].astype(np.int64).tobytes()]
        return b"".join(parts)

    @classmethod
    def load(cls, raw: bytes, bits: int, range_bits: int, number: int) -> QuotientFilter:
        """The filter that ``dump`` wrote, of quotient range ``number``."""
        n, q, limbs = (int(x) for x in np.frombuffer(raw, np.int64, 3))
        at = 24

        def take(size: int) -> bytes:
            nonlocal at
            at += size
            return raw[at - size: at]

        low = 2 * bits - range_bits
        rest = low - q
        occupied = np.flatnonzero(np.unpackbits(np.frombuffer(take(_width(1 << q)), np.uint8), count=1 << q))
        ends = np.unpackbits(np.frombuffer(take(_width(n)), np.uint8), count=n).astype(np.int64)
        quotient = occupied[np.cumsum(ends) - ends].astype(_U)
        head = _U(number) << _U(low) | quotient << _U(rest) | _unpack(take(n * _width(rest)), _width(rest), n)
        more = [_unpack(take(n * _width(bits)), _width(bits), n) for _ in range(limbs - 2)]
        counts = np.frombuffer(take(n), np.uint8).astype(np.int64)
        counts[counts == 255] = np.frombuffer(raw[at:], np.int64)
        return cls([head >> _U(bits), head & _U((1 << bits) - 1), *more], counts, bits, range_bits)

    def split(self) -> Iterator[tuple[int, QuotientFilter]]:
        """The filter of each range of quotients that occurs."""
        number = (self._head() >> _U(2 * self.bits - self.range_bits)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(number) else []
        for a, b in zip(starts, [*starts[1:], len(number)], strict=True):
            yield int(number[a]), QuotientFilter([x[a:b] for x in self.limbs], self.counts[a:b], self.bits, self.range_bits)

    def ids(self) -> list[np.ndarray]:
        return restore(self.limbs, self.bits)


# ------------------------------------------------------------ words of blocks

def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
    """Of each block of text in one language: its distinct words, and of each word of the block, which it is and where.

    Places count words and the breaks between them, so that places one apart are
    neighbours in a piece. Texts are cut only where a piece ends.
    """
    def cut(lang: str, data: np.ndarray):
        inside = _WORD[data]
        edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return None
        broken = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)
        gap = np.concatenate(([0], (np.diff(broken) > 0).astype(np.int64)))
        letters = pa.py_buffer(FOLD[data[inside]].tobytes())
        offsets = np.concatenate(([0], np.cumsum(stops - starts)))
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), letters).dictionary_encode()
        return lang, words.dictionary, words.indices.to_numpy(zero_copy_only=False), np.arange(len(starts)) + np.cumsum(gap)

    held: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}
    stop = np.frombuffer(b"\n", np.uint8)

    def flush(lang: str, last: bool):
        data = np.concatenate(held.pop(lang))
        sizes.pop(lang)
        while len(data) > BLOCK or last and len(data):
            # At a break: a piece longer than a block is a block of its own.
            end = len(data)
            if len(data) > BLOCK:
                breaks = np.flatnonzero(_BREAK[data[:BLOCK]])
                end = int(breaks[-1]) + 1 if len(breaks) else _next_break(data)
            out = cut(lang, data[:end])
            data = data[end:]
            if out is not None:
                yield out
        if len(data):
            held[lang], sizes[lang] = [data], len(data)

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        data, offs = utf8(batch.column("text"))
        for lang, a, b in zip(langs, offs[:-1], offs[1:], strict=True):
            if b > a:
                held.setdefault(lang, []).extend((data[a:b].copy(), stop))
                sizes[lang] = sizes.get(lang, 0) + int(b - a) + 1
                if sizes[lang] > BLOCK:
                    yield from flush(lang, False)
        if sum(sizes.values()) > 16 * BLOCK:  # many languages
            for lang in list(held):
                yield from flush(lang, True)
    for lang in list(held):
        yield from flush(lang, True)


def _next_break(data: np.ndarray) -> int:
    """End of the first piece, for a piece longer than a block."""
    for i in range(0, len(data), BLOCK):
        found = np.flatnonzero(_BREAK[data[i: i + BLOCK]])
        if len(found):
            return i + int(found[0]) + 1
    return len(data)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), docs["text"].cast("string").alias("text"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words, which, _ in _blocks(batches):
        n = np.bincount(which, minlength=len(words)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(words) + 1), pa.string()), pa.concat_arrays([words.cast(pa.string()), pa.nulls(1, pa.string())]), pa.array(np.append(n, n.sum()))],
            names=["lang", "word", "f"])


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, word, f of the words found ``least`` times, and per language a row without word: all its words."""
    counted = _texts(docs).mapInArrow(_count_words, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
    return counted.filter(F.col("word").isNull() | (F.col("f") >= least))


def _index(batches: Iterator[pa.RecordBatch], head: dict[str, dict[str, int]], maybe: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per block a row of codes (one more than the id of each word of the head, by place; zero elsewhere), and a row of places for each other word."""
    task = TaskContext.get().partitionId() << 32
    for number, (lang, words, which, at) in enumerate(_blocks(batches)):
        texts, known = words.to_pylist(), head.get(lang, {})
        ids = np.array([known.get(w, -1) for w in texts], np.int32)
        keep = (ids < 0) & _may_hold(maybe, [_text_hashes([lang] * len(texts), texts)])
        by_word = np.argsort(np.where(keep, np.arange(len(texts)), len(texts))[which], kind="stable")
        sizes = np.bincount(which, minlength=len(texts))[keep]
        codes = np.zeros(int(at[-1]) + 2, np.int32)
        codes[at] = ids[which] + 1
        n = len(sizes)
        offsets = np.concatenate(([0, 0], np.cumsum(sizes))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(1 + n, task | number)), pa.array([lang] * (1 + n), pa.string()),
             pa.concat_arrays([pa.nulls(1, pa.string()), words.cast(pa.string()).filter(pa.array(keep))]),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(at[by_word][: int(sizes.sum())].astype(np.int32))),
             pa.array([codes.tobytes(), *[None] * n], pa.binary())],
            names=["block", "lang", "word", "at", "codes"])


def _text_hashes(langs: list[str], texts: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{x}\n{t}") for x, t in zip(langs, texts, strict=True)], _U)


# --------------------------------------------------------------- fixed bitmap

def _slots(limbs: list[np.ndarray]) -> np.ndarray:
    h = np.zeros(len(limbs[0]), _U)
    with np.errstate(over="ignore"):
        for x in limbs:
            h = mix(h * _U(0x9E3779B97F4A7C15) + x + _U(1))
    return (h >> _U(64 - MAP_BITS)).astype(np.int64)


def _may_hold(bitmap: np.ndarray, limbs: list[np.ndarray]) -> np.ndarray:
    slot = _slots(limbs)
    return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _bitmap(rows: DataFrame, hashed) -> np.ndarray:
    """Bitmap of 2 ** MAP_BITS bits over ``rows``; ``hashed`` gives the limbs of a batch. What comes to the driver has that bound."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = _slots(hashed(batch))
            yield pa.RecordBatch.from_arrays([pa.array((slot >> 6).astype(np.int32)), pa.array((_U(1) << (slot & 63).astype(_U)).view(np.int64))], names=["word", "bit"])

    found = rows.mapInArrow(words, "word int, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << MAP_BITS - 6, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


# ------------------------------------------------------------- encoded blocks

def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The codes of each block, with the ids of its other words at their places."""
    for table in whole_groups(batches, ["block"]):
        at, known = table.column("at").combine_chunks(), table.column("codes").combine_chunks()
        ends, places = np.cumsum(np.append(0, np.asarray(pc.list_value_length(at)).astype(np.int64))), np.asarray(at.flatten())
        values = np.repeat(np.asarray(table.column("id")) + 1, np.diff(ends))
        starts, first = group_starts(table, ["block"]), np.flatnonzero(np.asarray(known.is_valid()))
        out = []
        for a, b, row in zip(starts, [*starts[1:], table.num_rows], first, strict=True):
            codes = np.frombuffer(known[int(row)].as_buffer(), np.int32).copy()
            codes[places[ends[a]: ends[b]]] = values[ends[a]: ends[b]]
            out.append(codes.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["codes"])


def encode(docs: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """Staged blocks of ids (``codes``), from ``words`` (lang, word, f, id)."""
    sc = docs.sparkSession.sparkContext
    head: dict[str, dict[str, int]] = {}
    often = (F.col("f") * HEAD > total) & (F.octet_length("word") <= HEAD_BYTES)
    for r in words.filter(often).select("lang", "word", "id").collect():  # fewer than HEAD short words
        head.setdefault(r["lang"], {})[r["word"]] = r["id"]
    rest = words.filter(~often).select("lang", "word", F.col("id").cast("int"))

    def hashed(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [_text_hashes(batch.column("lang").to_pylist(), batch.column("word").to_pylist())]

    maybe, head_ = sc.broadcast(_bitmap(rest.select("lang", "word"), hashed)), sc.broadcast(head)
    indexed = staged(_texts(docs).mapInArrow(
        lambda batches: _index(batches, head_.value, maybe.value), "block long, lang string, word string, at array<int>, codes binary"), "phrases-index")
    joined = indexed.filter(F.col("word").isNotNull()).join(rest, ["lang", "word"]).select("block", "at", "codes", "id")
    every = joined.unionByName(indexed.filter(F.col("word").isNull()).select("block", "at", "codes", F.lit(0).alias("id")))
    blocks = every.repartition("block").sortWithinPartitions("block").mapInArrow(_assemble, "codes binary")
    out = staged(blocks, "phrases-codes")
    release(indexed)
    return out


# ------------------------------------------------------------------- counting

def _grams(codes: np.ndarray, n: int, shorter: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams (columns of ids) of a block, and how often each occurs."""
    m = len(codes) - n + 1
    if m <= 0:
        return [np.zeros(0, _U)] * n, np.zeros(0, np.int64)
    ok = codes[:m] != 0
    for j in range(1, n):
        ok &= codes[j: j + m] != 0
    at = np.flatnonzero(ok)
    if shorter is not None and len(at):
        held = _may_hold(shorter, [codes[at + j].astype(_U) - _U(1) for j in range(n - 1)])
        at = at[held]
        if len(at):
            at = at[_may_hold(shorter, [codes[at + j].astype(_U) - _U(1) for j in range(1, n)])]
    if not len(at):
        return [np.zeros(0, _U)] * n, np.zeros(0, np.int64)
    key = codes[at].astype(_U)
    for j in range(1, n):  # number the distinct prefixes, one word longer each time
        _, first, key, counts = np.unique(key << _U(32) | codes[at + j].astype(_U), return_index=True, return_inverse=True, return_counts=True)
        key = key.astype(_U)
    return [codes[at[first] + j].astype(_U) - _U(1) for j in range(n)], counts.astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], n: int, bits: int, range_bits: int, shorter) -> Iterator[pa.RecordBatch]:
    """The filters of what a task reads, one row a range of quotients."""
    held: list[QuotientFilter] = []

    def hand_on():
        numbers, dumps = [], []
        for number, part in QuotientFilter.merge(held).split():
            numbers.append(number)
            dumps.append(part.dump())
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(dumps, pa.binary())], names=["range", "filter"])

    for batch in batches:
        for raw in batch.column("codes"):
            grams, counts = _grams(np.frombuffer(raw.as_buffer(), np.int32), n, None if shorter is None else shorter.value)
            if not len(counts):
                continue
            held.append(QuotientFilter.of(permute(grams, bits), counts, bits, range_bits))
            if sum(len(f.counts) for f in held) > GATHER:
                held[:] = [QuotientFilter.merge(held)]
                if len(held[0].counts) > GATHER // 2:
                    yield hand_on()
    if held:
        yield hand_on()


def _merge(batches: Iterator[pa.RecordBatch], bits: int, range_bits: int, least: int) -> Iterator[pa.RecordBatch]:
    """Frequent grams (ids and count) of each range, from the filters of all shards."""
    number, held = None, []

    def done():
        merged = QuotientFilter.merge(held)
        often = merged.counts >= least
        ids = QuotientFilter([x[often] for x in merged.limbs], merged.counts[often], bits, range_bits).ids()
        flat = np.stack(ids, axis=1).astype(np.int64).reshape(-1)
        offsets = np.arange(0, len(flat) + 1, len(ids), dtype=np.int32)
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(merged.counts[often])], names=["gram", "f"])

    for batch in batches:
        for k, raw in zip(batch.column("range").to_pylist(), batch.column("filter"), strict=True):
            if k != number and held:
                yield done()
                held = []
            number = k
            held.append(QuotientFilter.load(raw.as_py(), bits, range_bits, k))
            if len(held) > 64 or sum(len(f.counts) for f in held[1:]) > 2 * GATHER:
                held = [QuotientFilter.merge(held)]
    if held:
        yield done()


def count_grams(codes: DataFrame, n: int, n_words: int, total: int, least: int = LEAST, shorter=None) -> DataFrame:
    """gram (ids) and f of the n-grams found ``least`` times in the encoded blocks."""
    bits = max(20, n_words.bit_length())
    if bits > 31:
        raise ValueError("more frequent words than ids of 31 bits")
    range_bits = max(5, min(bits, (total // RANGE).bit_length()))
    filters = codes.mapInArrow(lambda batches: _count(batches, n, bits, range_bits, shorter), "range long, filter binary")
    return filters.repartition("range").sortWithinPartitions("range").mapInArrow(
        lambda batches: _merge(batches, bits, range_bits, least), "gram array<long>, f long")


# --------------------------------------------------------------------- scores

def _score(a: Column, left: Column, right: Column, n: Column) -> Column:
    """floor(1000 a n / (l r)), exact: products in decimals of up to 38 digits."""
    def d(x: Column) -> Column:
        return x.cast("decimal(18,0)")

    over, under = (a * 1000).cast("decimal(19,0)") * d(n), d(left) * d(right)
    return F.floor((over - over % under) / under).cast("long")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    spark = docs.sparkSession
    counts = staged(word_counts(docs, least), "phrases-words")
    totals = counts.filter(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    frequent = placed(counts.filter(F.col("word").isNotNull()).withColumn("one", F.lit("")), "one", ["lang", "word"], "phrases-ids")
    words = staged(frequent.select("lang", "word", "f", F.col("place").alias("id")), "phrases-dictionary")
    release(frequent)
    total, n_words = totals.agg(F.sum("n")).first()[0] or 0, words.count()
    codes = encode(docs, words, total)
    found = [words.select(F.array("id").alias("gram"), "f")]
    shorter = None
    for n in range(2, longest + 1):
        grams = staged(count_grams(codes, n, n_words, total, least, shorter), f"phrases-{n}")
        found.append(grams)
        if grams.isEmpty():
            break
        if n < longest:
            def limbs(batch: pa.RecordBatch, n: int = n) -> list[np.ndarray]:
                flat = batch.column("gram").flatten().to_numpy().astype(_U)
                return [flat[j::n] for j in range(n)]

            shorter = spark.sparkContext.broadcast(_bitmap(grams.select("gram"), limbs))
    release(codes)
    every = found[0]
    for g in found[1:]:
        every = every.unionByName(g)
    out = staged(_ranked(every, found[1:], words, totals, top), "phrases")
    for x in (counts, words, *found[1:]):
        release(x)
    return out


def _ranked(every: DataFrame, longer: list[DataFrame], words: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    size = F.size("gram")
    candidates = longer[0]
    for g in longer[1:]:
        candidates = candidates.unionByName(g)
    # A candidate goes if a longer one as frequent holds it; then one just a word longer does, as frequency never grows with length.
    inner = F.array(F.slice("gram", F.lit(1), size - 1), F.slice("gram", F.lit(2), size - 1))
    within = candidates.filter(size > 2).select(F.explode(inner).alias("gram"), "f").groupBy("gram").agg(F.max("f").alias("holder"))
    kept = candidates.join(within, "gram", "left").filter(F.col("holder").isNull() | (F.col("holder") < F.col("f"))).select("gram", F.col("f").alias("a"))
    cuts = kept.select("gram", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "gram", "a", "k", F.slice("gram", F.lit(1), F.col("k")).alias("head"), F.slice("gram", F.col("k") + 1, size).alias("tail"))
    sides = every.select(F.col("gram").alias("side"), F.col("f").alias("side_f"))
    parts = cuts.join(sides.withColumnRenamed("side_f", "l"), F.col("head") == F.col("side")).drop("side", "head")
    parts = parts.join(sides.withColumnRenamed("side_f", "r"), F.col("tail") == F.col("side")).drop("side", "tail")
    of_word = words.select(F.col("id").alias("first"), "lang").join(totals, "lang")
    scored = parts.withColumn("first", F.element_at("gram", 1)).join(of_word, "first").withColumn("score", _score(F.col("a"), F.col("l"), F.col("r"), F.col("n")))
    lowest = scored.groupBy("gram", "lang", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("gram", "lang", "a", "n", "cut.score", "cut.l", "cut.r")
    best = lowest.withColumn("_r", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).filter(F.col("_r") <= top).drop("_r")
    spelled = best.select("gram", F.posexplode("gram").alias("at", "id")).join(words.select("id", "word"), "id").groupBy("gram").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = best.join(spelled, "gram").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

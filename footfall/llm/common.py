"""Helpers shared by the operators: staged tables and vectorised word scans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import delete_path, shared_dir

#: Bytes of text that one vectorised step looks at; temporaries are some forty times that.
BLOCK = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Fixed pattern: words between ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor sees, so a lost executor
    costs only its running tasks. The schema is given, so rereading needs no job.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    delete_path(df.sparkSession, df._staged_at)


def text_key(text: Column) -> Column:
    """Hash of a text that also tells null from empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def placed(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``place`` (its position from 0 within ``group``, by ``order``) and ``members`` (rows of the group).

    The rows are range-sorted and written, so a group of any size, and rows equal
    in all of ``order`` too, lie over as many partitions as they need. What each
    partition holds of a group is counted, and the counts before it are added.
    ``group`` must not be null. ``df`` is read twice; give a staged table.
    """
    order = [group, *order, "_tie"]
    run = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = staged(run.drop("_tie").withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)), name)
    held = rows.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    one = Window.partitionBy(group)  # a row for each partition that holds some of the group
    before = F.coalesce(F.sum("_n").over(one.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = held.select(group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(one).alias("members"))
    out = rows.join(shift, [group, "_part"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_shift", "_part")
    out._staged_at = rows._staged_at
    return out


#: Columns that ``with_identity`` adds.
IDENTITY = ["_row_id", "_row_key"]


def identity(doc_id: Column, key: Column) -> list[Column]:
    """Null-free equality columns of a row: its id and the hash of its text."""
    return [F.coalesce(doc_id.cast("string"), F.lit("")).alias("_row_id"), key.alias("_row_key")]


def with_identity(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns IDENTITY, by which repeated rows are equal."""
    return docs.select("*", *identity(docs["doc_id"].cast("long"), text_key(docs["text"].cast("string"))))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 2 * BLOCK) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``limit`` text bytes (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def group_starts(batch: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a run of rows equal in ``keys`` (not null) starts."""
    n = batch.num_rows
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = False
        for k in keys:
            column = batch.column(k)
            new[1:] |= np.asarray(pc.not_equal(column.slice(1), column.slice(0, n - 1)))
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of ``batches`` anew, cut only where a run of rows equal in ``keys`` ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        last = int(group_starts(batch, keys)[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end and the n + 1 offsets; null counts as empty."""
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset: arr.offset + len(arr) + 1]
    buf = arr.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[offs[0]: offs[-1]], offs - offs[0]


def byte_class(test) -> np.ndarray:
    return np.array([bool(test(b)) for b in range(256)])


#: Bytes of words between ASCII white space, and of words of letters, digits and non-ASCII characters.
SPACED = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
ALNUM = byte_class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
FOLD = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (one-to-one)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def words(data: np.ndarray, offs: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word: a longest run of bytes in ``cls`` within a text."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = cls[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    before = np.concatenate(([False], inside[:-1])) & ~cut[:-1]
    after = np.concatenate((inside[1:], [False])) & ~cut[1:]
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit hash of each word (with ``fold``: of the word with A-Z lower-cased)."""
    out = np.zeros(len(starts), np.uint64)
    lengths = ends - starts
    if not len(starts):
        return out
    power = np.ones(int(lengths.max()), np.uint64)
    power[1:] = _BASE
    power = np.multiply.accumulate(power)
    total = np.cumsum(lengths)
    i = 0
    while i < len(starts):  # blocks of about BLOCK bytes, cut between words
        done = int(total[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(total, done + BLOCK, "right")))
        n = lengths[i:j]
        first = np.cumsum(n) - n
        pos = np.arange(int(n.sum())) - np.repeat(first, n)
        raw = data[np.repeat(starts[i:j], n) + pos]
        out[i:j] = np.add.reduceat(_BYTE[FOLD[raw] if fold else raw] * power[pos], first)
        i = j
    return mix(out)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (across texts too; the caller masks those)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _BASE + h[j: j + n]
    return mix(out)


def per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of set flags (one flag a byte) in each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offs[1:]] - total[offs[:-1]]

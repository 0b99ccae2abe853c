"""Which records have landed: a ledger of keys that a batch reads only in part.

The ledger of a landing table holds the identity of every landed record
(``record_identity``) in segments::

    segments/<name>/keys/bucket=<b>/part-*.parquet    identities, by hash bucket
    segments/<name>/filters/part-*.parquet            per bucket, a blocked Bloom filter over them
    _commits/<version>.json                           the live segments, marks and writers

A batch is looked up in three steps, each of which leaves little to the next:

* Marks. For each (topic, partition) the highest landed offset is known. A
  record without an id is only the same as a re-delivery of itself, so above
  the mark it is new without any look-up. (Records with an id may come again in
  any later message; a message below the mark may be late rather than repeated.)
* Filters, of the batch's buckets only. A key that none of a bucket's filters
  may hold is new.
* Keys, in the files (segment, bucket) that some filter named. They decide.

So a batch opens no file that can't hold one of its keys. Landing and ledger are
kept in step by an intent: it is written before rows are appended, and the
record that publishes the batch's segment makes it void. A batch that finds its
own intent still standing was broken off in between and also looks for its
rows among those landed on its days.

Segments are merged once there are ``MAX_SEGMENTS``, so there are few files a
bucket. ``buckets`` should grow with the keys expected (some ten million a
bucket); it is fixed when the ledger is first written.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, hadoop_path
from .versioned import Conflict

#: Identity columns of a record and their hash.
SAME, HASH = ["_same_id", "_same_row"], "_key_hash"
BUCKETS, MAX_SEGMENTS = 64, 8
#: Filter bits a key; a key sets one bit in each of the eight words of one block.
BITS_PER_KEY, WORDS = 24, 8

_KEYS = "_same_id string, _same_row string, _key_hash long, bucket int"
_SALT = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], np.uint64)


def _masks(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each key, and its bit in each word of the block."""
    h = hashes.view(np.uint64)
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    low = h & np.uint64(0xFFFFFFFF)
    bit = ((low[:, None] * _SALT) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
    return block.astype(np.int64), np.left_shift(np.uint32(1), bit.astype(np.uint32))


def make_filter(hashes: np.ndarray) -> bytes:
    blocks = max(1, -(-len(hashes) * BITS_PER_KEY // (32 * WORDS)))
    out = np.zeros((blocks, WORDS), np.uint32)
    block, mask = _masks(hashes, blocks)
    np.bitwise_or.at(out, block, mask)
    return out.tobytes()


def may_hold(raw: bytes, hashes: np.ndarray) -> np.ndarray:
    words = np.frombuffer(raw, np.uint32).reshape(-1, WORDS)
    block, mask = _masks(hashes, len(words))
    return ((words[block] & mask) == mask).all(axis=1)


@dataclass
class LedgerState:
    version: int = 0
    buckets: int = BUCKETS
    segments: dict[str, list[int]] = field(default_factory=dict)  # name -> its buckets
    marks: dict[str, int] = field(default_factory=dict)  # "topic/partition" -> highest landed offset
    writers: dict[str, int] = field(default_factory=dict)  # writer -> its last batch


def with_keys(records: DataFrame, identity: list, buckets: int) -> DataFrame:
    """The records with SAME, HASH and bucket."""
    marked = records.select("*", *identity).withColumn(HASH, F.xxhash64(*SAME))
    return marked.withColumn("bucket", F.pmod(F.shiftright(HASH, 7), F.lit(buckets)).cast("int"))


class KeyLedger:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    # ---- state

    def state(self) -> LedgerState:
        where = hadoop_path(self.spark, f"{self.path}/_commits")
        names = [s.getPath().getName() for s in where.fs.listStatus(where.path)] if where.fs.exists(where.path) else []
        versions = [n for n in names if n.endswith(".json")]
        if not versions:
            return LedgerState(buckets=self.buckets)
        return LedgerState(**json.loads(hadoop_path(self.spark, f"{self.path}/_commits/{max(versions)}").read()))

    def _publish(self, state: LedgerState) -> None:
        draft = hadoop_path(self.spark, f"{self.path}/_commits/.{uuid.uuid4().hex}.tmp")
        draft.write(json.dumps(state.__dict__))
        if not draft.rename_if_free(f"{self.path}/_commits/{state.version:020d}.json"):
            draft.fs.delete(draft.path, False)
            raise Conflict(f"version {state.version} of {self.path} exists")
        delete_path(self.spark, f"{self.path}/_commits/{state.version - 3:020d}.json")

    def _intent(self, writer: str, batch: int):
        name = hashlib.sha256(f"{writer}\n{batch}".encode()).hexdigest()[:24]
        return hadoop_path(self.spark, f"{self.path}/_intents/{name}")

    # ---- look-up

    def _filters(self, state: LedgerState) -> DataFrame:
        paths = [f"{self.path}/segments/{s}/filters" for s in state.segments]
        return self.spark.read.schema("segment string, bucket int, bits binary").parquet(*paths)

    def candidate_files(self, keys: DataFrame, state: LedgerState) -> list[str]:
        """Folders (segment and bucket) that may hold one of the keys: at most segments x buckets."""
        if not state.segments:
            return []

        def probe(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            hashes = left.column(HASH).to_numpy()
            hit = [s for s, bits in zip(right.column("segment").to_pylist(), right.column("bits"), strict=True) if len(hashes) and may_hold(bits.as_py(), hashes).any()]
            return pa.table({"segment": pa.array(hit, pa.string()), "bucket": pa.array([key[0].as_py()] * len(hit), pa.int32())})

        found = (keys.select(HASH, "bucket").groupBy("bucket").cogroup(self._filters(state).groupBy("bucket"))
                 .applyInArrow(probe, "segment string, bucket int").collect())
        return sorted(f"{self.path}/segments/{r['segment']}/keys/bucket={r['bucket']}" for r in found)

    def read_keys(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], _KEYS).select(*SAME)
        return self.spark.read.schema("_same_id string, _same_row string").parquet(*folders)

    def unseen(self, keyed: DataFrame, state: LedgerState) -> DataFrame:
        """The rows of ``keyed`` (``with_keys``) that have not landed."""
        ask = keyed
        if state.marks and {"topic", "partition", "offset"} <= set(keyed.columns):
            marks = self.spark.createDataFrame([(k, v) for k, v in state.marks.items()], "_feed string, _mark long")
            feed = F.concat_ws("/", "topic", "partition")
            ask = keyed.join(F.broadcast(marks), feed == F.col("_feed"), "left")  # a row a partition of the topics
            ask = ask.filter((F.col("_same_row") == "") | (F.col("offset") <= F.col("_mark")) | F.col("offset").isNull())
        folders = self.candidate_files(ask, state)
        return keyed.join(self.read_keys(folders), SAME, "left_anti") if folders else keyed

    # ---- landing

    def land(self, keyed: DataFrame, writer: str, batch: int, append: Callable[[DataFrame], None], landed: Callable[[DataFrame], DataFrame]) -> bool:
        """Append the rows of ``keyed`` that have not landed, and enter their keys; False if this batch is entered already.

        ``append`` adds rows to the landing table; ``landed`` gives the identities in it that a broken-off run of this batch may have appended.
        """
        while True:
            state = self.state()
            if state.writers.get(writer, -1) >= batch:
                return False
            fresh = self.unseen(keyed, state)
            intent = self._intent(writer, batch)
            broken = intent.fs.exists(intent.path)
            if not broken:
                intent.write(f"{writer} {batch}")
            append(fresh.join(landed(fresh), SAME, "left_anti") if broken else fresh)
            new = self._add(fresh, state)
            new.writers[writer] = batch
            try:
                self._publish(new)
            except Conflict:  # the intent stands, so the next turn finds what this one has appended
                continue
            intent.fs.delete(intent.path, False)
            self.compact()
            return True

    def _add(self, keyed: DataFrame, state: LedgerState) -> LedgerState:
        segments = dict(state.segments)
        name, buckets = self._write(keyed.select(*SAME, HASH, "bucket"))
        if buckets:
            segments[name] = buckets
        marks = dict(state.marks)
        if {"topic", "partition", "offset"} <= set(keyed.columns):
            for r in keyed.groupBy(F.concat_ws("/", "topic", "partition").alias("feed")).agg(F.max("offset").alias("top")).collect():
                if r["top"] is not None:
                    marks[r["feed"]] = max(marks.get(r["feed"], -1), r["top"])
        return LedgerState(state.version + 1, state.buckets, segments, marks, dict(state.writers))

    def _write(self, keys: DataFrame) -> tuple[str, list[int]]:
        """A segment with its filters; its name and buckets."""
        name = uuid.uuid4().hex
        at = f"{self.path}/segments/{name}"
        keys.repartition("bucket").sortWithinPartitions("bucket", *SAME).write.partitionBy("bucket").parquet(f"{at}/keys")

        def build(key: tuple, rows: pa.Table) -> pa.Table:
            bits = make_filter(rows.column(HASH).to_numpy())
            return pa.table({"segment": [name], "bucket": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits], pa.binary())})

        written = self.spark.read.schema(_KEYS).parquet(f"{at}/keys")
        written.select(HASH, "bucket").groupBy("bucket").applyInArrow(build, "segment string, bucket int, bits binary").write.parquet(f"{at}/filters")
        buckets = self.spark.read.schema("segment string, bucket int, bits binary").parquet(f"{at}/filters").select("bucket").collect()
        return name, sorted(r["bucket"] for r in buckets)

    # ---- upkeep

    def compact(self, most: int = MAX_SEGMENTS) -> bool:
        """Merge all segments into one if there are ``most``; the old ones go."""
        state = self.state()
        if len(state.segments) < most:
            return False
        every = None
        for s in state.segments:
            part = self.spark.read.schema(_KEYS).parquet(f"{self.path}/segments/{s}/keys")
            every = part if every is None else every.unionByName(part)
        name, buckets = self._write(every)
        try:
            self._publish(LedgerState(state.version + 1, state.buckets, {name: buckets}, state.marks, state.writers))
        except Conflict:
            delete_path(self.spark, f"{self.path}/segments/{name}")
            return False
        for s in state.segments:
            delete_path(self.spark, f"{self.path}/segments/{s}")
        return True

    def vacuum(self, grace_hours: float = 24) -> int:
        """Delete segments that no record names and that are older than ``grace_hours``; returns their number."""
        live, data, gone = self.state().segments, hadoop_path(self.spark, f"{self.path}/segments"), 0
        if not data.fs.exists(data.path):
            return 0
        for s in data.fs.listStatus(data.path):
            if s.getPath().getName() not in live and s.getModificationTime() < (time.time() - 3600 * grace_hours) * 1000:
                gone += data.fs.delete(s.getPath(), True)
        return gone

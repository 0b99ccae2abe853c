"""A landing table with a record a batch, for readers that go on from the last record.

A plain Parquet landing folder tells a stream nothing but its files, so every
trigger lists all of them, and rewriting them would look like new rows. Here
each batch adds a folder of files and publishes one record that names it::

    data/commit=<name>/year=.../month=.../mdate=.../part-*.parquet
    _commits/<version>.json

``append`` is idempotent by (writer, batch). ``read`` gives all rows.
``follow`` hands the rows of new records on, batch by batch, with the version as
batch id: it looks at new records only, whatever has landed before.
``compact`` merges the folders of many small batches into one and publishes
that, too. Every row keeps the name of the commit it came with, so a
follower that has seen some of the merged commits still takes just the others,
and compaction may run under it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import delete_path, hadoop_path
from .versioned import SNAPSHOT_EVERY, CommitLog, Conflict

#: The commit that a row came with.
FROM = "_from"


@dataclass
class LandingState:
    version: int = 0
    homes: dict[str, list[str]] = field(default_factory=dict)  # live folder -> the commits whose rows it holds
    writers: dict[str, int] = field(default_factory=dict)


class LandingLog(CommitLog):
    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition_by: list[str]):
        super().__init__(spark, path)
        self.schema, self.partition_by = schema, partition_by
        self._stored = StructType([*schema.fields, StructField(FROM, StringType(), True)])

    def state(self) -> LandingState:
        records = []
        for v in reversed(self._versions()):
            records.append(self._record(v))
            if "homes" in records[-1]:
                break
        out = LandingState()
        for r in reversed(records):
            out.version = r["version"]
            if "homes" in r:
                out.homes, out.writers = dict(r["homes"]), dict(r["writers"])
            else:
                self._apply(out, r)
        return out

    @staticmethod
    def _apply(state: LandingState, r: dict) -> None:
        for old in r.get("merges", []):
            state.homes.pop(old, None)
        state.homes[r["folder"]] = r["holds"]
        if "writer" in r:
            state.writers[r["writer"]] = r["batch"]

    def _commit(self, record: dict, state: LandingState) -> None:
        record["version"] = state.version + 1
        if record["version"] % SNAPSHOT_EVERY == 0:
            after = LandingState(record["version"], dict(state.homes), dict(state.writers))
            self._apply(after, record)
            record |= {"homes": after.homes, "writers": after.writers}
        self._publish(record)

    def _write(self, rows: DataFrame, folder: str) -> None:
        (rows.select(*self._stored.names).hint("rebalance", *self.partition_by)
         .write.partitionBy(*self.partition_by).parquet(f"{self.path}/data/{folder}"))

    def _folders(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self._stored)
        every = None
        for f in folders:
            part = self.spark.read.schema(self._stored).parquet(f"{self.path}/data/{f}")
            every = part if every is None else every.unionByName(part)
        return every

    # ---- writing

    def append(self, rows: DataFrame, writer: str, batch: int) -> int | None:
        """Land ``rows`` as this batch of this writer; None if it has landed already."""
        folder = None
        while True:
            state = self.state()
            if state.writers.get(writer, -1) >= batch:
                if folder:
                    delete_path(self.spark, f"{self.path}/data/{folder}")
                return None
            if folder is None:
                folder = f"commit={uuid.uuid4().hex}"
                self._write(rows.withColumn(FROM, F.lit(folder)), folder)
            try:
                self._commit({"folder": folder, "holds": [folder], "writer": writer, "batch": batch}, state)
                return state.version + 1
            except Conflict:
                continue  # another writer's rows: these are still as they should be

    def compact(self, least: int = 8) -> int:
        """Merge the folders that hold one commit each, if there are ``least``; returns how many were merged."""
        while True:
            state = self.state()
            small = [f for f, holds in state.homes.items() if len(holds) == 1]
            if len(small) < least:
                return 0
            folder = f"commit={uuid.uuid4().hex}"
            self._write(self._folders(small), folder)
            try:
                self._commit({"folder": folder, "holds": [c for f in small for c in state.homes[f]], "merges": small}, state)
                return len(small)
            except Conflict:
                delete_path(self.spark, f"{self.path}/data/{folder}")

    def vacuum(self, grace_hours: float = 24) -> int:
        """Delete folders that are no commit's home and older than ``grace_hours``; returns their number."""
        live, data, gone = self.state().homes, hadoop_path(self.spark, f"{self.path}/data"), 0
        if not data.fs.exists(data.path):
            return 0
        for s in data.fs.listStatus(data.path):
            if s.getPath().getName() not in live and s.getModificationTime() < (time.time() - 3600 * grace_hours) * 1000:
                gone += data.fs.delete(s.getPath(), True)
        return gone

    # ---- reading

    def read(self) -> DataFrame:
        """All landed rows."""
        return self._folders(list(self.state().homes)).drop(FROM)

    def since(self, position: int, most: int = 64, until: int | None = None) -> tuple[int, DataFrame]:
        """The rows of up to ``most`` batches after version ``position`` (or of all up to ``until``), and the version they reach to.

        Opens those records and the folders their rows are in now, no others.
        """
        new, at = [], position
        while (len(new) < most if until is None else at < until) and self._exists(at + 1):
            at += 1
            record = self._record(at)
            if "merges" not in record:
                new.append(record["folder"])
        if not new:
            return at, self._folders([]).drop(FROM)
        homes = self.state().homes
        folders = [f for f, holds in homes.items() if not set(new).isdisjoint(holds)]
        rows = self._folders(folders)
        if any(set(homes[f]) - set(new) for f in folders):  # merged with commits that are seen already
            rows = rows.filter(F.col(FROM).isin(new))
        return at, rows.drop(FROM)

    def _exists(self, version: int) -> bool:
        where = hadoop_path(self.spark, self._record_path(version))
        return where.fs.exists(where.path)

    def follow(self, checkpoint: str, handle: Callable[[DataFrame, int], None], most: int = 64) -> int:
        """Hand all new records on, ``most`` a batch, as ``handle(rows, version)``; returns the number of batches.

        The position is a file named by the version under ``checkpoint``, written
        when ``handle`` has returned. A batch that was broken off is handed
        on again from the same position; ``handle`` must take a version once,
        as ``totals.merge_batch`` does, and up to the same record: the end of a
        batch is fixed in the checkpoint before it begins.
        """
        root, batches = checkpoint.rstrip("/"), 0
        while True:
            position, planned = self._marker(root, "done"), self._marker(root, "next")
            until = planned if planned > position else None
            at, rows = self.since(position, most, until)
            if until is not None and at != until:
                raise RuntimeError(f"records up to {until} of {self.path} are gone")
            if at == position:
                return batches
            if until is None:
                self._mark(root, "next", at)
            handle(rows, at)
            self._mark(root, "done", at)
            batches += 1

    def _marker(self, root: str, name: str) -> int:
        where = hadoop_path(self.spark, f"{root}/{name}")
        if not where.fs.exists(where.path):
            return 0
        return max((int(s.getPath().getName()) for s in where.fs.listStatus(where.path)), default=0)

    def _mark(self, root: str, name: str, version: int) -> None:
        before = self._marker(root, name)
        hadoop_path(self.spark, f"{root}/{name}/{version}").write("")
        if before and before != version:
            delete_path(self.spark, f"{root}/{name}/{before}")

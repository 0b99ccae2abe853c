"""Paged API source (SRC-6 incremental, SRC-7 bulk backfill, STR-3/4).

A Python Data Source named ``paged``. The user supplies a *client factory*
as ``"module:callable"``; the client needs one method and may have another::

    fetch(offset, limit) -> list[dict]     # records from offset, at most limit
    size() -> int                          # optional: records available now

Without ``size()`` the driver finds the end by probing single records
(doubling, then halving: a few dozen calls). Every page becomes one input
partition and is fetched on an executor, so a backfill is spread over the
cluster. A task goes on from the number of records it really got, so a server
that answers with shorter pages loses nothing; an empty page before the
planned end fails the task. The batch reader reads ``[start, end)``; the stream
reader keeps its position in the query checkpoint (restart resumes, nothing is
re-read), and its end never falls, even if the feed shrinks.

A feed that puts records in before the position, or takes some out, moves the
others, and a number alone then skips or repeats records (T19). With the option
``key`` (the name of an id field) the stream's position also holds the ids of
the last, second, fourth, eighth ... record before it. At each poll these
show up to where the feed is unchanged, and reading goes on from there. What is
read again is dropped downstream by id (``dedup_records``, ``ingest``). Only a
record put in and another taken out between the same two marks can hide each
other.

``max_records_per_trigger`` bounds what one trigger takes; with an interval
trigger the rest follows in the next ones. Spark plans an ``availableNow`` run
from a single position of a Python source, so such a run is one step;
``read_in_steps`` fixes the end first and takes steps until it is reached.

Options: ``client`` (required), ``page_size`` (records per API call,
default 1000), ``pages_per_partition`` (API pages fetched in sequence by one
task, default 1 — raise it for large backfills so tasks stay coarse),
``start`` (default 0), ``key`` and ``max_records_per_trigger`` (streams only,
see above), ``until`` (stream: end that is not passed); any option prefixed ``client.`` is passed to the factory as a
keyword.
"""

from __future__ import annotations

import importlib

import pyarrow as pa
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from ..schemas import COUNT_JSON_COLUMNS, RAW_COUNT_JSON_SCHEMA

SOURCE_NAME = "paged"


class Page(InputPartition):
    """A run of records [offset, offset + limit), fetched ``page_size`` at a time."""

    def __init__(self, offset: int, limit: int, page_size: int | None = None):
        self.offset = offset
        self.limit = limit
        self.page_size = page_size or limit


def _client(options, factory=None):
    if factory is not None:
        kwargs = {k[len("client."):]: v for k, v in options.items() if k.startswith("client.")}
        return factory(**kwargs)
    spec = options.get("client")
    if not spec or ":" not in spec:
        raise ValueError("option 'client' must be 'module:callable'")
    module, attr = spec.split(":", 1)
    factory = getattr(importlib.import_module(module), attr)
    kwargs = {k[len("client."):]: v for k, v in options.items() if k.startswith("client.")}
    return factory(**kwargs)


def _pages(start: int, end: int, size: int, per_partition: int = 1) -> list[Page]:
    """Input partitions over [start, end): ``per_partition`` API pages each."""
    span = size * max(1, per_partition)
    return [Page(o, min(span, end - o), size) for o in range(start, end, span)]


def _end(client, start: int, known: int = 0) -> int:
    """Number of records the feed holds; ``known`` of them are sure."""
    size = getattr(client, "size", None)
    if size is not None:
        return int(size())

    def has(offset: int) -> bool:
        return bool(client.fetch(offset, 1))

    low = max(start, known)  # records before ``low`` are there
    step = 1
    while has(low + step - 1):
        low, step = low + step, step * 2
    high = low + step - 1  # not there
    while low < high:
        mid = (low + high) // 2
        low, high = (mid + 1, high) if has(mid) else (low, mid)
    return low


def _batches(options, page: Page, factory=None):
    """One Arrow batch per API page, going on from what was returned."""
    client = _client(options, factory)
    at, end = page.offset, page.offset + page.limit
    schema = pa.schema([(c, pa.string()) for c in COUNT_JSON_COLUMNS])
    while at < end:
        got = client.fetch(at, min(page.page_size, end - at))
        if not got:
            raise RuntimeError(f"paged source: empty page at {at}, before the end {end}")
        got = got[: end - at]
        at += len(got)
        columns = [[None if r.get(c) is None else str(r.get(c)) for r in got] for c in COUNT_JSON_COLUMNS]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in columns], schema=schema)


class PagedReader(DataSourceReader):
    def __init__(self, options, factory=None):
        self.options = dict(options)
        self.factory = factory
        self.page_size = int(self.options.get("page_size", 1000))
        self.start = int(self.options.get("start", 0))
        self.per_partition = int(self.options.get("pages_per_partition", 1))

    def partitions(self):
        end = _end(_client(self.options, self.factory), self.start)
        return _pages(self.start, end, self.page_size, self.per_partition) or [Page(self.start, 0)]

    def read(self, partition):
        if partition.limit <= 0:
            return iter(())
        return _batches(self.options, partition, self.factory)


def _marks(client, end: int, key: str) -> list[list]:
    """[index, key] of records 1, 2, 4, 8, ... before ``end``: a few dozen, whatever the feed's size."""
    out, back = [], 1
    while back <= end:
        got = client.fetch(end - back, 1)
        if got:
            out.append([end - back, str(got[0].get(key))])
        back *= 2
    return out


def _resume(client, position: int, marks: list[list], start: int, key: str) -> int:
    """The index to go on from, so that no record that was put in or moved is missed.

    Marks are looked at from the farthest back on. Up to the last one that
    stands where it stood the feed is unchanged; from there it is read again.
    """
    unchanged = start
    for index, wanted in reversed(marks):
        got = client.fetch(index, 1)
        if not got or str(got[0].get(key)) != wanted:
            return unchanged
        unchanged = index
    return position


class PagedStreamReader(DataSourceStreamReader):
    def __init__(self, options, factory=None):
        self.options = dict(options)
        self.factory = factory
        self.page_size = int(self.options.get("page_size", 1000))
        self.start = int(self.options.get("start", 0))
        self.per_partition = int(self.options.get("pages_per_partition", 1))
        self.cap = int(self.options.get("max_records_per_trigger", 0))
        self.until = int(self.options["until"]) if "until" in self.options else None
        self.key = self.options.get("key")
        self.planned = None  # last offset handed to Spark (driver side)

    def initialOffset(self):
        return {"offset": self.start}

    def latestOffset(self):
        # Spark asks for the latest offset before ``initialOffset`` on a fresh
        # query, and re-plans the last checkpointed batch (``partitions``)
        # before asking on a restart, so ``planned`` is the current position
        # whenever it is set, and ``start`` is it otherwise.
        last = self.planned or self.initialOffset()
        position = int(last["offset"])
        client = _client(self.options, self.factory)
        end = _end(client, self.start, 0 if self.key else position)
        if self.until is not None:
            end = min(end, self.until)
        begin = position
        if self.key and self.planned:
            begin = min(_resume(client, position, last.get("marks", []), self.start, self.key), end)
        if end <= position and begin >= min(position, end):
            return last  # nothing new: the end never falls
        if self.cap:
            end = min(end, begin + self.cap)
        if self.key:
            end_at = {"offset": end, "from": begin, "marks": _marks(client, end, self.key)}
        else:
            end_at = {"offset": end}
        self.planned = end_at
        return end_at

    def partitions(self, start, end):
        self.planned = end
        begin = min(int(end.get("from", start["offset"])), int(start["offset"]))
        return _pages(begin, int(end["offset"]), self.page_size, self.per_partition)

    def read(self, partition):
        return _batches(self.options, partition, self.factory)

    def commit(self, end):
        # The durable position lives in the query checkpoint; keep the
        # reader's view in step with it.
        if self.planned is None:
            self.planned = end


class PagedDataSource(DataSource):
    client_factory = None  # set by ``register(spark, client=...)``

    @classmethod
    def name(cls):
        return SOURCE_NAME

    def schema(self):
        return RAW_COUNT_JSON_SCHEMA

    def reader(self, schema):
        return PagedReader(self.options, type(self).client_factory)

    def streamReader(self, schema):
        return PagedStreamReader(self.options, type(self).client_factory)


def read_in_steps(spark, options: dict, start_query, max_records: int, client=None) -> list[int]:
    """Read what the feed holds now in ``availableNow`` runs of at most ``max_records`` records each.

    ``start_query`` starts a checkpointed query with trigger ``availableNow`` on
    the stream it is given. The end is fixed before the first step; records
    that come meanwhile are left to the next call. Returns the records of each
    step. ``client``: the factory given to ``register``.
    """
    options = {k: str(v) for k, v in options.items()}
    end = _end(_client(options, client), int(options.get("start", 0)))
    steps = []
    while True:
        stream = spark.readStream.format(SOURCE_NAME).options(**options, until=str(end), max_records_per_trigger=str(max_records)).load()
        query = start_query(stream)
        query.awaitTermination()
        n = sum(p["numInputRows"] for p in query.recentProgress)
        if not n:
            return steps
        steps.append(n)


def register(spark, client=None) -> None:
    """Make ``spark.read.format('paged')`` / ``readStream.format('paged')`` available.

    ``client`` (a factory callable) is bound to the source; without it the
    ``client`` option names ``module:callable`` importable on executors.
    The source code is pickled by value, so Python workers and the
    streaming planner need not have this package installed.
    """
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    if client is not None:
        # Ship the client's own module by value unless it is an installed
        # package (executors have those); ``__main__`` is by value anyway.
        module = sys.modules.get(getattr(client, "__module__", ""), None)
        path = getattr(module, "__file__", "") or ""
        if module is not None and module.__name__ != "__main__" and "site-packages" not in path:
            cloudpickle.register_pickle_by_value(module)
    source = type("PagedDataSource", (PagedDataSource,), {"client_factory": client})
    spark.dataSource.register(source)

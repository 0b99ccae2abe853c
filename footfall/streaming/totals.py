"""Running totals and incrementally maintained rankings over a count stream.

Both tables are versioned (``versioned.VersionedTable``): a batch becomes
visible by one commit record and not before, so a crash at any point leaves the
old totals or the new ones. Per micro-batch (``foreachBatch``):

1. ``delta``: the batch summed per (period, sensor) — partial aggregation,
   so a hot sensor collapses map-side.
2. If a record of the totals table already names this batch of this writer (a
   re-run after a failure), nothing is merged again. The writer is the
   checkpoint, so a new checkpoint over an old table starts its own count.
3. Otherwise ``current + delta`` is re-summed per key, where ``current`` is
   read in the touched periods only, straight from the files that the record
   names; the sums are written to new files and published.
4. Top-n of the touched periods is ranked from the totals as published and
   published in turn, unless its record names the batch too. A ``row_number``
   on the stream itself is rejected by Spark, hence ranking inside the batch.

Two writers may share a table: the slower one finds its version taken and
merges again on top of the other's. Every key may be null and is compared
null-safe.

No state store is involved, so nothing grows with the number of keys ever
seen: the totals table is the state, and each batch costs in proportion to
the periods it touches. Late rows are simply merged into their period (the
reference keeps late data too). Files of replaced versions stay for readers
of ``KEEP`` versions and are deleted after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.rank import MEASURE, PERIOD_KEYS, period_keys, top_n
from ..schemas import COUNTS_SCHEMA
from ..session import delete_path
from .ingest import stage, trigger_args
from .landing import LandingLog
from .versioned import Conflict, VersionedTable

KEY = "sensor_id"
#: Versions whose files stay for readers that began with them; how often older ones are deleted.
KEEP, VACUUM_EVERY = 16, 32


def totals_schema(period: str = "day") -> StructType:
    types = {f.name: f.dataType for f in COUNTS_SCHEMA.fields}
    return StructType([StructField(k, types[k], True) for k in period_keys(period)] + [
        StructField(KEY, StringType(), True),
        StructField(MEASURE, LongType(), True),
    ])


#: A ranking has the columns of the totals.
top_schema = totals_schema


def totals_table(spark: SparkSession, path: str, period: str = "day") -> VersionedTable:
    return VersionedTable(spark, path, totals_schema(period), period_keys(period))


def period_delta(counts: DataFrame, period: str = "day") -> DataFrame:
    """Sum per (period, sensor) of one batch of counts."""
    keys = period_keys(period)
    return counts.groupBy(*keys, KEY).agg(F.sum(MEASURE).alias(MEASURE))


def read_totals(spark: SparkSession, totals_path: str, period: str = "day") -> DataFrame:
    """The totals as last published (empty before the first batch)."""
    return totals_table(spark, totals_path, period).read()


def read_top_n(spark: SparkSession, top_path: str, period: str = "day") -> DataFrame:
    return totals_table(spark, top_path, period).read()


def _merge(table: VersionedTable, delta: DataFrame, touched: list[tuple], writer: str, batch_id: int) -> None:
    """Publish the totals of the touched periods with ``delta`` added, unless this batch is published."""
    while True:
        state = table.state()
        if state.published(writer, batch_id):
            return
        current = table.read(state, touched)
        merged = current.unionByName(delta).groupBy(*table.keys, KEY).agg(F.sum(MEASURE).alias(MEASURE))
        try:
            table.replace(merged, state, writer, batch_id, touched)
            return
        except Conflict:
            continue


def _rank(totals: VersionedTable, top: VersionedTable, touched: list[tuple], writer: str, batch_id: int, n: int) -> None:
    """Publish the ranking of the touched periods as the totals now stand, unless this batch's is published."""
    while True:
        state = top.state()
        if state.published(writer, batch_id):
            return
        try:
            top.replace(top_n(totals.read(only=touched), totals.keys, n), state, writer, batch_id, touched)
            return
        except Conflict:
            continue


def merge_batch(counts: DataFrame, batch_id: int, totals_path: str, staging_root: str,
                top_path: str | None = None, period: str = "day", n: int = 10,
                writer: str | None = None) -> None:
    """Fold one batch of counts into the totals (and top-n) tables; idempotent.

    ``writer`` names the sequence that ``batch_id`` counts in (default: ``staging_root``).
    """
    spark = counts.sparkSession
    writer = writer or staging_root
    root = f"{staging_root.rstrip('/')}/batch={batch_id}"
    delta = stage(period_delta(counts, period), f"{root}/delta")
    # The periods of one batch: a line a day, as the commit record has.
    touched = [tuple(r) for r in delta.select(*period_keys(period)).distinct().collect()]
    if touched:
        tables = [totals_table(spark, totals_path, period)]
        _merge(tables[0], delta, touched, writer, batch_id)
        if top_path is not None:
            tables.append(totals_table(spark, top_path, period))
            _rank(*tables, touched, writer, batch_id, n)
        if batch_id % VACUUM_EVERY == VACUUM_EVERY - 1:
            for t in tables:
                t.vacuum(KEEP)
    delete_path(spark, root)


def maintain_totals_and_top_n(counts: DataFrame, totals_path: str, checkpoint: str,
                              top_path: str | None = None, period: str = "day", n: int = 10,
                              trigger: str | None = "availableNow") -> StreamingQuery:
    """Start the streaming query that keeps totals (and top-n) per period."""
    if period not in PERIOD_KEYS:
        raise ValueError(f"unknown period {period!r}")
    keys = period_keys(period)
    staging = f"{checkpoint.rstrip('/')}/staging"
    return (counts.select(*keys, KEY, MEASURE).writeStream
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, bid: merge_batch(df, bid, totals_path, staging, top_path, period, n, checkpoint))
            .trigger(**trigger_args(trigger))
            .start())



def follow_landing(log: LandingLog, totals_path: str, checkpoint: str, top_path: str | None = None,
                   period: str = "day", n: int = 10, most: int = 64) -> int:
    """Bring totals (and top-n) up to the last record of a landing log; returns the number of batches taken."""
    staging = f"{checkpoint.rstrip('/')}/staging"
    keys = period_keys(period)
    return log.follow(checkpoint, lambda rows, version: merge_batch(
        rows.select(*keys, KEY, MEASURE), version, totals_path, staging, top_path, period, n, checkpoint), most)

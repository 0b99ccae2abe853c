"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1], piecewise
linear between knots. Its integral up to t, scaled to the source's target, is
the source's cumulative token demand. The documents of a source stand in a
fixed hashed order; the copy that begins after a tokens of that order trains
at the time t at which the demand reaches a (the inverse of the integral).
Sorting by that time, by ranges, gives the training order.

A source is repeated in epochs until its target is met (at most
``MAX_EPOCHS`` times). Running totals within a source are exact and spread
over ``bins`` hash ranges of the order: totals of the bins are added up per
source and each bin is summed on its own, so a source with a third of all
rows is never in one task. Results do not depend on the number of bins.

Defined results: a null or empty text has size 0, takes nothing and stays in
the mix once. A null source is a source of its own, last in order. Rows with
equal ids are ordered by size and text; rows without an id stand where the hash of their text puts them. Repeated rows count each. An empty
table gives an empty result. Extra columns are ignored by ``mix`` and kept by
``mixed_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import IDENTITY, SPACED_WORD, identity, placed, staged, text_key, with_identity

#: Contract values: weights of the sources in turn, and the most a source is repeated.
WEIGHTS, MAX_EPOCHS = (1, 2, 3), 3

#: Weight schedules in turn, as (time, weight) knots: falling, level, rising. Sources of little weight fade out.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)

BINS = 1024


def _sized(docs: DataFrame, bins: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = F.col("source").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key(F.col("text").cast("string")).alias("text_key"),
        source.isNull().alias("no_source"), F.coalesce(source, F.lit("")).alias("source"),
        F.regexp_count(text, F.lit(SPACED_WORD)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.concat(F.lit("text "), text)).cast("binary")).alias("hash"),
    ).withColumn("place", F.conv(F.substring("hash", 1, 15), 16, 10).cast("long")).drop("hash").withColumn(
        "bin", F.shiftright(F.shiftright("place", 29) * bins, 31))  # bins are runs of the order by place


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """no_source, source, source_size, rank, target from one row per source (no_source, source, source_size).

    Water filling in closed form: in the order of cap over weight, the first
    source that its level leaves below its cap sets the level for all later ones.
    There may be any number of sources: they are ranked, and summed up in that
    order, by ranges and the totals of the ranges before; one row, that
    first source's, is collected.
    """
    listed = staged(sizes.select(F.lit(0).alias("_all"), "no_source", "source", "source_size"), "mixing-sources")
    ranked = placed(listed, "_all", ["no_source", "source"], "mixing-ranks").withColumnRenamed("place", "rank")
    w = F.element_at(F.array(*map(F.lit, weights)), F.pmod("rank", F.lit(len(weights))).cast("int") + 1).cast("double")
    cap = (F.col("source_size") * max_epochs).cast("double")
    weighted = ranked.select("no_source", "source", "source_size", "rank", w.alias("w"), cap.alias("cap")).withColumn("ratio", F.col("cap") / F.col("w"))
    run = staged(weighted.repartitionByRange("ratio", "rank").withColumn("_part", F.spark_partition_id()), "mixing-ratios")
    parts = run.groupBy("_part").agg(F.sum("cap").alias("cap"), F.sum("w").alias("w"), F.sum("source_size").alias("size"))
    everything = Window.partitionBy(F.lit(0))  # a row for each range
    earlier = everything.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0.0)
    start = parts.select(
        "_part", (F.sum("size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(earlier), none)).alias("left_at"),
        (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(earlier), none)).alias("rest_at"))
    within = Window.partitionBy("_part").orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        run.withColumn("cap_before", F.coalesce(F.sum("cap").over(within), none)).withColumn("w_before", F.coalesce(F.sum("w").over(within), none))
        .join(start, "_part")
        .select("ratio", "rank", (F.col("left_at") - F.col("cap_before")).alias("left_over"), (F.col("rest_at") - F.col("w_before")).alias("rest")))
    # The free sources' common level is (left_over / rest) of the first free one.
    free = filled.filter(F.col("left_over") / F.col("rest") <= F.col("ratio"))
    level = free.agg(F.min(F.struct("ratio", "rank", "left_over", "rest")).alias("first")).first()["first"]
    target = F.col("cap")
    if level is not None:
        later = (F.col("ratio") > level["ratio"]) | ((F.col("ratio") == level["ratio"]) & (F.col("rank") >= level["rank"]))
        filled_to = F.least(F.col("w") * F.lit(level["left_over"]) / F.lit(level["rest"]), F.col("cap"))
        target = F.when(later, filled_to).otherwise(F.col("cap"))
    return run.select("no_source", "source", "source_size", "rank", target.alias("target"))


def _segments(schedules) -> Column:
    """Per schedule the linear pieces of its normalised integral: start time, integral there, weight and slope."""
    out = []
    for knots in schedules:
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
        area, done, parts = sum(areas), 0.0, []
        for (t0, w0), (t1, w1), a in zip(knots, knots[1:], areas, strict=False):
            parts.append(F.struct(
                F.lit(done).alias("done"), F.lit(t0).alias("t0"), F.lit(w0 / area).alias("w0"), F.lit((w1 - w0) / (t1 - t0) / area).alias("slope")))
            done += a / area
        out.append(F.array(*parts))
    return F.array(*out)


def _time(share: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """Time at which the schedule's integral reaches ``share`` of its whole: a quadratic solved in the right piece."""
    pieces = F.element_at(_segments(schedules), F.pmod(rank, F.lit(len(schedules))).cast("int") + 1)
    piece = F.element_at(F.filter(pieces, lambda p: p["done"] <= share), -1)
    y = share - piece["done"]
    root = F.sqrt(F.greatest(piece["w0"] * piece["w0"] + 2 * piece["slope"] * y, F.lit(0.0)))
    return F.least(piece["t0"] + 2 * y / (piece["w0"] + root), F.lit(1.0))


def mix(docs: DataFrame, bins: int = BINS, weights: tuple[int, ...] = WEIGHTS, schedules=SCHEDULES, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per document: doc_id, text_key, size, source_size, target, taken, copies and times (training time of each copy).

    ``taken`` is the document's share of the demand: the last epoch ends inside
    a document, whose last copy is then taken in part. ``copies`` are whole: that
    last copy is in if at least half of it is taken.
    """
    sized = staged(_sized(docs, bins), "mixing-sizes")
    key = ["no_source", "source"]
    by_bin = sized.groupBy(*key, "bin").agg(F.sum("size").alias("bin_size"))
    ahead = F.sum("bin_size").over(Window.partitionBy(*key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bin_start = by_bin.select(*key, "bin", F.coalesce(ahead, F.lit(0)).cast("long").alias("bin_start"))
    targets = source_targets(sized.groupBy(*key).agg(F.sum("size").alias("source_size")), weights, max_epochs)
    within = F.sum("size").over(
        Window.partitionBy(*key, "bin").orderBy("place", "doc_id", "size", "text_key").rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        sized.withColumn("before", F.coalesce(within, F.lit(0)))
        .join(bin_start, [*key, "bin"]).join(targets, key)
        .withColumn("before", F.col("before") + F.col("bin_start"))
    )
    goal, size, total = F.round("target").cast("long"), F.col("size"), F.col("source_size")

    def part(epoch: int) -> Column:
        """Words taken of the copy in this epoch."""
        return F.greatest(F.least(goal - F.col("before") - total * epoch, size), F.lit(0))

    taken = sum((part(e) for e in range(max_epochs)), F.lit(0).cast("long"))
    whole = [(part(e) * 2 >= size) & (part(e) > 0) for e in range(max_epochs)]
    whole[0] |= size == 0
    share = [F.least(F.greatest((F.col("before") + total * e) / F.greatest(F.col("target"), F.lit(1e-300)), F.lit(0.0)), F.lit(1.0)) for e in range(max_epochs)]
    times = F.filter(F.array(*(F.when(w, _time(s, F.col("rank"), schedules)) for w, s in zip(whole, share, strict=True))), lambda t: t.isNotNull())
    return placed.select(
        "doc_id", "text_key", "size", "source_size", "target", taken.alias("taken"), F.size(times).cast("long").alias("copies"), times.alias("times"))


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, range-sorted by training time.

    Rows of equal id and text are one row here, which comes out as often as the
    plans of them all say.
    """
    plan = mix(docs, **how).select(*identity(F.col("doc_id"), F.col("text_key")), F.explode("times").alias("_mix_time"))
    rows = with_identity(docs).dropDuplicates(IDENTITY).join(plan, IDENTITY)
    return rows.orderBy("_mix_time", F.col("doc_id").cast("long"), "_row_key").select(docs.columns)


def with_positions(mixed: DataFrame) -> DataFrame:
    """``mixed`` (of ``mix``) and the array ``positions``: the place of each copy of a row in training, from 0.

    All copies are range-sorted by time, id and size; ranges are numbered by the
    counts of the ranges before, so positions are exact and without gaps.
    """
    key = ["doc_id", "text_key", "size"]
    plan = staged(mixed.withColumn("_row", F.monotonically_increasing_id()), "mixing-rows")  # written, so that a row keeps its number
    copies = plan.select(F.lit(0).alias("_all"), "_row", *key, F.explode("times").alias("_time"))
    order = placed(copies, "_all", ["_time", *key], "mixing-order")
    found = order.groupBy("_row").agg(F.sort_array(F.collect_list("place")).alias("positions"))  # MAX_EPOCHS copies a row at most
    none = F.array().cast("array<bigint>")
    return plan.join(found, "_row", "left").withColumn("positions", F.coalesce("positions", none)).drop("_row")

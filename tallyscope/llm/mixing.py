"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage
from tallyscope.llm.common import WORD, spread, text_of

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Weight of a source at the start and at the end of the training, relative to its mean; by order, repeating.
SCHEDULES = ((0.5, 1.5), (1.5, 0.5), (1.0, 1.0))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, schedules=SCHEDULES) -> DataFrame:
    """Target words of each source from (source, source_size).

    ``share`` of all words is dealt out by weight; no target exceeds ``most`` times its source, and what a source can't
    take goes to the others by weight. So the target is the smaller of ceiling and weight times a common level, and the
    level follows from ordering the sources by the level at which they fill up: one row per source, hence one window.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("place") % len(values) + 1).cast("int"))
    full = Window.orderBy("fills_at", "place")
    before, rest = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", pick(weights))
        .withColumn("ceiling", most * F.col("source_size"))
        .withColumn("fills_at", F.col("ceiling") / F.col("weight"))
        .withColumn("to_deal", share * F.sum("source_size").over(everything))
        .withColumn("level", (F.col("to_deal") - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
        # Taking too few or too many sources as full gives a lower level, so the highest is the common one.
        .withColumn("level", F.max("level").over(everything))
    )
    return ranked.select(
        "source",
        "source_size",
        F.least("ceiling", F.col("level") * F.col("weight")).alias("target"),
        pick([s for s, _ in schedules]).alias("starts_with"),
        pick([e for _, e in schedules]).alias("ends_with"),
    )


def invert_demand(share: Column, start: Column, end: Column) -> Column:
    """When, between 0 and 1, a source with linearly changing weight has been asked for ``share`` of its words.

    The weight is start + (end - start) t, scaled to a mean of 1; its integral, the demand, is solved for t.
    """
    a, b = 2 * start / (start + end), 2 * end / (start + end)
    root = F.sqrt(F.greatest(a * a + 2 * (b - a) * share, F.lit(0.0)))
    return F.when(F.abs(b - a) < 1e-12, share).otherwise(F.when(root + a <= 0, F.lit(0.0)).otherwise(2 * share / (root + a)))


def in_order(rows: DataFrame, *by: Column | str) -> DataFrame:
    """``rows`` cut into ranges of ``by`` and sorted within them, so that all parts, one after the other, are in order."""
    return rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``positions`` in the order in which training first reads them; those it does not read come last."""
    return in_order(positions(docs, **options), F.asc_nulls_last("first_position"), spread(F.col("doc_id")), F.col("doc_id"))


def positions(docs: DataFrame, rows_per_bin: int = 4096, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, schedules=SCHEDULES) -> DataFrame:
    """Words that a mix takes of every row of ``docs`` (doc_id, text, source, …) and when training reads them.

    Each source is read in the order of md5(doc_id), whole pass after whole pass, until its target is met; the text on
    which it ends is taken in part, so each source gives its target but for less than a word, and no text more than
    ``most`` times, 2 at most. A null source is a source of its own, the last. Empty and null texts have no words and take
    nothing; without any word all targets are 0. Rows that repeat a doc_id are read one after the other.

    The columns of ``docs`` with size, source_size, target, taken, first_position and second_position are returned; the
    positions say when a pass over the text begins (null: it is not read). A column of ``docs`` that has such a name is
    replaced.

    A source may hold most rows: rows fall into bins by hash prefix, bins are summed first, and a row needs but its own bin.
    """
    made = ["size", "source_size", "target", "taken", "first_position", "second_position"]
    docs = docs.drop(*made)
    bits = min(40, max(0, ceil(log2(max(1, docs.count() / rows_per_bin)))))
    order = spread(F.col("doc_id"))
    # A key without nulls: windows and the join on it share one shuffle of the texts, which eqNullSafe would not.
    named = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    head = F.conv(F.substring(order, 1, 10), 16, 10).cast("long")
    rows = docs.withColumn("size", F.regexp_count(text_of(), F.lit(WORD)).cast("long")).withColumn("_bin", F.shiftright(head, 40 - bits))
    bins = cut_lineage(rows.groupBy("source", "_bin").agg(F.sum("size").alias("words")))
    targets = source_targets(bins.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most, schedules)
    ahead = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bins.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
        .join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .select(named.alias("_source"), F.col("_bin").alias("_of"), "ahead", "source_size", "target", "starts_with", "ends_with")
    )
    inside = Window.partitionBy("_named", "_bin").orderBy(order, "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begun = (
        rows.withColumn("_named", named)
        .withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, (F.col("_named") == F.col("_source")) & (F.col("_bin") == F.col("_of")))
        .withColumn("_from", F.col("ahead") + F.col("_inside"))
        .withColumn("_goal", F.floor(F.col("target") + 1e-6))
    )
    start, goal, size = F.col("_from"), F.col("_goal"), F.col("size")

    def within(at: Column) -> Column:
        return F.greatest(F.lit(0), F.least(at + size, goal) - at)

    def when(at: Column) -> Column:
        return F.when((at < goal) & (size > 0), invert_demand(at / goal, F.col("starts_with"), F.col("ends_with")))

    second = start + F.col("source_size")
    return begun.withColumns(
        {
            "taken": within(start) + within(second),
            "first_position": when(start),
            "second_position": when(second),
        }
    ).select(*docs.columns, *made)


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as training reads them: whole texts, repeated as often as the mix passes over them, sorted by position."""
    passes = F.array_compact(F.array("first_position", "second_position"))
    reads = positions(docs, **options).select(*docs.columns, F.explode(passes).alias("_position"))
    return in_order(reads, "_position", "doc_id").select(*docs.columns)

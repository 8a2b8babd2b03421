"""Ordered scans over long keys, cut into time slices.

A window over a key sorts all rows of that key in one task. Here the window runs over (key, slice), where the
slice is a fixed span of the ordering column, and what one slice needs from the earlier ones is carried over by
a table with one row per (key, slice). A key holding a large part of all rows is thus spread over as many tasks
as it has slices, and the carry table stays small because it is bounded by time, not by rows.

Input are ticks: one row per key and order value, with the number of rows behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, SLICE = "_key", "_slice"


def with_slice(df: DataFrame, order: str, width: int) -> DataFrame:
    return df.withColumn(SLICE, F.floor(F.col(order) / F.lit(width)))


def ticks_of(rows: DataFrame, order: str) -> DataFrame:
    return rows.groupBy(KEY, SLICE, order).agg(F.count(F.lit(1)).alias("_rows"))


def number_runs(ticks: DataFrame, order: str, limit: int) -> DataFrame:
    """Number the runs of ticks without a gap above ``limit``.

    Adds ``_gap`` to the previous tick of the key (NULL for the first), ``_opens`` (1 where a run begins), ``_run``
    (counted from 1) and ``_first``, the position among the key's rows of the run's first row. One pass inside the
    slices, one over the slices of a key, one join on (key, slice), for which both sides are partitioned already.
    """
    inside = Window.partitionBy(KEY, SLICE).orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wide = F.col("_near") > limit
    local = (
        ticks.withColumn("_near", F.col(order) - F.lag(order).over(inside))
        .withColumn("_breaks", F.when(wide, 1).otherwise(0))
        .withColumn("_through", F.sum("_rows").over(upto))
        .withColumn("_breaks_upto", F.sum("_breaks").over(upto))
        .withColumn("_start", F.max(F.when(wide, F.col("_through") - F.col("_rows") + 1)).over(upto))
    )
    along = Window.partitionBy(KEY).orderBy(SLICE)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    slices = (
        local.groupBy(KEY, SLICE)
        .agg(
            F.min(order).alias("_from"),
            F.max(order).alias("_to"),
            F.sum("_rows").alias("_n"),
            F.sum("_breaks").alias("_n_breaks"),
            F.max("_start").alias("_last_start"),
        )
        .withColumn("_far", F.col("_from") - F.lag("_to").over(along))
        .withColumn("_enters", F.when(F.col("_far").isNull() | (F.col("_far") > limit), 1).otherwise(0))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_fresh", F.when(F.col("_enters") == 1, F.col("_before") + 1))
        .withColumn("_newest", F.coalesce(F.col("_before") + F.col("_last_start"), F.col("_fresh")))
        .withColumn("_entry", F.coalesce(F.col("_fresh"), F.last("_newest", ignorenulls=True).over(earlier)))
        .withColumn(
            "_runs_before",
            F.coalesce(F.sum(F.col("_n_breaks") + F.col("_enters")).over(earlier), F.lit(0)) + F.col("_enters"),
        )
        .select(KEY, SLICE, "_far", "_enters", "_before", "_entry", "_runs_before")
    )
    head = F.col("_near").isNull()
    return local.join(slices, [KEY, SLICE]).select(
        *ticks.columns,
        F.when(head, F.col("_far")).otherwise(F.col("_near")).alias("_gap"),
        F.when(head, F.col("_enters")).otherwise(F.col("_breaks")).alias("_opens"),
        (F.col("_runs_before") + F.col("_breaks_upto")).alias("_run"),
        F.coalesce(F.col("_before") + F.col("_start"), F.col("_entry")).alias("_first"),
    )


def running_sum(ticks: DataFrame, order: str, value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the key's ticks up to and including each."""
    upto = Window.partitionBy(KEY, SLICE).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(KEY).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    marked = ticks.withColumn("_value", value)
    carry = (
        marked.groupBy(KEY, SLICE)
        .agg(F.sum("_value").alias("_total"))
        .select(KEY, SLICE, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_carry"))
    )
    return (
        marked.withColumn("_local", F.sum("_value").over(upto))
        .join(carry, [KEY, SLICE])
        .select(*ticks.columns, (F.col("_carry") + F.col("_local")).alias(out))
    )

"""Exact quantiles per group without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bins per e-fold of the value.
RESOLUTION = 256


def grouped_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], discrete: bool = False
) -> DataFrame:
    """One row per group with the asked quantiles of ``value``, NULLs ignored.

    Continuous quantiles interpolate between neighbours, discrete ones are the first value whose share of smaller or
    equal values reaches the level. Equal values are counted together; counts per logarithmic bin locate the bins
    that hold the wanted positions; only the values of those bins are ordered. The ordering windows therefore run over
    a group's bins (bounded by the range of doubles) and over single bins, never over a whole group.
    """
    values = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bin", _bin(F.col("_v")))
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = (
        values.groupBy(*keys, "_bin")
        .agg(F.sum("_n").alias("_in_bin"))
        .withColumn("_before", F.sum("_in_bin").over(upto) - F.col("_in_bin"))
        .withColumn("_all", F.sum("_in_bin").over(group))
    )
    ranks = {name: _ranks(F.col("_all"), p, discrete) for name, p in quantiles.items()}

    def holds(rank: Column, start: Column, size: Column) -> Column:
        return (rank >= start) & (rank < start + size)

    wanted = F.lit(False)
    for low, high, _ in ranks.values():
        for rank in (low, high):
            wanted = wanted | holds(rank, F.col("_before"), F.col("_in_bin"))
    inside = (
        Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = (
        values.join(bins.filter(wanted), [*keys, "_bin"])
        .withColumn("_start", F.col("_before") + F.sum("_n").over(inside) - F.col("_n"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(holds(rank, F.col("_start"), F.col("_n")), F.col("_v")))

    out = placed.groupBy(*keys, "_all").agg(
        *[at(low).alias(f"_{name}_low") for name, (low, _, _) in ranks.items()],
        *[at(high).alias(f"_{name}_high") for name, (_, high, _) in ranks.items()],
    )
    return out.select(
        *keys,
        *[
            (
                F.col(f"_{name}_low")
                + (F.col(f"_{name}_high") - F.col(f"_{name}_low")) * part
            ).alias(name)
            for name, (_, _, part) in ranks.items()
        ],
    )


def _bin(v: Column) -> Column:
    """Number of a value's bin, ascending with the value: equal steps of ln |v|, so small values have bins, too."""
    # |v| is between e**-745 and e**710, so steps above 0 are positive, those of negative values are their mirror.
    step = F.floor(F.log(F.abs(v)) * F.lit(RESOLUTION)) + F.lit(750 * RESOLUTION)
    return F.when(v == 0, F.lit(0)).when(v > 0, step).otherwise(-step)


def _ranks(n: Column, p: float, discrete: bool) -> tuple[Column, Column, Column]:
    """Zero-based positions below and above a quantile, and the part of the way between them."""
    if discrete:
        rank = F.greatest(F.ceil(n * F.lit(p)) - 1, F.lit(0))
        return rank, rank, F.lit(0.0)
    position = (n - 1) * F.lit(p)
    return F.floor(position), F.ceil(position), position - F.floor(position)

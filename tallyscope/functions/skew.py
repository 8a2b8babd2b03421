"""Joins on keys of which a few may hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy with more than this part of a side's rows, so there are fewer heavy keys than this.
PARTS = 1000


def heavy_keys(rows: DataFrame, on: Sequence[str], least: int = 10_000, parts: int = PARTS) -> DataFrame:
    """(key, _parts): keys with more than ``least`` rows and more than 1 / ``parts`` of all, and over how many parts to
    deal their rows so that a part has no more than that. No more than ``parts`` rows, whatever the input."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.greatest(F.lit(least), F.ceil(F.sum("_n") / parts)).alias("most")).scalar()
    return counts.filter(F.col("_n") > total).select(*on, F.ceil(F.col("_n") / total).cast("int").alias("_parts"))


def split_join(left: DataFrame, right: DataFrame, on: Sequence[str] | str, least: int = 10_000, parts: int = PARTS) -> DataFrame:
    """Inner join in which the left rows of a heavy key are dealt over many tasks.

    Each meets the right rows of the key, which are repeated for every part; all other keys are joined as they are. Left
    rows are dealt by a checksum of all their columns, so a lost task finds the same ones again.
    """
    on = [on] if isinstance(on, str) else list(on)
    heavy = F.broadcast(heavy_keys(left, on, least, parts))
    whole = F.coalesce("_parts", F.lit(1))
    dealt = left.join(heavy, on, "left").withColumn("_part", F.pmod(F.xxhash64(*left.columns), whole).cast("int")).drop("_parts")
    repeated = right.join(heavy, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), whole - 1))).drop("_parts")
    return dealt.join(repeated, [*on, "_part"]).drop("_part")

"""Pieces shared by the corpus operators."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """A text column, null counting as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def fold(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n: a fold that depends on the key alone. A null key counts as the text ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def spread(key: Column) -> Column:
    """A pseudo-random text by which rows are ordered or drawn, the same on every run and in every SQL engine."""
    return F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lengths(texts: pa.Array) -> list[int]:
    """Code points of an Arrow array of texts, none of them null, told without making Python's strings of them all."""
    return pc.utf8_length(texts).to_pylist()


def slices(sizes: list[int], most: int):
    """Cut a list into runs (from, to) of a summed size of at most ``most``; a larger item is a run of its own."""
    lo, total = 0, 0
    for k, size in enumerate(sizes):
        if k > lo and total + size > most:
            yield lo, k
            lo, total = k, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)

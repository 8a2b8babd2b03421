"""Reusable column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday names in calendar order, Sunday first.
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri")

NULL_TOKEN = "\x00"
KEY_SEPARATOR = "\x1f"


def ratio(top, bottom) -> Column:
    """Division as double that yields NULL instead of failing when the denominator is zero."""
    return F.try_divide(_col(top).cast("double"), _col(bottom).cast("double"))


def w_avg(value, weight) -> Column:
    """Weighted mean aggregate. Weights of NULL values do not count."""
    v, w = _col(value), _col(weight)
    return ratio(F.sum(v * w), F.sum(F.when(v.isNotNull(), w)))


def binomial_mean(p, n) -> Column:
    """Mean of the posterior of a proportion under a uniform prior."""
    return (_col(p) * _col(n) + F.lit(1)) / (_col(n) + F.lit(2))


def dow_number(name) -> Column:
    """Weekday name to 1 (Sunday) .. 7; every other value, NULL included, is 7."""
    place = F.array_position(F.array(*map(F.lit, WEEKDAYS)), _col(name))
    return F.coalesce(F.nullif(place, F.lit(0)), F.lit(7)).cast("int")


def key_text(*columns) -> Column:
    """One text per combination of key values; NULLs count as a value of their own."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.concat_ws(KEY_SEPARATOR, *parts)


def hash_number(*columns) -> Column:
    """Reproducible 32-bit number of a key, the same in every engine that has md5."""
    text = F.concat_ws("|", *[_col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_fold(k: int, *columns) -> Column:
    return F.pmod(hash_number(*columns), F.lit(k)).cast("int")


def hash_uniform(*columns) -> Column:
    """Reproducible number in [0, 1)."""
    return hash_number(*columns).cast("double") / F.lit(4294967296.0)


def hash_order(*columns) -> Column:
    """Sort key of a reproducible shuffle."""
    return F.md5(F.concat_ws("|", *[_col(c).cast("string") for c in columns]))


def round_doubles(df: DataFrame, places: int = 12) -> DataFrame:
    """Round every double column far below any value of interest, so that the order of summation does not show."""
    return df.select(
        *[
            (F.round(F.col(name), places).alias(name) if kind in ("double", "float") else F.col(name))
            for name, kind in df.dtypes
        ]
    )


def fits_int(column) -> Column:
    """Aggregate: whether every whole number of a column fits into 32 bits."""
    lo, hi = F.min(column), F.max(column)
    return F.coalesce((lo >= -(2**31)) & (hi < 2**31), F.lit(True))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c

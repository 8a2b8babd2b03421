"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.exprs import _col


def add_date(df: DataFrame, year_n_digits: int = 4) -> DataFrame:
    """Build ``date`` (text, ISO) from year, month and day columns.

    Years of two digits belong to 2000 and after where four are wanted, and years of four lose the century where two are.
    """
    year = F.col("year").cast("int")
    digits = F.length(F.col("year").cast("string"))
    if year_n_digits == 4:
        full = F.when(digits == 2, F.lit(2000) + year).otherwise(year)
    else:
        full = F.when(digits == 4, F.pmod(year, F.lit(100))).otherwise(year)
    two = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")
    return df.withColumn("date", F.concat_ws("-", full.cast("string"), two("month"), two("day")))


def add_ymd(df: DataFrame, year_n_digits: int = 4) -> DataFrame:
    """Split ``date`` into zero-padded year, month and day text columns."""
    pattern = "yyyy" if year_n_digits == 4 else "yy"
    return (
        df.withColumn("year", F.date_format("date", pattern))
        .withColumn("month", F.date_format("date", "MM"))
        .withColumn("day", F.date_format("date", "dd"))
    )


def sunday_weeks_ago(day, n: int) -> Column:
    """The Sunday n weeks before the Sunday on or before ``day``."""
    d = _col(day)
    return F.date_sub(d, F.lit(7 * n - 1) + F.dayofweek(d))


def execution_dates(start, end, mode: str = "daily") -> Column:
    """Array of run dates between two date columns.

    Weekly runs begin on the first Sunday on or after the start; monthly runs must begin on the first of a month.
    """
    s, e = _col(start), _col(end)
    if mode == "daily":
        return F.when(s <= e, F.sequence(s, e, F.expr("interval 1 day"))).otherwise(_no_dates())
    if mode == "weekly":
        first = F.date_add(s, F.pmod(F.lit(8) - F.dayofweek(s), F.lit(7)))
        return F.when(first <= e, F.sequence(first, e, F.expr("interval 7 days"))).otherwise(_no_dates())
    if mode == "monthly":
        checked = F.when(F.dayofmonth(s) == 1, s).otherwise(
            F.raise_error(F.lit("monthly runs start on the first day of a month")).cast("date")
        )
        return F.when(checked <= e, F.sequence(checked, e, F.expr("interval 1 month"))).otherwise(_no_dates())
    raise ValueError(f"unknown mode {mode!r}")


def weekly_lookback(day, weeks: int, first_available: dt.date) -> Column:
    """Array of the last ``weeks`` Sundays before ``day``, never earlier than the first available week."""
    floor = F.lit(first_available + dt.timedelta(weeks=weeks)).cast("date")
    last = sunday_weeks_ago(F.greatest(_col(day), floor), 1)
    return F.sequence(F.date_sub(last, 7 * (weeks - 1)), last, F.expr("interval 7 days"))


def previous_month(day) -> Column:
    return F.add_months(_col(day), -1)


def days_in_month(day) -> Column:
    return F.dayofmonth(F.last_day(_col(day)))


def historic_months(month, start, lookback: int = 2) -> Column:
    """Sorted array of the ``lookback`` months before ``month``.

    Months before ``start`` are replaced by months after ``month``: with e such months, the e ones that
    begin lookback - e + 1 months later.
    """
    m, s = _col(month), _col(start)
    back = [F.add_months(m, -i) for i in range(1, lookback + 1)]
    early = sum((F.when(b < s, 1).otherwise(0) for b in back), F.lit(0))
    ahead = [
        F.when(F.lit(lookback) - early <= F.lit(i), F.add_months(m, i + 1)) for i in range(lookback)
    ]
    kept = [F.when(b >= s, b) for b in back]
    return F.array_sort(F.array_compact(F.array(*kept, *ahead)))


def _no_dates() -> Column:
    return F.array().cast("array<date>")


def zoned_times(time: Column) -> tuple[Column, Column]:
    """The instant that a time names, and the wall clock that it shows, both as timestamps.

    They differ for text with an offset (``2024-01-01T10:00:00.000+02:00``): the instant counts the offset, the wall clock
    is the text without it. Text without an offset, and timestamps, are both. Text that is no time is null.
    """
    instant = time.try_cast("timestamp")
    shown = F.regexp_extract(time.cast("string"), r"^\s*(\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(?:\.\d+)?)\s*(?:Z|[+-]\d\d:?\d\d)\s*$", 1)
    return instant, F.coalesce(F.when(instant.isNotNull(), shown.try_cast("timestamp")), instant)

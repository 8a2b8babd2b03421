"""Accuracy by size bucket, coverage, and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.exprs import ratio
from tallyscope.functions.quantile import grouped_quantiles

OVERALL = -1
CLOSE = 0.3


def paired_means(truth: DataFrame, estimates: DataFrame, min_truth: float) -> DataFrame:
    """Mean truth y and mean estimate yhat per (country, app) over the truth's days; absent estimates count 0."""
    day = ["date", "country", "app"]
    best = truth.groupBy(*day).agg(F.max("active_users").alias("_y"))
    return (
        best.join(estimates.select(*day, F.col("active_users").alias("_est")), day, "left")
        .groupBy("country", "app")
        .agg(
            F.avg("_y").alias("y"),
            F.avg(F.coalesce(F.col("_est").cast("double"), F.lit(0.0))).alias("yhat"),
            F.count(F.lit(1)).alias("n_days"),
        )
        .filter((F.col("yhat") > 0) & (F.col("y") >= min_truth))
    )


def bucketed_accuracy(
    pairs: DataFrame, extra: dict[str, tuple[str, str]] | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """Median error, share of errors below 0.3 and count, per country and size bucket (-1 for all sizes).

    ``pairs`` has country, y and yhat. ``extra`` maps more median-error columns to their (truth, estimate) columns.
    ``by`` adds grouping columns such as the date. Errors are compared as rows; medians come from grouped quantiles.
    """
    keys = [*by, "country", "bucket"]
    sizes = F.array(F.lit(OVERALL), F.floor(F.log10("y")).cast("int"))
    errors = {"mape": ("y", "yhat"), **(extra or {})}
    rows = pairs.withColumn("bucket", F.explode(sizes))
    for name, (true, est) in errors.items():
        rows = rows.withColumn(f"_{name}", ratio(F.abs(F.col(true) - F.col(est)), true))
    out = rows.groupBy(*keys).agg(
        F.avg((F.col("_mape") < CLOSE).cast("double")).alias("swacc"), F.count(F.lit(1)).alias("n_apps")
    )
    for name in errors:
        out = out.join(grouped_quantiles(rows, keys, f"_{name}", {name: 0.5}), keys)
    return out


def monthly_pairs(truth: DataFrame, monthly: DataFrame, daily_truth: DataFrame, min_truth: float) -> DataFrame:
    """Monthly truth and estimate with their ratios to mean daily users.

    Truth rows carry the stream they come from; daily truth is averaged per stream.
    """
    stream = ["app", "country", "stream_id"]
    daily = daily_truth.groupBy(*stream).agg(F.avg("active_users").alias("_avg_dau"))
    return (
        truth.select(*stream, F.col("active_users").alias("y"))
        .join(monthly.select("app", "country", F.col("active_users").alias("yhat"), "published_avg_dau"), ["app", "country"])
        .join(daily, stream)
        .filter((F.col("yhat") > 0) & (F.col("y") >= min_truth))
        .withColumn("ratio_y", ratio("y", "_avg_dau"))
        .withColumn("ratio_yhat", ratio("yhat", "published_avg_dau"))
    )


def monthly_accuracy(pairs: DataFrame) -> DataFrame:
    return bucketed_accuracy(pairs, {"mau_dau_ratio_mape": ("ratio_y", "ratio_yhat")})


def coverage(estimates: DataFrame, min_active_users: float = 10.0) -> DataFrame:
    """Apps per country whose mean over all days of the input reaches the minimum."""
    n_days = estimates.select("date").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        estimates.groupBy("country", "app")
        .agg(F.sum("active_users").alias("_sum"))
        .filter(ratio(F.col("_sum"), n_days) >= min_active_users)
        .groupBy("country")
        .agg(F.count("app").alias("coverage"))
    )


def coverage_of_day(calibrated: DataFrame, min_active_users: float = 10.0) -> DataFrame:
    """Apps per country with at least the minimum of absolute users."""
    return (
        calibrated.filter(F.col("dau_abs") >= min_active_users)
        .groupBy("country")
        .agg(F.count_distinct("app").alias("coverage"))
    )


def accuracy_rollup(daily: DataFrame) -> DataFrame:
    """Mean of daily metrics per (country, bucket), in that order."""
    return (
        daily.groupBy("country", "bucket")
        .agg(*[F.avg(c).alias(c) for c in ("mape", "swacc", "n_apps")])
        .orderBy("country", "bucket")
    )


def with_coverage(accuracy: DataFrame, covered: DataFrame) -> DataFrame:
    """Accuracy rows and coverage rows in one table."""
    return accuracy.unionByName(covered, allowMissingColumns=True)

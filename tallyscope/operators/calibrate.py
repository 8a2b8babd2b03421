"""Calibration of proportions to absolute users against ground truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.exprs import hash_fold, ratio
from tallyscope.functions.quantile import grouped_quantiles

FOLDS = 5
INNER_FOLDS = 3
CANDIDATES = 100


def calibration_rows(
    truth: DataFrame, estimates: DataFrame, min_truth: float, min_users: float
) -> DataFrame:
    """(country, app) with mean truth y, mean proportion x (absent days 0), and whether the row may be fitted.

    ``estimates`` has date, country, app, p and users.
    """
    daily = truth.groupBy("date", "country", "app").agg(F.max("active_users").alias("_y"))
    return (
        daily.join(
            estimates.select("date", "country", "app", F.col("p").alias("_p"), F.col("users").alias("_users")),
            ["date", "country", "app"], "left",
        )
        .groupBy("country", "app")
        .agg(
            F.avg("_y").alias("y"),
            F.avg(F.coalesce(F.col("_p"), F.lit(0.0))).alias("x"),
            F.avg("_users").alias("users"),
            F.count(F.lit(1)).alias("n_days"),
        )
        .filter((F.col("x") > 0) & (F.col("y") >= min_truth))
        .withColumn("fit", F.coalesce(F.col("users") >= min_users, F.lit(False)))
    )


def median_ratio(rows: DataFrame) -> DataFrame:
    """Median of y / x per country."""
    return grouped_quantiles(rows.withColumn("_r", ratio("y", "x")), ["country"], "_r", {"adj": 0.5})


def fold_scales(rows: DataFrame, folds: int = FOLDS, inner: int = INNER_FOLDS, candidates: int = CANDIDATES) -> DataFrame:
    """Scale of every (country, outer fold), fitted without the rows of that fold.

    Folds are hash buckets. Inside the training rows of an outer fold, each inner fold is held out in turn: candidates
    are spread evenly between the 20th and the 80th percentile of y / x of the other rows, and the one with the
    smallest median error on the held-out rows wins (the smaller candidate on ties). The scale is the winners' mean.
    Everything is rows and grouped quantiles, so the work spreads over (country, folds, candidate).
    """
    outer = F.sequence(F.lit(0), F.lit(folds - 1))
    mine = hash_fold(folds, F.lit("outer"), F.col("country"), F.col("app"))
    training = (
        rows.filter("fit")
        .withColumn("_mine", mine)
        .withColumn("fold", F.explode(outer))
        .filter(F.col("_mine") != F.col("fold"))
        .withColumn("_part", hash_fold(inner, F.lit("inner"), F.col("fold"), F.col("country"), F.col("app")))
    )
    fitted = training.withColumn("inner", F.explode(F.sequence(F.lit(0), F.lit(inner - 1)))).filter(
        F.col("_part") != F.col("inner")
    )
    keys = ["country", "fold", "inner"]
    ranges = grouped_quantiles(
        fitted.withColumn("_r", ratio("y", "x")), keys, "_r", {"low": 0.2, "high": 0.8}
    )
    step = F.col("at").cast("double") / F.lit(float(candidates - 1))
    tried = (
        training.withColumn("inner", F.col("_part"))
        .join(ranges, keys)
        .withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(candidates - 1))))
        .withColumn("candidate", F.col("low") + (F.col("high") - F.col("low")) * step)
        .withColumn("_error", F.abs(F.col("y") - F.col("x") * F.col("candidate")) / F.col("y"))
    )
    losses = grouped_quantiles(tried, [*keys, "at", "low", "high"], "_error", {"loss": 0.5})
    winners = losses.groupBy(*keys).agg(F.min(F.struct("loss", "at", "low", "high")).alias("_best"))
    best_at = F.col("_best.at").cast("double") / F.lit(float(candidates - 1))
    chosen = F.col("_best.low") + (F.col("_best.high") - F.col("_best.low")) * best_at
    return winners.withColumn("_chosen", chosen).groupBy("country", "fold").agg(F.avg("_chosen").alias("adj"))


def final_scale(scales: DataFrame) -> DataFrame:
    """Mean of the middle fold scales of a country (sorted, positions int(.2k) to int(.8k))."""
    ordered = F.sort_array(F.collect_list("adj"))
    return (
        scales.groupBy("country")
        .agg(ordered.alias("_all"))
        .withColumn("_from", F.floor(F.size("_all") * 0.2).cast("int"))
        .withColumn("_to", F.floor(F.size("_all") * 0.8).cast("int"))
        .withColumn("_middle", F.slice("_all", F.col("_from") + 1, F.col("_to") - F.col("_from")))
        .withColumn(
            "adj",
            F.try_divide(
                F.aggregate("_middle", F.lit(0.0), lambda a, b: a + b), F.size("_middle").cast("double")
            ),
        )
        .select("country", "adj")
    )


def held_out_predictions(rows: DataFrame, scales: DataFrame, folds: int = FOLDS) -> DataFrame:
    """y and the prediction from the fold that left the row out."""
    mine = hash_fold(folds, F.lit("outer"), F.col("country"), F.col("app"))
    return (
        rows.withColumn("fold", mine)
        .join(scales, ["country", "fold"])
        .select("country", "app", "y", (F.col("adj") * F.col("x")).alias("yhat"))
    )


def apply_calibration(daily: DataFrame, scale: DataFrame) -> DataFrame:
    """Absolute users: proportion times the country's scale."""
    return (
        daily.withColumnRenamed("dau", "dau_p")
        .join(scale, "country")
        .withColumn("dau_abs", F.col("adj") * F.col("dau_p"))
    )

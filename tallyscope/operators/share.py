"""Second signal: the other platform's usage times the expected share of this one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.exprs import dow_number, ratio


def apps_with_category(matching: DataFrame, bundles: DataFrame, categories: DataFrame) -> DataFrame:
    """Matched app pairs with the commonest category of the app; equal counts go to the first in order."""
    counted = categories.groupBy("app_ios", "category").agg(F.count(F.lit(1)).alias("_n"))
    top = counted.filter(F.col("category").isNotNull()).groupBy("app_ios").agg(
        F.min(F.struct((-F.col("_n")).alias("n"), "category")).getField("category").alias("category")
    )
    ids = bundles.select("id", F.col("bundle_id").alias("app_ios")).distinct()
    pairs = matching.select(F.col("android_id").alias("app_android"), F.col("ios_id").alias("id")).distinct()
    return ids.join(pairs, "id").join(top, "app_ios", "left").select("app_android", "app_ios", "category").distinct()


def country_prior(priors: DataFrame) -> DataFrame:
    return priors.groupBy("country").agg(F.avg("country_ratio").alias("country_ratio"))


def category_prior(priors: DataFrame) -> DataFrame:
    """Mean share of the category in the country, or of its neighbours where the country has none."""
    return priors.groupBy("country", "category").agg(
        F.coalesce(F.avg("category_country_ratio"), F.avg("neighbour_category_country_ratio")).alias(
            "category_country_ratio"
        )
    )


def share_ratio_v1(
    apps: DataFrame, app_priors: DataFrame, country_priors: DataFrame, category_priors: DataFrame
) -> DataFrame:
    """Share per (pair, country, weekday) row of the app priors: own, else country, else category."""
    own = app_priors.select("app_android", "app_ios", "country", dow_number("dow").alias("dow"), "ios_ratio")
    return (
        apps.join(own, ["app_ios", "app_android"], "left")
        .join(country_prior(country_priors), "country", "left")
        .join(category_prior(category_priors), ["country", "category"], "left")
        .select(
            "app_android",
            "app_ios",
            "country",
            "dow",
            F.coalesce("ios_ratio", "country_ratio", "category_country_ratio").alias("ratio"),
        )
    )


def share_ratio_v2(
    apps: DataFrame, app_priors: DataFrame, country_priors: DataFrame, category_priors: DataFrame
) -> DataFrame:
    """Share per (pair, country, weekday) for every country: own (from any country), else category, else country.

    Own priors are averaged per (pair, weekday) before the countries are attached. A mean over categories of a pair
    would count each prior once per category, which leaves the mean of own priors unchanged.
    """
    own = app_priors.groupBy("app_android", "app_ios", dow_number("dow").alias("dow")).agg(
        F.avg("ios_ratio").alias("ios_ratio")
    )
    countries = country_prior(country_priors).agg(F.collect_list(F.struct("country", "country_ratio")).alias("all"))
    per_country = apps.join(own, ["app_ios", "app_android"], "left").select("*", F.inline(countries.scalar()))
    return (
        per_country.join(category_prior(category_priors), ["country", "category"], "left")
        .groupBy("app_android", "app_ios", "country", "dow")
        .agg(
            F.coalesce(F.avg("ios_ratio"), F.avg("category_country_ratio"), F.avg("country_ratio")).alias("ratio")
        )
    )


def share_reach(usage: DataFrame, population: DataFrame, ratios: DataFrame) -> DataFrame:
    """Reach of the second platform times the share of the pair on that weekday, per (date, country, app)."""
    p = (
        usage.join(population, "country")
        .withColumn("_p", ratio("active_users", "population_size"))
        .withColumn("dow", F.dayofweek("date"))
        .select("date", "country", F.col("android_id").alias("app_android"), "dow", "_p")
    )
    return p.join(ratios, ["app_android", "country", "dow"]).select(
        "date", "country", F.col("app_ios").alias("app"), "ratio", (F.col("_p") * F.col("ratio")).alias("p")
    )

"""Association measures and learning sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.contracts import require
from tallyscope.functions.exprs import ratio


def phi(pxy: Column, px: Column, py: Column) -> Column:
    """Correlation of two presence indicators; NULL when one of them is constant."""
    spread = F.sqrt(px * (1 - px)) * F.sqrt(py * (1 - py))
    return F.try_divide(pxy - px * py, spread)


def correlate(df: DataFrame, x: str, y: str, units: list[str]) -> DataFrame:
    """Phi coefficient of x and y over distinct units: x, y, N, px, py, pxy, correlation.

    The input is first reduced to distinct (x, y, unit) rows, so every later count works on the smaller set, and
    the number of units is a scalar subquery instead of a driver-side count.
    """
    require(df, x, y, *units)
    seen = df.select(x, y, *units).distinct()
    n_units = seen.select(*units).distinct().agg(F.count(F.lit(1)).alias("n"))
    nx = seen.groupBy(x).agg(F.count_distinct(*units).alias("_x"))
    ny = seen.groupBy(y).agg(F.count_distinct(*units).alias("_y"))
    nxy = seen.filter(_all_present(units)).groupBy(x, y).agg(F.count(F.lit(1)).alias("_xy"))
    n = F.col("N")
    return (
        nxy.join(nx, x)
        .join(ny, y)
        .withColumn("N", n_units.scalar())
        .select(x, y, "N", ratio("_x", n).alias("px"), ratio("_y", n).alias("py"), ratio("_xy", n).alias("pxy"))
        .withColumn("correlation", phi(F.col("pxy"), F.col("px"), F.col("py")))
    )


def _all_present(columns: list[str]) -> Column:
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return present


def match_entities(matching: DataFrame, bundles: DataFrame) -> DataFrame:
    """Pairs (android_id, bundle_id) of accepted store matches."""
    ids = bundles.select("bundle_id", F.col("id").alias("ios_id")).distinct()
    accepted = matching.filter(F.col("label") == 1).select("android_id", "ios_id").distinct()
    return ids.join(accepted, "ios_id").select("android_id", "bundle_id")


def learning_log(log: DataFrame, blacklist: list[str]) -> DataFrame:
    """Usable rows of the field log, under the names the models use."""
    usable = (
        F.col("bundle_id").isNotNull()
        & F.col("domain").isNotNull()
        & (F.col("domain_classification") != "2.0")
        & (F.col("context_verification_type") == "0.0")
    )
    return log.filter(usable & ~F.col("bundle_id").isin(blacklist)).select(
        F.col("bundle_id").alias("app"),
        F.col("domain").alias("host"),
        "hits",
        F.col("user_id").alias("did"),
        "first_time_stamp",
        "timestamp",
        "date",
        "country",
    )


def trusted_apps(log: DataFrame, check_hosts: list[str], min_users: int) -> DataFrame:
    """Rows of apps with enough devices that were not seen with two or more check hosts.

    The verdict is made on per-app counts; the log itself meets only the short list of accepted apps.
    """
    devices = log.groupBy("app").agg(F.count_distinct("did").alias("_devices"))
    checks = log.filter(F.col("host").isin(check_hosts)).groupBy("app").agg(F.count_distinct("host").alias("_checks"))
    untrusted = checks.filter((F.col("_checks") >= 2) & ~F.col("app").like("%com.apple%"))
    enough = devices.filter(F.col("_devices") >= min_users)
    accepted = enough.select("app").join(untrusted.select("app"), "app", "left_anti")
    return log.join(accepted, "app", "left_semi")


def lab_learning_set(lab: DataFrame) -> DataFrame:
    """(app, host) pairs of the lab log; hits counts the versions that showed the pair."""
    return (
        lab.select(F.col("bundle_id").alias("app"), "bundle_version", "host")
        .filter((F.col("host") != "") & ~F.col("app").like("%com.apple%"))
        .distinct()
        .groupBy("app", "host")
        .agg(F.count(F.lit(1)).alias("hits"))
    )


def learning_set(field: DataFrame, lab: DataFrame, collectors: list[str], remove_vendor: bool = False) -> DataFrame:
    """Field and lab pairs merged: summed hits, and whether any lab run saw the pair.

    ``collectors`` are the apps that collect the data; they would be seen with every host and are left out.
    """
    both = field.select("app", "host", "hits", F.lit(False).alias("is_lab")).unionByName(
        lab.select("app", "host", "hits", F.lit(True).alias("is_lab"))
    )
    kept = both.filter(~F.col("app").isin(*collectors)) if collectors else both
    if remove_vendor:
        kept = kept.filter(~F.col("host").like("%apple%") & ~F.col("host").like("%icloud%"))
    return kept.groupBy("app", "host").agg(F.sum("hits").alias("hits"), F.max("is_lab").alias("is_lab"))

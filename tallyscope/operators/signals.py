"""Data behind the visual checks: selection of apps, joined and rescaled signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.functions.exprs import hash_order, ratio
from tallyscope.sources.tables import union_all

DAY = ["date", "country", "app"]


def mean_users(daily: DataFrame, column: str = "active_users") -> DataFrame:
    return daily.groupBy("country", "app").agg(F.avg(column).alias("active_users"))


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, split_by: list[str]) -> DataFrame:
    """First k rows of each group, with their ``rank``.

    Groups can be large, so every group is first cut into parts by a hash, the first k of each part are kept, and only
    those are ranked together.
    """
    part = F.pmod(F.xxhash64(*split_by), F.lit(64))
    first = Window.partitionBy(*group, "_part").orderBy(*order)
    final = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_part", part)
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= k)
        .drop("_part", "_rank")
        .withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= k)
    )


def stratified_sample(daily: DataFrame, k: int) -> DataFrame:
    """Up to k apps per (country, size bucket), in a reproducible random order. A bucket is round(log10(mean users))."""
    sized = mean_users(daily).withColumn("bucket_size", F.round(F.log10("active_users")).cast("int"))
    order = [hash_order("country", "app"), F.col("app")]
    return top_per_group(sized, ["country", "bucket_size"], order, k, ["app"])


def top_by_size(daily: DataFrame, k: int, ascending: bool = False) -> DataFrame:
    """The k largest (or smallest) apps of each country by mean users."""
    means = daily.filter(F.col("active_users") >= 0).groupBy("country", "app").agg(
        F.count("date").alias("n_days"), F.avg("active_users").alias("avg_active_users")
    )
    size = F.col("avg_active_users")
    return top_per_group(means, ["country"], [size.asc() if ascending else size.desc(), F.col("app")], k, ["app"])


def chart_selection(ranks: DataFrame, bundles: DataFrame, max_rank: int = 7) -> DataFrame:
    """Apps high in the free chart, under their bundle ids."""
    top = ranks.filter(
        (F.col("mode") == "topselling_free") & (F.col("device_type") == "iphone") & (F.col("rank") <= max_rank)
    )
    return top.join(bundles.select("id", "bundle_id").distinct(), "id").select(
        "country", F.col("bundle_id").alias("app")
    )


def select_apps(lists: list[DataFrame], pinned: list[str], vip: DataFrame) -> DataFrame:
    """All selected (country, app), VIP where any list says so. Pinned apps enter in every country of the first list."""
    everywhere = lists[0].select("country").distinct().select(
        "country", F.explode(F.array(*[F.lit(a) for a in pinned]) if pinned else F.array().cast("array<string>")).alias("app")
    )
    plain = [df.select("country", "app").withColumn("is_vip", F.lit(False)) for df in (*lists, everywhere)]
    marked = vip.select("country", "app").withColumn("is_vip", F.lit(True))
    return union_all([*plain, marked]).groupBy("country", "app").agg(F.max("is_vip").alias("is_vip"))


def join_signals(signals: dict[str, DataFrame]) -> DataFrame:
    """Daily signals side by side; each input has one row per date, country and app, and the column it is named after.

    Stacking the signals and taking the one value per key is a full outer join of all of them with a single shuffle.
    """
    stacked = union_all((df.select(*DAY, name) for name, df in signals.items()), allow_missing=True)
    return stacked.groupBy(*DAY).agg(*[F.max(name).alias(name) for name in signals])


def stage_signals(raw: DataFrame, established: DataFrame, applied: DataFrame) -> DataFrame:
    """p of the raw, scaled and trend stages per day, with the raw evidence k and n; absent p is 0."""
    shown = raw.select(*DAY, F.col("p").alias("raw_p"), (F.col("p") * F.col("n")).alias("k"), "n")
    scaled = established.select(*DAY, F.col("p").alias("established_scale_p"))
    trend = applied.select(*DAY, F.col("p").alias("tss_p"))
    return (
        shown.join(scaled, DAY, "full_outer")
        .join(trend, DAY, "full_outer")
        .fillna(0, subset=["raw_p", "tss_p", "established_scale_p"])
    )


def rescale_signals(daily: DataFrame, base: str, others: list[str], points: int = 14) -> DataFrame:
    """Signals of every (country, app) on a common scale.

    The base is divided by its mean over the first ``points`` days. Every other signal is multiplied by the mean ratio of
    rescaled base to signal over their first ``points`` common days, where both are positive; without such days it stays.
    """
    key = Window.partitionBy("country", "app")
    in_order = key.orderBy("date")
    out = daily.withColumn("_at", F.row_number().over(in_order)).withColumn(
        "_mean", F.avg(F.when(F.col("_at") <= points, F.col(base))).over(key)
    )
    out = out.withColumn(base, ratio(base, "_mean"))
    for name in others:
        common = (F.col(name) > 0) & (F.col(base) > 0)
        before = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = (
            out.withColumn("_common", F.sum(F.when(common, 1).otherwise(0)).over(before))
            .withColumn("_used", F.when(common & (F.col("_common") <= points), ratio(base, name)))
            .withColumn("_factor", F.avg("_used").over(key))
            .withColumn(name, F.col(name) * F.coalesce(F.col("_factor"), F.lit(1.0)))
        )
    return out.select(*daily.columns)


def panel_size(estimates: DataFrame) -> DataFrame:
    return estimates.groupBy("date", "country").agg(F.max("n").alias("n"))


def live_signals(signals: DataFrame, staged: DataFrame) -> DataFrame:
    """Signals of apps that also have stage signals."""
    return signals.join(staged.select("country", "app").distinct(), ["country", "app"], "left_semi")


def app_ordering(signals: DataFrame, column: str = "active_users") -> DataFrame:
    """Apps of each country by falling mean size, with the number of values."""
    return (
        signals.groupBy("country", "app")
        .agg(F.avg(column).alias("active_users"), F.count(column).alias("count"))
        .orderBy("country", F.col("active_users").desc_nulls_last(), "app")
    )

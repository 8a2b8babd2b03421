"""Confidence-weighted posterior model."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.contracts import require
from tallyscope.functions.exprs import ratio
from tallyscope.functions.lineage import cut_lineage

MIN_SHARE = 0.001
TYPICAL_APPS = 4
SESSION = ["country", "did", "session_id"]
#: Rows (session, app, host) that one task orders.
ROWS_PER_TASK = 250_000


def posterior_params(ls: DataFrame, min_share: float = MIN_SHARE, distinct_apps: bool = False) -> DataFrame:
    """Confidence-weighted hits of every (app, host) and of the host as a whole.

    A host seen with n apps has confidence 1 / (1 + (n/4)^4). n counts the rows of the host; with ``distinct_apps``
    each app counts once.
    """
    require(ls, "app", "host", "hits")
    pairs = ls.groupBy("app", "host").agg(F.sum("hits").alias("_hits"), F.count("app").alias("_rows"))
    n = F.count("app") if distinct_apps else F.sum("_rows")
    hosts = (
        pairs.groupBy("host")
        .agg(F.sum("_hits").alias("_all"), n.alias("_n"))
        .withColumn("_confidence", F.lit(1.0) / (F.lit(1.0) + F.pow(F.col("_n") / F.lit(TYPICAL_APPS), F.lit(4.0))))
    )
    return (
        pairs.join(hosts, "host")
        .withColumn("total_host_portion", F.col("_confidence") * F.col("_all"))
        .withColumn("host_portion_per_bundle", F.col("_confidence") * F.col("_hits"))
        .filter(ratio("host_portion_per_bundle", "total_host_portion") > min_share)
        .select("app", "host", "total_host_portion", "host_portion_per_bundle")
    )


def session_pairs(sessions: DataFrame, params: DataFrame) -> DataFrame:
    """Distinct (session, app, host) with the host's portions and the mean event time of the session.

    A host weighs as many times as it has apps. Rows are dealt by session over as many tasks as they need, at
    ``ROWS_PER_TASK`` each: a few bytes a row when shuffled, they take much more when ordered.
    """
    known = params.select("host", "app", "total_host_portion", "host_portion_per_bundle")
    hosts = (
        sessions.dropna(subset=SESSION)
        .groupBy(*SESSION, "host")
        .agg(F.count(F.lit(1)).alias("_events"), F.sum("ts").alias("_ts"))
        .join(known.groupBy("host").agg(F.count(F.lit(1)).alias("_apps")), "host")
    )
    whole = Window.partitionBy(*SESSION)
    time = ratio(F.sum(F.col("_ts") * F.col("_apps")).over(whole), F.sum(F.col("_events") * F.col("_apps")).over(whole))
    timed = cut_lineage(hosts.select(*SESSION, "host", "_apps", time.alias("avg_session")))
    rows = timed.agg(F.coalesce(F.sum("_apps"), F.lit(0)).alias("n")).first()["n"]
    return (
        timed.join(known, "host")
        .repartition(max(1, ceil(rows / ROWS_PER_TASK)), *SESSION)
        .select(*SESSION, "host", "app", "total_host_portion", "host_portion_per_bundle", "avg_session")
    )


def _pooled(own: Column, total: Column, best: Column) -> Column:
    return F.greatest(F.try_divide(own, total), best)


def posterior_scores(sessions: DataFrame, params: DataFrame) -> DataFrame:
    """Posterior of every (session, app) three ways, and the largest as score.

    ``posterior`` pools all hosts of the pair, ``posterior3`` and ``posterior5`` pool the row frame of one or two
    neighbours around the first host in host order, that is the first two or three hosts. All three are conditional
    sums of a single aggregation over hosts numbered within (session, app).
    """
    at = F.row_number().over(Window.partitionBy(*SESSION, "app").orderBy("host"))
    own, total = F.col("host_portion_per_bundle"), F.col("total_host_portion")
    share = F.try_divide(own, total)

    def pooled(first: int | None) -> Column:
        keep = (lambda c: c) if first is None else (lambda c: F.when(F.col("_at") <= first, c))
        return _pooled(F.sum(keep(own)), F.sum(keep(total)), F.max(keep(share)))

    return (
        session_pairs(sessions, params)
        .withColumn("_at", at)
        .groupBy(*SESSION, "app", "avg_session")
        .agg(
            pooled(None).alias("posterior"),
            pooled(2).alias("posterior3"),
            pooled(3).alias("posterior5"),
        )
        .withColumn("score", F.greatest("posterior", "posterior3", "posterior5"))
    )


def session_posterior(sessions: DataFrame, params: DataFrame) -> DataFrame:
    """Pooled posterior of every (session, app) and its rank in the session."""
    best_first = Window.partitionBy(*SESSION).orderBy(F.col("posterior").desc(), F.col("app"))
    own, total = F.col("host_portion_per_bundle"), F.col("total_host_portion")
    return (
        session_pairs(sessions, params)
        .groupBy(*SESSION, "app", "avg_session")
        .agg(
            F.sum(own).alias("expected_hits_given_bundle"),
            F.sum(total).alias("expected_total_hits"),
            F.max(F.try_divide(own, total)).alias("max_single"),
        )
        .withColumn(
            "posterior",
            _pooled(F.col("expected_hits_given_bundle"), F.col("expected_total_hits"), F.col("max_single")),
        )
        .withColumn("order_in_session", F.row_number().over(best_first))
    )


def _around(reach: int) -> Column:
    """Posterior over ``reach`` neighbours on each side of a host, hosts of a (session, app) in host order."""
    around = Window.partitionBy(*SESSION, "app").orderBy("avg_session", "host").rowsBetween(-reach, reach)
    own, total = F.col("host_portion_per_bundle"), F.col("total_host_portion")
    return _pooled(F.sum(own).over(around), F.sum(total).over(around), F.max(F.try_divide(own, total)).over(around))


def windowed_posterior(sessions: DataFrame, params: DataFrame, reach: int) -> DataFrame:
    """Posterior over ``reach`` neighbours on each side of every host, hosts of a (session, app) in host order."""
    return session_pairs(sessions, params).withColumn("posterior", _around(reach))


def first_frame_posteriors(sessions: DataFrame, params: DataFrame, reaches: tuple[int, ...]) -> DataFrame:
    """The windowed posterior at the first host of every (session, app), one row per reach; pairs are ordered once for all."""
    frames = session_pairs(sessions, params).withColumns({f"_{n}": _around(n) for n in reaches})
    first = frames.groupBy(*SESSION, "app", "avg_session").agg(*[F.min_by(f"_{n}", "host").alias(f"_{n}") for n in reaches])
    rows = F.inline(F.array(*[F.struct(F.lit(n).alias("reach"), F.col(f"_{n}").alias("posterior")) for n in reaches]))
    return first.select(*SESSION, "app", "avg_session", rows)


def first_frame_posterior(sessions: DataFrame, params: DataFrame, reach: int) -> DataFrame:
    """The windowed posterior at the first host of every (session, app)."""
    return first_frame_posteriors(sessions, params, (reach,)).drop("reach")

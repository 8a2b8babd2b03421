"""Host graph: correlations, cliques, candidate features and session matching."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyscope.contracts import require
from tallyscope.functions.exprs import ratio
from tallyscope.functions.lineage import cut_lineage
from tallyscope.functions.skew import split_join
from tallyscope.functions.urls import domain_label, url_host, with_domain
from tallyscope.operators.assoc import correlate, phi
from tallyscope.operators.sessions import sessionize
from tallyscope.sources.tables import as_date, finished_dates, mark_finished, union_all

PAIR = ["bundle_id", "clique_id"]
FEATURES = [
    "bundles", "hosts", "domains",
    "app_info_hosts_Y", "app_info_hosts_score", "app_info_domains_Y", "app_info_domains_score",
    "panel_hosts_Y", "panel_hosts_score", "panel_domains_Y", "panel_domains_score",
    "max_corr", "match_bundle", "match_publisher", "match_app_name",
]
# Pairs of a host set are made in blocks of this many hosts per task key.
BLOCK = 128
# Triangles that Python lists cliques of in one call (those of one first vertex, if it has more).
TRIANGLES = 10_000


def host_bundle_correlation(
    lab: DataFrame, suffixes: DataFrame, min_corr: float, gap: int = 600
) -> DataFrame:
    """Correlation of hosts and bundles over lab sessions, above a minimum, with the host's domain.

    ``lab`` has device_id, ts (epoch seconds), bundle_id and host.
    """
    usable = (
        ~F.col("host").like("%.apple.com") & (F.col("bundle_id") != "UserEventAgent")
        & F.col("host").isNotNull() & (F.col("host") != "")
    )
    sessions = sessionize(lab.filter(usable), ["device_id", "bundle_id"], gap)
    kept = correlate(sessions, "host", "bundle_id", ["session_id"]).filter(F.col("correlation") > min_corr)
    return with_domain(kept, suffixes)


def validated_app_hosts(app_info: DataFrame, suffixes: DataFrame, min_length: int = 5) -> DataFrame:
    """Hosts of an app's publisher and privacy pages whose domain label occurs in its names."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    names = app_info.select(
        "bundle_id",
        F.lower(F.replace(text("publisher_name"), F.lit(" "), F.lit(""))).alias("_publisher"),
        text("app_name").alias("_app"),
        F.lower("bundle_id").alias("_bundle"),
        F.explode(F.array(text("publisher_url"), text("privacy_url"))).alias("_url"),
    )
    hosts = names.withColumn("host", url_host("_url")).filter(F.length("host") >= min_length)
    label = domain_label("domain")
    named = F.col("_publisher").contains(label) | F.col("_app").contains(label) | F.col("_bundle").contains(label)
    return with_domain(hosts, suffixes).filter(named).select("bundle_id", "host", "domain").distinct()


def host_correlation(
    panel: DataFrame, min_host_count: int, min_corr: float = 0.1, cut: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """Correlation of hosts over the sessions they share, for hosts in more than ``min_host_count`` sessions.

    Sessions with the same hosts are counted together first, so pairs are made once per distinct host set. Correlation
    cannot exceed the square root of the smaller over the larger odds of the two hosts, so only hosts whose odds lie
    within that range of each other are paired: hosts are put in bands of that width and met in their own and the next
    band. Long sets are cut into blocks, so a set is spread over many keys. Each pair is made once and mirrored at the end.

    N counts the sessions with a pair of different hosts, as the pairs are the observations.
    """
    seen = panel.select("session_id", "host").distinct()
    frequent = seen.groupBy("host").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > min_host_count)
    kept = seen.join(frequent.select("host"), "host")
    # A session's host set is known by its size and two independent 64-bit hashes that do not depend on order.
    sets = (
        kept.groupBy("session_id")
        .agg(
            F.count(F.lit(1)).alias("_size"),
            F.bit_xor(F.xxhash64("host")).alias("_one"),
            F.bit_xor(F.xxhash64(F.lit("second"), "host")).alias("_two"),
        )
        .filter(F.col("_size") > 1)
        .groupBy("_size", "_one", "_two")
        .agg(F.min("session_id").alias("session_id"), F.count(F.lit(1)).alias("_times"))
    )
    # One row per host of a distinct set: written out, because counts, both sides of the pairs and N read it.
    members = cut(kept.join(sets.select("session_id", "_size", "_times"), "session_id"))
    total = members.select("session_id", "_times").distinct().agg(F.sum("_times").alias("n")).scalar()
    counts = members.groupBy("host").agg(F.sum("_times").alias("_count"))
    # Width of a band in log odds: pairs further apart stay below min_corr.
    width = F.lit(-2.0) * F.log(F.lit(min_corr))
    odds = F.try_divide(F.col("_count").cast("double"), (total - F.col("_count")).cast("double"))
    banded = counts.select("host", F.floor(F.log(odds) / width).alias("_band")).filter(F.col("_band").isNotNull())
    entries = members.join(banded, "host")
    blocks = F.ceil(F.col("_size") / F.lit(BLOCK)).cast("int")
    left = entries.select(
        "session_id", "_times", "host", F.pmod(F.xxhash64("host"), blocks).cast("int").alias("_block"),
        F.explode(F.array(F.col("_band") - 1, F.col("_band"), F.col("_band") + 1)).alias("_band"),
    )
    right = entries.select(
        "session_id", F.col("host").alias("target"), "_band",
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_block"),
    )
    pairs = (
        left.join(right, ["session_id", "_band", "_block"])
        .filter(F.col("host") < F.col("target"))
        .groupBy("host", "target")
        .agg(F.sum("_times").alias("_xy"))
    )
    n = F.col("N")
    half = (
        pairs.join(counts.select("host", F.col("_count").alias("_x")), "host")
        .join(counts.select(F.col("host").alias("target"), F.col("_count").alias("_y")), "target")
        .withColumn("N", total)
        .select(
            "host", "target", "N",
            ratio("_x", n).alias("px"), ratio("_y", n).alias("py"), ratio("_xy", n).alias("pxy"),
        )
        .withColumn("correlation", phi(F.col("pxy"), F.col("px"), F.col("py")))
        .filter(F.col("correlation") > min_corr)
    )
    mirrored = half.select(
        F.col("target").alias("host"), F.col("host").alias("target"), "N",
        F.col("py").alias("px"), F.col("px").alias("py"), "pxy", "correlation",
    )
    return half.unionByName(mirrored)


def remove_hubs(correlations: DataFrame, suffixes: DataFrame, max_domains: int, min_corr: float = 0.3) -> DataFrame:
    """Each pair once, without hosts that correlate with targets of too many domains."""
    targets = with_domain(correlations.filter(F.col("correlation") > min_corr), suffixes, "target", "_domain")
    hubs = (
        targets.groupBy("host")
        .agg(F.count_distinct("_domain").alias("_domains"))
        .filter(F.col("_domains") > max_domains)
        .select("host")
    )
    return (
        correlations.filter(F.col("host") < F.col("target"))
        .join(hubs, "host", "left_anti")
        .join(hubs.withColumnRenamed("host", "target"), "target", "left_anti")
        .select(*correlations.columns)
    )


def clique_id(members: Column) -> Column:
    return F.md5(F.array_join(members, ""))


def maximal_cliques(
    edges: DataFrame, min_corr: float = 0.3, cut: Callable[[DataFrame], DataFrame] = cut_lineage
) -> DataFrame:
    """Maximal cliques of three or more hosts of the graph of edges above ``min_corr``.

    Vertices are ordered by degree, then name, and edges point to the later end; then no vertex has more than
    sqrt(2 * edges) later neighbours, hubs included. Every triangle is found once by joining edges. A clique is listed
    by the task of its first vertex, which needs the triangles of that vertex only; first vertices share a call by hash, as
    most have a few triangles, less work than a call. What a task lists is maximal among
    later vertices; a join with the triangles then drops cliques that an earlier vertex extends. Triangles and lists are
    written out, as both are read twice.
    """
    require(edges, "host", "target", "correlation")
    strong = edges.filter((F.col("correlation") > min_corr) & (F.col("host") != F.col("target")))
    links = strong.select(F.least("host", "target").alias("a"), F.greatest("host", "target").alias("b")).distinct()
    ends = links.select("a").unionByName(links.select(F.col("b").alias("a")))
    degree = ends.groupBy("a").agg(F.count(F.lit(1)).alias("_degree"))
    ranked = links.join(degree.withColumnRenamed("_degree", "_da"), "a").join(
        degree.select(F.col("a").alias("b"), F.col("_degree").alias("_db")), "b"
    )
    a_first = (F.col("_da") < F.col("_db")) | ((F.col("_da") == F.col("_db")) & (F.col("a") < F.col("b")))
    arcs = ranked.select(
        F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("u"),
        F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("v"),
    )
    triangles = cut(
        arcs.join(arcs.select(F.col("u").alias("v"), F.col("v").alias("w")), "v")
        .join(arcs.select("u", F.col("v").alias("w")), ["u", "w"], "left_semi")
        .select("u", "v", "w")
    )
    calls = max(1, ceil(triangles.count() / TRIANGLES))
    shared = triangles.groupBy(F.pmod(F.xxhash64("u"), F.lit(calls)).alias("_call"))
    listed = shared.applyInPandas(_cliques_of_first, "u string, members array<string>")
    listed = cut(listed.select("u", F.array_sort("members").alias("members")))
    numbered = listed.withColumn("_id", clique_id(F.col("members")))
    # An earlier vertex extends a clique when it forms a triangle with the clique's first vertex and each other member.
    extended = (
        numbered.select("_id", F.col("u").alias("v"), F.size("members").alias("_size"), F.explode("members").alias("w"))
        .filter(F.col("v") != F.col("w"))
        .join(triangles, ["v", "w"])
        .groupBy("_id", "_size", "u")
        .agg(F.count(F.lit(1)).alias("_met"))
        .filter(F.col("_met") == F.col("_size") - 1)
        .select("_id")
        .distinct()
    )
    return numbered.join(extended, "_id", "left_anti").select(
        F.col("members").alias("clique"), F.col("_id").alias("clique_id")
    )


def _cliques_of_first(group: pd.DataFrame) -> pd.DataFrame:
    """Maximal cliques among the later neighbours of every first vertex ``u``, with that vertex."""
    near: dict[str, dict[str, set[str]]] = {}
    for u, v, w in zip(group["u"], group["v"], group["w"]):
        own = near.setdefault(u, {})
        own.setdefault(v, set()).add(w)
        own.setdefault(w, set()).add(v)
    found = [(u, [u, *c]) for u, own in near.items() for c in _expand(own)]
    return pd.DataFrame(found, columns=["u", "members"])


def _expand(near: dict[str, set[str]]) -> Iterator[list[str]]:
    """Maximal cliques of a small graph, by pivoting; an explicit stack keeps deep graphs safe."""
    stack = [([], set(near), set())]
    while stack:
        chosen, open_, closed = stack.pop()
        if not open_:
            if not closed:
                yield chosen
            continue
        pivot = max(open_ | closed, key=lambda x: len(near[x] & open_))
        for vertex in sorted(open_ - near[pivot]):
            stack.append((chosen + [vertex], open_ & near[vertex], closed & near[vertex]))
            open_ = open_ - {vertex}
            closed = closed | {vertex}


def complete_cliques(
    cliques: DataFrame, edges: DataFrame, lab: DataFrame, min_corr_pair: float = 0.8, min_corr_single: float = 0.8
) -> DataFrame:
    """Cliques, plus strong pairs of hosts in no clique, plus single lab hosts in neither."""
    used = cliques.select(F.explode("clique").alias("host")).distinct()
    pairs = (
        edges.filter(F.col("correlation") > min_corr_pair)
        .join(used, "host", "left_anti")
        .join(used.withColumnRenamed("host", "target"), "target", "left_anti")
        .select(F.array("host", "target").alias("clique"))
    )
    paired = pairs.select(F.explode("clique").alias("host")).distinct()
    singles = (
        lab.filter(F.col("correlation") > min_corr_single)
        .select("host")
        .distinct()
        .join(used.unionByName(paired), "host", "left_anti")
        .select(F.array("host").alias("clique"))
    )
    more = pairs.unionByName(singles).withColumn("clique_id", clique_id(F.col("clique")))
    return more.unionByName(cliques.select("clique", "clique_id"))


def flatten_cliques(cliques: DataFrame, suffixes: DataFrame) -> DataFrame:
    """One row per clique host, with its domain."""
    return with_domain(cliques.select("clique_id", F.explode("clique").alias("host")), suffixes)


def clique_jaccard(flat: DataFrame, bundles: DataFrame, on: str, source: str) -> DataFrame:
    """Overlap of a clique's and a bundle's hosts (or domains) over their union.

    Both sides are reduced to distinct pairs before they meet. Cliques of the same hosts (or domains) meet the bundles once
    and have their pairs handed out afterwards. Hosts and domains of very many bundles, and sets of very many cliques, are
    split over tasks.
    """
    mine = flat.filter(F.col(on).isNotNull()).groupBy("clique_id").agg(F.array_sort(F.collect_set(on)).alias("_set"))
    alike = mine.groupBy("_set").agg(F.min("clique_id").alias("_like"))
    theirs = bundles.select("bundle_id", on).filter(F.col(on).isNotNull()).distinct()
    y = theirs.groupBy("bundle_id").agg(F.count(F.lit(1)).alias("_y"))
    met = split_join(theirs, alike.select("_like", F.size("_set").cast("bigint").alias("_x"), F.explode("_set").alias(on)), on)
    xy = met.groupBy("_like", "_x", "bundle_id").agg(F.count(F.lit(1)).alias("_xy"))
    scores = xy.join(y, "bundle_id").select(
        "_like",
        "bundle_id",
        F.col("_x").alias(f"{source}_{on}s_X"),
        F.col("_y").alias(f"{source}_{on}s_Y"),
        ratio("_xy", F.col("_x") + F.col("_y") - F.col("_xy")).alias(f"{source}_{on}s_score"),
    )
    members = mine.join(alike, "_set").select("clique_id", "_like")
    return split_join(members, scores, "_like").drop("_like")


def clique_max_correlation(flat: DataFrame, bundles: DataFrame) -> DataFrame:
    """Largest correlation of a clique's hosts with a bundle."""
    best = bundles.groupBy("bundle_id", "host").agg(F.max("correlation").alias("correlation"))
    hosts = flat.select("clique_id", "host").distinct()
    return (
        split_join(hosts, best, "host")
        .groupBy(*PAIR)
        .agg(F.max("correlation").alias("max_corr"))
    )


def name_matches(pairs: DataFrame, labels: DataFrame, app_info: DataFrame) -> DataFrame:
    """Whether a domain label of the clique occurs in the bundle id, publisher or app name, as 1.0 or 0.0.

    ``labels`` has one row per clique with the array of its distinct domain labels.
    """
    squeezed = lambda c: F.lower(F.replace(F.col(c), F.lit(" "), F.lit("")))
    texts = {"match_bundle": F.lower("bundle_id"), "match_publisher": squeezed("publisher_name"), "match_app_name": squeezed("app_name")}
    apps = app_info.select("bundle_id", *[text.alias(f"_{name}") for name, text in texts.items()])
    named = pairs.join(labels, "clique_id").join(apps, "bundle_id")

    def occurs(text: Column) -> Column:
        return F.exists("_labels", lambda label: F.contains(text, label)).cast("double")

    return named.select(*pairs.columns, *[occurs(F.col(f"_{name}")).alias(name) for name in texts])


def clique_labels(flat: DataFrame) -> DataFrame:
    """Distinct domain labels of every clique."""
    return flat.groupBy("clique_id").agg(F.collect_set(domain_label("domain")).alias("_labels"))


def clique_candidates(
    cliques: DataFrame, app_hosts: DataFrame, lab: DataFrame, app_info: DataFrame, suffixes: DataFrame,
    cut: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> DataFrame:
    """Features of every (clique, bundle) that share a domain; absent features are -1.

    ``app_hosts`` and ``lab`` have bundle_id, host and domain, ``lab`` also the correlation; ``app_info`` has one row
    per bundle. Each overlap and the largest correlation have one row per pair at most, so they are stacked, dealt by clique
    once, and laid side by side there; counts per clique, labels and hosts of the clique meet them in the same place.
    """
    flat = cut(flatten_cliques(cliques, suffixes))
    parts = [
        clique_jaccard(flat, bundles, on, source)
        for source, bundles in (("app_info", app_hosts), ("panel", lab))
        for on in ("host", "domain")
    ]
    stacked = union_all([*parts, clique_max_correlation(flat, lab)], allow_missing=True).repartition("clique_id")
    domains = F.coalesce("app_info_domains_X", "panel_domains_X")
    out = (
        stacked.groupBy("clique_id", "bundle_id")
        .agg(*[F.max(c).alias(c) for c in stacked.columns if c not in PAIR])
        .filter(domains.isNotNull())
        .withColumn("bundles", F.count("bundle_id").over(Window.partitionBy("clique_id")))
    )
    out = name_matches(out, clique_labels(flat), app_info).join(cliques, "clique_id")
    numbers = {
        "hosts": F.size("clique"),
        "domains": domains,
    }
    filled = [
        F.coalesce(numbers.get(c, F.col(c)).cast("double"), F.lit(-1.0)).alias(c) for c in FEATURES
    ]
    return out.select("clique_id", "bundle_id", *filled, "clique")


def train_clique_model(labelled: DataFrame, seed: int = 1, num_trees: int = 50, max_depth: int = 5):
    """Classifier of (clique, bundle) pairs from the candidate features and a 0/1 ``label``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    return Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="features"),
            RandomForestClassifier(
                featuresCol="features", labelCol="label", numTrees=num_trees, maxDepth=max_depth, seed=seed
            ),
        ]
    ).fit(labelled)


def save_model(model, spark: SparkSession, path: str, model_date) -> None:
    """Keep a trained pipeline under its date; it counts once all of it is written."""
    day = as_date(model_date)
    model.write().overwrite().save(f"{path.rstrip('/')}/model_date={day}")
    mark_finished(spark, path, [day], column="model_date")


def load_model(spark: SparkSession, path: str, day):
    """The newest pipeline of ``path`` that was kept on ``day`` or before."""
    from pyspark.ml import PipelineModel

    known = [d for d in finished_dates(spark, path, column="model_date") if d <= as_date(day)]
    if not known:
        raise FileNotFoundError(f"{path} has no model up to {day}")
    return PipelineModel.load(f"{path.rstrip('/')}/model_date={known[-1]}")


def predict_candidates(candidates: DataFrame, model) -> DataFrame:
    """Candidates with the model's probability of a match as ``predict``."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(candidates)
    return scored.select(*candidates.columns, F.get(vector_to_array("probability"), F.lit(1)).alias("predict"))


def clique_scores(predicted: DataFrame, priors: DataFrame, min_prob: float = 0.9) -> DataFrame:
    """Likely bundles of a clique, weighted by their usage priors.

    Bundles without a prior take the smallest of the clique, or 1 when the clique has none.
    """
    clique = Window.partitionBy("clique_id")
    prior = F.coalesce(F.col("prior"), F.min("prior").over(clique), F.lit(1.0))
    return (
        predicted.filter(F.col("predict") >= min_prob)
        .join(priors.select("bundle_id", "prior"), "bundle_id", "left")
        .withColumn("_prior", prior)
        .withColumn("score", ratio("_prior", F.sum("_prior").over(clique)))
        .select("clique_id", "clique", "bundle_id", "score", F.col("predict").alias("model_predict"))
    )


def match_sessions(panel: DataFrame, scored: DataFrame, min_share: float = 0.6) -> DataFrame:
    """Sessions that touched enough of a clique, with their hosts and the clique's bundles.

    A session that has enough of a clique's n hosts lacks n minus enough of them at most, so it has one of the n - enough + 1
    that the fewest sessions have. Only by these do sessions meet cliques; then all hosts are counted. Very frequent hosts
    take part only where a clique has no others, and are split over tasks then, as are cliques of very many sessions.
    """
    seen = panel.groupBy("country", "did", "session_id", "host").agg(F.min("ts").alias("ts"))
    sessions = seen.groupBy("country", "did", "session_id").agg(
        F.min("ts").alias("ts"), F.collect_set("host").alias("hosts")
    )
    visits = seen.select("session_id", "host").distinct()
    often = visits.groupBy("host").agg(F.count(F.lit(1)).alias("_often"))
    cliques = scored.select("clique_id", "clique").distinct().withColumn("_n", F.size(F.array_distinct("clique")))
    # A little less than the share, so that rounding never asks for one host too many; the filter below decides.
    enough = F.greatest(F.lit(1), F.ceil(F.col("_n") * min_share - 1e-9))
    ranked = (
        cliques.select("clique_id", F.explode(F.array_distinct("clique")).alias("host"), (F.col("_n") - enough + 1).alias("_rare"))
        .join(often, "host", "left")
        .groupBy("clique_id", "_rare")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_often", F.lit(0)).alias("often"), "host"))).alias("_hosts"))
        .select("clique_id", F.explode(F.expr("slice(_hosts, 1, CAST(_rare AS INT))")).alias("_host"))
        .select("clique_id", F.col("_host.host").alias("host"))
    )
    met = split_join(visits, ranked, "host").select("session_id", "clique_id").distinct()
    share = ratio(F.size(F.array_intersect("hosts", "clique")), F.size("clique"))
    touched = (
        split_join(met.join(sessions, "session_id"), cliques.select("clique_id", "clique"), "clique_id")
        .filter(share >= min_share)
        .drop("clique")
    )
    reference = scored.select("clique_id", "bundle_id", "score", "model_predict")
    return split_join(touched, reference, "clique_id")

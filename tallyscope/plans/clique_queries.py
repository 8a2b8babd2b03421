"""Host graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyscope.functions.exprs import hash_uniform
from tallyscope.functions.urls import with_domain
from tallyscope.functions.lineage import new_folder
from tallyscope.operators import cliques
from tallyscope.plans.base_queries import domain_sql, panel_sessions
from tallyscope.plans.model_queries import priors
from tallyscope.plans.registry import Data, query
from tallyscope.plans.views import STAGES

MIN_EDGE, MIN_PAIR, MIN_SINGLE = 0.8, 0.95, 0.8
LAB_GAP = 86_400
PHI = "(pxy - px * py) / nullif(sqrt(px * (1 - px)) * sqrt(py * (1 - py)), 0)"

STAGES["v_lab_events"] = """
    SELECT did AS device_id, concat('a', event_id % 50) AS bundle_id, host, ts FROM f_panel"""
STAGES["v_lab_sessions"] = f"""
    WITH p AS (SELECT *, max(ts) OVER (PARTITION BY device_id, bundle_id ORDER BY ts
          RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
        rank() OVER (PARTITION BY device_id, bundle_id ORDER BY ts) AS place FROM v_lab_events)
    SELECT device_id, bundle_id, host, concat_ws('-', device_id, bundle_id, max(CASE WHEN before IS NULL OR ts - before > {LAB_GAP}
      THEN place END) OVER (PARTITION BY device_id, bundle_id ORDER BY ts
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS session_id FROM p"""
STAGES["v_lab_phi"] = f"""
    WITH u AS (SELECT DISTINCT host, bundle_id, session_id FROM v_lab_sessions),
    n AS (SELECT count(DISTINCT session_id) AS n FROM u),
    x AS (SELECT host, count(DISTINCT session_id) AS x FROM u GROUP BY 1),
    y AS (SELECT bundle_id, count(DISTINCT session_id) AS y FROM u GROUP BY 1),
    xy AS (SELECT host, bundle_id, count(*) AS xy FROM u GROUP BY ALL),
    p AS (SELECT host, bundle_id, n AS "N", x / n AS px, y / n AS py, xy / n AS pxy
      FROM xy JOIN x USING (host) JOIN y USING (bundle_id), n),
    c AS (SELECT *, {PHI} AS correlation FROM p)
    SELECT * FROM c WHERE correlation > 0.02"""
STAGES["v_lab_domains"] = domain_sql("v_lab_phi")


@query(
    "host_bundle_corr",
    """SELECT host, bundle_id, "N", round(px, 12) AS px, round(py, 12) AS py, round(pxy, 12) AS pxy,
         round(correlation, 12) AS correlation, domain FROM v_lab_phi JOIN v_lab_domains USING (host)""",
)
def _(d):
    lab = d["f_panel"].select(
        F.col("did").alias("device_id"), F.concat(F.lit("a"), F.col("event_id") % 50).alias("bundle_id"), "host", "ts"
    )
    return cliques.host_bundle_correlation(lab, d["f_suffix"], 0.02, LAB_GAP)


STAGES["v_app_urls"] = """
    SELECT bundle_id, app_name, publisher_name,
      regexp_extract(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS host
    FROM (SELECT *, unnest([publisher_url, privacy_url]) AS u FROM f_app_pages) x"""
STAGES["v_app_url_domains"] = domain_sql("v_app_urls")
STAGES["v_app_hosts"] = """
    SELECT DISTINCT bundle_id, host, domain FROM v_app_urls JOIN v_app_url_domains USING (host)
    WHERE length(host) >= 5 AND (contains(replace(lower(publisher_name), ' ', ''), split_part(domain, '.', 1))
      OR contains(app_name, split_part(domain, '.', 1)) OR contains(lower(bundle_id), split_part(domain, '.', 1)))"""


def app_pages(d: Data):
    return d.stage("app_pages", lambda: d["f_app_pages"])


def app_hosts(d: Data):
    return d.stage("app_hosts", lambda: cliques.validated_app_hosts(app_pages(d), d["f_suffix"]))


@query("validated_app_hosts", "SELECT bundle_id, host, domain FROM v_app_hosts")
def _(d):
    return app_hosts(d)


MIN_HOST, MIN_PHI = 20, 0.01
STAGES["v_host_corr"] = f"""
    WITH s AS (SELECT DISTINCT session_id, host FROM v_sessions),
    k AS (SELECT * FROM s WHERE host IN (SELECT host FROM s GROUP BY host HAVING count(*) > {MIN_HOST})),
    c AS (SELECT a.session_id, a.host, b.host AS target FROM k a JOIN k b ON a.session_id = b.session_id AND a.host <> b.host),
    n AS (SELECT count(DISTINCT session_id) AS n FROM c),
    x AS (SELECT host, count(DISTINCT session_id) AS x FROM c GROUP BY 1),
    xy AS (SELECT host, target, count(DISTINCT session_id) AS xy FROM c GROUP BY ALL),
    p AS (SELECT xy.host, xy.target, n AS "N", a.x / n AS px, b.x / n AS py, xy / n AS pxy
      FROM xy JOIN x a ON a.host = xy.host JOIN x b ON b.host = xy.target, n),
    r AS (SELECT *, {PHI} AS correlation FROM p)
    SELECT * FROM r WHERE correlation > {MIN_PHI}"""


def host_corr(d: Data):
    return cliques.host_correlation(panel_sessions(d), MIN_HOST, MIN_PHI)


@query(
    "host_host_corr",
    """SELECT host, target, "N", round(px, 12) AS px, round(py, 12) AS py, round(pxy, 12) AS pxy,
         round(correlation, 12) AS correlation FROM v_host_corr""",
)
def _(d):
    return host_corr(d)


STAGES["v_edge_domains"] = domain_sql(
    "(SELECT host FROM f_edges UNION SELECT target FROM f_edges)", "host"
)
STAGES["v_hubs"] = """
    WITH b AS (SELECT host, target FROM f_edges WHERE correlation > 0.3 UNION ALL
      SELECT target, host FROM f_edges WHERE correlation > 0.3)
    SELECT b.host FROM b JOIN v_edge_domains t ON t.host = b.target GROUP BY 1 HAVING count(DISTINCT domain) > 14"""


def both_ways(edges):
    mirrored = edges.select(F.col("target").alias("host"), F.col("host").alias("target"), "correlation")
    return edges.unionByName(mirrored)


@query(
    "hub_filtered_corr",
    """SELECT least(host, target) AS host, greatest(host, target) AS target, round(correlation, 12) AS correlation FROM f_edges
       WHERE host NOT IN (SELECT host FROM v_hubs) AND target NOT IN (SELECT host FROM v_hubs)""",
)
def _(d):
    return cliques.remove_hubs(both_ways(edges(d)), d["f_suffix"], 14)


# Cliques level by level: every clique grows by one later vertex at a time; maximal ones have no common neighbour.
STAGES["v_adj"] = f"""
    SELECT DISTINCT host AS a, target AS b FROM f_edges WHERE correlation > {MIN_EDGE}
    UNION SELECT target, host FROM f_edges WHERE correlation > {MIN_EDGE}"""
STAGES["v_c2"] = "SELECT [a, b] AS m FROM v_adj WHERE a < b"
for _k in range(3, 9):
    STAGES[f"v_c{_k}"] = f"""
    SELECT list_append(m, b) AS m FROM (SELECT c.m, e.b, count(*) AS n FROM (SELECT m, unnest(m) AS x FROM v_c{_k - 1}) c
      JOIN v_adj e ON e.a = c.x WHERE e.b > c.m[-1] GROUP BY ALL) g WHERE n = {_k - 1}"""
STAGES["v_cliques"] = """
    WITH c AS (SELECT * FROM v_c3 UNION ALL SELECT * FROM v_c4 UNION ALL SELECT * FROM v_c5 UNION ALL SELECT * FROM v_c6
      UNION ALL SELECT * FROM v_c7 UNION ALL SELECT * FROM v_c8),
    e AS (SELECT m FROM (SELECT c.m, e.b, count(*) AS n FROM (SELECT m, unnest(m) AS x FROM c) c JOIN v_adj e ON e.a = c.x
      GROUP BY ALL) g WHERE n = len(m))
    SELECT m AS clique, md5(array_to_string(m, '')) AS clique_id FROM c WHERE m NOT IN (SELECT m FROM e)"""


def edges(d: Data):
    return d.stage("edges", lambda: d["f_edges"])


def found_cliques(d: Data):
    return d.stage("cliques", lambda: cliques.maximal_cliques(edges(d), MIN_EDGE))


def flat(df):
    return df.withColumn("clique", F.array_join("clique", ","))


@query("maximal_cliques", "SELECT array_to_string(clique, ',') AS clique, clique_id FROM v_cliques")
def _(d):
    return flat(found_cliques(d))


STAGES["v_used"] = "SELECT DISTINCT unnest(clique) AS host FROM v_cliques"
STAGES["v_pairs_left"] = f"""
    SELECT host, target FROM f_edges WHERE correlation > {MIN_PAIR} AND host NOT IN (SELECT host FROM v_used)
      AND target NOT IN (SELECT host FROM v_used)"""
STAGES["v_all_cliques"] = f"""
    WITH p AS (SELECT [host, target] AS clique FROM v_pairs_left),
    s AS (SELECT DISTINCT [host] AS clique FROM f_lab_corr WHERE correlation > {MIN_SINGLE}
      AND host NOT IN (SELECT host FROM v_used UNION SELECT host FROM v_pairs_left UNION SELECT target FROM v_pairs_left))
    SELECT clique, md5(array_to_string(clique, '')) AS clique_id FROM p
    UNION ALL SELECT clique, md5(array_to_string(clique, '')) FROM s UNION ALL SELECT * FROM v_cliques"""


def all_cliques(d: Data):
    return d.stage(
        "all_cliques",
        lambda: cliques.complete_cliques(found_cliques(d), edges(d), d["f_lab_corr"], MIN_PAIR, MIN_SINGLE),
    )


@query("clique_completion", "SELECT array_to_string(clique, ',') AS clique, clique_id FROM v_all_cliques")
def _(d):
    return flat(all_cliques(d))


STAGES["v_lab_hosts"] = """
    SELECT c.bundle_id, c.host, c.correlation, m.domain FROM f_lab_corr c JOIN v_lab_corr_domains m USING (host)
    WHERE correlation > 0.5"""
STAGES["v_lab_corr_domains"] = domain_sql("f_lab_corr")
STAGES["v_clique_hosts"] = "SELECT clique_id, unnest(clique) AS host FROM v_all_cliques"
STAGES["v_clique_domains"] = domain_sql("v_clique_hosts")
STAGES["v_flat"] = "SELECT clique_id, host, domain FROM v_clique_hosts JOIN v_clique_domains USING (host)"


def lab_hosts(d: Data):
    return d.stage("lab_hosts", lambda: with_domain(d["f_lab_corr"].filter(F.col("correlation") > 0.5), d["f_suffix"]))


def jaccard_sql(bundles: str, on: str, source: str) -> str:
    return f"""
    WITH x AS (SELECT clique_id, count(DISTINCT {on}) AS x FROM v_flat GROUP BY 1),
    y AS (SELECT bundle_id, count(DISTINCT {on}) AS y FROM {bundles} GROUP BY 1),
    xy AS (SELECT bundle_id, clique_id, count(DISTINCT {on}) AS xy FROM v_flat JOIN {bundles} USING ({on}) GROUP BY ALL)
    SELECT bundle_id, clique_id, x AS "{source}_{on}s_X", y AS "{source}_{on}s_Y",
      CAST(xy AS DOUBLE) / (x + y - xy) AS "{source}_{on}s_score" FROM xy JOIN x USING (clique_id) JOIN y USING (bundle_id)"""


for _name, _bundles in (("app_info", "v_app_hosts"), ("panel", "v_lab_hosts")):
    for _on in ("host", "domain"):
        STAGES[f"v_jac_{_name}_{_on}"] = jaccard_sql(_bundles, _on, _name)


@query(
    "clique_jaccard",
    """SELECT bundle_id, clique_id, "panel_hosts_X", "panel_hosts_Y", round("panel_hosts_score", 12) AS "panel_hosts_score"
       FROM v_jac_panel_host""",
)
def _(d):
    return cliques.clique_jaccard(cliques.flatten_cliques(all_cliques(d), d["f_suffix"]), lab_hosts(d), "host", "panel")


STAGES["v_max_corr"] = """
    SELECT bundle_id, clique_id, max(correlation) AS max_corr FROM v_flat JOIN v_lab_hosts USING (host) GROUP BY ALL"""


@query("clique_max_corr", "SELECT bundle_id, clique_id, round(max_corr, 12) AS max_corr FROM v_max_corr")
def _(d):
    return cliques.clique_max_correlation(cliques.flatten_cliques(all_cliques(d), d["f_suffix"]), lab_hosts(d))


STAGES["v_app_names"] = "SELECT bundle_id, app_name, publisher_name FROM f_app_pages"
STAGES["v_candidate_pairs"] = """
    SELECT bundle_id, clique_id FROM v_jac_app_info_domain UNION SELECT bundle_id, clique_id FROM v_jac_panel_domain"""
STAGES["v_name_matches"] = """
    SELECT bundle_id, clique_id, max(CASE WHEN contains(lower(bundle_id), split_part(domain, '.', 1)) THEN 1.0 ELSE 0 END) AS match_bundle,
      max(CASE WHEN contains(lower(replace(publisher_name, ' ', '')), split_part(domain, '.', 1)) THEN 1.0 ELSE 0 END) AS match_publisher,
      max(CASE WHEN contains(lower(replace(app_name, ' ', '')), split_part(domain, '.', 1)) THEN 1.0 ELSE 0 END) AS match_app_name
    FROM v_candidate_pairs JOIN v_flat USING (clique_id) JOIN v_app_names USING (bundle_id) GROUP BY ALL"""


@query(
    "name_match_features",
    """SELECT bundle_id, clique_id, CAST(match_bundle AS DOUBLE) AS match_bundle, CAST(match_publisher AS DOUBLE) AS match_publisher,
         CAST(match_app_name AS DOUBLE) AS match_app_name FROM v_name_matches""",
)
def _(d):
    found = d.stage("flat_cliques", lambda: cliques.flatten_cliques(all_cliques(d), d["f_suffix"]))
    pairs = cliques.clique_jaccard(found, app_hosts(d), "domain", "app_info").select(*cliques.PAIR).unionByName(
        cliques.clique_jaccard(found, lab_hosts(d), "domain", "panel").select(*cliques.PAIR)
    )
    # Dealt by clique alone, so that the labels of the clique meet its pairs without another shuffle.
    return cliques.name_matches(pairs.repartition("clique_id").distinct(), cliques.clique_labels(found), app_pages(d))


def _filled(c: str) -> str:
    return f'coalesce(CAST("{c}" AS DOUBLE), -1) AS "{c}"'


STAGES["v_candidates"] = f"""
    WITH b AS (SELECT *, count(bundle_id) OVER (PARTITION BY clique_id) AS bundles FROM v_candidate_pairs),
    j AS (SELECT b.*, len(clique) AS hosts, coalesce("app_info_domains_X", "panel_domains_X") AS domains,
        "app_info_hosts_Y", "app_info_hosts_score", "app_info_domains_Y", "app_info_domains_score", "panel_hosts_Y",
        "panel_hosts_score", "panel_domains_Y", "panel_domains_score", max_corr, match_bundle, match_publisher, match_app_name, clique
      FROM b LEFT JOIN v_jac_app_info_host USING (bundle_id, clique_id) LEFT JOIN v_jac_app_info_domain USING (bundle_id, clique_id)
      LEFT JOIN v_jac_panel_host USING (bundle_id, clique_id) LEFT JOIN v_jac_panel_domain USING (bundle_id, clique_id)
      LEFT JOIN v_max_corr USING (bundle_id, clique_id) JOIN v_name_matches USING (bundle_id, clique_id)
      JOIN v_all_cliques USING (clique_id))
    SELECT clique_id, bundle_id, {", ".join(_filled(c) for c in cliques.FEATURES)}, clique FROM j"""


def candidates(d: Data):
    return d.stage(
        "candidates",
        lambda: cliques.clique_candidates(all_cliques(d), app_hosts(d), lab_hosts(d), app_pages(d), d["f_suffix"]),
    )


@query(
    "clique_candidates",
    f"""SELECT clique_id, bundle_id, {", ".join(f'round("{c}", 12) AS "{c}"' for c in cliques.FEATURES)},
          array_to_string(clique, ',') AS clique FROM v_candidates""",
)
def _(d):
    return flat(candidates(d))


PREDICT = "(('0x' || substr(md5(concat_ws('|', clique_id, bundle_id)), 1, 8))::BIGINT / 4294967296.0)"
STAGES["v_clique_scores"] = f"""
    WITH c AS (SELECT clique_id, bundle_id, clique, {PREDICT} AS predict FROM v_candidates),
    f AS (SELECT c.*, p.p_prior AS prior FROM c LEFT JOIN (SELECT app, p_prior FROM v_priors WHERE country = 840) p
      ON p.app = c.bundle_id WHERE predict >= 0.6),
    w AS (SELECT *, coalesce(prior, min(prior) OVER (PARTITION BY clique_id), 1.0) AS weight FROM f)
    SELECT clique_id, clique, bundle_id, weight / sum(weight) OVER (PARTITION BY clique_id) AS score, predict FROM w"""


def scored_cliques(d: Data):
    own = priors(d).filter("country = 840").select(F.col("app").alias("bundle_id"), F.col("p_prior").alias("prior"))
    predicted = candidates(d).withColumn("predict", hash_uniform("clique_id", "bundle_id"))
    return cliques.clique_scores(predicted, own, 0.6)


@query(
    "clique_scores",
    """SELECT clique_id, array_to_string(clique, ',') AS clique, bundle_id, round(score, 12) AS score,
         round(predict, 12) AS model_predict FROM v_clique_scores""",
)
def _(d):
    return flat(scored_cliques(d))


@query("clique_model_ml")
def _(d):
    # Trained on a label that is no feature: whether the bundle is used more than the mean bundle on the second platform.
    rows = candidates(d)
    usage = priors(d).groupBy(F.col("app").alias("bundle_id")).agg(F.avg("p_prior").alias("_usage"))
    typical = usage.agg(F.avg("_usage").alias("typical")).scalar()
    often = F.coalesce(F.col("_usage") > typical, F.lit(False)).cast("double")
    labelled = rows.join(usage, "bundle_id", "left").withColumn("label", often).drop("_usage")
    # Training keeps the pipeline by date; scoring takes the newest one of its day or before.
    path = new_folder(d.spark, "models")
    cliques.save_model(cliques.train_clique_model(labelled), d.spark, path, "2024-01-21")
    model = cliques.load_model(d.spark, path, "2024-01-28")
    return cliques.predict_candidates(rows, model).select("clique_id", "bundle_id", "predict")


@query(
    "clique_session_match",
    """WITH q AS (SELECT DISTINCT clique_id, len(clique) AS n_hosts, unnest(clique) AS host FROM v_clique_scores),
       t AS (SELECT session_id, clique_id FROM f_order_panel JOIN q USING (host) GROUP BY session_id, clique_id, n_hosts
         HAVING count(DISTINCT host) / n_hosts >= 0.6),
       s AS (SELECT country, did, session_id, min(ts) AS ts, list_sort(list(DISTINCT host)) AS hosts FROM f_order_panel GROUP BY ALL)
       SELECT country, did, s.session_id, ts, array_to_string(hosts, ',') AS hosts, clique_id, bundle_id, round(score, 12) AS score,
         round(predict, 12) AS model_predict
       FROM s JOIN t ON t.session_id = s.session_id JOIN v_clique_scores USING (clique_id)""",
)
def _(d):
    scored = d.stage("scored_cliques", lambda: scored_cliques(d))
    matched = cliques.match_sessions(d["f_order_panel"], scored, 0.6)
    return matched.withColumn("hosts", F.array_join(F.array_sort("hosts"), ","))

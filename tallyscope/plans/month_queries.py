"""Monthly users and validation-signal queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyscope.operators import evaluate, monthly, signals
from tallyscope.operators.assoc import match_entities
from tallyscope.plans.estimate_queries import applied, daily_users, share_estimates
from tallyscope.plans.model_queries import daily_estimates
from tallyscope.plans.registry import Data, query
from tallyscope.plans.views import STAGES

MIN_DAYS = 25

STAGES["v_month_scores"] = """
    SELECT date, source, country, did, app, max(score) AS score FROM (
      SELECT *, max(model_date) OVER (PARTITION BY date, source, country, app, did, model_type) AS newest FROM f_solved) x
    WHERE model_date = newest GROUP BY ALL"""
STAGES["v_reporting"] = f"""
    SELECT source, country, did, count(DISTINCT date) AS user_total_n_reporting_days,
      (SELECT count(DISTINCT date) FROM v_month_scores) AS period_total_n_days FROM v_month_scores
    GROUP BY source, country, did HAVING count(DISTINCT date) >= {MIN_DAYS}"""
STAGES["v_kept"] = "SELECT * FROM v_month_scores JOIN v_reporting USING (source, country, did)"


def scores(d: Data):
    return d.stage("scores", lambda: monthly.newest_scores(d["f_solved"]))


def kept(d: Data):
    found = scores(d)
    return monthly.kept_scores(found, monthly.reporting_users(found, MIN_DAYS))


@query(
    "reporting_users",
    "SELECT source, country, did, user_total_n_reporting_days, period_total_n_days FROM v_reporting",
)
def _(d):
    return monthly.reporting_users(scores(d), MIN_DAYS)


STAGES["v_period_reach"] = """
    SELECT source, country, app, k / n AS p, n FROM (SELECT source, country, app, sum(s) AS k FROM (
      SELECT source, country, app, did, max(score) AS s FROM v_kept GROUP BY ALL) b GROUP BY ALL) x
    JOIN (SELECT source, country, count(DISTINCT did) AS n FROM v_kept GROUP BY ALL) y USING (source, country)"""


@query("period_reach", "SELECT source, country, app, round(p, 12) AS p, n FROM v_period_reach")
def _(d):
    return monthly.period_reach(kept(d))


STAGES["v_engaged"] = """
    WITH e AS (SELECT source, country, did, app, sum(score) / max(user_total_n_reporting_days) AS engagement_p FROM v_kept
      WHERE user_total_n_reporting_days <> period_total_n_days GROUP BY ALL),
    g AS (SELECT e.*, c.date FROM e CROSS JOIN (SELECT DISTINCT date FROM v_month_scores) c),
    s AS (SELECT coalesce(k.date, g.date) AS date, coalesce(k.source, g.source) AS source,
        coalesce(k.country, g.country) AS country, coalesce(k.did, g.did) AS did, coalesce(k.app, g.app) AS app,
        k.score, g.engagement_p FROM v_kept k FULL JOIN g ON k.date = g.date AND k.source = g.source
        AND k.country = g.country AND k.did = g.did AND k.app = g.app),
    r AS (SELECT DISTINCT date, source, country, did, true AS is_panel FROM v_kept)
    SELECT date, source, country, app, sum(CASE WHEN is_panel THEN coalesce(score, 0) ELSE engagement_p END) AS k
    FROM s LEFT JOIN r USING (date, source, country, did) GROUP BY ALL"""


@query("engagement_imputed_daily", "SELECT date, source, country, app, round(k, 12) AS k FROM v_engaged")
def _(d):
    return monthly.engagement_daily(kept(d), monthly.period_days(scores(d)))


STAGES["v_month_average"] = """
    WITH n AS (SELECT source, country, count(DISTINCT did) AS n FROM v_kept GROUP BY ALL),
    w AS (SELECT date, source, country, count(DISTINCT did) AS raw_n FROM v_kept GROUP BY ALL),
    a AS (SELECT DISTINCT source, country, app FROM v_engaged),
    g AS (SELECT a.*, c.date FROM a CROSS JOIN (SELECT DISTINCT date FROM v_month_scores) c),
    p AS (SELECT g.source, g.country, g.app, g.date, coalesce(k, 0) / n AS p FROM g JOIN n USING (source, country)
      LEFT JOIN v_engaged e ON e.source = g.source AND e.country = g.country AND e.app = g.app AND e.date = g.date)
    SELECT source, country, app, sum(p * raw_n) / sum(raw_n) AS avg_dau_p, max(p) AS max_dau_p
    FROM p JOIN w USING (date, source, country) GROUP BY ALL"""


@query(
    "monthly_avg_reach",
    """SELECT source, country, app, round(r.p, 12) AS p, round(avg_dau_p, 12) AS avg_dau_p, round(max_dau_p, 12) AS max_dau_p, n
       FROM v_period_reach r JOIN v_month_average USING (source, country, app)""",
)
def _(d):
    return monthly.monthly_source_estimation(d["f_solved"], MIN_DAYS)


# Monthly estimates per country and month, from the monthly series: p, avg_dau_p and the month's device count n.
STAGES["v_month_n"] = "SELECT date, country, CAST(sum(n) AS BIGINT) AS n FROM f_monthly GROUP BY ALL"
STAGES["v_month_est"] = """
    SELECT m.date, m.country, m.app, CAST(m.n AS DOUBLE) / c.n AS p, CAST(m.n AS DOUBLE) / c.n / 3 AS avg_dau_p, c.n
    FROM f_monthly m JOIN v_month_n c ON c.date = m.date AND c.country = m.country"""
CURRENT, HISTORY = "1998-06-01", ("1998-05-01", "1998-04-01")
STAGES["v_fused"] = f"""
    WITH e AS (SELECT country, app, p, avg_dau_p, n FROM v_month_est WHERE date = DATE '{CURRENT}'),
    h AS (SELECT date, country, app, p, avg_dau_p, n FROM v_month_est WHERE date IN (DATE '{HISTORY[0]}', DATE '{HISTORY[1]}')),
    a AS (SELECT country, app FROM e UNION SELECT country, app FROM h),
    f AS (SELECT a.country, a.app, c.n, coalesce(e.p, 0) AS p, coalesce(e.avg_dau_p, 0) AS avg_dau_p FROM a
      JOIN (SELECT DISTINCT country, n FROM e) c USING (country) LEFT JOIN e ON e.country = a.country AND e.app = a.app),
    g AS (SELECT a.country, a.app, c.n, coalesce(h.p, 0) AS p, coalesce(h.avg_dau_p, 0) AS avg_dau_p FROM a
      JOIN (SELECT DISTINCT date, country, n FROM h) c USING (country)
      LEFT JOIN h ON h.country = a.country AND h.app = a.app AND h.date = c.date),
    pr AS (SELECT country, app, sum(p * n) / sum(n) AS historic_p, sum(avg_dau_p * n) / sum(n) AS historic_avg_dau_p,
      avg(n) AS historic_n FROM (SELECT * FROM f UNION ALL SELECT * FROM g) u GROUP BY ALL),
    w AS (SELECT f.country, f.app, f.p AS clean_p, f.avg_dau_p AS clean_avg_dau_p, f.n AS clean_n, pr.* EXCLUDE (country, app),
      CASE WHEN f.p * f.n <= 3 THEN (3 - f.p * f.n) / 4 ELSE 0 END AS historic_w FROM f JOIN pr USING (country, app))
    SELECT country, app, clean_p * (1 - historic_w) + historic_p * historic_w AS p,
      clean_avg_dau_p * (1 - historic_w) + historic_avg_dau_p * historic_w AS avg_dau_p,
      clean_n * (1 - historic_w) + historic_n * historic_w AS n, clean_p, clean_avg_dau_p, clean_n, historic_p,
      historic_avg_dau_p, historic_n, historic_w FROM w"""


def month_estimates(d: Data):
    n = d["f_monthly"].groupBy("date", "country").agg(F.sum("n").alias("_n"))
    p = F.col("n").cast("double") / F.col("_n")
    return d["f_monthly"].join(n, ["date", "country"]).select(
        "date", "country", "app", p.alias("p"), (p / 3).alias("avg_dau_p"), F.col("_n").alias("n")
    )


def fused(d: Data):
    est = month_estimates(d)
    current = est.filter(F.col("date") == F.lit(CURRENT).cast("date"))
    history = est.filter(F.col("date").isin(*[F.lit(h).cast("date") for h in HISTORY]))
    return monthly.fuse_history(current, history, threshold=3)


@query(
    "historic_prior_fusion",
    """SELECT country, app, round(p, 12) AS p, round(avg_dau_p, 12) AS avg_dau_p, round(n, 12) AS n, round(clean_p, 12) AS clean_p,
         round(clean_avg_dau_p, 12) AS clean_avg_dau_p, clean_n, round(historic_p, 12) AS historic_p,
         round(historic_avg_dau_p, 12) AS historic_avg_dau_p, round(historic_n, 12) AS historic_n,
         round(historic_w, 12) AS historic_w FROM v_fused""",
)
def _(d):
    return fused(d)


STAGES["v_stats"] = """
    SELECT country, app, avg(active_users) AS published_avg_dau, sum(active_users) AS published_sum_dau,
      max(active_users) AS published_max_dau, count(date) AS n_dau FROM v_dau WHERE country <> 999 GROUP BY ALL"""
STAGES["v_mau"] = """
    SELECT country, app, (p * n + 1) / (n + 2) * published_avg_dau / nullif(avg_dau_p, 0) AS active_users
    FROM v_fused JOIN v_stats USING (country, app)"""


def stats(d: Data):
    return monthly.published_stats(daily_users(d))


@query("mau_scale", "SELECT country, app, round(active_users, 12) AS active_users FROM v_mau")
def _(d):
    return monthly.scale_monthly(fused(d), stats(d)).withColumn("active_users", F.round("active_users", 12))


UNIFORM = "(('0x' || substr(md5(concat_ws('|', country, app)), 1, 8))::BIGINT / 4294967296.0)"
STAGES["v_clamped"] = f"""
    WITH b AS (SELECT s.country, s.app, active_users AS clean, CAST(published_max_dau AS DOUBLE) AS lo,
        least(CAST(population_size AS DOUBLE), published_sum_dau) AS hi, published_avg_dau, {UNIFORM.replace('country', 's.country').replace(', app', ', s.app')} AS u
      FROM v_stats s LEFT JOIN v_mau m ON m.country = s.country AND m.app = s.app
      JOIN f_population p ON p.country = s.country),
    c AS (SELECT *, CASE WHEN clean >= lo AND clean <= hi THEN clean
        WHEN clean > hi THEN hi * (1 - 0.005 + 0.0025 - 2 * 0.0025 * u)
        WHEN clean < lo THEN lo * (1 + 0.005 - 0.0025 + 2 * 0.0025 * u) END AS moved FROM b)
    SELECT country, app, least(greatest(moved, lo), hi) AS active_users, clean AS clean_active_users, lo AS min_border,
      hi AS max_border, published_avg_dau FROM c"""


def clamped(d: Data):
    return monthly.clamp_monthly(monthly.scale_monthly(fused(d), stats(d)), stats(d), d["f_population"])


def tame(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, 12))
    return df


@query(
    "mau_clamp",
    """SELECT country, app, round(active_users, 12) AS active_users, round(clean_active_users, 12) AS clean_active_users,
         round(min_border, 12) AS min_border, round(max_border, 12) AS max_border,
         round(published_avg_dau, 12) AS published_avg_dau FROM v_clamped""",
)
def _(d):
    return tame(clamped(d), "active_users", "clean_active_users", "min_border", "max_border", "published_avg_dau")


@query(
    "monthly_accuracy",
    """WITH p AS (SELECT t.country, t.active_users AS y, m.active_users AS yhat, t.active_users / u.avg_dau AS ratio_y,
           m.active_users / m.published_avg_dau AS ratio_yhat
         FROM (SELECT country, app, CAST(sum(active_users) AS DOUBLE) AS active_users FROM f_truth GROUP BY ALL) t
         JOIN v_clamped m ON m.country = t.country AND m.app = t.app
         JOIN (SELECT country, app, avg(active_users) AS avg_dau FROM f_truth GROUP BY ALL) u
           ON u.country = t.country AND u.app = t.app WHERE m.active_users > 0 AND t.active_users >= 1000),
       b AS (SELECT *, unnest([-1, CAST(floor(log10(y)) AS INTEGER)]) AS bucket FROM p)
       SELECT country, bucket, round(median(abs(y - yhat) / y), 12) AS mape,
         round(median(abs(ratio_y - ratio_yhat) / ratio_y), 12) AS mau_dau_ratio_mape,
         round(avg(CASE WHEN abs(y - yhat) / y < 0.3 THEN 1.0 ELSE 0.0 END), 12) AS swacc, count(*) AS n_apps FROM b GROUP BY ALL""",
)
def _(d):
    stream = F.concat_ws("-", "country", "app").alias("stream_id")
    truth = d["f_truth"].groupBy("country", "app").agg(F.sum("active_users").cast("double").alias("active_users"))
    pairs = evaluate.monthly_pairs(
        truth.select("country", "app", "active_users", stream),
        clamped(d),
        d["f_truth"].select("country", "app", "active_users", stream),
        1000,
    )
    return evaluate.monthly_accuracy(pairs)


OVERLAP = "date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'"
STAGES["v_factors"] = f"""
    SELECT app, country, avg(CAST(active_users AS DOUBLE) / nullif(legacy_users, 0)) AS factor FROM f_monthly
    WHERE {OVERLAP} GROUP BY ALL"""


def factors(d: Data):
    overlap = d["f_monthly"].filter(OVERLAP)
    return monthly.alignment_factors(overlap, overlap)


@query("alignment_factors", "SELECT app, country, round(factor, 12) AS factor FROM v_factors")
def _(d):
    return factors(d)


STAGES["v_aligned"] = """
    SELECT m.date, m.country, m.app, legacy_users * coalesce(factor, 1.0) AS active_users FROM f_monthly m
    LEFT JOIN v_factors f ON f.app = m.app AND f.country = m.country"""


@query(
    "apply_alignment",
    """SELECT date, country, app, round(CAST(active_users AS DOUBLE), 12) AS active_users, CAST(0 AS DOUBLE) AS clean_active_users,
         CAST(0 AS DOUBLE) AS min_border, CAST(0 AS DOUBLE) AS max_border FROM v_aligned""",
)
def _(d):
    return tame(monthly.apply_alignment(d["f_monthly"], factors(d)), "active_users")


@query(
    "adapt_ids",
    """SELECT date, country, a.app AS bundle_id, b.id AS app, round(CAST(active_users AS DOUBLE), 12) AS active_users,
         CAST(1 AS DOUBLE) AS confidence
       FROM v_aligned a LEFT JOIN (SELECT DISTINCT bundle_id, id FROM f_bundle) b ON b.bundle_id = a.app""",
)
def _(d):
    return tame(monthly.adapt_ids(monthly.apply_alignment(d["f_monthly"], factors(d)), d["f_bundle"]), "active_users")


# ---- validation signals

STAGES["v_sized"] = """
    SELECT *, CAST(round(log10(active_users)) AS INTEGER) AS bucket_size FROM (
      SELECT country, app, avg(active_users) AS active_users FROM f_truth GROUP BY ALL) m"""


@query(
    "stratified_sample",
    """SELECT country, app, round(active_users, 12) AS active_users, bucket_size, CAST(pos AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY country, bucket_size ORDER BY md5(concat_ws('|', country, app)), app) AS pos
         FROM v_sized) x WHERE pos <= 10""",
)
def _(d):
    return tame(signals.stratified_sample(d["f_truth"], 10), "active_users")


@query(
    "top_k_per_group",
    """SELECT country, app, n_days, round(avg_active_users, 12) AS avg_active_users, CAST(pos AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY country ORDER BY avg_active_users DESC, app) AS pos FROM (
           SELECT country, app, count(date) AS n_days, avg(active_users) AS avg_active_users FROM f_truth
           WHERE active_users >= 0 GROUP BY ALL) m) x WHERE pos <= 20""",
)
def _(d):
    return tame(signals.top_by_size(d["f_truth"], 20), "avg_active_users")


STAGES["v_charts"] = """
    SELECT c.country, id, chart_rank AS rank, CASE WHEN chart_rank % 2 = 0 THEN 'topselling_free' ELSE 'topgrossing' END AS mode,
      'iphone' AS device_type FROM f_bundle JOIN (SELECT country FROM f_population) c ON true"""
STAGES["v_chart_apps"] = """
    SELECT r.country, b.bundle_id AS app FROM v_charts r JOIN (SELECT DISTINCT id, bundle_id FROM f_bundle) b USING (id)
    WHERE mode = 'topselling_free' AND device_type = 'iphone' AND rank <= 7"""


def chart_apps(d: Data):
    everywhere = d["f_population"].agg(F.collect_list("country").alias("all")).scalar()
    ranks = d["f_bundle"].select(
        F.explode(everywhere).alias("country"), "id", F.col("chart_rank").alias("rank"),
        F.when(F.col("chart_rank") % 2 == 0, "topselling_free").otherwise("topgrossing").alias("mode"),
        F.lit("iphone").alias("device_type"),
    )
    return signals.chart_selection(ranks, d["f_bundle"])


@query("chart_rank_selection", "SELECT country, app FROM v_chart_apps")
def _(d):
    return chart_apps(d)


@query(
    "selection_union",
    """WITH s AS (SELECT country, app FROM (SELECT *, row_number() OVER (PARTITION BY country, bucket_size
           ORDER BY md5(concat_ws('|', country, app)), app) AS pos FROM v_sized) x WHERE pos <= 10),
       u AS (SELECT country, app, false AS vip FROM s UNION ALL SELECT country, app, false FROM v_chart_apps
         UNION ALL SELECT c.country, p.app, false FROM (SELECT DISTINCT country FROM s) c
           CROSS JOIN (VALUES ('pinned.one'), ('a1')) p(app)
         UNION ALL SELECT country, app, true FROM v_sized WHERE active_users > 2000)
       SELECT country, app, max(vip) AS is_vip FROM u GROUP BY ALL""",
)
def _(d):
    vip = signals.mean_users(d["f_truth"]).filter("active_users > 2000")
    return signals.select_apps(
        [signals.stratified_sample(d["f_truth"], 10), chart_apps(d)], ["pinned.one", "a1"], vip
    )


STAGES["v_all_signals"] = """
    WITH a AS (SELECT date, country, app, active_users FROM v_dau), b AS (SELECT date, country, app, active_users AS ga_dau FROM f_truth),
    c AS (SELECT date, country, bundle_id AS app, CAST(active_users AS BIGINT) AS android_dau FROM f_second_platform
      JOIN v_matches USING (android_id)),
    e AS (SELECT date, country, app, p AS data_ai_dau FROM v_share)
    SELECT date, country, app, active_users, ga_dau, android_dau, data_ai_dau FROM a FULL JOIN b USING (date, country, app)
    FULL JOIN c USING (date, country, app) FULL JOIN e USING (date, country, app)"""


def all_signals(d: Data):
    matches = match_entities(d["f_match"], d["f_bundle"])
    android = d["f_second_platform"].join(matches, "android_id").select(
        "date", "country", F.col("bundle_id").alias("app"), F.col("active_users").alias("android_dau")
    )
    return signals.join_signals(
        {
            "active_users": daily_users(d),
            "ga_dau": d["f_truth"].withColumnRenamed("active_users", "ga_dau"),
            "android_dau": android,
            "data_ai_dau": share_estimates(d).withColumnRenamed("p", "data_ai_dau"),
        }
    )


@query(
    "signal_outer_join",
    """SELECT date, country, app, round(active_users, 12) AS active_users, ga_dau, android_dau,
         round(data_ai_dau, 12) AS data_ai_dau FROM v_all_signals""",
)
def _(d):
    return tame(all_signals(d), "active_users")


STAGES["v_stage_signals"] = """
    WITH r AS (SELECT date, country, app, p AS raw_p, p * n AS k, n FROM v_merged),
    e AS (SELECT date, country, app, p AS established_scale_p FROM v_share),
    t AS (SELECT date, country, app, p AS tss_p FROM v_applied)
    SELECT date, country, app, coalesce(raw_p, 0) AS raw_p, k, n, coalesce(established_scale_p, 0) AS established_scale_p,
      coalesce(tss_p, 0) AS tss_p FROM r FULL JOIN e USING (date, country, app) FULL JOIN t USING (date, country, app)"""


def stage_signals(d: Data):
    return signals.stage_signals(daily_estimates(d), share_estimates(d), applied(d))


@query(
    "scale_stage_signals",
    """SELECT date, country, app, round(raw_p, 12) AS raw_p, round(k, 12) AS k, n,
         round(established_scale_p, 12) AS established_scale_p, round(tss_p, 12) AS tss_p FROM v_stage_signals""",
)
def _(d):
    return stage_signals(d)


def rescale_sql(columns: list[str]) -> str:
    steps, shown = [], []
    for c in columns:
        steps.append(
            f"(SELECT country, app, avg(a / {c}) AS f FROM (SELECT *, row_number() OVER (PARTITION BY country, app ORDER BY date) "
            f"AS pos FROM b WHERE {c} > 0 AND a > 0) x WHERE pos <= 14 GROUP BY ALL) f_{c}"
        )
        shown.append(f"round({c} * coalesce(f_{c}.f, 1), 12) AS {c}")
    joins = " ".join(f"LEFT JOIN {s} ON {s.split()[-1]}.country = b.country AND {s.split()[-1]}.app = b.app" for s in steps)
    return f"""
    WITH m AS (SELECT country, app, avg(active_users) AS m FROM (SELECT *, row_number() OVER (PARTITION BY country, app
        ORDER BY date) AS pos FROM v_all_signals) x WHERE pos <= 14 GROUP BY ALL),
    b AS (SELECT s.*, active_users / nullif(m, 0) AS a FROM v_all_signals s JOIN m USING (country, app))
    SELECT b.date, b.country, b.app, round(a, 12) AS active_users, {", ".join(shown)} FROM b {joins}"""


@query("signal_rescale", rescale_sql(["ga_dau", "android_dau", "data_ai_dau"]))
def _(d):
    out = signals.rescale_signals(all_signals(d), "active_users", ["ga_dau", "android_dau", "data_ai_dau"])
    return tame(out, "active_users", "ga_dau", "android_dau", "data_ai_dau")


@query("panel_size", "SELECT date, country, max(n) AS n FROM v_stage_signals GROUP BY ALL")
def _(d):
    return signals.panel_size(stage_signals(d))


@query(
    "live_signals",
    """SELECT date, country, app, round(active_users, 12) AS active_users, ga_dau, android_dau, round(data_ai_dau, 12) AS data_ai_dau
       FROM v_all_signals s WHERE EXISTS (SELECT 1 FROM v_stage_signals t WHERE t.country = s.country AND t.app = s.app)""",
)
def _(d):
    return tame(signals.live_signals(all_signals(d), stage_signals(d)), "active_users")


@query(
    "app_ordering",
    """SELECT country, app, round(avg(active_users), 12) AS active_users, count(active_users) AS count FROM v_all_signals
       GROUP BY country, app""",
)
def _(d):
    return tame(signals.app_ordering(all_signals(d)), "active_users")

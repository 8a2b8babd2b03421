"""Share, trend, scale, calibration and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyscope.functions.exprs import fits_int
from tallyscope.functions.lineage import new_folder
from tallyscope.operators import calibrate, evaluate, labelled, reach, scale, share, trend
from tallyscope.operators.assoc import match_entities
from tallyscope.plans.base_queries import learning_log
from tallyscope.plans.model_queries import daily_estimates, daily_sources, session_eval
from tallyscope.plans.registry import Data, query
from tallyscope.plans.views import STAGES
from tallyscope.sources.tables import between_dates, inline_table, union_all

# ---- share estimator

STAGES["v_apps"] = """
    WITH c AS (SELECT bundle_id, category, count(*) AS n FROM f_bundle WHERE category IS NOT NULL GROUP BY ALL),
    t AS (SELECT bundle_id, category FROM (SELECT *, row_number() OVER (PARTITION BY bundle_id ORDER BY n DESC, category)
      AS pos FROM c) x WHERE pos = 1)
    SELECT DISTINCT m.android_id AS app_android, b.bundle_id AS app_ios, t.category FROM f_bundle b
    JOIN f_match m ON m.ios_id = b.id LEFT JOIN t ON t.bundle_id = b.bundle_id"""


def apps(d: Data):
    categories = d["f_bundle"].select(F.col("bundle_id").alias("app_ios"), "category")
    return share.apps_with_category(d["f_match"], d["f_bundle"], categories)


@query("apps_with_category", "SELECT app_android, app_ios, category FROM v_apps")
def _(d):
    return apps(d)


STAGES["v_country_ratio"] = "SELECT country, avg(country_ratio) AS country_ratio FROM f_country_ratio GROUP BY 1"
STAGES["v_category_ratio"] = """
    SELECT country, category, coalesce(avg(category_country_ratio), avg(neighbour_category_country_ratio))
      AS category_country_ratio FROM f_category_ratio GROUP BY ALL"""
DOW = """CASE dow WHEN 'Sun' THEN 1 WHEN 'Mon' THEN 2 WHEN 'Tue' THEN 3 WHEN 'Wed' THEN 4 WHEN 'Thu' THEN 5
    WHEN 'Fri' THEN 6 ELSE 7 END"""


@query(
    "share_ratio_v1",
    f"""SELECT app_android, app_ios, r.country, {DOW} AS dow,
          round(coalesce(ios_ratio, country_ratio, category_country_ratio), 12) AS ratio
        FROM v_apps LEFT JOIN f_ratio r USING (app_ios, app_android) LEFT JOIN v_country_ratio c ON c.country = r.country
        LEFT JOIN v_category_ratio k ON k.country = r.country AND k.category = v_apps.category""",
)
def _(d):
    return share.share_ratio_v1(apps(d), d["f_ratio"], d["f_country_ratio"], d["f_category_ratio"])


STAGES["v_ratio"] = f"""
    SELECT app_android, app_ios, c.country, r.dow,
      coalesce(avg(ios_ratio), avg(category_country_ratio), avg(country_ratio)) AS ratio
    FROM v_apps CROSS JOIN v_country_ratio c
    LEFT JOIN (SELECT app_ios, app_android, {DOW} AS dow, ios_ratio FROM f_ratio) r USING (app_ios, app_android)
    LEFT JOIN v_category_ratio k ON k.country = c.country AND k.category = v_apps.category GROUP BY ALL"""


def ratios(d: Data):
    return share.share_ratio_v2(apps(d), d["f_ratio"], d["f_country_ratio"], d["f_category_ratio"])


@query("share_ratio_v2", "SELECT app_android, app_ios, country, dow, round(ratio, 12) AS ratio FROM v_ratio")
def _(d):
    return ratios(d)


STAGES["v_share"] = """
    SELECT date, u.country, app_ios AS app, ratio, CAST(active_users AS DOUBLE) / population_size * ratio AS p
    FROM f_second_platform u JOIN f_population p ON p.country = u.country
    JOIN v_ratio r ON r.app_android = u.android_id AND r.country = u.country AND r.dow = dayofweek(date) + 1"""


def share_estimates(d: Data):
    return d.stage("share", lambda: share.share_reach(d["f_second_platform"], d["f_population"], ratios(d)))


@query("share_reach", "SELECT date, country, app, round(ratio, 12) AS ratio, round(p, 12) AS p FROM v_share")
def _(d):
    return share_estimates(d)


# ---- trends

# Sets of anchor days that have one trend, as days before the subject day.
SETS = ((7, 6, 5, 4, 3, 2, 1), (3, 2, 1), (7, 6))


def set_name(days) -> str:
    return " || ',' || ".join(f"CAST(date - {d} AS VARCHAR)" for d in days)


def trend_sql(sets) -> str:
    """Trends of every date with seven days before it, from each of these days and from the sets."""
    key = "country, app, source, model_type, model_date"
    group = "country, source, model_type, model_date"
    same = " AND ".join(f"{{0}}.{c} = k.{c}" for c in ("date", *key.split(", ")))
    parts = [
        f"SELECT date, {key}, 'DAY' AS trend_type, CAST(anchor_date AS VARCHAR) AS anchor_dates, p, n, anchor_p, anchor_n, "
        "reliability, anchor_reliability FROM grid"
    ]
    for days in sets:
        parts.append(
            f"SELECT date, {key}, 'AVG_SCALE', {set_name(days)}, avg(p), CAST(ceil(avg(n)) AS BIGINT), avg(anchor_p), "
            f"CAST(ceil(avg(anchor_n)) AS BIGINT), avg(reliability), avg(anchor_reliability) FROM grid "
            f"WHERE date - anchor_date IN ({', '.join(map(str, days))}) GROUP BY date, {key} HAVING count(anchor_date) = {len(days)}"
        )
    return f"""
    WITH sub AS (SELECT date, {key}, p, n, reliability FROM v_src WHERE date >= (SELECT min(date) + 7 FROM v_src)),
    dates AS (SELECT DISTINCT date FROM sub),
    anc AS (SELECT d.date, {key}, v.date AS anchor_date, p AS anchor_p, n AS anchor_n, reliability AS anchor_reliability
      FROM dates d JOIN v_src v ON v.date BETWEEN d.date - 7 AND d.date - 1),
    keys AS (SELECT date, {key} FROM sub UNION SELECT date, {key} FROM anc),
    grid AS (SELECT k.date, k.country, k.app, k.source, k.model_type, k.model_date, sn.n, dn.anchor_date, dn.anchor_n,
        coalesce(s.p, 0) AS p, s.reliability, coalesce(x.anchor_p, 0) AS anchor_p, x.anchor_reliability
      FROM keys k JOIN (SELECT DISTINCT date, {group}, n FROM sub) sn USING (date, {group})
      JOIN (SELECT DISTINCT date, {group}, anchor_date, anchor_n FROM anc) dn USING (date, {group})
      LEFT JOIN sub s ON {same.format('s')} LEFT JOIN anc x ON {same.format('x')} AND x.anchor_date = dn.anchor_date),
    u AS ({" UNION ALL ".join(parts)})
    SELECT date, {key}, trend_type, anchor_dates, p, n, anchor_p, anchor_n, p / nullif(anchor_p, 0) AS trend,
      least(reliability, anchor_reliability) AS reliability FROM u WHERE p > 0 OR anchor_p > 0"""


def merge_sql(trends: str) -> str:
    of = "PARTITION BY date, country, app, trend_type, anchor_dates"
    return f"""
    WITH l AS (SELECT * FROM (SELECT *, max(model_date) OVER (PARTITION BY date, country, app, source, model_type, trend_type,
        anchor_dates) AS newest FROM {trends}) x WHERE model_date = newest),
    w AS (SELECT *, CASE WHEN n > anchor_n THEN anchor_n / n ELSE n / anchor_n END AS st,
        n / sum(n) OVER ({of}) AS w FROM l),
    s AS (SELECT *, w * min(n / w) OVER ({of}) AS sn, w * min(anchor_n / w) OVER ({of}) AS san FROM w),
    g AS (SELECT date, country, app, trend_type, anchor_dates, sum(sn) AS n, sum(san) AS anchor_n,
        sum(p * w) / sum(w) AS p, sum(anchor_p * w) / sum(w) AS anchor_p, sum(st * w) / sum(w) AS stability_score,
        sum(reliability * w) / sum(CASE WHEN reliability IS NOT NULL THEN w END) AS reliability FROM s GROUP BY ALL)
    SELECT *, p / anchor_p AS trend FROM g WHERE anchor_p > 0"""


def flat_trend(df):
    return df.select("*", F.col("trend_id.type").alias("trend_type"), "trend_id.anchor_dates").drop("trend_id")


STAGES["v_trends"] = trend_sql(SETS)
STAGES["v_merged_trends"] = merge_sql("v_trends")
TREND_COLS = """date, country, app, source, model_type, model_date, trend_type, anchor_dates, round(p, 12) AS p, n,
    round(anchor_p, 12) AS anchor_p, anchor_n, round(trend, 12) AS trend, round(reliability, 12) AS reliability"""


@query("trend_day2day", f"SELECT {TREND_COLS} FROM v_trends WHERE trend_type = 'DAY'")
def _(d):
    return flat_trend(trend.daily_trends(daily_sources(d)))


@query("trend_avg_scale", f"SELECT {TREND_COLS} FROM v_trends WHERE trend_type = 'AVG_SCALE'")
def _(d):
    return flat_trend(trend.daily_trends(daily_sources(d), (), SETS))


def merged_trends(d: Data):
    return trend.merge_source_trends(trend.daily_trends(daily_sources(d), sets=SETS))


@query(
    "merge_source_trends",
    """SELECT date, country, app, trend_type, anchor_dates, round(trend, 12) AS trend, round(p, 12) AS p, round(n, 12) AS n,
         round(anchor_p, 12) AS anchor_p, round(anchor_n, 12) AS anchor_n, round(stability_score, 12) AS stability_score,
         round(reliability, 12) AS reliability FROM v_merged_trends""",
)
def _(d):
    return flat_trend(merged_trends(d))


def prior_sql() -> str:
    parts = ["SELECT date, country, app, 'DAY' AS trend_type, CAST(anchor_date AS VARCHAR) AS anchor_dates, CAST(u AS DOUBLE) AS u, CAST(a AS DOUBLE) AS a FROM grid"]
    for days in SETS:
        parts.append(
            f"SELECT date, country, app, 'AVG_SCALE', {set_name(days)}, avg(u), avg(a) FROM grid "
            f"WHERE date - anchor_date IN ({', '.join(map(str, days))}) GROUP BY date, country, app HAVING count(anchor_date) = {len(days)}"
        )
    return f"""
    WITH m AS (SELECT date, country, bundle_id AS app, active_users FROM f_second_platform JOIN v_matches USING (android_id)),
    s AS (SELECT date, country, app, active_users AS u FROM m WHERE date >= (SELECT min(date) + 7 FROM m)),
    a AS (SELECT s.date, m.date AS anchor_date, country, app, active_users AS a
      FROM (SELECT DISTINCT date FROM s) s JOIN m ON m.date BETWEEN s.date - 7 AND s.date - 1),
    k AS (SELECT date, country, app FROM s UNION SELECT date, country, app FROM a),
    grid AS (SELECT k.date, k.country, k.app, c.anchor_date, coalesce(s.u, 0) AS u, coalesce(a.a, 0) AS a
      FROM k JOIN (SELECT DISTINCT date, anchor_date FROM a) c ON c.date = k.date
      LEFT JOIN s ON s.date = k.date AND s.country = k.country AND s.app = k.app
      LEFT JOIN a ON a.date = k.date AND a.country = k.country AND a.app = k.app AND a.anchor_date = c.anchor_date),
    t AS ({" UNION ALL ".join(parts)})
    SELECT date, country, app, trend_type, anchor_dates, u / a AS prior_trend, u AS active_users, a AS anchor_active_users FROM t
    WHERE a > 0"""


STAGES["v_prior_trends"] = prior_sql()


def prior_trends(d: Data):
    matches = match_entities(d["f_match"], d["f_bundle"])
    return trend.prior_trends(d["f_second_platform"], matches, sets=SETS)


@query(
    "prior_trend",
    """SELECT date, country, app, trend_type, anchor_dates, round(prior_trend, 12) AS prior_trend,
         round(active_users, 12) AS active_users, round(anchor_active_users, 12) AS anchor_active_users FROM v_prior_trends""",
)
def _(d):
    return flat_trend(prior_trends(d))


@query(
    "trend_prior_blend",
    """SELECT date, country, app, trend_type, anchor_dates,
         round(CASE WHEN q.prior_trend IS NULL THEN trend ELSE 0.75 * trend + 0.25 * q.prior_trend END, 12) AS trend,
         round(p, 12) AS p, round(n, 12) AS n, round(anchor_p, 12) AS anchor_p, round(anchor_n, 12) AS anchor_n,
         round(stability_score, 12) AS stability_score, round(reliability, 12) AS reliability,
         round(trend, 12) AS clean_trend, round(q.prior_trend, 12) AS prior_trend
       FROM v_merged_trends LEFT JOIN v_prior_trends q USING (date, country, app, trend_type, anchor_dates)""",
)
def _(d):
    return flat_trend(trend.blend_prior(merged_trends(d), prior_trends(d), prior_weight=0.25))


# Every date after the first seven, each from its seven previous days and their average; the SQL unrolls the steps.
CHAIN = [f"2024-01-{n:02}" for n in range(8, 31)]
CHAIN_SET = ((7, 6, 5, 4, 3, 2, 1),)
STAGES["v_chain_trends"] = trend_sql(CHAIN_SET)
STAGES["v_chain"] = merge_sql("v_chain_trends")
STAGES["v_chain_days"] = """
    SELECT *, CAST(unnest(string_split(anchor_dates, ',')) AS DATE) AS one, len(string_split(anchor_dates, ',')) AS n_days FROM v_chain"""
STAGES["v_known07"] = """
    SELECT date AS anchor_date, country, app, p, n, p AS eff FROM v_merged
    WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-07'"""


def step_sql(day: str, known: str) -> str:
    return f"""
    WITH t AS (SELECT * FROM v_chain_days WHERE date = DATE '{day}'),
    j AS (SELECT t.country, t.app, trend_type, anchor_dates, trend, t.p AS tp, t.anchor_p AS tap, t.n AS tn,
        t.anchor_n AS tan, sum(k.p) / max(n_days) AS ap, avg(k.n) AS an,
        sum(k.eff) / max(n_days) AS ae
      FROM t JOIN {known} k ON k.country = t.country AND k.app = t.app AND k.anchor_date = one GROUP BY ALL),
    w AS (SELECT *, ap * trend AS p, sqrt(ae * an * (tap * tan)) AS w0 FROM j WHERE ap > 0),
    v AS (SELECT *, w0 / sum(w0) OVER (PARTITION BY country, app) AS w FROM w),
    g AS (SELECT country, app, sum(p * w) / sum(w) AS p, sum(tp * w) / sum(w) AS eff, ceil(round(sum(tn * w) / sum(w), 9)) AS n,
        count(*) AS n_anchors FROM v GROUP BY ALL
      HAVING round((sum(tap * w) / sum(w)) * ceil(round(sum(tan * w) / sum(w), 9))) > 0),
    r AS (SELECT country, app, p AS raw_p, n AS raw_n FROM v_merged WHERE date = DATE '{day}')
    SELECT DATE '{day}' AS date, coalesce(g.country, r.country) AS country, coalesce(g.app, r.app) AS app,
      coalesce(p, raw_p) AS p, CAST(ceil(coalesce(n, raw_n)) AS BIGINT) AS n, raw_p, coalesce(eff, raw_p) AS eff_p, n_anchors
    FROM g FULL JOIN r ON g.country = r.country AND g.app = r.app"""


for _day in CHAIN:
    _n = int(_day[-2:])
    STAGES[f"v_applied{_n:02}"] = step_sql(_day, f"v_known{_n - 1:02}")
    STAGES[f"v_known{_n:02}"] = f"""
        SELECT * FROM v_known{_n - 1:02} WHERE anchor_date > DATE '{_day}' - 7
        UNION ALL SELECT date, country, app, p, n, eff_p FROM v_applied{_n:02}"""
STAGES["v_applied"] = " UNION ALL ".join(f"SELECT * FROM v_applied{day[-2:]}" for day in CHAIN)


def first_days(d: Data):
    """The days before any trend: the panel's own estimates."""
    raw = daily_estimates(d)
    last = raw.agg(F.date_add(F.min("date"), 6).alias("last"))
    return raw.filter(F.col("date") <= last.scalar()).withColumn("eff_p", F.col("p"))


def applied(d: Data):
    def build():
        raw = daily_estimates(d)
        trends = trend.merge_source_trends(trend.daily_trends(daily_sources(d), sets=CHAIN_SET))
        after = raw.agg(F.date_add(F.min("date"), 7).alias("first"))
        return trend.apply_trends(trends, raw.filter(F.col("date") >= after.scalar()), first_days(d))

    return d.stage("applied", build)


APPLIED_SQL = """SELECT date, country, app, round(p, 12) AS p, n, round(raw_p, 12) AS raw_p, round(eff_p, 12) AS eff_p, n_anchors
       FROM v_applied"""


def counted_anchors(done):
    # size() of a missing list is NULL, as in the counterpart.
    return done.withColumn("n_anchors", F.size("anchors").cast("bigint")).drop("anchors")


@query("apply_trend", APPLIED_SQL)
def _(d):
    return counted_anchors(applied(d))


@query("apply_trend_resumed", APPLIED_SQL)
def _(d):
    """The same table, kept in a folder by date: a first run stops in the middle, a second one goes on after its last date."""
    raw, path = daily_estimates(d), new_folder(d.spark, "estimates")
    trends = d.stage("chain", lambda: trend.merge_source_trends(trend.daily_trends(daily_sources(d), sets=CHAIN_SET)))
    trend.extend_estimates(path, trends, raw, CHAIN[:10], first_days(d), step=5)
    trend.extend_estimates(path, trends, raw, CHAIN, step=7)
    later = trend.estimates_at(d.spark, path).filter(F.col("date") >= F.lit(CHAIN[0]).cast("date"))
    return counted_anchors(later.select("date", "country", "app", "p", "n", "raw_p", "eff_p", "anchors"))


@query(
    "apply_trend_init",
    """SELECT country, app, round(p, 12) AS p, n, round(p, 12) AS raw_p, round(p, 12) AS eff_p, CAST(NULL AS BIGINT) AS n_anchors
       FROM v_merged WHERE date = (SELECT min(date) FROM v_merged)""",
)
def _(d):
    raw = daily_estimates(d)
    first = raw.agg(F.min("date").alias("first"))
    return counted_anchors(trend.initial_estimates(raw.filter(F.col("date") == first.scalar())))


# ---- scale

DAY = "2024-01-28"
COUNTRIES = [840, 826, 124, 36]
MIN_TRUTH = 1000
METADATA_SQL = """
    SELECT bundle_id AS app, id, avg(rating) AS "averageUserRating", min(publisher_name) AS "contentAdvisoryRating",
      max(CASE WHEN chart_rank > 48 THEN 1 ELSE 0 END) AS "hasInAppPurchases", min(category) AS category,
      CAST(sum(chart_rank) AS BIGINT) AS "userRatingCount" FROM f_bundle GROUP BY ALL"""
STAGES["v_metadata"] = METADATA_SQL
STAGES["v_ranks"] = """
    SELECT id, country, category, min(chart_rank) AS rank FROM f_bundle JOIN (
      SELECT DISTINCT country FROM f_population WHERE country <> 36) c ON true GROUP BY ALL"""
STAGES["v_store"] = f"""
    SELECT c.country, m.app, coalesce(r.rank, -1) AS rank, m."averageUserRating", m."contentAdvisoryRating",
      m."hasInAppPurchases", m.category, m."userRatingCount"
    FROM v_metadata m CROSS JOIN (SELECT unnest({COUNTRIES}) AS country) c
    LEFT JOIN v_ranks r ON r.id = m.id AND r.country = c.country AND r.category = m.category"""


def metadata(d: Data):
    in_app = F.max(F.when(F.col("chart_rank") > 48, 1).otherwise(0))
    return d["f_bundle"].groupBy(F.col("bundle_id").alias("app"), "id").agg(
        F.avg("rating").alias("averageUserRating"), F.min("publisher_name").alias("contentAdvisoryRating"),
        in_app.alias("hasInAppPurchases"), F.min("category").alias("category"), F.sum("chart_rank").alias("userRatingCount"),
    )


def store(d: Data):
    listed = d["f_bundle"].groupBy("id", "category").agg(F.min("chart_rank").alias("rank"))
    ranks = listed.withColumn("country", F.explode(F.array(*[F.lit(c) for c in COUNTRIES if c != 36])))
    return scale.store_features(metadata(d), ranks, COUNTRIES)


@query(
    "store_features",
    """SELECT country, app, rank, round("averageUserRating", 12) AS "averageUserRating", "contentAdvisoryRating",
         "hasInAppPurchases", category, "userRatingCount" FROM v_store""",
)
def _(d):
    return store(d)


@query(
    "alias_fix",
    """SELECT date, country, coalesce(f, app) AS app, active_users FROM f_truth
       LEFT JOIN (VALUES ('a3', 'fixed.three'), ('a4', 'fixed.four')) t(a, f) ON a = app""",
)
def _(d):
    aliases = inline_table(d.spark, [("a3", "fixed.three"), ("a4", "fixed.four")], "app string, fixed_app string")
    return scale.fix_aliases(d["f_truth"], aliases)


def scale_sql(estimates: str, column: str, on: str, k: str, min_users: float) -> str:
    return f"""
    SELECT country, CAST(floor(quantile_disc(y / x, 0.5)) AS INTEGER) AS adj FROM (
      SELECT t.country, t.app, avg(active_users) AS y, avg(coalesce(e.{column}, 0)) AS x, avg({k}) AS k
      FROM f_truth t LEFT JOIN {estimates} e ON {on} GROUP BY ALL) a
    WHERE x > 0 AND k >= {min_users} AND y > {MIN_TRUTH} GROUP BY 1"""


ON_DAY = "e.country = t.country AND e.date = t.date AND e.app = t.app"
STAGES["v_raw_adj"] = scale_sql("v_merged", "p", ON_DAY, "coalesce(e.p * e.n, 0)", 0.05)
STAGES["v_share_adj"] = scale_sql("v_share", "p", ON_DAY, "0", 0)
STAGES["v_field_adj"] = scale_sql("v_field_reach", "p", "e.country = t.country AND e.app = t.app", "0", 0)
PERIOD = f"date BETWEEN DATE '{DAY}' - INTERVAL 27 DAY AND DATE '{DAY}'"


def raw_estimates(d: Data):
    return daily_estimates(d).withColumn("k", F.col("p") * F.col("n"))


def field_estimates(d: Data):
    return d.stage("field", lambda: labelled.field_reach(learning_log(d)))


def adjustments(d: Data):
    truth = d["f_truth"]
    return (
        d.stage("adj1", lambda: scale.median_scale(raw_estimates(d), truth, "p", min_users=0.05, min_truth=MIN_TRUTH)),
        d.stage("adj2", lambda: scale.median_scale(share_estimates(d), truth, "p", min_truth=MIN_TRUTH)),
        d.stage("adj3", lambda: scale.median_scale(field_estimates(d), truth, "p", min_truth=MIN_TRUTH, by_date=False)),
    )


def sql_typed(d: Data, out):
    """``out`` with its scales typed as in the SQL, INTEGER, where all scales fit; beyond, where the SQL's cast fails, they stay long."""
    if union_all(df.select("adj") for df in adjustments(d)).agg(fits_int("adj").alias("fits")).first()["fits"]:
        return out.withColumns({c: F.col(c).cast("int") for c in out.columns if c == "adj" or c.endswith("_adj")})
    return out


@query(
    "median_scale",
    """SELECT 'raw' AS signal, country, adj FROM v_raw_adj UNION ALL SELECT 'share', country, adj FROM v_share_adj
       UNION ALL SELECT 'field', country, adj FROM v_field_adj""",
)
def _(d):
    scales = union_all(
        df.select(F.lit(name).alias("signal"), "country", "adj") for name, df in zip(("raw", "share", "field"), adjustments(d))
    )
    return sql_typed(d, scales)


STAGES["v_raw_scaled"] = f"""
    SELECT date, v.country, app, p * adj AS users, adj FROM v_merged v JOIN v_raw_adj a ON a.country = v.country WHERE {PERIOD}"""
STAGES["v_share_scaled"] = f"""
    SELECT date, v.country, app, p * adj AS users, adj FROM v_share v JOIN v_share_adj a ON a.country = v.country WHERE {PERIOD}"""
STAGES["v_days"] = f"SELECT count(DISTINCT date) AS n_days FROM v_merged WHERE {PERIOD}"
STAGES["v_signals"] = """
    WITH r AS (SELECT country, app, max(adj) AS raw_est_adj, count(date) AS days_count, min(date) AS first_seen,
        sum(users) / max(n_days) AS raw_est_active_users FROM v_raw_scaled, v_days GROUP BY ALL),
    s AS (SELECT country, app, max(adj) AS ios_share_adj, sum(users) / max(n_days) AS ios_share_active_users
      FROM v_share_scaled, v_days GROUP BY ALL),
    m AS (SELECT v.country, app, p * adj AS mp_active_users, adj AS mp_adj FROM v_field_reach v
      JOIN v_field_adj a ON a.country = v.country)
    SELECT country, app, coalesce(raw_est_active_users, 0) AS raw_est_active_users, raw_est_adj,
      coalesce(ios_share_active_users, 0) AS ios_share_active_users, ios_share_adj,
      coalesce(mp_active_users, 0) AS mp_active_users, mp_adj, days_count, first_seen
    FROM r FULL JOIN s USING (country, app) FULL JOIN m USING (country, app)"""
SIGNAL_COLS = """country, app, round(raw_est_active_users, 12) AS raw_est_active_users, raw_est_adj,
    round(ios_share_active_users, 12) AS ios_share_active_users, ios_share_adj,
    round(mp_active_users, 12) AS mp_active_users, mp_adj"""


def scaled_signals(d: Data):
    raw_adj, share_adj, field_adj = adjustments(d)
    raw = scale.scale_signal(between_dates(raw_estimates(d), DAY, DAY, 27), raw_adj, "p", "raw_est")
    shares = scale.scale_signal(between_dates(share_estimates(d), DAY, DAY, 27), share_adj, "p", "ios_share")
    field = scale.scale_signal(field_estimates(d), field_adj, "p", "mp")
    return raw, shares, field


@query(
    "scaled_signals",
    """SELECT country, app, max(adj) AS raw_est_adj, count(date) AS days_count, min(date) AS first_seen,
         round(sum(users) / max(n_days), 12) AS raw_est_active_users FROM v_raw_scaled, v_days GROUP BY ALL""",
)
def _(d):
    raw, _, _ = scaled_signals(d)
    n_days = scale.count_days(between_dates(daily_estimates(d), DAY, DAY, 27)).scalar()
    return sql_typed(d, scale.average_signal(raw, "raw_est", n_days, with_days=True))


def signals(d: Data):
    raw, shares, field = scaled_signals(d)
    n_days = scale.count_days(between_dates(daily_estimates(d), DAY, DAY, 27)).scalar()
    return d.stage(
        "signals",
        lambda: scale.join_signals(
            scale.average_signal(raw, "raw_est", n_days, with_days=True),
            scale.average_signal(shares, "ios_share", n_days),
            field,
        ),
    )


@query("joined_signals", f"SELECT {SIGNAL_COLS}, days_count, first_seen FROM v_signals")
def _(d):
    return sql_typed(d, signals(d))


STAGES["v_train"] = f"""
    WITH t AS (SELECT t.country, t.app, avg(active_users) AS ga_active_users, avg(coalesce(r.users, 0)) AS raw_est_active_users,
        avg(coalesce(s.users, 0)) AS ios_share_active_users, max(r.adj) AS raw_est_adj, max(s.adj) AS ios_share_adj
      FROM (SELECT * FROM f_truth WHERE {PERIOD}) t
      LEFT JOIN v_raw_scaled r ON r.country = t.country AND r.app = t.app AND r.date = t.date
      LEFT JOIN v_share_scaled s ON s.country = t.country AND s.app = t.app AND s.date = t.date GROUP BY ALL)
    SELECT t.*, coalesce(p * adj, 0) AS mp_active_users, adj AS mp_adj FROM t
    LEFT JOIN (SELECT v.country, app, p, adj FROM v_field_reach v JOIN v_field_adj a ON a.country = v.country) m
      ON m.country = t.country AND m.app = t.app"""


def training(d: Data):
    raw, shares, field = scaled_signals(d)
    return d.stage(
        "training",
        lambda: scale.join_signals_for_training(between_dates(d["f_truth"], DAY, DAY, 27), raw, shares, field),
    )


@query(
    "joined_signals_train",
    f"SELECT {SIGNAL_COLS}, round(ga_active_users, 12) AS ga_active_users FROM v_train",
)
def _(d):
    return sql_typed(d, training(d))


STAGES["v_features"] = """
    WITH i AS (SELECT s.*, f.* EXCLUDE (country, app), e.* EXCLUDE (app),
        CASE WHEN raw_est_active_users > 10 THEN 1 ELSE 0 END AS raw_est_indicator,
        CASE WHEN ios_share_active_users > 10 THEN 1 ELSE 0 END AS ios_share_est_indicator,
        CASE WHEN mp_active_users > 10 THEN 1 ELSE 0 END AS mp_est_indicator
      FROM v_signals s LEFT JOIN v_store f ON f.country = s.country AND f.app = s.app LEFT JOIN v_eval e ON e.app = s.app)
    SELECT *, (raw_est_active_users + ios_share_active_users + mp_active_users)
        / nullif(raw_est_indicator + ios_share_est_indicator + mp_est_indicator, 0) AS avg_est,
      raw_est_active_users / nullif(ios_share_active_users + mp_active_users, 0) AS raw_est_ratio,
      ios_share_active_users / nullif(raw_est_active_users + mp_active_users, 0) AS ios_share_est_ratio,
      mp_active_users / nullif(ios_share_active_users + raw_est_active_users, 0) AS mp_est_ratio FROM i"""


def features(d: Data):
    return scale.add_features(signals(d), store(d), session_eval(d))


@query(
    "blend_features",
    """SELECT country, app, rank, category, true_n_users, round(n_users_err, 12) AS n_users_err, raw_est_indicator,
         ios_share_est_indicator, mp_est_indicator, round(avg_est, 12) AS avg_est, round(raw_est_ratio, 12) AS raw_est_ratio,
         round(ios_share_est_ratio, 12) AS ios_share_est_ratio, round(mp_est_ratio, 12) AS mp_est_ratio FROM v_features""",
)
def _(d):
    return features(d).select(
        "country", "app", "rank", "category", "true_n_users", "n_users_err", "raw_est_indicator", "ios_share_est_indicator",
        "mp_est_indicator", "avg_est", "raw_est_ratio", "ios_share_est_ratio", "mp_est_ratio",
    )


@query(
    "closest_signal_label",
    """WITH c AS (SELECT country, app, CASE WHEN raw_est_active_users > 10 THEN abs(ga_active_users - raw_est_active_users) END AS a,
         CASE WHEN ios_share_active_users > 10 THEN abs(ga_active_users - ios_share_active_users) END AS b,
         CASE WHEN mp_active_users > 10 THEN abs(ga_active_users - mp_active_users) END AS c FROM v_train)
       SELECT country, app, CASE WHEN a IS NULL AND b IS NULL AND c IS NULL THEN NULL
         WHEN a IS NOT NULL AND a <= coalesce(b, 1e300) AND a <= coalesce(c, 1e300) THEN 0
         WHEN b IS NOT NULL AND b <= coalesce(c, 1e300) THEN 1 ELSE 2 END AS label FROM c""",
)
def _(d):
    return training(d).select("country", "app", scale.closest_signal().alias("label"))


@query("blend_classifier")
def _(d):
    rows = d.stage(
        "blend_training",
        lambda: scale.add_features(training(d), store(d), session_eval(d)).withColumn("label", scale.closest_signal()),
    )
    data = d.stage("blend_features", lambda: features(d))
    return scale.blend_probabilities(data, rows, min_truth=MIN_TRUTH)


PROBS = {"raw_est_model_p": (3, 10), "ios_share_est_model_p": (5, 20), "mp_est_model_p": (7, 30)}
STAGES["v_blended"] = f"""
    WITH q AS (SELECT *, CAST(substr(app, 2) AS BIGINT) AS k FROM v_signals),
    p AS (SELECT q.*, (1 + k % 3) / 10.0 AS raw_p, (1 + k % 5) / 20.0 AS share_p, (1 + k % 7) / 30.0 AS mp_p,
        CASE WHEN raw_est_active_users > 10 THEN 1 ELSE 0 END AS ri, CASE WHEN ios_share_active_users > 10 THEN 1 ELSE 0 END AS si,
        CASE WHEN mp_active_users > 10 THEN 1 ELSE 0 END AS mi FROM q
      WHERE date_diff('day', first_seen, DATE '{DAY}') = 27 AND days_count >= 1),
    b AS (SELECT *, (ri * raw_p * raw_est_active_users + si * share_p * ios_share_active_users + mi * mp_p * mp_active_users)
      / nullif(ri * raw_p + si * share_p + mi * mp_p, 0) AS blended FROM p),
    s AS (SELECT b.*, (blended / population_size) / nullif(raw_est_active_users / nullif(raw_est_adj, 0), 0) AS scale_factor
      FROM b JOIN f_population USING (country))
    SELECT s.country, s.app, coalesce(m.p, 0) * scale_factor AS p, m.n, scale_factor, blended AS blended_active_users, days_count
    FROM s LEFT JOIN (SELECT * FROM v_merged WHERE date = DATE '{DAY}') m ON m.country = s.country AND m.app = s.app"""


def blended(d: Data):
    base = scale.blend_features(signals(d))
    k = F.substring("app", 2, 10).cast("bigint")
    probabilities = base.select(
        "country", "app", *[((1 + k % m) / F.lit(float(by))).alias(c) for c, (m, by) in PROBS.items()]
    )
    today = between_dates(daily_estimates(d), DAY, DAY)
    return scale.blended_scale(base, probabilities, today, d["f_population"], DAY)


@query(
    "blended_scale",
    """SELECT country, app, round(p, 12) AS p, n, round(scale_factor, 12) AS scale_factor,
         round(blended_active_users, 12) AS blended_active_users, days_count FROM v_blended""",
)
def _(d):
    return blended(d).select("country", "app", "p", "n", "scale_factor", "blended_active_users", "days_count")


STAGES["v_dau"] = """
    SELECT m.date, m.country, m.app, b.id AS track_id, p * population_size AS active_users FROM v_merged m
    JOIN f_population USING (country) LEFT JOIN (SELECT DISTINCT bundle_id, id FROM f_bundle) b ON b.bundle_id = m.app"""


def daily_users(d: Data):
    return scale.population_scale(daily_estimates(d), d["f_population"], d["f_bundle"])


@query("population_scale", "SELECT date, country, app, track_id, round(active_users, 12) AS active_users FROM v_dau")
def _(d):
    return daily_users(d)


# ---- calibration


STAGES["v_daily_reach"] = """
    SELECT date, country, app, v / u AS p, v AS users FROM (
      SELECT date, country, app, sum(s) AS v FROM (SELECT date, did, country, app, max(score) AS s FROM f_solved GROUP BY ALL) b
      GROUP BY ALL) k JOIN (SELECT date, country, count(DISTINCT did) AS u FROM f_solved GROUP BY ALL) n USING (date, country)"""
STAGES["v_calibration"] = f"""
    SELECT t.country, t.app, avg(t.active_users) AS y, avg(coalesce(e.p, 0)) AS x, avg(e.users) AS users, count(*) AS n_days,
      coalesce(avg(e.users) >= 0.05, false) AS fit
    FROM (SELECT date, country, app, max(active_users) AS active_users FROM f_truth GROUP BY ALL) t
    LEFT JOIN v_daily_reach e ON {ON_DAY} GROUP BY ALL HAVING avg(coalesce(e.p, 0)) > 0 AND avg(t.active_users) >= {MIN_TRUTH}"""


def hash_sql(k: int, *parts: str) -> str:
    text = "concat_ws('|', " + ", ".join(parts) + ")"
    return f"CAST(('0x' || substr(md5({text}), 1, 8))::BIGINT % {k} AS INTEGER)"


STAGES["v_fold_scales"] = f"""
    WITH t AS (SELECT c.*, f.fold FROM (SELECT *, {hash_sql(5, "'outer'", "country", "app")} AS mine FROM v_calibration WHERE fit) c
        CROSS JOIN (SELECT unnest(range(5))::INTEGER AS fold) f WHERE mine <> f.fold),
    h AS (SELECT *, {hash_sql(3, "'inner'", "fold", "country", "app")} AS part FROM t),
    q AS (SELECT country, fold, i.i AS "inner", quantile_cont(y / x, 0.2) AS low, quantile_cont(y / x, 0.8) AS high
      FROM h JOIN (SELECT unnest(range(3))::INTEGER AS i) i ON part <> i.i GROUP BY ALL),
    c AS (SELECT h.country, h.fold, h.part, a.pos, low + (high - low) * (CAST(a.pos AS DOUBLE) / 99.0) AS cand, y, x
      FROM h JOIN q ON q.country = h.country AND q.fold = h.fold AND q."inner" = h.part
      CROSS JOIN (SELECT unnest(range(100)) AS pos) a),
    l AS (SELECT country, fold, part, pos, cand, median(abs(y - x * cand) / y) AS loss FROM c GROUP BY ALL),
    w AS (SELECT *, row_number() OVER (PARTITION BY country, fold, part ORDER BY loss, pos) AS place FROM l)
    SELECT country, fold, avg(cand) AS adj FROM w WHERE place = 1 GROUP BY ALL"""
STAGES["v_final_scale"] = """
    SELECT country, avg(adj) AS adj FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY adj) - 1 AS pos,
      count(*) OVER (PARTITION BY country) AS k FROM v_fold_scales) x
    WHERE pos >= floor(0.2 * k) AND pos < floor(0.8 * k) GROUP BY 1"""


def daily_reach(d: Data):
    return reach.reach(d["f_solved"], ["date", "country"]).select(
        "date", "country", "app", F.col("dau").alias("p"), F.col("total_visits").alias("users")
    )


def calibration_rows(d: Data):
    return d.stage(
        "calibration_rows", lambda: calibrate.calibration_rows(d["f_truth"], daily_reach(d), MIN_TRUTH, 0.05)
    )


@query(
    "cv_scale_calibration",
    """SELECT r.date, country, app, round(r.p, 12) AS dau_p, round(adj, 12) AS adj, round(adj * r.p, 12) AS dau_abs
       FROM v_daily_reach r JOIN v_final_scale USING (country)""",
)
def _(d):
    final = calibrate.final_scale(calibrate.fold_scales(calibration_rows(d)))
    daily = daily_reach(d).select("date", "country", "app", F.col("p").alias("dau"))
    out = calibrate.apply_calibration(daily, final)
    return out.withColumn("dau_abs", F.round("dau_abs", 12)).withColumn("adj", F.round("adj", 12))


@query(
    "cv_calibration_eval",
    f"""WITH p AS (SELECT c.country, y, adj * x AS yhat FROM (SELECT *, {hash_sql(5, "'outer'", "country", "app")} AS fold
          FROM v_calibration) c JOIN v_fold_scales s ON s.country = c.country AND s.fold = c.fold),
        b AS (SELECT country, y, yhat, unnest([-1, CAST(floor(log10(y)) AS INTEGER)]) AS bucket FROM p)
        SELECT country, bucket, round(median(abs(y - yhat) / y), 12) AS mape,
          round(avg(CASE WHEN abs(y - yhat) / y < 0.3 THEN 1.0 ELSE 0.0 END), 12) AS swacc, count(*) AS n_apps
        FROM b GROUP BY ALL""",
)
def _(d):
    rows = calibration_rows(d)
    return evaluate.bucketed_accuracy(calibrate.held_out_predictions(rows, calibrate.fold_scales(rows)))


@query("median_ratio", "SELECT country, round(median(y / x), 12) AS adj FROM v_calibration GROUP BY 1")
def _(d):
    return calibrate.median_ratio(calibration_rows(d)).withColumn("adj", F.round("adj", 12))


# ---- evaluation


STAGES["v_pairs_eval"] = f"""
    SELECT t.country, t.app, avg(t.active_users) AS y, avg(coalesce(e.active_users, 0)) AS yhat
    FROM (SELECT date, country, app, max(active_users) AS active_users FROM f_truth GROUP BY ALL) t
    LEFT JOIN v_dau e ON {ON_DAY} GROUP BY ALL
    HAVING avg(coalesce(e.active_users, 0)) > 0 AND avg(t.active_users) >= {MIN_TRUTH}"""
STAGES["v_accuracy"] = """
    SELECT country, bucket, median(abs(y - yhat) / y) AS mape,
      avg(CASE WHEN abs(y - yhat) / y < 0.3 THEN 1.0 ELSE 0.0 END) AS swacc, count(*) AS n_apps FROM (
      SELECT *, unnest([-1, CAST(floor(log10(y)) AS INTEGER)]) AS bucket FROM v_pairs_eval) b GROUP BY country, bucket"""


def accuracy(d: Data):
    return evaluate.bucketed_accuracy(evaluate.paired_means(d["f_truth"], daily_users(d), MIN_TRUTH))


@query(
    "bucketed_accuracy",
    "SELECT country, bucket, round(mape, 12) AS mape, round(swacc, 12) AS swacc, n_apps FROM v_accuracy",
)
def _(d):
    return accuracy(d)


@query(
    "coverage",
    """SELECT country, count(DISTINCT app) AS coverage FROM (
         SELECT country, app, sum(active_users) / (SELECT count(DISTINCT date) FROM v_dau) AS m FROM v_dau GROUP BY ALL) x
       WHERE m >= 400 GROUP BY 1""",
)
def _(d):
    return evaluate.coverage(daily_users(d), 400.0)


@query(
    "accuracy_with_coverage",
    """SELECT country, bucket, round(mape, 12) AS mape, round(swacc, 12) AS swacc, n_apps, CAST(NULL AS BIGINT) AS coverage
       FROM v_accuracy
       UNION ALL SELECT country, NULL, NULL, NULL, NULL, count(DISTINCT app) FROM v_daily_reach JOIN v_final_scale USING (country)
         WHERE adj * p >= 10 GROUP BY country""",
)
def _(d):
    final = calibrate.final_scale(calibrate.fold_scales(calibration_rows(d)))
    daily = daily_reach(d).select("date", "country", "app", F.col("p").alias("dau"))
    covered = evaluate.coverage_of_day(calibrate.apply_calibration(daily, final))
    return evaluate.with_coverage(accuracy(d), covered)


@query(
    "accuracy_rollup",
    """WITH b AS (SELECT date, country, y, yhat, unnest([-1, CAST(floor(log10(y)) AS INTEGER)]) AS bucket FROM (
         SELECT t.date, t.country, CAST(t.active_users AS DOUBLE) AS y, e.active_users AS yhat FROM f_truth t JOIN v_dau e
           ON e.date = t.date AND e.country = t.country AND e.app = t.app WHERE e.active_users > 0 AND t.active_users >= 1000) p),
       a AS (SELECT date, country, bucket, median(abs(y - yhat) / y) AS mape,
         avg(CASE WHEN abs(y - yhat) / y < 0.3 THEN 1.0 ELSE 0.0 END) AS swacc, count(*) AS n_apps FROM b GROUP BY ALL)
       SELECT country, bucket, round(avg(mape), 12) AS mape, round(avg(swacc), 12) AS swacc, round(avg(n_apps), 12) AS n_apps
       FROM a GROUP BY country, bucket""",
)
def _(d):
    day = ["date", "country", "app"]
    pairs = (
        d["f_truth"].select(*day, F.col("active_users").cast("double").alias("y"))
        .join(daily_users(d).select(*day, F.col("active_users").alias("yhat")), day)
        .filter((F.col("yhat") > 0) & (F.col("y") >= MIN_TRUTH))
    )
    return evaluate.accuracy_rollup(evaluate.bucketed_accuracy(pairs, by=("date",)))

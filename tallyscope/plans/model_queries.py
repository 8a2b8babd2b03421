"""Host-to-app models, session scoring and labelled-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyscope.functions.lineage import new_folder
from tallyscope.operators import cnb, info, labelled, posterior, reach
from tallyscope.plans.base_queries import learning_log, panel_sessions
from tallyscope.plans.registry import Data, query
from tallyscope.plans.views import STAGES
from tallyscope.sources.tables import read_models

# ---- complement naive Bayes

STAGES["v_params"] = """
    WITH f AS (SELECT host, 1.0 / count(DISTINCT app) AS inv_freq FROM f_ls GROUP BY 1),
    l AS (SELECT app, host, hits, is_lab, inv_freq FROM f_ls JOIN f USING (host) WHERE inv_freq >= 0.001),
    h AS (SELECT host, sum(hits) AS hh FROM l GROUP BY 1),
    a AS (SELECT app, sum(hits) AS ah, median(hits) AS am FROM l GROUP BY 1),
    t AS (SELECT sum(hits) AS total FROM l),
    c AS (SELECT app, host, CAST(hh - hits AS DOUBLE) / nullif(CAST(total - ah AS DOUBLE), 0) AS cond_p,
      hits / am AS host_importance, CAST(inv_freq AS DOUBLE) AS inv_freq, hits, is_lab
      FROM l JOIN h USING (host) JOIN a USING (app), t)
    SELECT *, inv_freq = 1 AND host_importance >= 0.5 AND cond_p > -1 AND hits >= 10 AS is_unique FROM c"""
UNIQUE_P = -1.0


def params(d: Data):
    return d.stage("params", lambda: cnb.cnb_params(d["f_ls"], min_cond_p=UNIQUE_P))


@query("host_inv_freq", "SELECT host, round(1.0 / count(DISTINCT app), 12) AS inv_freq FROM f_ls GROUP BY host")
def _(d):
    return cnb.host_inverse_frequency(d["f_ls"])


@query(
    "median_hits_per_app",
    "SELECT app, round(median(hits), 12) AS median_hits, CAST(sum(hits) AS BIGINT) AS hits FROM f_ls GROUP BY app",
)
def _(d):
    return d["f_ls"].groupBy("app").agg(F.median("hits").alias("median_hits"), F.sum("hits").alias("hits"))


@query("cnb_cond_p", "SELECT app, host, round(cond_p, 12) AS cond_p, round(host_importance, 12) AS host_importance FROM v_params")
def _(d):
    return params(d).select("app", "host", "cond_p", "host_importance")


@query(
    "cnb_params",
    """SELECT app, host, round(cond_p, 12) AS cond_p, round(host_importance, 12) AS host_importance,
         round(inv_freq, 12) AS inv_freq, is_unique, hits, is_lab FROM v_params""",
)
def _(d):
    return params(d)


@query(
    "cnb_params_filtered",
    """SELECT app, host, round(cond_p, 12) AS cond_p, hits, is_lab FROM v_params
       WHERE (hits >= 20 OR is_lab) AND cond_p >= 0.001 AND host NOT LIKE '%apple%'""",
)
def _(d):
    return cnb.filter_params(params(d), 20, 0.001, remove_vendor=True).select("app", "host", "cond_p", "hits", "is_lab")


STAGES["v_priors"] = """
    SELECT bundle_id AS app, country, p_prior FROM v_matches JOIN (
      SELECT android_id, country, avg(CAST(active_users AS DOUBLE) / population_size) AS p_prior
      FROM f_second_platform JOIN f_population USING (country)
      WHERE date BETWEEN DATE '2024-01-07' AND DATE '2024-01-13' GROUP BY ALL) t USING (android_id)"""


def priors(d: Data):
    return cnb.usage_priors(
        d["f_second_platform"], d["f_population"], d["f_match"], d["f_bundle"], "2024-01-07", "2024-01-13"
    )


@query("usage_priors", "SELECT app, country, round(p_prior, 12) AS p_prior FROM v_priors")
def _(d):
    return priors(d)


STAGES["v_counts"] = """
    SELECT session_id, did, country, source, host, count(host) AS host_count, min(local_ts) AS local_ts,
      min(utc_ts) AS utc_ts FROM v_sessions GROUP BY session_id, did, country, source, host"""


def counts(d: Data):
    return cnb.session_host_counts(panel_sessions(d))


@query(
    "session_host_counts",
    "SELECT session_id, did, country, source, host, host_count, local_ts, utc_ts FROM v_counts",
)
def _(d):
    return counts(d)


STAGES["v_info"] = """
    SELECT session_id, did, country, source, min(local_ts) AS local_ts, min(utc_ts) AS utc_ts,
      sum(inv_freq * host_count) AS info_q, list_sort(list(concat(host, ':', host_count))) AS hosts
    FROM v_counts JOIN (SELECT DISTINCT host, inv_freq FROM v_params) k USING (host)
    GROUP BY session_id, did, country, source HAVING sum(inv_freq * host_count) >= 1"""


def host_text(hosts):
    """A host map as sorted text, so that both engines show it alike."""
    listed = F.transform(F.map_entries(hosts), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return F.array_join(F.array_sort(listed), ",")


def flat_hosts(df):
    return df.withColumn("hosts", host_text(F.col("hosts")))


@query(
    "session_information",
    """SELECT session_id, did, country, source, local_ts, utc_ts, round(info_q, 12) AS "info_Q",
         array_to_string(hosts, ',') AS hosts FROM v_info""",
)
def _(d):
    return flat_hosts(cnb.session_information(counts(d), params(d)))


def infer_sql(model: str = "v_params") -> str:
    """Every candidate paired with every known host of its session, missing pairs at the smoothing value."""
    return f"""
    WITH s AS (SELECT 1.0 / count(DISTINCT host) AS smooth FROM {model}),
    i AS (SELECT session_id, sum(inv_freq * host_count) AS info_q
      FROM v_counts JOIN (SELECT DISTINCT host, inv_freq FROM {model}) k USING (host) GROUP BY 1),
    h AS (SELECT c.*, info_q FROM v_counts c JOIN i USING (session_id)
      WHERE info_q >= 1 AND host IN (SELECT host FROM {model})),
    a AS (SELECT DISTINCT session_id, app FROM h JOIN {model} USING (host)),
    e AS (SELECT session_id, did, country, source, info_q, a.app,
        sum(ln(1 + host_count) * ln(coalesce(p.cond_p + smooth, smooth))) AS ll
      FROM a JOIN h USING (session_id) LEFT JOIN {model} p ON p.host = h.host AND p.app = a.app, s
      GROUP BY session_id, did, country, source, info_q, a.app)
    SELECT session_id, did, country, source, info_q, app, ll / sum(ll) OVER (PARTITION BY session_id) AS score FROM e"""


STAGES["v_scored"] = infer_sql()


@query(
    "cnb_infer",
    """SELECT session_id, did, country, source, round(info_q, 12) AS "info_Q", app, round(score, 12) AS score FROM v_scored""",
)
def _(d):
    return cnb.infer_sessions(counts(d), params(d)).drop("hosts", "local_ts", "utc_ts")


MODELS = [
    {"model_date": "2023-12-31", "model_type": "NB_1", "is_main_model": True},
    {"model_date": "2023-12-24", "model_type": "NB_1", "is_main_model": False},
]


def model_params(d: Data):
    """Two models in one table: all parameters, and only those with enough hits."""
    both = params(d)
    return cnb.union_models([(both, MODELS[0]), (cnb.filter_params(both, 30), MODELS[1])])


STAGES["v_params_two"] = "SELECT * FROM v_params WHERE hits >= 30 OR is_lab"
STAGES["v_scored_two"] = infer_sql("v_params_two")
STAGES["v_solved_models"] = """
    SELECT *, DATE '2023-12-31' AS model_date, 'NB_1' AS model_type, true AS is_main_model FROM v_scored
    UNION ALL SELECT *, DATE '2023-12-24', 'NB_1', false FROM v_scored_two"""


def scored_models(d: Data, show=None):
    return cnb.infer_sessions(counts(d), model_params(d), models=("model_date", "model_type", "is_main_model"), show=show)


def solved_models(d: Data):
    return d.stage("solved", lambda: scored_models(d))


@query(
    "cnb_infer_multi_model",
    """SELECT session_id, did, country, source, round(info_q, 12) AS "info_Q", app, round(score, 12) AS score,
         model_date, model_type, is_main_model FROM v_solved_models""",
)
def _(d):
    # Read once and without its maps, so it needs no table.
    return scored_models(d).drop("hosts", "local_ts", "utc_ts")


STAGES["v_solved_full"] = """
    WITH seen AS (SELECT session_id, min(local_ts) AS local_ts, min(utc_ts) AS utc_ts, list_sort(list(concat(host, ':', host_count))) AS hosts, true AS main
      FROM v_counts WHERE host IN (SELECT host FROM v_params) GROUP BY 1
      UNION ALL SELECT session_id, min(local_ts), min(utc_ts), list_sort(list(concat(host, ':', host_count))), false
      FROM v_counts WHERE host IN (SELECT host FROM v_params_two) GROUP BY 1)
    SELECT m.session_id, did, country, source, local_ts, utc_ts, info_q, app, array_to_string(hosts, ',') AS hosts, score, model_date, model_type,
      is_main_model FROM v_solved_models m JOIN seen ON seen.session_id = m.session_id AND seen.main = is_main_model"""


@query(
    "cnb_infer_registered",
    """SELECT session_id, did, country, source, local_ts, utc_ts, round(info_q, 12) AS "info_Q", app, hosts, round(score, 12) AS score,
         model_date, model_type, is_main_model FROM v_solved_full""",
)
def _(d):
    """Models are kept in folders of their own and found by the registry's text; the older one has a column more and one less."""
    root, both = new_folder(d.spark, "models"), params(d)
    both.write.parquet(f"{root}/nb/new")
    cnb.filter_params(both, 30).drop("hits").withColumn("note", F.lit("older")).write.parquet(f"{root}/nb/old")
    found = read_models(d.spark, "nb/new,2023-12-31,NB_1,True;nb/old,2023-12-24,NB_1,False", root)
    return cnb.infer_sessions(counts(d), found, models=("model_date", "model_type", "is_main_model"), show=host_text)


STAGES["v_trivial"] = """
    SELECT session_id, did, country, source, local_ts, utc_ts, 1000.0 AS info_q, app, host, 1.0 AS score, model_date,
      model_type, is_main_model FROM v_sessions JOIN (
      SELECT host, app, DATE '2023-12-31' AS model_date, 'NB_1' AS model_type, true AS is_main_model FROM v_params
        WHERE is_unique
      UNION ALL SELECT host, app, DATE '2023-12-24', 'NB_1', false FROM v_params_two WHERE is_unique) u USING (host)"""


@query(
    "trivial_matches",
    """SELECT session_id, did, country, source, local_ts, utc_ts, CAST(info_q AS DOUBLE) AS "info_Q", app,
         concat(host, ':1') AS hosts, CAST(score AS DOUBLE) AS score, model_date, model_type, is_main_model FROM v_trivial""",
)
def _(d):
    return flat_hosts(cnb.trivial_matches(panel_sessions(d), model_params(d)))


STAGES["v_merged_solved"] = """
    WITH t AS (SELECT session_id, min(local_ts) AS local_ts, min(utc_ts) AS utc_ts
      FROM v_counts WHERE host IN (SELECT host FROM v_params) GROUP BY 1),
    t2 AS (SELECT session_id, min(local_ts) AS local_ts, min(utc_ts) AS utc_ts
      FROM v_counts WHERE host IN (SELECT host FROM v_params_two) GROUP BY 1),
    h AS (SELECT session_id, list_sort(list(concat(host, ':', host_count))) AS hosts
      FROM v_counts WHERE host IN (SELECT host FROM v_params) GROUP BY 1),
    h2 AS (SELECT session_id, list_sort(list(concat(host, ':', host_count))) AS hosts
      FROM v_counts WHERE host IN (SELECT host FROM v_params_two) GROUP BY 1),
    u AS (SELECT m.session_id, did, country, source, local_ts, utc_ts, info_q, app, array_to_string(hosts, ',') AS hosts,
        score, model_date, model_type, is_main_model FROM v_solved_models m JOIN t USING (session_id) JOIN h USING (session_id)
        WHERE is_main_model
      UNION ALL SELECT m.session_id, did, country, source, local_ts, utc_ts, info_q, app, array_to_string(hosts, ','),
        score, model_date, model_type, is_main_model FROM v_solved_models m JOIN t2 USING (session_id) JOIN h2 USING (session_id)
        WHERE NOT is_main_model
      UNION ALL SELECT session_id, did, country, source, local_ts, utc_ts, info_q, app, concat(host, ':1'), score,
        model_date, model_type, is_main_model FROM v_trivial)
    SELECT * EXCLUDE (top) FROM (SELECT *, max(info_q) OVER (PARTITION BY session_id, did, country, source, local_ts, utc_ts,
      app, score, model_date, model_type, is_main_model) AS top FROM u) x WHERE info_q = top"""


def merged_solved(d: Data):
    return cnb.merge_trivial(solved_models(d), cnb.trivial_matches(panel_sessions(d), model_params(d)))


@query(
    "solved_with_trivial",
    """SELECT session_id, did, country, source, local_ts, utc_ts, round(info_q, 12) AS "info_Q", app, hosts,
         round(score, 12) AS score, model_date, model_type, is_main_model FROM v_merged_solved""",
)
def _(d):
    # Hosts are shown once per session; the maps themselves are not needed here.
    solved = d.stage("solved_shown", lambda: scored_models(d, host_text))
    return cnb.merge_trivial(solved, flat_hosts(cnb.trivial_matches(panel_sessions(d), model_params(d))))


@query(
    "host_contribution",
    """WITH b AS (SELECT * FROM (SELECT *, max(score) OVER (PARTITION BY session_id, did, country, source, local_ts, utc_ts,
         app, model_date, model_type, is_main_model) AS best FROM v_merged_solved) x WHERE score = best),
       e AS (SELECT country, app, source, model_date, model_type, is_main_model,
         unnest(string_split(hosts, ',')) AS hc FROM b),
       c AS (SELECT country, app, source, split_part(hc, ':', 1) AS host, model_date, model_type, is_main_model,
         sum(ln(CAST(split_part(hc, ':', 2) AS BIGINT) + 1)) AS host_count FROM e GROUP BY ALL)
       SELECT country, app, source, host, model_date, model_type, is_main_model, round(host_count, 12) AS host_count,
         round(inv_freq, 12) AS inv_freq, round(cond_p, 12) AS cond_p
       FROM c LEFT JOIN (SELECT app, host, inv_freq, cond_p, true AS is_main_model FROM v_params
         UNION ALL SELECT app, host, inv_freq, cond_p, false FROM v_params_two) p USING (app, host, is_main_model)""",
)
def _(d):
    return cnb.host_contribution(merged_solved(d), model_params(d))


# ---- labelled log


STAGES["v_blocks"] = """
    WITH a AS (SELECT *, first_time_stamp AS ts FROM v_log), b AS (SELECT *, "timestamp" AS ts FROM v_log),
    f AS (SELECT *, CAST(floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000) AS BIGINT) AS gap FROM a
      WINDOW w AS (PARTITION BY app, did, date ORDER BY ts)),
    l AS (SELECT *, CAST(floor((epoch_us(lag(ts) OVER w) - epoch_us(ts)) / 1000000) AS BIGINT) AS gap FROM b
      WINDOW w AS (PARTITION BY app, did, date ORDER BY ts DESC)),
    u AS (SELECT app, did, date, host, ts, 'first_session' AS session_type, sum(CASE WHEN gap > 172800 THEN 1 ELSE 0 END)
        OVER (PARTITION BY app, did, date ORDER BY ts) AS block FROM f
      UNION ALL SELECT app, did, date, host, ts, 'last_session', sum(CASE WHEN gap > 172800 THEN 1 ELSE 0 END)
        OVER (PARTITION BY app, did, date ORDER BY ts DESC) FROM l),
    n AS (SELECT md5(concat(app, did, CAST(date AS VARCHAR), session_type)) AS session_id, did, app, host, ts FROM u
      WHERE block = 0),
    t AS (SELECT session_id, count(host) AS hits,
        CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS session_length,
        min(ts) AS session_timestamp FROM n GROUP BY 1)
    SELECT n.*, t.* EXCLUDE (session_id) FROM n JOIN t USING (session_id)"""
BLOCK_GAP = 172_800


@query(
    "first_last_sessions",
    "SELECT session_id, did, app, host, ts, hits, session_length, session_timestamp FROM v_blocks",
)
def _(d):
    return labelled.first_last_sessions(learning_log(d), BLOCK_GAP)


STAGES["v_labelled"] = """
    SELECT 840 AS country, '-1' AS source, did, session_id, '-1' AS model, '-1' AS cv, '-1' AS osv, '-1' AS v,
      session_timestamp AS local_ts, session_timestamp AS utc_ts, host, '-1' AS ua, app, hits
    FROM (SELECT *, count(host) OVER (PARTITION BY session_id, app, did) AS n FROM (
      SELECT session_id, did, app, host, session_timestamp, CAST(sum(hits) AS BIGINT) AS hits FROM v_blocks
      WHERE session_length < 200000 GROUP BY ALL) g) h WHERE n >= 1"""


def labelled_sessions(d: Data):
    return labelled.labelled_sessions(learning_log(d), BLOCK_GAP, 200_000, 1)


@query("labelled_sessions", "SELECT * FROM v_labelled")
def _(d):
    return labelled_sessions(d)


#: Offsets of the zoned field log and their minutes, by the device's number.
OFFSETS = {"Z": 0, "+02:00": 120, "-05:30": -330, "+09:00": 540}


def zoned_log(d: Data):
    """The learning log with its times as text: the wall clock of each device with its offset."""
    place = F.pmod(F.substring("did", 2, 20).cast("int"), F.lit(len(OFFSETS))) + 1
    minutes, name = (F.element_at(F.array(*map(F.lit, x)), place) for x in (OFFSETS.values(), OFFSETS))

    def text(time: str):
        shown = F.timestamp_micros(F.unix_micros(time) + minutes.cast("long") * 60_000_000)
        return F.concat(F.date_format(shown, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), name)

    return learning_log(d).withColumns({c: text(c) for c in ("first_time_stamp", "timestamp")})


@query(
    "labelled_sessions_zoned",
    f"""SELECT * REPLACE (utc_ts + to_minutes({list(OFFSETS.values())}[1 + CAST(substr(did, 2) AS INTEGER) % {len(OFFSETS)}]) AS utc_ts)
        FROM v_labelled""",
)
def _(d):
    return labelled.labelled_sessions(zoned_log(d), BLOCK_GAP, 200_000, 1)


STAGES["v_eval"] = """
    WITH p AS (SELECT app, sum(b) AS users, sum(s) AS sessions FROM (
      SELECT did, app, max(score) AS b, sum(score) AS s FROM f_solved GROUP BY ALL) x GROUP BY 1),
    t AS (SELECT app, count(DISTINCT did) AS true_n_users, count(DISTINCT session_id) AS true_n_sessions
      FROM v_labelled GROUP BY 1),
    e AS (SELECT app, true_n_users, true_n_sessions, coalesce(users, 1e-6) / true_n_users AS u,
      coalesce(sessions, 1e-6) / true_n_sessions AS s FROM t LEFT JOIN p USING (app))
    SELECT app, true_n_users, true_n_sessions, CASE WHEN u > 0 THEN ln(u) END AS n_users_err,
      CASE WHEN s > 0 THEN ln(s) END AS n_sessions_err FROM e WHERE u > 0"""


def session_eval(d: Data):
    return d.stage("session_eval", lambda: labelled.session_eval(d["f_solved"], labelled_sessions(d)))


@query(
    "session_eval",
    """SELECT app, true_n_users, true_n_sessions, round(n_users_err, 12) AS n_users_err,
         round(n_sessions_err, 12) AS n_sessions_err FROM v_eval""",
)
def _(d):
    return session_eval(d)


STAGES["v_life_first"] = """
    SELECT date, did, country, min(first_time_stamp) AS start_interval,
      min(first_time_stamp) + INTERVAL 24 HOUR AS end_interval, max("timestamp") AS last_seen
    FROM v_log GROUP BY date, did, country HAVING max("timestamp") >= min(first_time_stamp) + INTERVAL 24 HOUR"""
STAGES["v_life_last"] = """
    SELECT date, did, country, max("timestamp") - INTERVAL 24 HOUR AS start_interval, max("timestamp") AS end_interval,
      min(first_time_stamp) AS first_seen
    FROM v_log GROUP BY date, did, country HAVING min(first_time_stamp) <= max("timestamp") - INTERVAL 24 HOUR"""
STAGES["v_life_later"] = """
    SELECT l.* FROM v_life_last l WHERE EXISTS (SELECT 1 FROM v_life_first f WHERE f.date = l.date AND f.did = l.did
      AND f.country = l.country AND l.start_interval > f.end_interval)"""


def timed(d: Data):
    return labelled.with_times(learning_log(d))


@query(
    "user_life_intervals",
    """SELECT 'first_ts' AS edge, date, did, country, start_interval, end_interval FROM v_life_first
       UNION ALL SELECT 'last_ts', date, did, country, start_interval, end_interval FROM v_life_last""",
)
def _(d):
    cols = ["date", "did", "country", "start_interval", "end_interval"]
    edges = [
        labelled.life_intervals(timed(d), e).select(F.lit(e).alias("edge"), *cols) for e in (labelled.FIRST, labelled.LAST)
    ]
    return edges[0].unionByName(edges[1])


def later_intervals(d: Data):
    first = labelled.life_intervals(timed(d), labelled.FIRST)
    return labelled.non_overlapping(labelled.life_intervals(timed(d), labelled.LAST), first)


@query(
    "non_overlapping_intervals",
    "SELECT date, did, country, start_interval, end_interval, first_seen FROM v_life_later",
)
def _(d):
    return later_intervals(d)


STAGES["v_interval_reach"] = """
    WITH a AS (SELECT app, e.date, e.country, count(DISTINCT e.did) AS activities FROM v_log e JOIN v_life_first f
        ON f.date = e.date AND f.did = e.did AND f.country = e.country AND f.end_interval >= e.first_time_stamp GROUP BY ALL),
    b AS (SELECT app, e.date, e.country, count(DISTINCT e.did) AS activities FROM v_log e JOIN v_life_later f
        ON f.date = e.date AND f.did = e.did AND f.country = e.country AND f.start_interval <= e."timestamp" GROUP BY ALL)
    SELECT app, date, country, activities, active_users, activities / active_users AS dau, 'first_ts' AS day_type
    FROM a JOIN (SELECT date, country, count(DISTINCT did) AS active_users FROM v_life_first GROUP BY ALL) u
      USING (date, country)
    UNION ALL SELECT app, date, country, activities, active_users, activities / active_users, 'last_ts'
    FROM b JOIN (SELECT date, country, count(DISTINCT did) AS active_users FROM v_life_later GROUP BY ALL) u
      USING (date, country)"""


@query(
    "interval_reach",
    "SELECT app, date, country, activities, active_users, round(dau, 12) AS dau, day_type FROM v_interval_reach",
)
def _(d):
    first = labelled.life_intervals(timed(d), labelled.FIRST)
    a = labelled.interval_reach(timed(d), first, labelled.FIRST)
    return a.unionByName(labelled.interval_reach(timed(d), later_intervals(d), labelled.LAST))


STAGES["v_field_reach"] = """
    SELECT app, country, avg(coalesce(dau, 0)) AS p FROM (SELECT DISTINCT app, country FROM v_interval_reach) k
    CROSS JOIN (SELECT DISTINCT date, day_type FROM v_interval_reach) g
    LEFT JOIN v_interval_reach USING (app, country, date, day_type) GROUP BY ALL"""


@query("zero_filled_reach", "SELECT app, country, round(p, 12) AS p FROM v_field_reach")
def _(d):
    return labelled.field_reach(learning_log(d))


# ---- information and posterior models


def seconds(df):
    """Mean epoch seconds to the precision a double of that size keeps."""
    return df.withColumn("avg_session", F.round("avg_session", 12))


STAGES["v_mi"] = """
    WITH b AS (SELECT app, sum(hits) AS bundle_hits, count(DISTINCT host) AS total_distinct_hosts_in_bundle
      FROM f_ls GROUP BY 1),
    h AS (SELECT host, sum(hits) AS hits_of_host FROM f_ls GROUP BY 1), t AS (SELECT sum(hits) AS total FROM f_ls),
    p AS (SELECT app, host, CAST(bundle_hits AS BIGINT) AS bundle_hits, total_distinct_hosts_in_bundle,
        CAST(hits_of_host AS BIGINT) AS hits_of_host, CAST(bundle_hits AS DOUBLE) / total AS prior_bundle_hits,
        CAST(hits_of_host AS DOUBLE) / total AS p_h, CAST(hits AS DOUBLE) / bundle_hits AS p_of_h_given_b
      FROM f_ls JOIN b USING (app) JOIN h USING (host), t),
    q AS (SELECT *, least(prior_bundle_hits * p_of_h_given_b, 1.0) AS p_of_b_h FROM p)
    SELECT *, p_of_b_h / p_h AS p_of_b_given_h, p_of_h_given_b * (ln(p_of_h_given_b) - ln(p_h)) AS mutual_information
    FROM q WHERE p_of_b_h / p_h > 0.001"""


@query(
    "mi_params",
    """SELECT app, host, bundle_hits, total_distinct_hosts_in_bundle, hits_of_host,
         round(prior_bundle_hits, 12) AS prior_bundle_hits, round(p_h, 12) AS p_h, round(p_of_h_given_b, 12) AS p_of_h_given_b,
         round(p_of_b_h, 12) AS p_of_b_h, round(p_of_b_given_h, 12) AS p_of_b_given_h,
         round(mutual_information, 12) AS mutual_information FROM v_mi""",
)
def _(d):
    return info.info_params(d["f_ls"]).drop("hits")


@query(
    "mi_session_score",
    """WITH k AS (SELECT session_id, avg(ts) AS avg_session, count(DISTINCT app) AS n FROM v_sessions JOIN v_mi USING (host)
         GROUP BY 1),
       c AS (SELECT DISTINCT did, country, source, session_id, host FROM v_sessions),
       p AS (SELECT did, country, source, session_id, app, max(prior_bundle_hits) AS prior, sum(mutual_information) AS mi,
           sum(p_of_b_h) AS bundle_prob_by_panel, max(p_of_b_given_h) AS max_p_b_given_h,
           count(DISTINCT host) / max(total_distinct_hosts_in_bundle) AS host_activity_for_bundle
         FROM c JOIN v_mi USING (host) GROUP BY ALL),
       a AS (SELECT p.*, avg_session, n, prior * greatest(mi, 0) AS bh FROM p JOIN k USING (session_id)),
       s AS (SELECT *, bh / (1e-20 + sum(bh) OVER (PARTITION BY session_id)) AS share FROM a),
       e AS (SELECT *, sum(CASE WHEN share > 0 THEN -ln(share) * share END) OVER (PARTITION BY session_id) AS entropy FROM s),
       f AS (SELECT *, 1 - entropy / nullif(ln(n), 0) AS activity FROM e)
       SELECT did, country, source, session_id, app, round(avg_session, 12) AS avg_session, n AS num_bundles_in_session,
         round(bundle_prob_by_panel, 12) AS bundle_prob_by_panel,
         round(host_activity_for_bundle, 12) AS host_activity_for_bundle,
         round(share, 12) AS prob_of_activity_in_session, round(entropy, 12) AS entropy, round(activity, 12) AS activity_in_session,
         round(CASE WHEN activity > 0.1 THEN max_p_b_given_h ELSE 0 END, 12) AS score FROM f""",
)
def _(d):
    scored = info.score_sessions(panel_sessions(d), info.info_params(d["f_ls"]), min_activity=0.1)
    return seconds(scored).select(
        "did", "country", "source", "session_id", "app", "avg_session", "num_bundles_in_session", "bundle_prob_by_panel",
        "host_activity_for_bundle", "prob_of_activity_in_session", "entropy", "activity_in_session", "score",
    )


STAGES["v_portions"] = """
    WITH h AS (SELECT host, sum(hits) AS hits, 1.0 / (1.0 + pow(count(app) / 4.0, 4.0)) AS conf FROM f_ls GROUP BY 1)
    SELECT app, host, conf * h.hits AS total_host_portion, sum(conf * l.hits) AS host_portion_per_bundle
    FROM f_ls l JOIN h USING (host) GROUP BY app, host, conf, h.hits
    HAVING sum(conf * l.hits) / (conf * h.hits) > 0.001"""


def portions(d: Data):
    return posterior.posterior_params(d["f_ls"])


@query(
    "posterior_params",
    """SELECT app, host, round(total_host_portion, 12) AS total_host_portion,
         round(host_portion_per_bundle, 12) AS host_portion_per_bundle FROM v_portions""",
)
def _(d):
    return portions(d)


STAGES["v_pairs"] = """
    SELECT DISTINCT country, did, session_id, app, host, total_host_portion AS t, host_portion_per_bundle AS o, avg_session
    FROM v_sessions JOIN v_portions USING (host) JOIN (
      SELECT country, did, session_id, avg(ts) AS avg_session FROM v_sessions JOIN v_portions USING (host) GROUP BY ALL) m
      USING (country, did, session_id)"""


@query(
    "session_posterior",
    """WITH g AS (SELECT country, did, session_id, app, avg_session, sum(o) AS o, sum(t) AS t, max(o / t) AS m FROM v_pairs
         GROUP BY ALL), p AS (SELECT *, greatest(o / t, m) AS posterior FROM g)
       SELECT country, did, session_id, app, round(avg_session, 12) AS avg_session, round(o, 12) AS expected_hits_given_bundle,
         round(t, 12) AS expected_total_hits, round(m, 12) AS max_single, round(posterior, 12) AS posterior FROM p""",
)
def _(d):
    # The rank is checked by a unit test: float noise decides between equal posteriors.
    return seconds(posterior.session_posterior(panel_sessions(d), portions(d))).drop("order_in_session")


def frame_sql(reach_: int) -> str:
    return f"""
    SELECT country, did, session_id, app, avg_session, posterior FROM (
      SELECT *, greatest(sum(o) OVER f / sum(t) OVER f, max(o / t) OVER f) AS posterior,
        row_number() OVER (PARTITION BY country, did, session_id, app ORDER BY host) AS pos FROM v_pairs
      WINDOW f AS (PARTITION BY country, did, session_id, app ORDER BY host
        ROWS BETWEEN {reach_} PRECEDING AND {reach_} FOLLOWING)) x WHERE pos = 1"""


STAGES["v_frame1"], STAGES["v_frame2"] = frame_sql(1), frame_sql(2)


@query(
    "windowed_posterior",
    """SELECT 1 AS reach, country, did, session_id, app, round(avg_session, 12) AS avg_session,
         round(posterior, 12) AS posterior FROM v_frame1
       UNION ALL SELECT 2, country, did, session_id, app, round(avg_session, 12), round(posterior, 12) FROM v_frame2""",
)
def _(d):
    frames = posterior.first_frame_posteriors(panel_sessions(d), portions(d), (1, 2))
    return seconds(frames.select("reach", *[c for c in frames.columns if c != "reach"]))


@query(
    "posterior_score",
    """WITH g AS (SELECT country, did, session_id, app, avg_session, greatest(sum(o) / sum(t), max(o / t)) AS posterior
         FROM v_pairs GROUP BY ALL)
       SELECT country, did, session_id, app, round(g.avg_session, 12) AS avg_session, round(g.posterior, 12) AS posterior,
         round(a.posterior, 12) AS posterior3, round(b.posterior, 12) AS posterior5,
         round(greatest(g.posterior, a.posterior, b.posterior), 12) AS score
       FROM g JOIN v_frame1 a USING (country, did, session_id, app) JOIN v_frame2 b USING (country, did, session_id, app)""",
)
def _(d):
    return seconds(posterior.posterior_scores(panel_sessions(d), portions(d)))


# ---- reach of solved sessions


STAGES["v_reach"] = """
    SELECT country, source, app, total_visits, total_users, total_visits / total_users AS dau FROM (
      SELECT country, source, app, sum(s) AS total_visits FROM (
        SELECT did, country, source, app, max(score) AS s FROM f_solved GROUP BY ALL) b GROUP BY ALL) k
    JOIN (SELECT country, source, count(DISTINCT did) AS total_users FROM f_solved GROUP BY ALL) n USING (country, source)"""


@query(
    "reach_per_source",
    """SELECT country, source, app, round(total_visits, 12) AS total_visits, total_users, round(dau, 12) AS dau FROM v_reach""",
)
def _(d):
    return reach.reach(d["f_solved"], ["country", "source"])


@query(
    "reach_overall",
    """SELECT country, app, round(total_visits, 12) AS total_visits, total_users, round(total_visits / total_users, 12) AS dau
       FROM (SELECT country, app, sum(s) AS total_visits FROM (
         SELECT did, country, app, max(score) AS s FROM f_solved GROUP BY ALL) b GROUP BY ALL) k
       JOIN (SELECT country, count(DISTINCT did) AS total_users FROM f_solved GROUP BY ALL) n USING (country)""",
)
def _(d):
    return reach.reach(d["f_solved"], ["country"])


@query(
    "merge_sources_totals",
    """SELECT country, app, round(v, 12) AS total_visits, CAST(u AS BIGINT) AS total_users, round(v / u, 12) AS dau
       FROM (SELECT country, app, sum(total_visits) AS v FROM v_reach GROUP BY ALL) a
       JOIN (SELECT country, sum(total_users) AS u FROM (SELECT DISTINCT country, source, total_users FROM v_reach) s
         GROUP BY 1) b USING (country)""",
)
def _(d):
    return reach.merge_source_totals(reach.reach(d["f_solved"], ["country", "source"]))


def daily_sources(d: Data):
    return d.stage("sources", lambda: reach.source_estimation(d["f_solved"], by=("date",)))


@query(
    "raw_source_estimation",
    """SELECT date, country, app, source, model_date, model_type, is_main_model, round(p, 12) AS p, n, reliability FROM v_src""",
)
def _(d):
    return daily_sources(d)


STAGES["v_filled"] = """
    SELECT k.date, k.country, k.app, s.source, s.model_type, s.model_date, coalesce(v.p, 0) AS p, s.n,
      coalesce(v.reliability, 0) AS reliability
    FROM (SELECT DISTINCT date, country, app FROM v_src) k
    JOIN (SELECT DISTINCT date, country, source, model_type, model_date, n FROM v_src) s USING (date, country)
    LEFT JOIN v_src v ON v.date = k.date AND v.country = k.country AND v.app = k.app AND v.source = s.source
      AND v.model_type = s.model_type AND v.model_date = s.model_date AND v.n = s.n"""


@query(
    "zero_fill_sources",
    """SELECT date, country, app, source, model_type, model_date, round(p, 12) AS p, n, reliability FROM v_filled""",
)
def _(d):
    given = daily_sources(d).select("date", "country", "app", "source", "model_type", "model_date", "p", "n", "reliability")
    return reach.zero_fill(
        given, ["date", "country"], ["app"], ["source", "model_type", "model_date", "n"], ["p", "reliability"]
    )


STAGES["v_latest"] = """
    SELECT date, country, app, source, p, n, reliability FROM (
      SELECT f.*, coalesce(a.seen, max(f.model_date) OVER (
        PARTITION BY f.date, f.country, f.app, f.source, f.model_type)) AS latest
      FROM v_filled f LEFT JOIN (SELECT date, country, app, source, model_type, max(model_date) AS seen FROM v_src
        GROUP BY ALL) a USING (date, country, app, source, model_type)) x WHERE model_date = latest"""


@query(
    "latest_model_version",
    "SELECT date, country, app, source, round(p, 12) AS p, n, reliability FROM v_latest",
)
def _(d):
    return reach.fill_and_pick(daily_sources(d), by=("date",))


STAGES["v_merged"] = """
    SELECT date, country, app, sum(p * n) / sum(n) AS p, CAST(sum(n) AS BIGINT) AS n,
      sum(reliability * n) / sum(n) AS reliability FROM v_latest GROUP BY ALL"""


def daily_estimates(d: Data):
    return d.stage("estimates", lambda: reach.merge_newest(daily_sources(d), by=("date",)))


@query(
    "merge_sources_weighted",
    "SELECT date, country, app, round(p, 12) AS p, n, round(reliability, 12) AS reliability FROM v_merged",
)
def _(d):
    return daily_estimates(d)


@query(
    "flagship",
    """WITH s AS (SELECT * FROM v_solved_models),
       b AS (SELECT did, country, source, app, model_date, max(score) AS score FROM s WHERE info_q >= 1 GROUP BY ALL),
       k AS (SELECT country, source, app, model_date, sum(score) AS k FROM b GROUP BY ALL),
       n AS (SELECT country, source, model_date, count(DISTINCT did) AS n FROM b GROUP BY ALL),
       e AS (SELECT country, app, source, model_date, k / n AS p, n FROM k JOIN n USING (country, source, model_date) WHERE k > 0),
       g AS (SELECT a.country, a.app, x.source, x.model_date, coalesce(e.p, 0) AS p, x.n,
           CASE WHEN e.p IS NULL THEN 0 ELSE 1 END AS r
         FROM (SELECT DISTINCT country, app FROM e) a
         JOIN (SELECT DISTINCT country, source, model_date, n FROM e) x USING (country)
         LEFT JOIN e ON e.country = a.country AND e.app = a.app AND e.source = x.source AND e.model_date = x.model_date),
       l AS (SELECT g.*, coalesce(m.seen, max(g.model_date) OVER (PARTITION BY g.country, g.app, g.source)) AS latest
         FROM g LEFT JOIN (SELECT country, app, source, max(model_date) AS seen FROM e GROUP BY ALL) m
           USING (country, app, source))
       SELECT country, app, round(sum(p * n) / sum(n), 12) AS p, CAST(sum(n) AS BIGINT) AS n,
         round(CAST(sum(r * n) AS DOUBLE) / sum(n), 12) AS reliability
       FROM l WHERE model_date = latest GROUP BY ALL""",
)
def _(d):
    # Read twice, but without the maps and times of the sessions.
    scores = d.stage("scores", lambda: scored_models(d).drop("hosts", "local_ts", "utc_ts"))
    return reach.merge_newest(reach.source_estimation(scores))

"""Sources, calendar, preprocessing and association queries."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import functions as F

from tallyscope.functions import dates, exprs
from tallyscope.functions.lineage import new_folder
from tallyscope.functions.urls import url_host, with_domain
from tallyscope.operators import assoc, sessions
from tallyscope.plans.registry import Data, query
from tallyscope.plans.views import STAGES
from tallyscope.sources import tables

GAP_S = 43_200
SESSION_KEYS = ["did", "country", "source"]
# Apps that collect the data, for the learning set.
COLLECTORS = ["a3"]
BLACKLIST = "SELECT DISTINCT host FROM f_ls WHERE is_lab AND hits % 7 = 0"


def order_days(d: Data):
    return d["orders"].select(F.to_date("o_orderdate").alias("date")).distinct()


# ---- sources and calendar


@query("scan_parquet", "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 12) AS qty FROM lineitem GROUP BY 1")
def _(d):
    files = tables.read_parquet(d.spark, f"{d.folder}/lineitem.parquet")
    return files.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@query(
    "scan_json_props",
    "SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL",
)
def _(d):
    parsed = d["events"].select("event_type", F.from_json("props", "k bigint").alias("p"))
    return parsed.groupBy("event_type", F.col("p.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("scan_partitioned", "SELECT date, country, app, active_users FROM f_truth WHERE date >= DATE '2024-01-20'")
def _(d):
    # Written by date, then read back by folder with the partition column restored.
    path = new_folder(d.spark, "partitioned")
    tables.write_parquet(d["f_truth"], path, partition_by=["date"])
    late = tables.read_parquet(d.spark, f"{path}/date=2024-01-[23]*", base_path=path)
    return late.select("date", "country", "app", "active_users")


@query(
    "unfinished_dates",
    """SELECT CAST(day AS DATE) AS date FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS day FROM f_truth)
       WHERE day(day) % 5 = 0 OR CAST(day AS DATE) NOT IN (SELECT date FROM f_truth)""",
)
def _(d):
    # Days are written to folders; every fifth is left without its success marker, as by a job that was interrupted.
    path = new_folder(d.spark, "published")
    d["f_truth"].write.partitionBy("date").parquet(path)
    days = sorted(r["date"] for r in tables.date_folders(d.spark, path).select("date").collect())
    tables.mark_finished(d.spark, path, [x for x in days if x.day % 5])
    return tables.unfinished_dates(d.spark, path, days[0], days[-1])


@query(
    "read_between_dates",
    """SELECT date, country, app, active_users FROM f_truth
       WHERE date BETWEEN DATE '2024-01-10' - INTERVAL 3 DAY AND DATE '2024-01-12'""",
)
def _(d):
    return tables.between_dates(d["f_truth"], "2024-01-10", "2024-01-12", days_back=3).select(
        "date", "country", "app", "active_users"
    )


@query(
    "union_allow_missing",
    """SELECT date, country, app, active_users, CAST(NULL AS BIGINT) AS n FROM f_truth
       UNION ALL SELECT date, country, app, active_users, n FROM f_monthly""",
)
def _(d):
    monthly = d["f_monthly"].select("date", "country", "app", "active_users", "n")
    return tables.union_all([d["f_truth"], monthly], allow_missing=True)


@query(
    "missing_dates",
    """SELECT CAST(x AS DATE) AS date FROM
         (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2005-12-31', INTERVAL 1 DAY)) AS x) c
       WHERE CAST(x AS DATE) NOT IN (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders)""",
)
def _(d):
    days = d["orders"].select(F.to_date("o_orderdate").alias("date"))
    return tables.missing_dates(days, "1995-01-01", "2005-12-31")


@query(
    "add_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders""",
)
def _(d):
    day = F.to_date("o_orderdate")
    parts = d["orders"].select(
        "o_orderkey",
        F.when(F.year(day) >= 2000, F.date_format(day, "yy")).otherwise(F.date_format(day, "yyyy")).alias("year"),
        F.month(day).cast("string").alias("month"),
        F.dayofmonth(day).cast("string").alias("day"),
    )
    return dates.add_date(parts).select("o_orderkey", "date")


@query(
    "add_ymd",
    """SELECT o_orderkey, strftime(o_orderdate, '%y') AS year, strftime(o_orderdate, '%m') AS month,
         strftime(o_orderdate, '%d') AS day FROM orders""",
)
def _(d):
    days = d["orders"].select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return dates.add_ymd(days, year_n_digits=2).select("o_orderkey", "year", "month", "day")


@query(
    "sunday_n_weeks_ago",
    """SELECT o_orderkey,
         CAST(CAST(o_orderdate AS DATE) - INTERVAL (7 * 1 + dayofweek(o_orderdate)) DAY AS DATE) AS sunday,
         CAST(CAST(o_orderdate AS DATE) - INTERVAL (7 * 3 + dayofweek(o_orderdate)) DAY AS DATE) AS earlier FROM orders""",
)
def _(d):
    day = F.to_date("o_orderdate")
    return d["orders"].select(
        "o_orderkey", dates.sunday_weeks_ago(day, 1).alias("sunday"), dates.sunday_weeks_ago(day, 3).alias("earlier")
    )


@query(
    "date_calendar",
    """WITH r AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e
         FROM orders GROUP BY 1),
       c AS (SELECT o_custkey, 'daily' AS mode, CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM r
       UNION ALL SELECT o_custkey, 'weekly', CAST(unnest(generate_series(
         s + INTERVAL ((7 - dayofweek(s)) % 7) DAY, e, INTERVAL 7 DAY)) AS DATE) FROM r
       UNION ALL SELECT o_custkey, 'monthly', CAST(unnest(generate_series(
         date_trunc('month', s), e, INTERVAL 1 MONTH)) AS DATE) FROM r)
       SELECT mode, date, count(*) AS n FROM c GROUP BY ALL""",
)
def _(d):
    day = F.to_date("o_orderdate")
    spans = d["orders"].groupBy("o_custkey").agg(F.min(day).alias("s"), F.max(day).alias("e"))
    starts = {"daily": F.col("s"), "weekly": F.col("s"), "monthly": F.trunc("s", "month")}
    runs = tables.union_all(
        spans.select(F.lit(m).alias("mode"), F.explode(dates.execution_dates(s, "e", m)).alias("date"))
        for m, s in starts.items()
    )
    return runs.groupBy("mode", "date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "weekly_lookback_dates",
    """WITH c AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
       k AS (SELECT day, greatest(day, DATE '1998-03-01' + INTERVAL 84 DAY) AS d FROM c),
       l AS (SELECT day, CAST(d - INTERVAL (7 + dayofweek(d)) DAY AS DATE) AS last FROM k)
       SELECT day, CAST(unnest(generate_series(last - INTERVAL 77 DAY, last, INTERVAL 7 DAY)) AS DATE) AS date FROM l""",
)
def _(d):
    return order_days(d).select(
        F.col("date").alias("day"), F.explode(dates.weekly_lookback("date", 12, dt.date(1998, 3, 1))).alias("date")
    )


@query(
    "month_helpers",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
         CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS previous, last_day(o_orderdate) AS last,
         CAST(day(last_day(o_orderdate)) AS INTEGER) AS n_days FROM orders""",
)
def _(d):
    return order_days(d).select(
        "date", dates.previous_month("date").alias("previous"), F.last_day("date").alias("last"),
        dates.days_in_month("date").alias("n_days"),
    )


@query(
    "historic_months",
    """WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
       s AS (SELECT min(month) AS start FROM m),
       e AS (SELECT month, start, (CASE WHEN month - INTERVAL 1 MONTH < start THEN 1 ELSE 0 END)
           + (CASE WHEN month - INTERVAL 2 MONTH < start THEN 1 ELSE 0 END) AS early FROM m, s)
       SELECT month, CAST(month - INTERVAL 1 MONTH AS DATE) AS date FROM e WHERE month - INTERVAL 1 MONTH >= start
       UNION ALL SELECT month, CAST(month - INTERVAL 2 MONTH AS DATE) FROM e WHERE month - INTERVAL 2 MONTH >= start
       UNION ALL SELECT month, CAST(month + INTERVAL 1 MONTH AS DATE) FROM e WHERE early = 2
       UNION ALL SELECT month, CAST(month + INTERVAL 2 MONTH AS DATE) FROM e WHERE early >= 1""",
)
def _(d):
    months = d["orders"].select(F.trunc("o_orderdate", "month").alias("month")).distinct()
    start = months.agg(F.min("month").alias("start")).scalar()
    return months.withColumn("_start", start).select(
        "month", F.explode(dates.historic_months("month", "_start", 2)).alias("date")
    )


@query(
    "dow_to_number",
    """SELECT dow, CASE dow WHEN 'Sun' THEN 1 WHEN 'Mon' THEN 2 WHEN 'Tue' THEN 3 WHEN 'Wed' THEN 4 WHEN 'Thu' THEN 5
         WHEN 'Fri' THEN 6 ELSE 7 END AS number, count(*) AS n FROM f_ratio GROUP BY ALL""",
)
def _(d):
    return d["f_ratio"].groupBy("dow", exprs.dow_number("dow").alias("number")).agg(F.count(F.lit(1)).alias("n"))


# ---- preprocessing and sessions


@query(
    "ingest_panel_day",
    """SELECT did, country, source, host, local_ts_ms, CAST(u AS TIMESTAMP) AS utc_ts FROM (
         SELECT *, make_timestamp((local_ts_ms // 1000 - (CAST(substr(did, 2) AS BIGINT) % 5 - 2) * 3600) * 1000000) AS u
         FROM f_panel) t WHERE CAST(u - INTERVAL 5 HOUR AS DATE) = DATE '2024-01-10'""",
)
def _(d):
    uploads = (
        d["f_panel"]
        .groupBy("did", "country", "source", "date")
        .agg(F.collect_list(F.struct(F.col("local_ts_ms").alias("ts"), "host", "ua")).alias("events"))
        .withColumn("tz", (F.substring("did", 2, 20).cast("bigint") % 5 - 2) * 3600)
        .drop("date")
    )
    day = sessions.ingest_panel(sessions.explode_uploads(uploads), "2024-01-10")
    return day.select("did", "country", "source", "host", "local_ts_ms", "utc_ts")


CELL_S, MERGE, REQUESTS = 3600, 60, 2
STAGES["v_stretch"] = f"""
    SELECT *, sum(b) OVER (PARTITION BY did, country ORDER BY cell) - 1 AS stretch FROM (
      SELECT *, CASE WHEN lag(kind) OVER w IS NULL OR lag(kind) OVER w <> kind OR cell - lag(cell) OVER w > {MERGE}
          THEN 1 ELSE 0 END AS b FROM (
        SELECT did, country, local_ts_ms // {CELL_S * 1000} AS cell, count(*) AS requests,
          CASE WHEN count(*) >= {REQUESTS} THEN 1 ELSE 0 END AS kind FROM f_panel GROUP BY ALL) c
      WINDOW w AS (PARTITION BY did, country ORDER BY cell)) m"""


@query(
    "fg_bg_split",
    """SELECT did, country, concat(did, '_', CAST(stretch AS BIGINT)) AS session_id, min(kind) AS kind,
         min(cell) AS first_cell, max(cell) AS last_cell, CAST(sum(requests) AS BIGINT) AS requests
       FROM v_stretch GROUP BY did, country, stretch""",
)
def _(d):
    return sessions.foreground_split(d["f_panel"], "local_ts_ms", CELL_S, MERGE, REQUESTS)


@query(
    "foreground_clean",
    f"""SELECT p.event_id, p.did, p.country, p.host, concat(s.did, '_', CAST(s.stretch AS BIGINT)) AS session_id,
          f.first_cell * {CELL_S * 1000} AS start_ms
        FROM f_panel p JOIN v_stretch s ON p.did = s.did AND p.country = s.country
          AND p.local_ts_ms // {CELL_S * 1000} = s.cell
        JOIN (SELECT did, country, stretch, min(cell) AS first_cell FROM v_stretch GROUP BY ALL) f
          ON f.did = s.did AND f.country = s.country AND f.stretch = s.stretch
        WHERE s.kind = 1 AND p.country IN (840, 826, 124) AND p.host NOT LIKE '%apple.com'
          AND p.host NOT IN ({BLACKLIST})""",
)
def _(d):
    found = sessions.foreground_events(d["f_panel"], "local_ts_ms", CELL_S, MERGE, REQUESTS)
    banned = d["f_ls"].filter("is_lab AND hits % 7 = 0").select("host")
    clean = sessions.clean_foreground(found, banned, [840, 826, 124], remove_vendor=True)
    return clean.select("event_id", "did", "country", "host", "session_id", "start_ms")


CAP_LEN, CAP_GAP = 86_400_000, 43_200_000
STAGES["v_capped"] = f"""
    WITH g AS (SELECT *, local_ts_ms - lag(local_ts_ms) OVER k AS gap FROM f_panel
        WINDOW k AS (PARTITION BY did, country, source, model, cv, osv, v ORDER BY local_ts_ms)),
    o AS (SELECT *, CASE WHEN gap IS NULL OR gap > {CAP_GAP} THEN 1 ELSE 0 END AS opens FROM g),
    r AS (SELECT *, sum(opens) OVER (PARTITION BY did, country, source, model, cv, osv, v ORDER BY local_ts_ms
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM o),
    l AS (SELECT did, country, source, model, cv, osv, v, grp,
        CAST(floor((max(local_ts_ms) - min(local_ts_ms)) / {CAP_LEN}) AS BIGINT) AS cuts FROM r GROUP BY ALL),
    k AS (SELECT r.*, l.cuts, rank() OVER (PARTITION BY r.did, r.country, r.source, r.model, r.cv, r.osv, r.v
        ORDER BY CASE WHEN opens = 1 THEN NULL ELSE gap END DESC NULLS LAST) AS rk
      FROM r JOIN l ON r.did = l.did AND r.country = l.country AND r.source = l.source AND r.model = l.model
        AND r.cv = l.cv AND r.osv = l.osv AND r.v = l.v AND r.grp = l.grp)
    SELECT *, sum(greatest(opens, CASE WHEN rk <= cuts THEN 1 ELSE 0 END)) OVER (
      PARTITION BY did, country, source, model, cv, osv, v ORDER BY local_ts_ms
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS final FROM k"""


@query(
    "sessionize_capped",
    """SELECT event_id, md5(concat_ws(chr(31), CAST(final AS BIGINT), did, country, source, model, cv, osv, v)) AS session_id
       FROM v_capped""",
)
def _(d):
    found = sessions.sessionize_capped(d["f_panel"], CAP_LEN, CAP_GAP, slice_ms=5 * 86_400_000)
    return found.select("event_id", "session_id")


STAGES["v_sessions"] = f"""
    WITH p AS (SELECT *, max(ts) OVER (PARTITION BY did, country, source ORDER BY ts
          RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
        rank() OVER (PARTITION BY did, country, source ORDER BY ts) AS place FROM f_panel),
    s AS (SELECT *, max(CASE WHEN before IS NULL OR ts - before > {GAP_S} THEN place END) OVER (
        PARTITION BY did, country, source ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first
      FROM p)
    SELECT * EXCLUDE (before, place, first), concat_ws('-', did, country, source, first) AS session_id FROM s"""


def panel_sessions(d: Data):
    return sessions.sessionize(d["f_panel"], SESSION_KEYS, GAP_S, slice_width=5 * 86_400)


@query("sessionize_gap", "SELECT event_id, session_id FROM v_sessions")
def _(d):
    return panel_sessions(d).select("event_id", "session_id")


@query(
    "paint_sessions",
    """SELECT s.event_id, s.session_id, round(a.median_p_browsing, 12) AS median_p_browsing,
         round(a.mean_p_browsing, 12) AS mean_p_browsing
       FROM v_sessions s LEFT JOIN (
         SELECT session_id, quantile_disc(p_browsing, 0.5) AS median_p_browsing, avg(p_browsing) AS mean_p_browsing
         FROM v_sessions JOIN f_browsing USING (host) GROUP BY 1) a USING (session_id)""",
)
def _(d):
    return sessions.paint_sessions(panel_sessions(d), d["f_browsing"]).select(
        "event_id", "session_id", "median_p_browsing", "mean_p_browsing"
    )


# ---- association and learning sets


@query(
    "phi_correlation",
    """WITH u AS (SELECT DISTINCT host, country, did FROM f_panel),
       n AS (SELECT count(DISTINCT did) AS n FROM u),
       x AS (SELECT host, count(DISTINCT did) AS x FROM u GROUP BY 1),
       y AS (SELECT country, count(DISTINCT did) AS y FROM u GROUP BY 1),
       xy AS (SELECT host, country, count(DISTINCT did) AS xy FROM u GROUP BY ALL),
       p AS (SELECT host, country, n AS "N", x / n AS px, y / n AS py, xy / n AS pxy
         FROM xy JOIN x USING (host) JOIN y USING (country), n)
       SELECT host, country, "N", round(px, 12) AS px, round(py, 12) AS py, round(pxy, 12) AS pxy,
         round((pxy - px * py) / nullif(sqrt(px * (1 - px)) * sqrt(py * (1 - py)), 0), 12) AS correlation FROM p""",
)
def _(d):
    return assoc.correlate(d["f_panel"], "host", "country", ["did"])


@query(
    "url_host",
    """SELECT page_id, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS host FROM f_urls""",
)
def _(d):
    return d["f_urls"].select("page_id", url_host("url").alias("host"))


STAGES["v_url_hosts"] = """
    SELECT DISTINCT regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS host FROM f_urls
    UNION SELECT host FROM f_edges UNION SELECT target FROM f_edges"""


def domain_sql(source: str, column: str = "host") -> str:
    """Registered domain of every distinct value of a column."""
    return f"""
    SELECT raw AS {column}, CASE WHEN regexp_matches(name, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$') THEN name || '.'
        WHEN suffix IS NULL THEN list_extract(string_split(name, '.'), -1) || '.'
        WHEN length(suffix) = length(name) THEN '.' || suffix
        ELSE list_extract(string_split(name[:length(name) - length(suffix) - 1], '.'), -1) || '.' || suffix END AS domain
    FROM (SELECT raw, name, coalesce(max(CASE WHEN rule LIKE '!%' THEN found END), arg_max(found, length(found))) AS suffix FROM (
        SELECT raw, name, suffix AS rule, CASE
            WHEN suffix LIKE '!%' THEN substr(suffix, strpos(suffix, '.') + 1)
            WHEN suffix LIKE '*.%' THEN list_extract(string_split(name[:length(name) - length(suffix) + 1], '.'), -1) || suffix[2:]
            ELSE suffix END AS found
        FROM (SELECT DISTINCT {column} AS raw,
            regexp_replace(lower({column}), '^.*@|:[0-9]*$|[.]$', '', 'g') AS name FROM {source}) h
        LEFT JOIN f_suffix ON name = ltrim(suffix, '!') OR ends_with(name, '.' || ltrim(suffix, '!*.'))) r
      GROUP BY raw, name) t"""


@query("registered_domain", domain_sql("v_url_hosts"))
def _(d):
    hosts = tables.union_all(
        [
            d["f_urls"].select(url_host("url").alias("host")),
            d["f_edges"].select("host"),
            d["f_edges"].select(F.col("target").alias("host")),
        ]
    ).distinct()
    return with_domain(hosts, d["f_suffix"])


@query(
    "weighted_avg",
    """SELECT l_returnflag, l_linestatus,
         round(sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0), 12) AS discount,
         round(sum(v * l_quantity) / nullif(sum(CASE WHEN v IS NOT NULL THEN l_quantity END), 0), 12) AS some
       FROM (SELECT *, CASE WHEN l_linenumber <> 2 THEN l_tax END AS v FROM lineitem) t GROUP BY ALL""",
)
def _(d):
    some = F.when(F.col("l_linenumber") != 2, F.col("l_tax"))
    return (
        d["lineitem"].withColumn("v", some).groupBy("l_returnflag", "l_linestatus")
        .agg(exprs.w_avg("l_discount", "l_quantity").alias("discount"), exprs.w_avg("v", "l_quantity").alias("some"))
    )


@query(
    "binomial_mean",
    """SELECT l_suppkey, round((p * n + 1) / (n + 2), 12) AS mean FROM (
         SELECT l_suppkey, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS p, count(*) AS n
         FROM lineitem GROUP BY 1) t""",
)
def _(d):
    returned = F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    rates = d["lineitem"].groupBy("l_suppkey").agg(F.avg(returned).alias("p"), F.count(F.lit(1)).alias("n"))
    return rates.select("l_suppkey", exprs.binomial_mean("p", "n").alias("mean"))


STAGES["v_matches"] = """
    SELECT DISTINCT m.android_id, b.bundle_id FROM (SELECT DISTINCT bundle_id, id FROM f_bundle) b
    JOIN (SELECT DISTINCT android_id, ios_id FROM f_match WHERE label = 1) m ON b.id = m.ios_id"""


@query("match_entities", "SELECT android_id, bundle_id FROM v_matches")
def _(d):
    return assoc.match_entities(d["f_match"], d["f_bundle"])


APP_BLACKLIST = ["a7", "a13"]
STAGES["v_log"] = """
    SELECT bundle_id AS app, domain AS host, hits, user_id AS did, first_time_stamp, "timestamp", date, country
    FROM f_field_log WHERE bundle_id IS NOT NULL AND domain IS NOT NULL AND domain_classification <> '2.0'
      AND context_verification_type = '0.0' AND bundle_id NOT IN ('a7', 'a13')"""


def learning_log(d: Data):
    return assoc.learning_log(d["f_field_log"], APP_BLACKLIST)


@query(
    "learning_log_filter",
    """SELECT app, host, hits, did, first_time_stamp, "timestamp", date, country FROM v_log""",
)
def _(d):
    return learning_log(d)


@query(
    "trusted_apps_filter",
    """SELECT app, host, hits, did, first_time_stamp, "timestamp", date, country FROM v_log
       WHERE app NOT IN (SELECT app FROM v_log WHERE host IN ('h1', 'h11', 'h5', 'h15') GROUP BY app
           HAVING count(DISTINCT host) >= 2 AND app NOT LIKE '%com.apple%')
         AND app IN (SELECT app FROM v_log GROUP BY app HAVING count(DISTINCT did) >= 10)""",
)
def _(d):
    return assoc.trusted_apps(learning_log(d), ["h1", "h11", "h5", "h15"], 10)


STAGES["v_lab"] = """
    SELECT app, host, count(*) AS hits FROM (SELECT DISTINCT bundle_id AS app, bundle_version, host FROM f_lab_log
      WHERE host <> '' AND bundle_id NOT LIKE '%com.apple%') t GROUP BY ALL"""


@query("lab_learning_set", "SELECT app, host, hits FROM v_lab")
def _(d):
    return assoc.lab_learning_set(d["f_lab_log"])


@query(
    "learning_set",
    """SELECT app, host, CAST(sum(hits) AS BIGINT) AS hits, max(is_lab) AS is_lab FROM (
         SELECT app, host, hits, false AS is_lab FROM v_log UNION ALL SELECT app, host, hits, true FROM v_lab) t
       WHERE app NOT IN ('a3') AND host NOT LIKE '%apple%' AND host NOT LIKE '%icloud%' GROUP BY app, host""",
)
def _(d):
    return assoc.learning_set(learning_log(d), assoc.lab_learning_set(d["f_lab_log"]), COLLECTORS, remove_vendor=True)

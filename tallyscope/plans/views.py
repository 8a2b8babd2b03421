"""Input views over the driver tables, written once for both engines.

The templates are plain SQL with table names in braces. Only the epoch functions and quoting differ between the
engines (``{sec}``, ``{ms}``, ``{q}``). Stage views, used by the SQL counterparts of later stages, follow in ``STAGES``.
"""

from __future__ import annotations

import re

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

SPARK = {
    "sec": "CAST(unix_seconds(CAST(ts AS TIMESTAMP)) AS INT)",
    "ms": "unix_millis(CAST(ts AS TIMESTAMP))",
    "q": "`",
}
DUCKDB = {
    "sec": "CAST(floor(epoch(ts)) AS INT)",
    "ms": "epoch_us(ts) // 1000",
    "q": '"',
}


def _country(n: str) -> str:
    return f"CASE {n} % 4 WHEN 0 THEN 840 WHEN 1 THEN 826 WHEN 2 THEN 124 ELSE 36 END"


def _host(n: str) -> str:
    """Host name of graph vertex n: an own label below one of five registered names."""
    return (
        f"concat('h', {n}, '.', CASE {n} % 5 WHEN 0 THEN 'ring' WHEN 1 THEN 'widget' WHEN 2 THEN 'brand' "
        f"WHEN 3 THEN concat('dom', {n} % 97) ELSE concat('a', {n} % 50) END, "
        f"CASE WHEN {n} % 3 = 0 THEN '.co.uk' ELSE '.com' END)"
    )


VIEWS: dict[str, str] = {
    "f_panel": f"""
        SELECT event_id, concat('d', user_id) AS did, {_country('user_id')} AS country,
          concat('s', user_id % 3) AS source, 'm1' AS model, 'c1' AS cv, 'o1' AS osv, 'v1' AS v,
          CASE WHEN k < 80 THEN concat('h', k % 40) ELSE concat('u', k % 20) END AS host, 'ua' AS ua,
          CAST(ts AS TIMESTAMP) AS local_ts, CAST(ts AS TIMESTAMP) AS utc_ts, {{sec}} AS ts, {{ms}} AS local_ts_ms,
          CAST(ts AS DATE) AS date
        FROM (SELECT e.*, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM {{events}} e) e""",
    "f_ls": """
        SELECT app, host, CAST(sum(hits) AS BIGINT) AS hits, max(is_lab) AS is_lab FROM (
          SELECT concat('a', l_partkey % 50) AS app,
            concat('h', ((l_partkey % 50) * 3 + l_suppkey % 7) % 40) AS host,
            1 AS hits, l_returnflag = 'R' AND l_linenumber = 1 AS is_lab FROM {lineitem}
          UNION ALL
          SELECT concat('a', p_partkey % 50),
            CASE WHEN p_partkey % 50 < 20 THEN concat('u', p_partkey % 50) ELSE concat('h', p_partkey % 40) END,
            p_size, false FROM {part}
        ) t GROUP BY app, host""",
    "f_lab_log": """
        SELECT concat('a', l_partkey % 50) AS bundle_id, l_linenumber AS bundle_version,
          CASE WHEN l_suppkey % 29 = 0 THEN '' ELSE concat('h', l_suppkey % 40) END AS host FROM {lineitem}""",
    "f_field_log": """
        SELECT concat('a', event_id % 50) AS bundle_id, concat('h', event_id % 40) AS domain, 1 + event_id % 5 AS hits,
          CASE WHEN event_id % 11 = 0 THEN '2.0' ELSE '1.0' END AS domain_classification,
          CASE WHEN event_id % 13 = 0 THEN '1.0' ELSE '0.0' END AS context_verification_type,
          concat('d', user_id) AS user_id, CAST(ts AS TIMESTAMP) AS first_time_stamp,
          CAST(ts AS TIMESTAMP) + INTERVAL '2' HOUR AS {q}timestamp{q},
          CAST(date_trunc('week', ts) AS DATE) AS date, 840 AS country FROM {events}""",
    "f_solved": f"""
        SELECT CAST(ts AS DATE) AS date, concat('d', user_id, '-', CAST(CAST(ts AS DATE) AS STRING)) AS session_id,
          concat('d', user_id) AS did, {_country('user_id')} AS country, concat('s', user_id % 3) AS source,
          concat('a', event_id % 50) AS app, value / 500 AS score, value / 25 AS info_q,
          CASE WHEN event_id % 3 = 0 THEN DATE '2023-12-24' ELSE DATE '2023-12-31' END AS model_date,
          'NB_1' AS model_type, event_id % 3 <> 0 AS is_main_model FROM {{events}}""",
    "f_truth": f"""
        SELECT CAST(ts AS DATE) AS date, {_country('user_id')} AS country, concat('a', event_id % 50) AS app,
          CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) * 3 AS active_users FROM {{events}} GROUP BY 1, 2, 3""",
    "f_second_platform": f"""
        SELECT CAST(ts AS DATE) AS date, {_country('user_id')} AS country,
          concat('and', (event_id * 7) % 50) AS android_id, count(*) * 1000 AS active_users FROM {{events}} GROUP BY 1, 2, 3""",
    "f_match": """
        SELECT concat('and', p_partkey % 50) AS android_id, CAST(p_partkey % 50 AS STRING) AS ios_id,
          CASE WHEN p_partkey % 9 = 0 THEN 0 ELSE 1 END AS label FROM {part}""",
    "f_bundle": """
        SELECT CAST(p_partkey % 50 AS STRING) AS id, concat('a', p_partkey % 50) AS bundle_id, p_type AS category,
          p_name AS app_name, p_brand AS publisher_name, p_size AS chart_rank, p_retailprice AS rating FROM {part}""",
    "f_population": f"""
        SELECT {_country('c_nationkey')} AS country, count(*) * 10000 AS population_size FROM {{customer}} GROUP BY 1""",
    "f_ratio": f"""
        SELECT concat('a', l_partkey % 50) AS app_ios, concat('and', l_partkey % 50) AS app_android,
          {_country('l_suppkey')} AS country,
          CASE l_linenumber WHEN 1 THEN 'Sun' WHEN 2 THEN 'Mon' WHEN 3 THEN 'Tue' WHEN 4 THEN 'Wed' WHEN 5 THEN 'Thu'
            WHEN 6 THEN 'Fri' ELSE 'Sat' END AS dow,
          CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_discount * 10 END AS ios_ratio FROM {{lineitem}}""",
    "f_country_ratio": f"""
        SELECT {_country('c_nationkey')} AS country, abs(c_acctbal) / 20000 AS country_ratio FROM {{customer}}""",
    "f_category_ratio": f"""
        SELECT {_country('l_suppkey')} AS country, p_type AS category,
          CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE l_tax * 5 END AS category_country_ratio,
          l_discount * 5 AS neighbour_category_country_ratio
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "f_monthly": f"""
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, concat('a', o_custkey % 50) AS app,
          {_country('o_custkey')} AS country,
          CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS legacy_users,
          CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) * 11 AS active_users, count(*) AS n
        FROM {{orders}} GROUP BY 1, 2, 3""",
    "f_edges": f"""
        SELECT {_host('a')} AS host, {_host('b')} AS target,
          CAST((a * 31 + b * 17) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS correlation
        FROM (SELECT DISTINCT least(x.o_custkey, y.o_custkey) AS a, greatest(x.o_custkey, y.o_custkey) AS b
          FROM {{orders}} x JOIN (
            SELECT o_custkey, o_orderkey - 1 AS near FROM {{orders}}
            UNION ALL SELECT o_custkey, o_orderkey - 2 AS near FROM {{orders}}) y
          ON x.o_orderkey = y.near
          WHERE x.o_custkey <> y.o_custkey) p""",
    "f_lab_corr": f"""
        SELECT DISTINCT concat('a', o_orderkey % 50) AS bundle_id, {_host('o_custkey')} AS host,
          CAST(((o_orderkey % 50) * 7 + o_custkey * 3) % 10 AS DOUBLE) / CAST(10 AS DOUBLE) AS correlation
        FROM {{orders}}""",
    "f_order_panel": f"""
        SELECT 840 AS country, concat('d', CAST(floor(o_orderkey / 30) AS BIGINT)) AS did,
          concat('o', CAST(floor(o_orderkey / 3) AS BIGINT)) AS session_id, {_host('o_custkey')} AS host, o_orderkey AS ts
        FROM {{orders}}""",
    "f_app_pages": f"""
        SELECT concat('a', p_partkey % 50) AS bundle_id, min(p_name) AS app_name, min(p_brand) AS publisher_name,
          concat('https://', {_host('min(p_partkey)')}, '/about') AS publisher_url,
          concat('https://', {_host('max(p_partkey)')}, ':443/privacy') AS privacy_url
        FROM {{part}} GROUP BY p_partkey % 50""",
    "f_browsing": """
        SELECT host, CAST(sum(hits) % 97 AS DOUBLE) / CAST(97 AS DOUBLE) AS p_browsing FROM {f_ls} GROUP BY host""",
    "f_urls": "SELECT page_id, url FROM {pages}",
    "f_suffix": "SELECT * FROM (VALUES ('com'), ('net'), ('org'), ('example.com'), ('co.uk'), ('*.net'), ('!example.net'), ('*.org')) t(suffix)",
}

# SQL of stages, for the counterparts only.
STAGES: dict[str, str] = {
    "v_src": """
        SELECT s.date, s.country, s.app, s.source, s.model_date, s.model_type, s.is_main_model, s.k / u.n AS p, u.n,
          CAST(1 AS DOUBLE) AS reliability
        FROM (SELECT date, country, app, source, model_date, model_type, is_main_model, sum(score) AS k FROM (
            SELECT date, did, country, app, source, model_date, model_type, is_main_model, max(score) AS score
            FROM f_solved WHERE info_q >= 1 GROUP BY ALL) b GROUP BY ALL) s
        JOIN (SELECT date, country, source, model_date, model_type, is_main_model, count(DISTINCT did) AS n
          FROM f_solved WHERE info_q >= 1 GROUP BY ALL) u
        USING (date, country, source, model_date, model_type, is_main_model)
        WHERE s.k > 0""",
}

_NAME = re.compile(r"\b[fv]_[a-z0-9_]+\b")


def spark_text(name: str) -> tuple[str, list[str]]:
    """Spark SQL of an input view, and the tables and views it reads."""
    text = VIEWS[name]
    for key, value in SPARK.items():
        text = text.replace("{" + key + "}", value)
    return text, re.findall(r"\{([a-z0-9_]+)\}", text)


def duckdb_text(name: str) -> str:
    if name in STAGES:
        return STAGES[name]
    text = VIEWS[name]
    for key, value in DUCKDB.items():
        text = text.replace("{" + key + "}", value)
    return re.sub(r"\{([a-z0-9_]+)\}", r"\1", text)


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the definitions of all views it names, in order of need."""
    done: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name not in done and (name in VIEWS or name in STAGES):
                body = duckdb_text(name)
                visit(body)
                done[name] = body

    visit(sql)
    if not done:
        return sql
    # Stages are read by several later ones: computed once, or a chain of them doubles with every link.
    kept = {name: " MATERIALIZED" if name in STAGES else "" for name in done}
    head = ",\n".join(f"{name} AS{kept[name]} ({body})" for name, body in done.items())
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql)
    if own is None:
        return f"WITH {head}\n{sql}"
    return f"WITH {own.group(1) or ''}{head},\n{sql[own.end():]}"

import datetime as dt
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyscope.functions.quantile import grouped_quantiles
from tallyscope.operators import cliques, cnb, evaluate, info, monthly, posterior, reach, scale, trend


def scored_reference(hosts, params):
    """Every candidate paired with every known host."""
    smooth = 1 / len({h for h, _ in params})
    known = {h: c for h, c in hosts.items() if any(h == x for x, _ in params)}
    apps = {a for h, a in params if h in known}
    ll = {
        a: sum(math.log(1 + c) * math.log(params.get((h, a), 0) + smooth) for h, c in known.items()) for a in apps
    }
    return {a: v / sum(ll.values()) for a, v in ll.items()}


def test_scores_equal_full_pairing_and_sum_to_one(spark):
    rng = random.Random(5)
    params = {(f"h{i}", f"a{rng.randrange(6)}"): rng.random() for i in range(12) for _ in range(2)}
    sessions = {f"s{k}": {f"h{rng.randrange(15)}": rng.randrange(1, 9) for _ in range(5)} for k in range(20)}
    p = spark.createDataFrame([(a, h, c, 1.0) for (h, a), c in params.items()], "app string, host string, cond_p double, inv_freq double")
    rows = [(s, "d", 1, "x", h, c) for s, hs in sessions.items() for h, c in hs.items()]
    counts = spark.createDataFrame(rows, "session_id string, did string, country int, source string, host string, host_count bigint")
    counts = counts.withColumn("local_ts", F.lit("2024-01-01").cast("timestamp")).withColumn("utc_ts", F.col("local_ts"))
    found = {}
    for r in cnb.infer_sessions(counts, p, min_info=0.0).collect():
        found.setdefault(r.session_id, {})[r.app] = r.score
    for s, hs in sessions.items():
        want = scored_reference(hs, params)
        if want:
            assert found[s] == pytest.approx(want)
            assert sum(found[s].values()) == pytest.approx(1)
        else:
            assert s not in found


def test_one_app_session_has_no_activity(spark):
    ls = spark.createDataFrame([("a", "h1", 5), ("b", "h2", 7)], "app string, host string, hits bigint")
    s = spark.createDataFrame([("s", "d", 1, "x", "h1", 10)], "session_id string, did string, country int, source string, host string, ts int")
    row = info.score_sessions(s, info.info_params(ls)).collect()[0]
    assert row.activity_in_session is None and row.score == 0


def test_rank_of_posteriors_breaks_ties_by_app(spark):
    ls = spark.createDataFrame([("b", "h", 5), ("a", "h", 5), ("c", "g", 9)], "app string, host string, hits bigint")
    s = spark.createDataFrame([("s", "d", 1, h, 10) for h in "gh"], "session_id string, did string, country int, host string, ts int")
    found = posterior.session_posterior(s, posterior.posterior_params(ls)).orderBy("order_in_session").collect()
    assert [r.app for r in found] == ["c", "a", "b"]


def test_grid_free_merge_equals_the_grid(spark):
    rng = random.Random(3)
    rows = []
    for source in "xyz":
        for model, n in (("2024-01-01", rng.randrange(5, 50)), ("2024-01-08", rng.randrange(5, 50))):
            rows += [(1, f"a{i}", source, "t", model, rng.random(), n, 1.0) for i in range(8) if rng.random() < 0.5]
    df = spark.createDataFrame(
        rows, "country int, app string, source string, model_type string, model_date string, p double, n bigint, reliability double"
    )
    grid = {r.app: (r.p, r.n, r.reliability) for r in reach.merge_sources(reach.fill_and_pick(df)).collect()}
    fused = {r.app: (r.p, r.n, r.reliability) for r in reach.merge_newest(df).collect()}
    assert grid.keys() == fused.keys()
    for app in grid:
        assert fused[app] == pytest.approx(grid[app])


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    rows = [(g, float(v)) for g in "ab" for v in np.concatenate([rng.normal(0, 50, 301), np.repeat(3.5, 40)])]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: r for r in grouped_quantiles(df, ["g"], "v", {"low": 0.2, "mid": 0.5, "high": 0.8}).collect()}
    disc = {r.g: r.mid for r in grouped_quantiles(df, ["g"], "v", {"mid": 0.5}, discrete=True).collect()}
    for g in "ab":
        values = [v for k, v in rows if k == g]
        assert (found[g].low, found[g].mid, found[g].high) == pytest.approx(tuple(np.percentile(values, [20, 50, 80])))
        assert disc[g] == np.percentile(values, 50, method="inverted_cdf")


def brute_cliques(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    names, found = sorted(near), set()
    for mask in range(1, 1 << len(names)):
        members = [n for i, n in enumerate(names) if mask >> i & 1]
        if len(members) > 2 and all(y in near[x] for x in members for y in members if x != y):
            if not any(set(members) <= near[z] for z in names if z not in members):
                found.add(tuple(members))
    return found


def test_maximal_cliques_match_brute_force(spark):
    for seed in (1, 2):
        rng = random.Random(seed)
        edges = [(f"v{i:02}", f"v{j:02}") for i in range(12) for j in range(i) if rng.random() < 0.55]
        df = spark.createDataFrame([(a, b, 0.9) for a, b in edges], "host string, target string, correlation double")
        assert {tuple(r.clique) for r in cliques.maximal_cliques(df).collect()} == brute_cliques(edges)


def test_host_correlation_with_blocks_and_copies(spark, monkeypatch):
    monkeypatch.setattr(cliques, "BLOCK", 2)
    rng = random.Random(4)
    sets = {f"s{k}": {f"h{rng.randrange(9)}" for _ in range(rng.randrange(1, 6))} for k in range(60)}
    df = spark.createDataFrame([(s, h) for s, hs in sets.items() for h in hs], "session_id string, host string")
    found = {(r.host, r.target): r.correlation for r in cliques.host_correlation(df, 2, 0.05).collect()}
    multi = [hs for hs in sets.values() if len(hs) > 1]
    n = len(multi)
    want = {}
    for a in sorted({h for hs in multi for h in hs}):
        for b in sorted({h for hs in multi for h in hs}):
            px, py = sum(a in s for s in multi) / n, sum(b in s for s in multi) / n
            pxy = sum(a in s and b in s for s in multi) / n
            phi = (pxy - px * py) / math.sqrt(px * (1 - px) * py * (1 - py))
            if a != b and phi > 0.05:
                want[a, b] = phi
    assert found == pytest.approx(want)


def test_clamping(spark):
    stats = spark.createDataFrame(
        [(1, a, 10.0, 300.0, 50.0, 5) for a in "abcd"],
        "country int, app string, published_avg_dau double, published_sum_dau double, published_max_dau double, n_dau bigint",
    )
    users = spark.createDataFrame([(1, "a", 100.0), (1, "b", 1.0), (1, "c", 9e9)], "country int, app string, active_users double")
    people = spark.createDataFrame([(1, 200)], "country int, population_size bigint")
    found = {r.app: r.active_users for r in monthly.clamp_monthly(users, stats, people).collect()}
    assert found["a"] == 100 and found["d"] == 50
    assert 50 * 1.0025 <= found["b"] <= 50 * 1.0075 and 200 * 0.9925 <= found["c"] <= 200 * 0.9975


def test_trend_of_absent_app_is_zero_and_of_absent_anchor_is_null(spark):
    cols = "date string, country int, app string, source string, model_type string, model_date string, p double, n bigint, reliability double"
    rows = [("2024-01-01", 1, a, "s", "t", "m", p, 20, 1.0) for a, p in (("a", 0.1), ("c", 0.3))]
    rows += [("2024-01-02", 1, a, "s", "t", "m", p, 10, 1.0) for a, p in (("a", 0.2), ("b", 0.1))]
    estimates = spark.createDataFrame(rows, cols).withColumn("date", F.col("date").cast("date"))
    found = trend.daily_trends(estimates, (1,)).collect()
    assert {r.app: r.trend for r in found} == {"a": pytest.approx(2.0), "b": None, "c": 0.0}
    assert {str(r.date) for r in found} == {"2024-01-02"}
    assert {r.trend_id.anchor_dates for r in found} == {"2024-01-01"}


TREND = "date date, country int, app string, trend_id struct<type: string, anchor_dates: string>, trend double, p double, n double, anchor_p double, anchor_n double"


def day(k):
    return dt.date(2024, 1, 1) + dt.timedelta(days=k)


def chain_inputs(spark, apps=6, days=20, seed=4):
    """Random trends from single days and sets of up to 14 days, with days and apps missing."""
    rng = random.Random(seed)
    raw = [(day(k), c, f"a{a}", rng.uniform(0.01, 0.3), rng.randint(20, 90)) for k in range(days) for c in (1, 2) for a in range(apps) if rng.random() < 0.8]
    trends = []
    for k in range(7, days):
        for c in (1, 2):
            for a in range(apps + 1):
                sets = [(o,) for o in range(1, 8)] + [tuple(range(7, 0, -1)), tuple(range(min(k, 14), 0, -1))]
                for days_back in rng.sample(sets, 5):
                    name = ",".join(str(day(k - o)) for o in days_back)
                    kind = "DAY" if len(days_back) == 1 else "AVG_SCALE"
                    values = [rng.uniform(0.5, 2), rng.uniform(0.01, 0.3), rng.randint(20, 90) / 1.0, rng.uniform(0.01, 0.3), rng.uniform(20, 90)]
                    trends.append((day(k), c, f"a{a}", (kind, name), *values))
    return (
        spark.createDataFrame(trends, TREND),
        spark.createDataFrame(raw, "date date, country int, app string, p double, n bigint"),
        trends,
        raw,
    )


def by_hand(trends, raw):
    """One date after the other, as the definition says."""
    state = {(d, c, a): (p, n, p) for d, c, a, p, n in raw if d < day(7)}
    own = {(d, c, a): (p, n) for d, c, a, p, n in raw if d >= day(7)}
    out = {}
    for key in sorted({t[:3] for t in trends} | set(own)):
        d, c, a = key
        voices = []
        for _, _, _, (kind, name), value, p, n, ap, an in (t for t in trends if t[:3] == key):
            days = name.split(",")
            met = [state[k] for x in days if (k := (dt.date.fromisoformat(x), c, a)) in state]
            if sum(m[0] for m in met) > 0:
                weight = math.sqrt(sum(m[2] for m in met) / len(days) * sum(m[1] for m in met) / len(met) * ap * an)
                voices.append((weight, sum(m[0] for m in met) / len(days) * value, p, n, ap, an))
        total = sum(v[0] for v in voices)
        mean = lambda k: sum(v[0] * v[k] for v in voices) / total  # noqa: B023, E731
        up = lambda k: math.ceil(round(mean(k), 9))  # noqa: B023, E731
        if voices and round(mean(4) * up(5)) > 0:
            found = (mean(1), up(3), mean(2), len(voices))
        elif key in own:
            found = (own[key][0], own[key][1], own[key][0], None)
        else:
            continue
        state[key] = found[:3]
        out[key] = found
    return out


def same_chain(rows, want):
    got = {(r.date, r.country, r.app): (r.p, r.n, r.eff_p, None if r.anchors is None else len(r.anchors)) for r in rows}
    assert got.keys() == want.keys() and len(rows) == len(want)
    for key, found in got.items():
        assert found == pytest.approx(want[key]), key


def test_trends_are_applied_to_all_days_in_order(spark):
    trends, raw, t, r = chain_inputs(spark)
    seeds = raw.filter(F.col("date") < F.lit(day(7))).withColumn("eff_p", F.col("p"))
    rows = trend.apply_trends(trends, raw.filter(F.col("date") >= F.lit(day(7))), seeds).collect()
    same_chain(rows, by_hand(t, r))
    some = next(x for x in rows if x.anchors)
    assert sum(v.w for v in some.anchors) == pytest.approx(1) and [v.trend_id for v in some.anchors] == sorted(v.trend_id for v in some.anchors)


def test_a_set_of_fourteen_days_counts_all_of_them(spark):
    """Anchors of any age are met: nothing is cut off after a week."""
    name = ",".join(str(day(k)) for k in range(14))
    trends = spark.createDataFrame([(day(14), 1, "a", ("AVG_SCALE", name), 1.0, 0.1, 50.0, 0.1, 50.0)], TREND)
    seeds = spark.createDataFrame([(day(k), 1, "a", 0.1, 50, 0.1) for k in range(14)], "date date, country int, app string, p double, n bigint, eff_p double")
    none = seeds.limit(0).drop("eff_p")
    assert [r.p for r in trend.apply_trends(trends, none, seeds).collect()] == [pytest.approx(0.1)]
    assert trend.apply_trends(trends.limit(0), none, seeds).count() == 0


def test_chain_stopped_in_the_middle_goes_on_from_its_last_day(spark, tmp_path):
    trends, raw, t, r = chain_inputs(spark, seed=8)
    seeds = raw.filter(F.col("date") < F.lit(day(7))).withColumn("eff_p", F.col("p"))
    days, path = [day(k) for k in range(7, 20)], f"{tmp_path}/estimates"
    with pytest.raises(FileNotFoundError):
        trend.extend_estimates(path, trends, raw, days)
    assert trend.extend_estimates(path, trends, raw, days[:6], seeds, step=4) == days[:6]
    # An interrupted step: a day's files are there, but wrong, and not marked as finished.
    wrong = spark.createDataFrame([(day(13), 1, "a0", 9.0, 1, 9.0)], "date date, country int, app string, p double, n bigint, eff_p double")
    wrong.write.mode("append").partitionBy("date").parquet(path)
    os.remove(f"{path}/date={day(13)}/_SUCCESS") if os.path.exists(f"{path}/date={day(13)}/_SUCCESS") else None
    assert trend.estimates_at(spark, path).agg(F.max("date")).first()[0] == days[5]
    assert trend.extend_estimates(path, trends, raw, days, step=3) == days[6:]
    assert trend.extend_estimates(path, trends, raw, days) == []
    same_chain(trend.estimates_at(spark, path).filter(F.col("date") >= F.lit(day(7))).collect(), by_hand(t, r))


def test_anchor_plan():
    anchors, todo = trend.anchor_plan("2024-01-31", "2024-01-10")
    assert (str(anchors[0]), str(anchors[-1]), len(anchors)) == ("2024-01-21", "2024-01-27", 7)
    assert [str(d) for d in todo] == ["2024-01-28", "2024-01-29", "2024-01-30", "2024-01-31"]


def test_label_is_nearest_present_signal(spark):
    df = spark.createDataFrame(
        [(100.0, 90.0, 110.0, 5.0), (100.0, 5.0, 5.0, 5.0), (100.0, 5.0, 50.0, 101.0)],
        "ga_active_users double, raw_est_active_users double, ios_share_active_users double, mp_active_users double",
    )
    assert [r.label for r in df.select(scale.closest_signal().alias("label")).collect()] == [0, None, 2]


def test_accuracy_of_no_rows_is_empty(spark):
    df = spark.createDataFrame([], "country int, y double, yhat double")
    assert evaluate.bucketed_accuracy(df).count() == 0

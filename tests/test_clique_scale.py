"""Cliques of many first vertices in one call; features of pairs laid side by side after one shuffle by clique."""

import random
from itertools import combinations

import pandas as pd
import pytest

from tallyscope.operators import cliques


def test_first_vertices_share_a_call():
    rows = [("a", "b", "c"), ("x", "b", "c"), ("a", "b", "d"), ("x", "c", "d"), ("x", "b", "d")]
    found = cliques._cliques_of_first(pd.DataFrame(rows, columns=["u", "v", "w"]))
    assert sorted((u, *sorted(m)) for u, m in zip(found["u"], found["members"])) == [("a", "a", "b", "c"), ("a", "a", "b", "d"), ("x", "b", "c", "d", "x")]


@pytest.mark.parametrize("triangles", [3, 10_000])
def test_maximal_cliques_whatever_the_calls(spark, monkeypatch, triangles):
    monkeypatch.setattr(cliques, "TRIANGLES", triangles)
    rng = random.Random(2)
    edges = {(a, b) for a, b in combinations("abcdefghijkl", 2) if rng.random() < 0.5}
    linked = lambda s: all(p in edges for p in combinations(sorted(s), 2))
    every = [set(s) for n in range(3, 13) for s in combinations("abcdefghijkl", n) if linked(s)]
    want = {tuple(sorted(s)) for s in every if not any(s < t for t in every)}
    df = spark.createDataFrame([(a, b, 0.9) for a, b in edges], "host string, target string, correlation double")
    got = [tuple(r["clique"]) for r in cliques.maximal_cliques(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_candidates_meet_after_one_shuffle_by_clique(spark):
    sets = {"c1": ["a.shop.com", "b.shop.com"], "c2": ["a.news.com"], "c3": ["x.other.com"]}
    found = spark.createDataFrame([(m, c) for c, m in sets.items()], "clique array<string>, clique_id string")
    app = spark.createDataFrame([("b1", "a.shop.com", "shop.com"), ("b2", "q.news.com", "news.com")], "bundle_id string, host string, domain string")
    lab = spark.createDataFrame([("b1", "a.news.com", "news.com", 0.7), ("b1", "b.shop.com", "shop.com", 0.6), ("b9", "a.news.com", "news.com", 0.9)], "bundle_id string, host string, domain string, correlation double")
    info = spark.createDataFrame([("b1", "The News", "Shop Ltd"), ("b2", "x", None)], "bundle_id string, app_name string, publisher_name string")
    out = cliques.clique_candidates(found, app, lab, info, spark.createDataFrame([("com",)], "suffix string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("REPARTITION_BY_COL" in line for line in shuffles) == 1
    got = {(r["clique_id"], r["bundle_id"]): r.asDict() for r in out.collect()}
    # b9 has no names; c3 shares no domain.
    assert set(got) == {("c1", "b1"), ("c2", "b1"), ("c2", "b2")}
    one, two = got["c1", "b1"], got["c2", "b2"]
    shown = ["bundles", "hosts", "domains", "app_info_hosts_score", "panel_hosts_score", "panel_domains_score", "max_corr", "match_publisher", "match_app_name"]
    assert [one[c] for c in shown] == [1.0, 2.0, 1.0, 0.5, 1 / 3, 0.5, 0.6, 1.0, 0.0]
    # A bundle without names still counts among those of its clique.
    assert [two[c] for c in shown] == [3.0, 1.0, 1.0, -1.0, -1.0, -1.0, -1.0, -1.0, 0.0]
    assert two["clique"] == ["a.news.com"] and out.columns == ["clique_id", "bundle_id", *cliques.FEATURES, "clique"]

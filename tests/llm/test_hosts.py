import re
from collections import defaultdict

import numpy as np
import pytest

from tallyscope.llm import hosts


def pages(spark):
    link = lambda *to: "".join(f'<a href="{t}">x</a>' for t in to)
    rows = [
        (1, "http://Good.EXAMPLE.net/en/1", link("https://friend.org/a", "/local", "http://other.com/?q")),
        (2, "https://bad.net/x", link("http://worse.com/")),
        (3, "http://liar.com/p?x=http://friend.org/", link("http://bad.net/1", "http://bad.net/2", "HTTP://BAD.NET#z")),
        (4, "http://friend.org/page#top", link("http://third.org/y")),
        (5, "http://a.b.friend.org/fr/1", None),
        (6, "http://third.org", "<A HREF = http://other.com/x>no quotes</a>"),
        (7, "http://shop.example.com/de/1", ""),
        (8, "http://shop.example.com/deep/1", ""),
        (9, "no scheme", link("http://bad.net/")),
        (10, None, link("http://bad.net/")),
        (11, "http://", ""),
        (12, "http://notnet/", ""),
        (13, "http://net/", ""),
        (14, "http://x.net", ""),
        (15, f"http://{'a.' * 400}com/", link("http://friend.org/")),
        (16, "x://https://y.net/z", ""),
        (None, "http://other.com/1", link("http://friend.org/")),
        (4, "http://friend.org/page#top", link("http://third.org/y")),
    ]
    return spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "page_id long, url string, html string, host string, rank double")


def split(url):
    m = re.match(r".*?://([^/?#]*)([^?#]*)", url or "", re.S)
    return (m[1].lower(), m[2]) if m else ("", "")


def rule(host, path):
    fits = [(r, v) for r, v in hosts.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


def by_hand(rows, rounds=16, d=0.85):
    edges, mass = defaultdict(float), {"trust": defaultdict(float), "distrust": defaultdict(float)}
    names = set()
    for r in rows:
        host, path = split(r["url"])
        if host and len(host) <= 253:
            names.add(host)
            targets = {split(t)[0] for t in re.findall(r"(?i)\bhref\s*=\s*[\"']?\s*([^\s\"'<>]+)", r["html"] or "")} - {"", host}
            names |= targets
            for t in targets:
                edges[host, t] += 1
        verdict = rule(host, path)[1]
        if verdict:
            mass["trust" if verdict == "allow" else "distrust"][host] += 1
    kin = set()
    for h in names:
        labels = h.split(".")
        below_country = len(labels) > 1 and len(labels[-1]) == 2 and labels[-2] in hosts.REGISTRIES
        for k in range(len(labels) - (3 if below_country else 2)):
            kin |= {(".".join(labels[k:]), ".".join(labels[k + 1 :])), (".".join(labels[k + 1 :]), ".".join(labels[k:]))}
    for e in kin:
        edges[e] += 1
    index = {h: k for k, h in enumerate({x for e in edges for x in e} | {h for m in mass.values() for h in m})}
    out = {}
    for kind in mass:
        a = np.zeros((len(index), len(index)))
        for (x, y), w in edges.items():
            i, j = (index[x], index[y]) if kind == "trust" else (index[y], index[x])
            a[i, j] += w
        a = np.divide(a, a.sum(1, keepdims=True), out=np.zeros_like(a), where=a.sum(1, keepdims=True) > 0)
        s = np.zeros(len(index))
        for h, m in mass[kind].items():
            s[index[h]] = m / sum(mass[kind].values())
        r = (1 - d) * s
        for _ in range(rounds):
            r = d * r @ a + (1 - d) * s
        out[kind] = {h: r[k] / r.sum() for h, k in index.items()}
    return out


def test_rules_and_ranks(spark):
    table = pages(spark)
    rows = table.collect()
    ranks = by_hand(rows)
    got = hosts.judge(table).collect()
    assert len(got) == len(rows)
    urls = {r["page_id"]: r["url"] for r in rows}
    for r in got:
        host, path = split(urls[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        want, verdict = rule(host, path)
        assert r["rule"] == want
        trust, distrust = (ranks[k].get(host, 0.0) for k in ("trust", "distrust"))
        assert (r["trust"], r["distrust"]) == pytest.approx((trust, distrust), abs=1e-12)
        assert r["verdict"] == (verdict or ("block" if distrust > trust + 1e-12 else "allow"))
    said = {r["page_id"]: (r["rule"], r["verdict"]) for r in got}
    assert said[1] == ("example.net/en/", "allow") and said[3] == (None, "block") and said[5] == ("org/fr/", "allow")
    assert said[13] == ("net/", "block") and said[12] == (None, "allow") and said[14][0] is None


def test_no_rows_and_no_seeds(spark):
    assert hosts.judge(pages(spark).limit(0)).count() == 0
    assert {r["verdict"] for r in hosts.judge(pages(spark).filter("page_id in (6, 9, 10)")).collect()} == {"allow"}


def test_ranks_are_spread_to_the_end(spark):
    link = lambda to: f'<a href="{to}">x</a>'
    chain = [(k, f"http://h{k}.org/", link(f"//h{k + 1}.org/x")) for k in range(22)]
    rows = [*chain, (22, "http://h22.org/", link("HTTP://bad.net/")), (23, "http://bad.net/", None), (24, "http://h30.org/fr/", link("//h31.org?u=http://bad.net/"))]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    rows = [{"url": u, "html": h and h.replace('"//', '"http://')} for _, u, h in rows]
    ranks = by_hand(rows, rounds=400)
    got = {r["host"]: r for r in hosts.judge(table, rounds=None).collect()}
    for host, r in got.items():
        assert r["trust"] == pytest.approx(ranks["trust"].get(host, 0.0), rel=1e-6)
        assert r["distrust"] == pytest.approx(ranks["distrust"].get(host, 0.0), rel=1e-6)
    assert {h for h, r in got.items() if r["verdict"] == "block"} == {"bad.net", *(f"h{k}.org" for k in range(23))}


def test_faint_distrust_counts(spark, monkeypatch):
    pages = [(0, "http://bad.net/", None), (1, "http://near.org/", '<a href="http://bad.net/">'), (2, "http://far.org/", '<a href="http://near.org/">')]
    pages += [(k, f"http://s{k}.net/", None) for k in range(3, 5)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    edges = [("distrust", "near.org", "far.org", 1e-13), ("distrust", "near.org", "s3.net", 1.0), ("distrust", "bad.net", "near.org", 1.0)]
    edges = spark.createDataFrame(edges, "kind string, src string, dst string, weight double")
    seeds = spark.createDataFrame([("distrust", "bad.net", 1.0)], "kind string, host string, mass double")
    ranks = {r["host"]: r["rank"] for r in hosts.spread_seeds(edges, seeds, rounds=None).collect()}
    assert 0 < ranks["far.org"] < 1e-12
    spread = spark.createDataFrame([("distrust", h, r) for h, r in ranks.items()], "kind string, host string, rank double")
    monkeypatch.setattr(hosts, "spread_seeds", lambda *_, **__: spread)
    assert {r["verdict"] for r in hosts.judge(table).collect()} == {"block"}


def test_sites_below_a_public_suffix_are_strangers(spark):
    link = lambda to: f'<a href="{to}">x</a>'
    rows = [
        (1, "http://www.spam.co.uk/", link("http://bad.net/")),
        (2, "http://www.honest.co.uk/", None),
        (3, "http://bbc.co.uk/", ""),
        (4, "http://deep.mail.spam.co.uk/", ""),
        (5, "http://bad.net/", ""),
        (6, "http://10.0.0.1/", link("http://bad.net/")),
        (7, "http://10.9.0.1/", ""),
        (8, "http://one.blogs.example/", link("http://bad.net/")),
        (9, "http://two.blogs.example/", ""),
    ]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    blocked = {r["page_id"] for r in hosts.judge(table, rounds=None).collect() if r["verdict"] == "block"}
    assert blocked == {1, 4, 5, 6, 8, 9}
    suffixes = spark.createDataFrame([("co.uk",), ("uk",), ("net",), ("blogs.example",)], "suffix string")
    blocked = {r["page_id"] for r in hosts.judge(table, suffixes=suffixes, rounds=None).collect() if r["verdict"] == "block"}
    assert blocked == {1, 4, 5, 6, 8}


def test_ranks_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    one = sorted(map(tuple, hosts.judge(pages(spark)).select("host", "trust", "distrust").collect()))
    monkeypatch.setattr(hosts, "STEPS_PER_TASK", 5)
    many = sorted(map(tuple, hosts.judge(pages(spark).repartition(7)).select("host", "trust", "distrust").collect()))
    assert [r[0] for r in one] == [r[0] for r in many]
    assert [x for r in many for x in r[1:]] == pytest.approx([x for r in one for x in r[1:]], rel=1e-9)

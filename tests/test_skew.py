import random

from pyspark.sql import functions as F

from tallyscope.functions.skew import heavy_keys, split_join
from tallyscope.operators import cliques


def test_heavy_keys_are_split_and_nothing_is_lost(spark):
    left = spark.range(40_000).select(F.when(F.col("id") % 5 < 3, 0).otherwise(F.col("id") % 900).alias("k"), F.col("id").alias("v"))
    right = spark.range(1000).select((F.col("id") % 500).alias("k"), F.col("id").alias("w"))
    was = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = split_join(left, right, "k", least=100, parts=100)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        total = joined.count()
        plain = left.join(right, "k").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
        spark.conf.set("spark.sql.shuffle.partitions", was[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was[1])
    assert total == left.join(right, "k").count() and joined.exceptAll(left.join(right, "k")).isEmpty()
    assert plain > total / 2 and sizes < total / 8
    assert heavy_keys(left, ["k"], 100, 100).count() <= 100
    assert [r["_parts"] > 40 for r in heavy_keys(left, ["k"], 100, 100).filter("k = 0").collect()] == [True]


def one_domain_in_most_cliques(rng):
    flat = [(f"c{k}", f"h{rng.randrange(9)}.{d}", d) for k in range(60) for d in {"all.com", *rng.sample(["x.com", "y.com", "z.com"], rng.randrange(2))}]
    bundles = [(f"b{k}", f"h{rng.randrange(9)}.{d}", d, rng.random()) for k in range(25) for d in {"all.com", rng.choice(["x.com", "w.com"])}]
    return flat + flat[:3] + [("c0", "nodomain", None)], bundles + bundles[:2]


def test_overlap_of_cliques_alike(spark):
    flat, bundles = one_domain_in_most_cliques(random.Random(4))
    f = spark.createDataFrame(flat, "clique_id string, host string, domain string")
    b = spark.createDataFrame(bundles, "bundle_id string, host string, domain string, correlation double")
    for on, place in (("host", 1), ("domain", 2)):
        mine, theirs = {}, {}
        for rows, sets in ((flat, mine), (bundles, theirs)):
            for r in rows:
                if r[place]:
                    sets.setdefault(r[0], set()).add(r[place])
        want = {(c, x): (len(m), len(t), len(m & t) / len(m | t)) for c, m in mine.items() for x, t in theirs.items() if m & t}
        rows = cliques.clique_jaccard(f, b, on, "s").collect()
        assert len(rows) == len(want)
        assert {(r.clique_id, r.bundle_id): (r[f"s_{on}s_X"], r[f"s_{on}s_Y"], r[f"s_{on}s_score"]) for r in rows} == want


def test_sessions_meet_cliques_by_their_rare_hosts(spark):
    rng = random.Random(6)
    hosts = ["everywhere"] + [f"h{k}" for k in range(12)]
    panel = [(1, f"d{k}", f"s{k}", h, rng.randrange(100)) for k in range(150) for h in ["everywhere", *rng.sample(hosts, rng.randint(1, 7))]]
    sets = {f"c{k}": sorted({"everywhere", *rng.sample(hosts, rng.randint(0, 5))}) for k in range(30)} | {"alone": ["everywhere"], "unseen": ["nowhere", "h1"]}
    scored = [(c, m, f"b{k}", 0.5, 0.9) for c, m in sets.items() for k in range(2)]
    p = spark.createDataFrame(panel, "country int, did string, session_id string, host string, ts int")
    q = spark.createDataFrame(scored, "clique_id string, clique array<string>, bundle_id string, score double, model_predict double")
    own = {}
    for _, _, s, h, _ in panel:
        own.setdefault(s, set()).add(h)
    for share in (0.6, 0.5, 1.0, 0.01):
        want = {(s, c, f"b{k}") for s, met in own.items() for c, m in sets.items() for k in range(2) if len(met & set(m)) / len(m) >= share}
        rows = cliques.match_sessions(p, q, share).collect()
        assert {(r.session_id, r.clique_id, r.bundle_id) for r in rows} == want and len(rows) == len(want)
        assert all(set(r.hosts) == own[r.session_id] for r in rows)

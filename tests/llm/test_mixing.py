import random

import pytest
from pyspark.sql import functions as F

from tallyscope.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, _bin int, note string"


def by_resharing(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by dealing out the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            over = target[s] - most * sizes[s]
            if over >= 0:
                target[s], left = most * sizes[s], left + over
                open_.discard(s)
    return target


def documents(spark, n=400):
    rng = random.Random(5)
    sources = ["hot"] * 6 + ["a", "b", "ünï", None, "z"]
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 40, 200])), rng.choice(sources), "clash", 1, None) for i in range(n)]
    rows += [(n, None, "a", None, None, "null text"), (None, "x y z", "b", None, None, "null key"), (7, "again", "b", None, None, None), (7, "again", "b", None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def test_targets_equal_resharing(spark):
    rng = random.Random(3)
    for n in (1, 2, 5, 13):
        sizes = {f"s{k}": rng.choice([0, 5, 100, 10_000, 300_000]) for k in range(n)} | {None: 50}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
        assert got == pytest.approx(by_resharing(sizes), rel=1e-9, abs=1e-6)


def test_mix_meets_targets_and_limits(spark):
    docs = documents(spark)
    rows = mixing.mix(docs, rows_per_bin=16).collect()
    assert len(rows) == docs.count() and set(docs.columns) - {"size"} <= set(rows[0].asDict())
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r["size"] == len((r["text"] or "").split()) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(by_resharing(sizes))
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    again = mixing.mix(docs.repartition(7), rows_per_bin=64).collect()
    key = lambda r: (str(r["doc_id"]), r["text"] or "", r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_positions_follow_the_integrated_schedule(spark):
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    frame = spark.createDataFrame([(x, a, b) for x in shares for a, b in [(0.5, 1.5), (1.5, 0.5), (1.0, 1.0), (0.0, 2.0), (2.0, 0.0)]], "x double, a double, b double")
    for r in frame.withColumn("t", mixing.invert_demand(F.col("x"), F.col("a"), F.col("b"))).collect():
        a, b = 2 * r["a"] / (r["a"] + r["b"]), 2 * r["b"] / (r["a"] + r["b"])
        assert a * r["t"] + (b - a) * r["t"] ** 2 / 2 == pytest.approx(r["x"], abs=1e-9)


def test_training_order_repeats_and_sorts(spark):
    docs = documents(spark).drop("size", "_bin")
    mixed = {(r["doc_id"], r["text"]): r for r in mixing.mix(docs).filter("doc_id <> 7").collect()}
    read = [(r["doc_id"], r["text"]) for r in mixing.training_order(docs).filter("doc_id <> 7").collect()]
    assert mixing.training_order(docs).columns == docs.columns
    for k, r in mixed.items():
        assert read.count(k) == (r["first_position"] is not None) + (r["second_position"] is not None)
    first = {}
    for at, k in enumerate(read):
        first.setdefault(k, at)
    order = [mixed[k]["first_position"] for k in sorted(first, key=first.get)]
    assert order == sorted(order)


def test_no_rows_and_no_words(spark):
    assert mixing.mix(documents(spark).limit(0)).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, None, None), (2, " \t", "a")], "doc_id long, text string, source string")).collect()
    assert [(r["size"], r["target"], r["taken"], r["first_position"]) for r in rows] == [(0, 0.0, 0, None)] * 2


def test_mix_is_sorted_by_position(spark):
    """Parts one after the other are in order, rows that are not read last."""
    docs = documents(spark, 300).repartition(5)
    at = mixing.mix(docs, rows_per_bin=16).withColumn("_part", F.spark_partition_id())
    parts = {}
    for r in at.select("_part", "first_position").toLocalIterator():
        parts.setdefault(r["_part"], []).append((r["first_position"] is None, r["first_position"] or 0.0))
    assert len(parts) > 1
    flat = [x for k in sorted(parts) for x in parts[k]]
    assert flat == sorted(flat) and len(flat) == docs.count()


def test_texts_are_shuffled_once_by_bin(spark):
    """However the small side of the join turns out: the texts are dealt by bin for their window, and not again for the join."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = mixing.positions(documents(spark), rows_per_bin=16)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert sum("_of" not in x and "_bin" in x for x in dealt) == 1, plan

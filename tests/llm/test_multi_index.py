import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyscope.llm import multi_index as mi


def table(spark, seed=3, n=900, dim=10):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim))
    x = centers[rng.integers(12, size=n)] + rng.normal(size=(n, dim)) * 0.4
    x[200:420] = x[200]  # very many copies
    x[500] = 2 * x[501]
    rows = [(i, [float(v) for v in x[i].astype(np.float32)], "a", 1) for i in range(n)]
    odd = [(1000, None), (1050, [0.0] * dim), (1100, [float("nan")] + [1.0] * (dim - 1)), (1150, [float("inf")] * dim), (1200, [None] + [1.0] * (dim - 1)), (1250, [1.0, 2.0]), (None, rows[0][1])]
    rows += [(i, v, "b", 2) for i, v in odd] + [rows[7]]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, ids string, one int"), x.astype(np.float32).astype(float)


def brute(x, q, best=5):
    s = x @ x[q] / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[q]))
    others = [i for i in range(len(x)) if i != q]
    return sorted(others, key=lambda i: (-round(s[i], 12), i))[:best], s


def test_all_cells_give_the_exact_answer(spark):
    rows, x = table(spark)
    got = {}
    for r in mi.search(rows, visited=1.0, centroids=8).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 900, 50))
    for q, found in got.items():
        want, s = brute(x, q)
        assert [i for _, i, _ in sorted(found)] == want
        assert np.allclose([v for *_, v in sorted(found)], s[want], atol=1e-12)


def test_recall_of_a_partial_visit(spark):
    rows, x = table(spark, n=4000)
    found = {}
    for r in mi.search(rows, visited=0.25, centroids=16).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = np.mean([len(found[q] & set(brute(x, q)[0])) / 5 for q in found])
    assert len(found) == 80 and hits >= 0.9


def test_defaults_on_vectors_without_structure(spark):
    x = np.random.default_rng(8).normal(size=(6000, 32))
    found = {}
    for r in mi.search(spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert len(found) == 120 and np.mean([len(found[q] & set(brute(x, q)[0])) / 5 for q in found]) >= 0.9


def test_vectors_meet_those_of_their_own_length(spark):
    rng = np.random.default_rng(9)
    sizes = {0: 8, 1: 8, 2: 8, 3: 3, 4: 1}  # the most common length and two others
    vectors = [rng.normal(size=sizes[i % 5]) for i in range(500)]
    got = {}
    for r in mi.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"), every=3, visited=1.0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert sorted(got) == list(range(0, 500, 3))
    for q, found in got.items():
        same = [i for i in range(500) if len(vectors[i]) == len(vectors[q])]
        want, _ = brute(np.stack([vectors[i] for i in same]), same.index(q))
        if len(vectors[q]) > 1:  # of one component, all cosines are 1 or -1
            assert [i for _, i in sorted(found)] == [same[i] for i in want]
        assert len(found) == 5


def test_cells_come_in_the_order_of_summed_distance():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = rng.random(7), rng.random(5)
        filled = rng.integers(0, 3, size=(7, 5))
        cells = mi.traverse(a, b, filled, np.inf)
        assert cells == [c for c in sorted(np.ndindex(7, 5), key=lambda c: a[c[0]] + b[c[1]]) if filled[c]]
        some = mi.traverse(a, b, filled, 9)
        assert some == cells[: len(some)] and sum(filled[c] for c in some) >= min(9, filled.sum())


def test_few_and_no_rows(spark):
    rows, _ = table(spark, n=600)
    assert mi.search(rows.limit(0)).count() == 0
    assert mi.search(rows.filter("vec_id in (0, 3)")).collect()[0]["vec_id"] == 3
    assert mi.search(rows.filter("vec_id = 0")).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0, 2.0]) for i in range(120)], "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in mi.search(same).collect()}
    assert [got[0, k] for k in range(1, 6)] == [1, 2, 3, 4, 5] and [got[50, k] for k in range(1, 6)] == [0, 1, 2, 3, 4] and len(got) == 15


def test_the_drawn_vectors_stay_with_the_tasks(spark):
    """The driver takes 1 MB of results; the vectors drawn have 0.5 MB, and each task could hand on as many."""
    x = np.random.default_rng(4).normal(size=(6000, 64))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    conf = spark.sparkContext._jsc.sc().conf()
    before = conf.get("spark.driver.maxResultSize", "1g")
    conf.set("spark.driver.maxResultSize", "1m")
    try:
        assert len(mi.search(rows, sample=1000).collect()) == 600
    finally:
        conf.set("spark.driver.maxResultSize", before)


def test_vectors_are_drawn_by_the_hash_of_their_ids(spark):
    rows = spark.createDataFrame([(str(i).encode(), [i % 3000]) for i in range(9000)], "v binary, ids array<long>")
    want = {bytes(r["v"]) for r in rows.orderBy(F.xxhash64("ids"), "v").limit(700).collect()}
    assert {bytes(r["v"]) for r in mi.draw(rows, 700).collect()} == want
    assert mi.draw(rows.withColumn("ids", F.array(F.lit(7))), 700).count() == 700
    assert mi.draw(rows, 10_000).count() == 9000


def test_entries_in_many_parts_give_the_exact_answer(spark, monkeypatch):
    monkeypatch.setattr(mi, "PAIRS", 500)
    rows, x = table(spark)
    got = {}
    for r in mi.search(rows, visited=1.0, centroids=8).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert sorted(got) == list(range(0, 900, 50))
    for q, found in got.items():
        assert [i for _, i in sorted(found)] == brute(x, q)[0]


def test_entries_held_are_searched_exactly():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(5000, 7)).astype(np.float32)
    x[1000:1800] = x[1000] * 2.0 ** rng.integers(-9, 9, size=(800, 1))  # equal cosines, beyond a block
    cells = rng.integers(0, 40, size=5000).astype(np.int32)
    cells[1000:3000] = 7
    ids = rng.permutation(5000)
    blocks = [(cells[lo:hi], x[lo:hi], pa.array([[i, i + 9000] for i in ids[lo:hi].tolist()])) for lo, hi in ((0, 1), (1, 3100), (3100, 5000))]
    y, masks = x[::40].astype(float) * 3, rng.random((125, 40)) < 0.6
    masks[3], masks[4] = False, np.arange(40) == 39
    held = mi.Held(blocks, 5)
    k, e, s = held.search(y, masks)
    first = held.ids.values.to_numpy()[::2]
    cosine = y @ x.T.astype(float) / (np.linalg.norm(y, axis=1)[:, None] * np.linalg.norm(x.astype(float), axis=1))
    for q in range(125):
        seen = np.flatnonzero(masks[q, cells])
        want = sorted(seen, key=lambda i: (-round(cosine[q, i], 12), ids[i]))[:6]  # noqa: B023
        assert [ids[i] for i in want] == [i for _, i in sorted(zip(-np.round(s[k == q], 12), first[e[k == q]], strict=True))]

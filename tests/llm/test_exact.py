import hashlib
import random

from pyspark.sql import functions as F

from tallyscope.llm import exact

DROP = {c: None for c in [0x20, *range(0x09, 0x0E)]}


def documents(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("ab cé\n") for _ in range(rng.choice([1, 5, 60]))) for _ in range(60)]
    rows = [(i, rng.choice([t, t.replace(" ", "\t"), t + "  ", " " + t])) for i in range(300) for t in [rng.choice(base[:3] if i % 3 == 0 else base)]]
    rows += [(900, None), (901, ""), (902, " \n\x0b\x0c\r"), (903, " "), (None, "a b"), (-5, "ab"), (10, "same"), (10, "same"), (11, "x" * 200_000), (12, "x" * 200_000 + " ")]
    return spark.createDataFrame([(*r, "h", 3) for r in rows], "doc_id long, text string, h string, kept int")


def by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r["text"] or "").translate(DROP), []).append(r)
    out = {}
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        for r in members:
            out[(r["doc_id"], r["text"])] = (best["doc_id"], len(members), hashlib.sha256(norm.encode()).hexdigest())
    return out


def test_groups_and_keepers(spark):
    docs = documents(spark)
    want = by_hand(docs.collect())
    for options in ({}, {"capacity": 3}, {"hasher": lambda c: F.length(c).cast("long"), "capacity": 5}):
        rows = exact.exact_dedup(docs, **options).collect()
        assert len(rows) == docs.count()
        got = {}
        for r in rows:
            got.setdefault((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]), []).append(r["kept"])
        assert set(got) == {(k[0], *v) for k, v in want.items()}
        assert sum(r["kept"] for r in rows) == len({v[2] for v in want.values()})
        assert {r["doc_id"] for r in rows if r["kept"]} == {v[0] for v in want.values()}


def test_collisions_are_chained(spark):
    index = exact.build_index(documents(spark), capacity=4, hasher=lambda c: (F.length(c) % 2).cast("long"))
    rows = index.entries.collect()
    assert len({(r["h"], r["chain"]) for r in rows}) == len(rows) and max(r["chain"] for r in rows) > 5


def test_look_up_goes_through_the_directory(spark):
    docs = documents(spark)
    index = exact.build_index(docs, capacity=3)
    rows = docs.select("text", F.regexp_replace(F.coalesce("text", F.lit("")), exact.SPACE, "").alias("norm"))
    asked = rows.select(F.xxhash64("norm").alias("h"), F.sha2("norm", 256).alias("text_sha256"))
    assert index.slots.count() > 8 and index.look_up(asked).count() == docs.count()
    buckets = sorted({r["bucket"] for r in index.slots.collect()})
    wrong, other = buckets[0], buckets[1]
    of_wrong = index.bucket_of(asked).filter(F.col("bucket") == wrong).count()
    moved = index._replace(slots=index.slots.withColumn("bucket", F.when(F.col("bucket") == wrong, other).otherwise(F.col("bucket"))))
    assert of_wrong > 0 and moved.look_up(asked).count() == docs.count() - of_wrong


def test_owners_hold_ranges_of_buckets(spark):
    files = exact.build_index(documents(spark), capacity=3).entries.groupBy(F.input_file_name().alias("f"))
    ranges = sorted((r["lo"], r["hi"]) for r in files.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).collect())
    assert len(ranges) > 1 and all(one[1] <= other[0] for one, other in zip(ranges, ranges[1:]))


def test_directory_doubles_until_buckets_fit(spark):
    entries = spark.range(3000).select(F.xxhash64("id").alias("h"))
    crowded = entries.unionByName(spark.range(2000).select((F.lit(2**62) + F.shiftright(F.xxhash64("id"), 12)).alias("h")))
    slots, depth = exact.directory(crowded, 200)
    rows = slots.collect()
    assert depth > 5 and len({r["local_depth"] for r in rows}) > 1
    full = crowded.withColumn("slot", exact.prefix(F.col("h"), depth)).join(slots, "slot").groupBy("bucket").count()
    assert full.agg(F.max("count")).first()[0] <= 200
    for r in rows:
        assert r["slot"] >> (depth - r["local_depth"]) << (depth - r["local_depth"]) == r["bucket"]


def test_drop_copies_keeps_one_row_of_each(spark):
    docs = documents(spark)
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(set(by_hand(docs.collect()).values()))
    assert exact.drop_copies(docs.limit(0)).count() == 0

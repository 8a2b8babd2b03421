import random
import zlib

import numpy as np

from tallyscope.llm import quality


def corpus(spark, n=500):
    rng = random.Random(4)
    words = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        good = i % 4 > 0
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 150)))
        docs.append((i, text + "." if good else text.upper().replace(" ", "!! "), "x"))
        labels.append((i, int(good)))
    docs += [(n, None, "x"), (n + 1, "", "x"), (n + 2, "good " * 60_000, "x"), (None, "text without a key", "x"), (0, docs[0][1], "x")]
    labels += [(None, 1), (1, None), (2, 7), (3, 0), (3, 1), (4, 1), (4, 1), (99_999, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy_and_edges(spark):
    docs, labels = corpus(spark)
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 500 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 100 and np.mean([r["predicted"] == (r["doc_id"] % 4 > 0) for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1


def test_score_ignores_labels_of_held_out_rows(spark):
    docs, labels = corpus(spark)
    flipped = labels.rdd.map(lambda r: (r[0], 1 - r[1] if r[0] is not None and r[1] in (0, 1) and zlib.crc32(str(r[0]).encode()) % 3 == 1 else r[1])).toDF(labels.schema)
    pick = lambda df: sorted((r["doc_id"] or -1, r["score"]) for r in df.collect())
    assert pick(quality.score_quality(docs, labels)) == pick(quality.score_quality(docs, flipped))


def test_one_class_none_or_no_rows(spark):
    docs, labels = corpus(spark, 40)
    for given in (labels.filter("quality = 1"), labels.limit(0)):
        assert len({round(r["score"], 9) for r in quality.score_quality(docs, given).collect()}) == 1
    assert quality.score_quality(docs.limit(0), labels).count() == 0

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest

from tallyscope.llm import gru, lm

SMALL = dict(head=40, frequent=16, width=4, tail=5, hidden=6, shard=12_000)


def corpus(spark, n=160):
    rng = random.Random(6)
    tongues = [[f"{a}{b}" for a in x for b in "aeiou"] for x in (["B", "c", "d"], ["ß", "é", "ñ"])]
    rows = []
    for i in range(n):
        words = [rng.choice(tongues[i % 2]) if rng.random() < 0.9 else f"rare{rng.randrange(400)}" for _ in range(rng.choice([3, 30, 90]))]
        rows.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, "no key"), (3, rows[3][1]), (1003, "B" * 5000), (1004, "Ba ca " * 4000), (1005, "nbsp is one word")]
    return spark.createDataFrame([(*r, "clash", 1.5) for r in rows], "doc_id long, text string, word string, score double").repartition(3)


def tokens_of(text):
    return (text or "").encode().lower().split() + [b""]


def encoded(vocabulary, words):
    return vocabulary.encode(pa.array(words, pa.binary()))


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def test_counts_and_base_scores(spark):
    docs = corpus(spark)
    rows = docs.collect()
    count = Counter(w for r in rows if not held_out(r["doc_id"]) for w in tokens_of(r["text"]))
    total, types = sum(count.values()), len(count)
    texts = {r["doc_id"]: tokens_of(r["text"]) for r in rows}
    got = lm.score_documents(docs, **SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        words = texts[r["doc_id"]]
        assert r["held_out"] == held_out(r["doc_id"]) and r["train_tokens"] == total
        assert (r["n_tokens"], r["n_known"]) == (len(words), sum(w in count for w in words))
        assert r["base_score"] == pytest.approx(sum(log10((count[w] + 1) / (total + types + 1)) for w in words), rel=1e-9)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 10 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def plain_scores(w, shape, words, vocabulary, count):
    """Log10 probability of a text, one token after the other."""
    h, last, total = np.zeros(shape.hidden), shape.begin, 0.0
    size = shape.hidden
    sig = lambda x: 1 / (1 + np.exp(-x))
    for word in words:
        gx, gh = w["into"][last] + w["bias"], h @ w["recur"]
        z, r = sig(gx[:size] + gh[:size]), sig(gx[size : 2 * size] + gh[size : 2 * size])
        h = (1 - z) * np.tanh(gx[2 * size :] + r * gh[2 * size :]) + z * h
        place = int(encoded(vocabulary, [word])[1][0])
        cls_logits = h @ w["to_class"] + w["class_bias"]
        cls_p = np.exp(cls_logits - cls_logits.max())
        cls_p /= cls_p.sum()
        if 0 <= place < shape.frequent:
            c, k = divmod(place, shape.width)
            logits = h @ w["to_word"][c] + w["word_bias"][c]
            q = np.exp(logits - logits.max())
            total += log10(cls_p[c] * (q / q.sum())[k])
            last = place
        else:
            t = int(vocabulary.class_of_ending[lm.ending(word)])
            share = (1 - vocabulary.unseen[t]) * count[word] / vocabulary.class_tokens[t] if count[word] else vocabulary.unseen[t]
            total += log10(cls_p[shape.own + t] * share)
            last = shape.frequent + t
    return total


def fitted(spark, docs):
    learned = docs.filter("doc_id is not null and text is not null")
    counted = lm.count_words(learned)
    vocabulary = lm.vocabulary(counted, 40, 16, 4, 5, 6)
    return vocabulary, Counter({bytes(r["word"]): r["n"] for r in counted.collect()}), learned


def test_documents_scored_in_lanes_equal_one_by_one(spark):
    docs = corpus(spark)
    vocabulary, count, learned = fitted(spark, docs)
    weights = gru.initial(vocabulary.shape, *vocabulary.shares())
    rows = learned.selectExpr("doc_id", "text", "false AS held_out", "monotonically_increasing_id() AS row", "xxhash64(doc_id, text) AS mix")
    weights, seen = lm.train_round(lm.encode_rows(rows, vocabulary), vocabulary.shape, weights, 0.02, 2)
    assert seen == sum(count.values())
    texts = [tokens_of(r["text"]) for r in docs.collect() if len(r["text"] or "") < 3000]
    tokens = [encoded(vocabulary, t)[0] for t in texts]
    for lanes, window in ((256, 64), (3, 5)):  # the state is carried from window to window
        logs = gru.score(weights, vocabulary.shape, tokens, lanes, window) / np.log(10)
        at = 0
        for words, token in zip(texts, tokens):
            own, place = logs[at : at + len(words)].sum(), encoded(vocabulary, words)[1]
            for w, p in zip(words, place):
                if p >= 0:
                    own += vocabulary.static[p]
                else:
                    t = vocabulary.class_of_ending[lm.ending(w)]
                    own += log10((1 - vocabulary.unseen[t]) * count[w] / vocabulary.class_tokens[t] if count[w] else vocabulary.unseen[t])
            at += len(words)
            assert own == pytest.approx(plain_scores(weights, vocabulary.shape, words, vocabulary, count), rel=2e-4)


def test_probabilities_of_a_class_sum_to_one(spark):
    vocabulary, count, _ = fitted(spark, corpus(spark))
    mass = vocabulary.unseen.copy()
    for w, n in count.items():
        if not 0 <= encoded(vocabulary, [w])[1][0] < vocabulary.shape.frequent:
            t = vocabulary.class_of_ending[lm.ending(w)]
            mass[t] += (1 - vocabulary.unseen[t]) * n / vocabulary.class_tokens[t]
    assert mass == pytest.approx(np.where(vocabulary.class_tokens > 0, 1.0, vocabulary.unseen))
    assert sum(x.sum() for x in vocabulary.shares()[:1]) == pytest.approx(1)


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    shape = gru.Shape(8, 4, 3, 5)
    w = gru.initial(shape, np.full(5, 0.2), np.full(8, 0.25))
    w = {k: (v + rng.normal(size=v.shape) * 0.3).astype(np.float64) for k, v in w.items()}
    texts = [rng.integers(0, 11, n).astype(np.int32) for n in (7, 3, 1, 5)]
    batch, flat = gru.Batch(texts, 2, shape), np.concatenate(texts)
    start = rng.normal(size=(2, 5))
    old, gru.F32 = gru.F32, np.float64
    try:
        loss = lambda: gru.gradient(w, shape, batch, flat, 0, batch.steps, start)[2]
        g = gru.gradient(w, shape, batch, flat, 0, batch.steps, start)[0]
        for name, grad in g.items():
            for at in [tuple(rng.integers(0, n) for n in grad.shape) for _ in range(12)]:
                keep, e = w[name][at], 1e-5
                w[name][at] = keep + e
                up = loss()
                w[name][at] = keep - e
                down = loss()
                w[name][at] = keep
                assert grad[at] == pytest.approx((up - down) / (2 * e), abs=2e-5)
    finally:
        gru.F32 = old


def test_no_rows_and_nothing_to_learn(spark):
    docs = corpus(spark)
    assert lm.score_documents(docs.limit(0), **SMALL).count() == 0
    only = docs.filter("doc_id in (1, 2, 4, 6, 9, 11, 12, 20)").collect()
    only = spark.createDataFrame([r for r in only if held_out(r["doc_id"])] or [(10**6 + k, "a b", "", 0.0) for k in range(60) if held_out(10**6 + k)], docs.schema)
    for r in lm.score_documents(only, **SMALL).collect():
        assert r["held_out"] and r["train_tokens"] == 0 and r["n_known"] == 0 and np.isfinite(r["score"]) and r["base_score"] == pytest.approx(0.0)


def test_words_of_texts():
    texts = ["  A\x0bb\tÉA ", "", " \n", "b", "x\x1cy\x85z b", "B"]
    for some in (texts, texts[:1], texts[1:3], []):
        types, number, n = lm.words_of(pa.array(some, pa.string()))
        assert [types[k].as_py() for k in number] == [w for t in some for w in [*t.encode().lower().split(), b""]]
        assert n.tolist() == [len(t.encode().split()) + 1 for t in some]
    words = pa.array([b"", b"a", b"xyz", "é".encode()], pa.binary())
    assert lm.endings(words).tolist() == [lm.ending(w.as_py()) for w in words] and lm.endings(words[2:]).tolist() == lm.endings(words).tolist()[2:]


def test_scores_do_not_depend_on_the_layout_of_the_input(spark):
    docs = corpus(spark)
    by_layout = [sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in lm.score_documents(docs.repartition(k), **SMALL).collect()) for k in (1, 7)]
    for one, other in zip(*by_layout):
        assert one[:2] == other[:2] and one[2] == pytest.approx(other[2], rel=1e-5)

import random
from collections import Counter

import numpy as np
import pytest

from tallyscope.llm import bagminhash as bag
from tallyscope.llm.graph import components


def bag_of(text, width=5):
    w = (text or "").lower().split()
    return Counter(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else Counter()


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(900)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = []
    for _ in range(40):
        texts.append(" ".join(rng.choice(vocabulary) for _ in range(rng.choice([6, 30, 120, 400]))) + (" " + passage if rng.random() < 0.4 else ""))
    for _ in range(110):  # chains of edits, so that members of a class differ more than by the threshold
        words = rng.choice(texts[20:]).split()
        for _ in range(rng.choice([0, 1, 2, len(words) // 40])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    loop = "a b c d e f " * 50
    return texts + [loop, loop + "a b c", "a b c d e f " * 30, "a b", "A  b\n", "one", None, "", "  ", "x" * 300_000, ("long " * 40_000).strip()]


def by_hand(rows):
    bags = {i: bag_of(t) for i, t in rows}
    parent = {i: i for i in bags}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in bags:
        for j in bags:
            if i < j and similarity(bags[i], bags[j]) >= 0.8:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in bags}


def test_classes_equal_brute_force(spark):
    rows = list(enumerate(corpus()))
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, key string, size int").repartition(5)
    got = bag.near_duplicates(docs).collect()
    want = by_hand(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == want and len(got) == len(rows)
    sizes = Counter(want.values())
    assert all(r["class_size"] == sizes[r["class_id"]] and r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)
    left = bag.drop_near_copies(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == set(want.values())


def test_null_keys_repeated_rows_and_no_rows(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (None, None), (5, text), (5, text), (9, text), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in bag.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(5, 5, True)] * 2 + [(9, 5, False), (4, 4, True)], key=str)
    assert bag.near_duplicates(docs.limit(0)).count() == 0


def test_rows_of_one_key_are_judged_by_their_texts(spark):
    rng = random.Random(5)
    one, two, other, last = (" ".join(rng.choice("abcdefgh") + str(rng.randrange(90)) for _ in range(80)) for _ in range(4))
    rows = [(1, one), (1, two), (2, one + " x"), (3, two + " y"), (4, other), (5, other), (5, last), (8, last + " z")]
    want = sorted([(1, 1, 2, True)] * 2 + [(2, 1, 2, False), (3, 1, 2, False), (4, 4, 2, True), (5, 4, 2, False), (5, 5, 2, True), (8, 5, 2, False)])
    for parts in (1, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = bag.near_duplicates(docs).select("doc_id", "class_id", "class_size", "kept").collect()
        assert sorted(map(tuple, got)) == want
        assert sorted(map(tuple, bag.drop_near_copies(docs).collect())) == sorted([(1, one), (1, two), (4, other), (5, last)])


def test_signature_is_unbiased_for_weights():
    rng = random.Random(1)
    one = [b"%d" % rng.randrange(9) for _ in range(200)]
    for edits in (0, 8, 60):
        other = list(one)
        for _ in range(edits):
            other[rng.randrange(len(other))] = b"%d" % rng.randrange(30)
        text, h, count = bag.shingles([one, other], 2)
        s = bag.signatures(text, h, count, 2, 3000)
        bags = [Counter(dict(zip(h[text == k].tolist(), count[text == k].tolist()))) for k in (0, 1)]
        assert max(bags[0].values()) > 4
        assert (s[0] == s[1]).mean() == pytest.approx(similarity(*bags), abs=0.04)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, k) for k in range(100, 160)] + [(900, 901), (901, 902), (902, 900), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in [*range(100, 160), 500]) and {got[i] for i in (900, 901, 902)} == {900}


def test_signatures_do_not_depend_on_the_batch():
    texts = [bag.words_of(t or "") for t in corpus()[:30]]
    together = bag.signatures(*bag.shingles(texts, 5), len(texts), 64)
    for k, words in enumerate(texts):
        assert np.array_equal(bag.signatures(*bag.shingles([words], 5), 1, 64)[0], together[k])


def test_edits_of_one_text_are_not_paired_with_each_other(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"b{k}" for k in range(150)]
    texts = [" ".join(base)]
    for i in range(300):  # too far from each other, near enough to the text that all come from
        words = list(base)
        for k in rng.sample(range(0, 150, 6), 3):
            words[k] = f"e{i}_{k}"
        texts.append(" ".join(words))
    for i in range(100):  # too far from that text
        words = list(base)
        for k in range(3, 150, 9):
            words[k] = f"f{i}_{k}"
        texts.append(" ".join(words))
    rows = list(enumerate(rng.sample(texts, len(texts))))
    asked, compare = [], bag.overlaps

    def counted(pairs, width):
        asked.append(pairs.select("a", "b").distinct().count())
        return compare(pairs, width)

    monkeypatch.setattr(bag, "overlaps", counted)
    got = bag.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == by_hand(rows)
    assert sum(asked) < 40 * len(texts)


def test_a_centre_loses_no_class(spark, monkeypatch):
    """Several families whose members lack different passages, with and without the text they come from."""
    rng = random.Random(11)
    texts = []
    for family in range(3):
        base = [f"w{rng.randrange(400)}" for _ in range(70)]
        texts += [" ".join(base)] * (family != 1)
        for _ in range(60):
            words = list(base)
            for _ in range(rng.choice([1, 1, 2, 3])):
                lo = rng.randrange(len(words) - 4)
                words[lo : lo + rng.randrange(3)] = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(3))]
            texts.append(" ".join(words))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    cut = bag.unconnected
    monkeypatch.setattr(bag, "unconnected", lambda *a: cut(*a, rare=3, crowd=4))
    got = bag.near_duplicates(docs, rows=2).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == by_hand(rows)

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from tallyscope.llm import runs
from tallyscope.llm.queries import QUERIES


def by_hand(words, least, exponent):
    """Stretches whose words agree with those one period later, and with none at a smaller distance."""
    n, out = len(words), set()
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i - start + p
            if length >= max(least, exponent * p):
                own = words[start : start + length]
                if all(own[q:] != own[: length - q] for q in range(1, p)):
                    out.add((start, length, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeating_tail(rng, n, letters, most=6):
    words = [rng.randint(1, letters) for _ in range(n)]
    if n > 4:
        a, p = rng.randrange(n), rng.randint(1, most)
        words = [w if i < a else words[min(n - 1, a + (i - a) % p)] for i, w in enumerate(words)]
    return words


def test_all_runs_of_short_texts():
    rng = random.Random(1)
    for _ in range(1200):
        words = repeating_tail(rng, rng.randint(0, 40), rng.randint(1, 3))
        for exponent in (2, 3):
            got = sorted(map(tuple, runs.all_runs(words, exponent).tolist()), key=lambda r: (r[0], r[2]))
            assert got == by_hand(words, 1, exponent)


def test_common_extensions():
    rng = random.Random(4)
    for n in (1, 2, 17, 300):
        words = repeating_tail(rng, n, 2, 9)
        found = runs.Extensions(words)
        pairs = np.array([(i, j) for i in range(n + 1) for j in range(n + 1) if i != j][:: 1 + n // 20])
        for (i, j), length in zip(pairs, found.common(pairs[:, 0], pairs[:, 1])):
            k = 0
            while max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            assert length == k
        assert found.rank.tolist() == [sorted(range(n + 1), key=lambda i: words[i:]).index(i) for i in range(n + 1)]
        assert found.rank_down.tolist() == [sorted(range(n + 1), key=lambda i: [-w for w in words[i:]]).index(i) for i in range(n + 1)]


def test_parts_without_repeats_cost_no_run():
    """Many texts at once, in which only repeated parts are looked at: the same as every text in full."""
    rng = random.Random(2)
    for _ in range(120):
        texts = [repeating_tail(rng, rng.randint(0, 150), 6, 40) for _ in range(6)]
        texts.append(texts[0])
        codes, sizes = np.array([w for t in texts for w in t], dtype=np.int64), np.array([len(t) for t in texts])
        for least, exponent in ((24, 3), (10, 2), (1, 3), (7, 4)):
            for got, words in zip(runs.runs_of_texts(codes, sizes, least, exponent), texts):
                assert list(map(tuple, got.tolist())) == by_hand(words, least, exponent)


CASES = [
    (1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "la " * 23), (6, "la " * 24), (7, "a b c d e f g h " * 3 + "a b x"), (8, "a b c d e f g h i " * 2),
    (9, ("one two\tthree\n" * 9) + "end " + "é ß " * 13), (None, "no key"), (9, "again " * 30), (9, "again " * 30), (-3, "la\x0bla\x0cla\rla\x1cla " * 12),
]


def test_operator(spark):
    docs = spark.createDataFrame([(*r, "x", 5) for r in CASES], "doc_id long, text string, runs string, n_words int")
    rows = runs.find_runs(docs.repartition(3)).collect()
    assert len(rows) == len(CASES)
    got = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows)
    want = []
    for key, text in CASES:
        words = (text or "").encode().split()
        found = by_hand(words, 24, 3)
        drop = {i for s, n, p in found for i in range(s + p, s + n)}
        want.append((str(key), len(words), found, b" ".join(w for i, w in enumerate(words) if i not in drop).decode()))
    assert got == sorted(want) and sum(len(x[2]) for x in want) >= 6
    assert runs.find_runs(docs.limit(0)).count() == 0
    kept = runs.find_runs(docs.withColumnRenamed("n_words", "other"), extra=("other",)).columns
    assert kept == ["doc_id", "other", "n_words", "runs", "collapsed"]


def test_very_long_text():
    words = [k % 3000 for k in range(20_000)] + list(range(3000, 6000)) * 4
    found = runs.runs_of_texts(np.array(words), np.array([len(words)]), 24, 3)[0].tolist()
    assert [0, 20_000, 3000] in found and [20_000, 12_000, 3000] in found and len(found) == 2


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, folder).collect()
    assert len(rows) == len(texts)
    seen = 0
    for r in rows:
        words = (texts[r["doc_id"]] or "").encode().split()
        h = crc32(str(r["doc_id"]).encode())
        n, g = len(words), h // 10
        if n > 1500:
            continue  # too long to be looked at by hand
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = by_hand(words, 24, 3)
        seen += len(found)
        drop = {i for s, m, q in found for i in range(s + q, s + m)}
        assert r["n_runs"] == len(found)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest()
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        want = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
    assert seen > 5

import math
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from tallyscope.llm import pieces

TEXTS = ["Hello  world", " ▁x ▁▁ y ", "a\nb\t c\r\n", " ", "x", "", "日本é😀\x00!", "the " * 3000, "nospace" * 4000, "Ünïcode ß ﬁ", "a a\x00 a\x00b \x00 b"]


@pytest.fixture(scope="module")
def sampler():
    return pieces.PieceSampler(pieces.model_path())


def test_lossless_and_made_of_pieces(spark, sampler):
    rows = [(i, t, "x", [1]) for i, t in enumerate(TEXTS)] + [(50, None, "x", None), (None, "no key", None, None), (1, TEXTS[1], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_pieces string, ids array<int>")
    got = pieces.encode(docs, chars=20_000).collect()
    assert len(got) == len(rows) and all(r["lossless"] and r["n_pieces"] == len(r["ids"]) for r in got)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(docs)).collect()}
    assert all(back[i] == t for i, t in enumerate(TEXTS)) and back[50] == "" and back[None] == "no key"
    again = {r["doc_id"]: r["ids"] for r in pieces.encode(docs.repartition(6), chars=500_000).collect()}
    assert all(again[r["doc_id"]] == r["ids"] for r in got)
    assert pieces.encode(docs.limit(0)).count() == 0
    other = {r["doc_id"]: r["ids"] for r in pieces.encode(docs, seed=1).collect()}
    assert other[7] != again[7]


def test_frequencies_follow_the_weights(sampler):
    """Every segmentation of a short text, weighed by hand, against many draws."""
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    rank = {model.id_to_piece(i): -model.get_score(i) for i in range(259, model.get_piece_size())}
    text = "▁there"

    def ways(rest):
        if not rest:
            yield ()
        for k in range(1, len(rest) + 1):
            if rest[:k] in rank:
                for more in ways(rest[k:]):
                    yield (rest[:k], *more)

    weight = {w: math.exp(sum(-math.log(rank[p] + 2) for p in w)) for w in ways(text)}
    n = 40_000
    ids, offsets = sampler.sample(np.arange(n), ["there"] * n)
    drawn = Counter(tuple(model.id_to_piece(int(i)) for i in ids[a:b]) for a, b in zip(offsets, offsets[1:]))
    assert set(drawn) <= set(weight) and len(weight) > 10
    for way, w in weight.items():
        p = w / sum(weight.values())
        assert abs(drawn[way] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_sharp_weights_approach_the_best_segmentation():
    sharp = pieces.PieceSampler(pieces.model_path(), sharpness=60.0)
    ids, _ = sharp.sample(np.arange(50), ["therefore"] * 50)
    assert len(set(map(tuple, np.split(ids, 50)))) == 1


def test_lattices_are_held_block_by_block(sampler, monkeypatch):
    text = " ".join(f"word{k}x{k * 7919 % 100_003}" for k in range(20_000))
    held, edges = [], pieces.PieceSampler.edges

    def seen(self, points, ends):
        held.append(len(points))
        return edges(self, points, ends)

    monkeypatch.setattr(pieces.PieceSampler, "edges", seen)
    keys, texts = np.array([5, 6, 7]), [text, *TEXTS[1:3]]
    ids, offsets = sampler.sample(keys, texts)
    assert sum(held) > 200_000 and max(held) <= 50_000
    assert all(sampler.decode(ids[a:b].tolist()) == t for t, a, b in zip(texts, offsets, offsets[1:]))
    for block in (1, 10**9):
        monkeypatch.setattr(pieces, "BLOCK", block)
        some = sampler.sample(keys[1:], texts[1:])[0]
        assert np.array_equal(some, ids[offsets[1] :])

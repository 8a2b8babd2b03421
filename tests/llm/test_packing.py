import random
from bisect import bisect_left, insort
from collections import defaultdict
from types import SimpleNamespace
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyscope.llm import packing
from tallyscope.llm.queries import QUERIES


TOKENIZER = Tokenizer.from_file(packing.model_path())


def whole_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs, capacity):
    """Every piece is the document's, every sequence is gapless and within its capacity; gives the number of sequences."""
    texts = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in docs)
    want = []
    for none, doc_id, text in texts:
        ids = whole_ids(text)
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want.append((none, doc_id, k // capacity, k, len(part), crc32(np.array(part, "<u4").tobytes())))
    got = [(r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got) == sorted(want)
    used = defaultdict(list)
    for r in rows:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in used.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(used)


def one_by_one(lengths, capacity):
    """Best fit, decreasing, piece by piece."""
    rooms, sequences = [], 0
    for n in sorted(lengths, reverse=True):
        k = bisect_left(rooms, n)
        sequences += k == len(rooms)
        insort(rooms, (rooms.pop(k) if k < len(rooms) else capacity) - n)
    return sequences


TEXTS = [
    "", None, "Hello  World's don't 123 <|endoftext|> x<|startoftext|>y", "É́ İstanbul ΑΣ ς wide blank\x1cnot\x85next", "日本語 テキスト", " \n\t\x0b\x0c\r ",
    "a" * 5000, "word " * 3000, "mixed\x0bblanks\x0chere\rand\tthere", "퟿ 😀😀 é", "tie tie", "tie tie",
]


def test_pieces_and_sequences(spark):
    rng = random.Random(5)
    words = ["alpha", "Beta,", "gamma's", "x1y2", "δέλτα", "...", "night"]
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, " ".join(rng.choices(words, k=rng.choice([1, 7, 40, 200])))) for i in range(150)]
    rows += [(None, "no key"), (3, "again"), (3, "again"), (-4, "minus")]
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, piece string, length int")
    for capacity in (2048, 64):
        got = packing.pack(docs.repartition(5), capacity).collect()
        n = check(got, docs.collect(), capacity)
        assert n == one_by_one([r["length"] for r in got], capacity)
    assert packing.pack(docs.limit(0)).count() == 0 and packing.pack(docs.limit(0)).columns == packing.pack(docs).columns


def test_long_texts_in_parts_have_the_same_ids():
    text = "some words\nand \t more, of them 42 " * 40 + "b" * 300
    tokens = packing.WordTokens(packing.model_path())
    for size in (1, 50, 333):
        parts = list(packing.parts_of(text.encode(), size))
        assert b"".join(parts) == text.encode()
        ids = b"".join(tokens.encode([p.split() for p in parts]))
        assert [*np.frombuffer(ids, "<u4").tolist(), 0] == whole_ids(text)
    assert len(list(packing.parts_of(text.encode(), 50))) > 20


def test_words_have_the_library_s_ids():
    rng = random.Random(1)
    odd = ["'s", "'ll", "'T", "'vE", "<|endoftext|>", "e\u0301", "\u0345", "\u2028", "Σ", "ﬁ", "\x7f", "\x1f", "中"]
    letters = [*map(chr, range(0x21, 0x250)), *odd]
    tokens = packing.WordTokens(packing.model_path())
    words = ["".join(rng.choices(letters if k % 3 else letters[:94], k=rng.randint(1, 9))) for k in range(20_000)]
    for word in [*words, *letters, "<|endoftext|>'s", "''ll", "DON'T've"]:
        assert np.frombuffer(tokens.of_word(word.encode()), "<u4").tolist() == TOKENIZER.encode(word, add_special_tokens=False).ids, word


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def test_words_of_many_texts_have_the_library_s_ids():
    rng = random.Random(7)
    letters = [*"''''sstmdrevllL9-.|Aß×÷", *map(chr, range(0xC0, 0x180)), "<|endoftext|>", "中", "e\u0301", "\x7f", "\x1c", "\x85", "\u2028"]
    blanks = [" ", "  ", "\n", "\r\n", "\t", "\x0b", "\x0c"]
    texts = ["".join(rng.choice(letters[:22] if k % 2 else letters) if rng.random() < 0.8 else rng.choice(blanks) for _ in range(rng.randint(0, 60))) for k in range(3000)]
    tokens = packing.WordTokens(packing.model_path())
    want = [TOKENIZER.encode(text, add_special_tokens=False).ids for text in texts]
    raw = [text.encode() for text in texts]
    for kind in (pa.binary(), pa.large_binary()):
        assert [numbers(ids) for ids in tokens.encode_texts(pa.array(raw, kind))] == want
    assert [numbers(ids) for ids in tokens.encode([text.split() for text in raw])] == want
    assert [numbers(ids) for ids in tokens.encode_texts(pa.array([b"x", *raw])[1:])] == want
    broken = [b"a\xffb \xc3", b"\xe4\xb8", b"", b" ", b"\xc3\x9f's \xf0\x9f\nx"]
    assert [numbers(ids) for ids in tokens.encode_texts(pa.array(broken))] == [TOKENIZER.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids for text in broken]
    assert tokens.encode([]) == [] and tokens.encode([[], []]) == [b"", b""] and tokens.encode_texts(pa.array([], pa.binary())) == []


def test_frequent_words_stay_known_when_rare_ones_are_forgotten(monkeypatch):
    for limit in ("WORDS", "KEPT"):
        monkeypatch.setattr(packing, limit, 500, raising=False)
    tokens, asked = packing.WordTokens(packing.model_path()), []
    library, merges = tokens.tokenizer, tokens.model
    tokens.model = SimpleNamespace(tokenize=lambda part: asked.append(part) or merges.tokenize(part))
    tokens.tokenizer = SimpleNamespace(encode=lambda word, **how: asked.append(word) or library.encode(word, **how))
    rng = random.Random(2)
    rare = ["".join(rng.choices("abcdefgh", k=12)) + rng.choice(["", "λόγος"]) for _ in range(4000)]
    for k in range(0, 4000, 200):
        words = ["often", "часто", *rare[k : k + 200], "often"]
        [ids] = tokens.encode([[word.encode() for word in words]])
        assert numbers(ids) == TOKENIZER.encode(" ".join(words), add_special_tokens=False).ids
    assert asked.count("often") == asked.count("часто") == 1


def test_plan_is_best_fit_over_counts():
    rng = random.Random(3)
    for capacity in (1, 2, 7, 30, 100):
        for _ in range(60):
            histogram = {rng.randint(1, capacity): rng.choice([1, 2, 5, 40]) for _ in range(rng.randint(1, 12))}
            plan = packing.plan_best_fit(histogram, capacity)
            slots, used = defaultdict(list), defaultdict(int)
            for length, rank, n, seq, each, offset in plan:
                for k in range(n):
                    slots[length].append(rank + k)
                    assert offset + k % each * length == used[seq + k // each]
                    used[seq + k // each] += length
            assert {k: sorted(v) for k, v in slots.items()} == {k: list(range(n)) for k, n in histogram.items()}
            assert max(used.values()) <= capacity and set(used) == set(range(len(used)))
            assert len(used) == one_by_one([k for k, n in histogram.items() for _ in range(n)], capacity)


def test_plan_stays_small_whatever_the_counts():
    small = packing.plan_best_fit({k: 3 for k in range(1, 2049)}, 2048)
    large = packing.plan_best_fit({k: 10**9 + 7 * k for k in range(1, 2049)}, 2048)
    assert len(small) < 20_000 and len(large) < 20_000


def test_one_length_of_most_rows_meets_no_single_task(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "one two three").otherwise(F.repeat(F.lit("w "), F.col("id").cast("int") % 200)).alias("text"))
    rows = packing.pack(docs.repartition(13), 256).collect()
    check(rows, docs.collect(), 256)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = QUERIES["op11_best_fit_packing"](spark, folder).collect()
    n = check(rows, docs, 2048)
    assert n == one_by_one([r["length"] for r in rows], 2048)

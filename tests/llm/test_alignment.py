import random
from collections import Counter
from functools import reduce
from hashlib import sha256

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallyscope.llm import alignment
from tallyscope.llm.queries import QUERIES

A_PATH, B_PATH = alignment.model_paths()
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=B_PATH)


def visible_bytes():
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in own)}


BYTE = visible_bytes()


def spelled(text):
    """Both sides as (id, bytes), of the whole text at once; None where they don't give it back."""
    if not text:
        return None
    a = [(i, bytes(BYTE.get(c, 0) for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        p = B.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()))
    want = b" " + text.encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else None


def by_hand(texts):
    """One row per text, walking along the bytes of both sides."""
    made, pairs = [], Counter()
    for text in texts:
        sides = spelled(text)
        if sides is None:
            made.append(None)
            continue
        owner = [[i for i, (_, x) in enumerate(side) for _ in x] for side in sides]
        links = list(dict.fromkeys(zip(*owner)))
        ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in sides]
        groups, begin = [], 0
        for end in sorted(ends[0] & ends[1]):
            ids = [[side[k][0] for k in dict.fromkeys(own[begin:end])] for side, own in zip(sides, owner)]
            groups.append("|".join(",".join(map(str, x)) for x in ids))
            begin = end
        links = [(sides[0][i][0], sides[1][j][0]) for i, j in links]
        pairs.update(links)
        made.append((len(sides[0]), len(sides[1]), len(groups), links, ";".join(groups)))
    top = Counter()
    for (_, b), n in pairs.items():
        top[b] = max(top[b], n)
    out = []
    for m in made:
        if m is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, g, links, groups = m
            out.append((a, b, g, len(links), sum(pairs[x] == top[x[1]] for x in links), sum(pairs[x] for x in links), sha256(groups.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    None, "", " ", "  two  spaces ", "Hello world, it's <|endoftext|> and <s> </s> <0x41> here", "a▁b", "日本語のテキスト 日本 😀😀 é é", "tabs\tand\nlines\r\n  \n\n x",
    "\x00 zero \x1c unit", "under_score __init__  x == 42.5e-7", "Größe naïve déjà-vu ﬁ", "x", "　wide blank   y", "tie tie tie", "tie tie tie",
]


def long_texts(rng):
    words = ["the", "Theorem", "überall", "don't", "42", "naïve", "x_y", "(or)", "日本", "  ", "\n", "a\tb"]
    texts = [" ".join(rng.choices(words, k=n)) for n in (60, 300, 1500)]
    return texts + ["nospace" * 200, "日本語" * 150, "ab " * 5 + "=" * 900 + " cd ef", "one ▁ mark far " + "and on " * 100, " " * 700, "é" * 500 + " " + "tail end" * 3]


@pytest.mark.parametrize("size,fan,head", [(65_536, 16, 131_072), (64, 2, 0), (100, 3, 40), (500, 16, 131_072)])
def test_against_whole_texts(spark, size, fan, head):
    texts = TEXTS + long_texts(random.Random(3))
    rows = [(i, t, "x", 5) for i, t in enumerate(texts)] + [(None, "no key", None, None), (3, "again", None, None), (3, "again", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, row int")
    got = [(str(r["doc_id"]), *[r[c] for c in COLUMNS]) for r in alignment.align(docs.repartition(3), size=size, fan=fan, head=head).collect()]
    want = [(str(k[0]), *w) for k, w in zip(rows, by_hand([r[1] for r in rows]))]
    assert sorted(got) == sorted(want)
    assert sum(w[1] == 0 for w in want) == 4 and max(w[1] for w in want) > 1500


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs).count() == 0


def test_fragments_compose_in_any_order():
    """Any cuts into ranges, composed in any order, give what the whole text gives; composing is associative."""
    rng = random.Random(7)
    for text in [t for t in TEXTS + long_texts(rng) if spelled(t)]:
        tokens, _ = alignment.aligner((A_PATH, B_PATH)).tokens(" " + text)
        whole, links = alignment.align_one(text)
        end = 1 + len(text.encode())
        for _ in range(3):
            bounds = sorted(rng.sample(range(1, end), min(end - 1, rng.randint(1, 12))))
            some, of_them = alignment.align_one(text, bounds=bounds)
            assert some == whole and sorted(of_them.tolist()) == sorted(links.tolist())
            parts = [alignment.fragment_of(tokens.part(lo, hi), k)[0] for k, (lo, hi) in enumerate(zip([0, *bounds], [*bounds, end]))]
            step = lambda x, y: alignment.joined(x, y)[0]
            left = reduce(step, parts, alignment.Fragment())
            right = reduce(lambda x, y: step(y, x), parts[::-1], alignment.Fragment())
            flat = lambda f: (f.cut, f.first, *[x.tolist() for side in (f.prefix, f.suffix) for x in side])
            assert flat(left) == flat(right)


def test_no_piece_goes_across_a_seam():
    pieces = [B.id_to_piece(i) for i in range(B.get_piece_size())]
    assert not any("\n" in p for p in pieces) and not any("▁" in p.lstrip("▁") for p in pieces)


def test_units_have_the_tokens_of_whole_texts():
    rng = random.Random(9)
    letters = [*map(chr, range(0x21, 0x180)), "'s", "'ll", "  ", "\n\n", "\t", "<|endoftext|>", "中", "e\u0301", "\u2003"]
    words = ["".join(rng.choices(letters if k % 3 else letters[:94], k=rng.randint(1, 7))) for k in range(6000)]
    text = "".join(w + rng.choice(" \n ") for w in words)
    at = alignment.Aligner((A_PATH, B_PATH))
    units, codes, _ = at.units_of([text])
    a, b = spelled(text)
    assert sum(units[c].n_a for c in codes) == len(a) and sum(units[c].n_b for c in codes) == len(b)
    assert ";".join(units[c].groups for c in codes) == alignment.align_one(text)[0]
    got = [tuple(map(int, part.split(","))) for c in codes for g in units[c].groups.split(";") for part in g.split("|")[:1]]
    assert [i for ids in got for i in ids] == [i for i, _ in a]


def test_ranges_are_whole_and_not_handed_on_often():
    rng = random.Random(2)
    for text in [t.encode() for t in long_texts(rng)] + [b"x" * 5000 + b" a b " + b"y" * 300]:
        parts = list(alignment.byte_ranges(text, 64))
        assert [p[1] for p in parts] == [0, *[p[2] for p in parts[:-1]]] and parts[-1][2] == len(text) + 1
        assert sum(len(p[4]) for p in parts) <= 3 * (len(text) + 1)
        assert all(at <= lo and at + len(part) >= hi and part[:1] in (b" ", b"\n") for _, lo, hi, at, part in parts)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = [(r["doc_id"], *[r[c] for c in COLUMNS]) for r in QUERIES["op12_token_alignment"](spark, folder).collect()]
    assert sorted(got) == sorted((d["doc_id"], *w) for d, w in zip(docs, by_hand([d["text"] for d in docs])))

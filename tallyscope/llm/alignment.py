"""Alignment of two tokenizations of a text, by fragments of byte ranges that compose associatively."""

from __future__ import annotations

import gc
import re
from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import sha256
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage
from tallyscope.llm.common import slices
from tallyscope.llm.packing import byte_letters

#: The public vocabularies, by the installed package's names for them.
MODELS = ("byte_bpe_50k.json", "piece_bpe_32k.model")
#: Where neither vocabulary has a token across: before a single space or line break between characters that are no white space.
SEAM = re.compile(r"(?<=\S)(?=[ \n]\S)")
BYTE_SEAM = re.compile(rb"(?<=[!-~])(?=[ \n][!-~])")
#: Units (text between seams) of these characters fall into parts by the first vocabulary's own rule.
PLAIN = re.compile("[ \n][!-~À-ÖØ-öø-ſ]+")
PARTS = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ſ]+| ?[0-9]+| ?[^ \nA-Za-z0-9À-ÖØ-öø-ſ]+")
#: Distinct units and parts that a Python worker keeps, and bytes of text worked on at a time.
UNITS, BYTES = 150_000, 1_000_000
#: A pair of ids as one number: the first times this, plus the second.
PAIR = 2**32
MARK = "▁"


def model_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(MODELS[0]), public_tokenizers.path(MODELS[1])


class Tokens(NamedTuple):
    """Tokens of both sides in a byte range of a text: ids, and the bytes of the whole text before each token's end."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def part(self, after: int, upto: int) -> Tokens:
        """The tokens that end after one byte and not after another."""
        i, j = (np.searchsorted(x, (after, upto), side="right") for x in (self.a_end, self.b_end))
        return Tokens(self.a[i[0] : i[1]], self.a_end[i[0] : i[1]], self.b[j[0] : j[1]], self.b_end[j[0] : j[1]])

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*map(np.concatenate, zip(self, other)))


NOTHING = Tokens(*(np.empty(0, np.int64) for _ in range(4)))


class Fragment(NamedTuple):
    """What a byte range knows of the alignment: tokens up to the first cut, and after the last one. A cut is a byte at
    which tokens of both sides end; without any, all tokens are in ``prefix``. Groups between cuts are closed.

    Fragments of neighbouring ranges compose with ``joined``, which is associative with ``Fragment()`` as its neutral
    element. ``first`` is the number of the first chunk with a cut: closed groups made by composing come before its own.
    """

    cut: bool = False
    first: int = -1
    prefix: Tokens = NOTHING
    suffix: Tokens = NOTHING


def joined(left: Fragment, right: Fragment) -> tuple[Fragment, tuple[int, Tokens] | None]:
    """The fragment of both ranges, and the group that their meeting closes: where it belongs, and its tokens."""
    if not right.cut:
        if not left.cut:
            return Fragment(prefix=left.prefix + right.prefix), None
        return left._replace(suffix=left.suffix + right.prefix), None
    if not left.cut:
        return right._replace(prefix=left.prefix + right.prefix), None
    closed = left.suffix + right.prefix
    return Fragment(True, left.first, left.prefix, right.suffix), (right.first, closed)


def cuts_of(tokens: Tokens) -> np.ndarray:
    """Bytes at which tokens of both sides end."""
    return np.intersect1d(tokens.a_end, tokens.b_end, assume_unique=True)


def ends_of(tokens: Tokens) -> np.ndarray:
    """Bytes at which tokens of either side end."""
    both = np.sort(np.concatenate([tokens.a_end, tokens.b_end]), kind="stable")
    return both[np.concatenate([both[1:] != both[:-1], [True]])] if len(both) else both


def links_of(tokens: Tokens) -> np.ndarray:
    """All pairs of tokens that share bytes, of whole groups: one for each stretch between two ends of either side."""
    ends = ends_of(tokens)
    return tokens.a[np.searchsorted(tokens.a_end, ends)] * PAIR + tokens.b[np.searchsorted(tokens.b_end, ends)]


def groups_text(tokens: Tokens, cuts: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3`` of whole groups that end at ``cuts``."""
    a, b = (list(map(str, x.tolist())) for x in (tokens.a, tokens.b))
    out, i, j = [], 0, 0
    for i_end, j_end in zip(np.searchsorted(tokens.a_end, cuts, side="right").tolist(), np.searchsorted(tokens.b_end, cuts, side="right").tolist()):
        out.append(f"{','.join(a[i:i_end])}|{','.join(b[j:j_end])}")
        i, j = i_end, j_end
    return ";".join(out)


def fragment_of(tokens: Tokens, chunk: int) -> tuple[Fragment, Tokens, np.ndarray]:
    """The fragment of the tokens that end in a chunk, the tokens of its closed groups, and the ends of these."""
    cuts = cuts_of(tokens)
    if not len(cuts):
        return Fragment(prefix=tokens), NOTHING, cuts
    last = int(max([0, *tokens.a_end[-1:], *tokens.b_end[-1:]]))
    fragment = Fragment(True, chunk, tokens.part(-1, int(cuts[0])), tokens.part(int(cuts[-1]), last))
    return fragment, tokens.part(int(cuts[0]), int(cuts[-1])), cuts[1:]


class Unit(NamedTuple):
    """All that is known of a distinct text between two seams."""

    whole: bool
    n_a: int
    n_b: int
    groups: str
    n_groups: int
    #: Links as 64-bit numbers.
    pairs: bytes


BROKEN = Unit(False, 0, 0, "", 0, b"")


class Aligner:
    """Both vocabularies. Every text is read with a space in front, which the second one adds by itself."""

    def __init__(self, paths: tuple[str, str]):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(paths[0])
        self.a.encode_special_tokens = True
        self.model = self.a.model
        self.b = SentencePieceProcessor(model_file=paths[1])
        letters = byte_letters()
        self.written = [letters[b] for b in range(256)]
        byte_of = {letter: byte for byte, letter in letters.items()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            known = all(c in byte_of for c in token)
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode())
        self.a_size, self.b_size = (np.array([len(x) for x in spelled]) for spelled in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (list(map(str, range(len(spelled)))) for spelled in (self.a_bytes, self.b_bytes))
        self.units: dict[str, Unit] = {}
        self.old: dict[str, Unit] = {}
        self.parts: dict[str, list[int]] = {}

    def of_part(self, part: str) -> list[int]:
        written = "".join([self.written[b] for b in part.encode()])
        ids = self.parts[part] = [t.id for t in self.model.tokenize(written)]
        return ids

    def first_ids(self, units: list[str]) -> list[int]:
        """Tokens of units, one after the other: plain ones by parts, which never reach across a seam."""
        if all(map(PLAIN.fullmatch, units)):
            known = self.parts.get
            return [i for part in PARTS.findall("".join(units)) for i in known(part) or self.of_part(part)]
        return [i for e in self.a.encode_batch_fast(units, add_special_tokens=False) for i in e.ids]

    def second_ids(self, texts: list[str]) -> list[list[int]]:
        """Of texts that begin with a space, which is added anyway, or with a line break, which no piece goes across."""
        plain = [t[1:] if t[0] == " " else t for t in texts]
        return [ids if t[0] == " " else ids[1:] for t, ids in zip(texts, self.b.encode(plain, num_threads=1))]

    def spells(self, text: str, a: list[int], b: list[int]) -> bool:
        want = text.encode("utf-8", "surrogatepass")
        return b"".join([self.a_bytes[i] for i in a]) == want and b"".join([self.b_bytes[i] for i in b]) == want

    def tokens(self, text: str, at: int = 0) -> tuple[Tokens, bool]:
        """Tokens of ``text``, which begins at byte ``at`` of a whole one, at its beginning or a seam; and whether both sides spell it."""
        a, b = self.first_ids([text]), self.second_ids([text])[0]
        whole = self.spells(text, a, b)
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        return Tokens(a, at + np.cumsum(self.a_size[a]), b, at + np.cumsum(self.b_size[b])), whole

    def make(self, units: list[str]) -> list[Unit]:
        """What is known of distinct units. They are aligned side by side, as one text, every seam being a cut."""
        if not units:
            return []
        a, b = self.first_ids(units), [i for ids in self.second_ids(units) for i in ids]
        if not self.spells("".join(units), a, b):
            if len(units) == 1:
                return [BROKEN]
            half = len(units) // 2
            return self.make(units[:half]) + self.make(units[half:])
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        tokens = Tokens(a, np.cumsum(self.a_size[a]), b, np.cumsum(self.b_size[b]))
        cuts, links = cuts_of(tokens), links_of(tokens)
        ends = ends_of(tokens)
        a_text, b_text = list(map(self.a_text.__getitem__, a.tolist())), list(map(self.b_text.__getitem__, b.tolist()))
        i, j = (np.searchsorted(x, cuts, side="right").tolist() for x in (tokens.a_end, tokens.b_end))
        groups = [
            f"{a_text[i0]}|{b_text[j0]}" if i1 - i0 == 1 == j1 - j0 else f"{','.join(a_text[i0:i1])}|{','.join(b_text[j0:j1])}"
            for i0, i1, j0, j1 in zip([0, *i], i, [0, *j], j)
        ]
        unit_end = np.cumsum([len(u.encode()) for u in units])
        upto = [np.searchsorted(x, unit_end, side="right") for x in (tokens.a_end, tokens.b_end, cuts, ends)]
        n_a, n_b, n_groups = (np.diff(x, prepend=0).tolist() for x in upto[:3])
        g, e, raw = upto[2].tolist(), (8 * upto[3]).tolist(), links.astype(np.int64).tobytes()
        return [
            Unit(True, k_a, k_b, ";".join(groups[g0:g1]), k, raw[e0:e1])
            for k_a, k_b, k, g0, g1, e0, e1 in zip(n_a, n_b, n_groups, [0, *g], g, [0, *e], e)
        ]

    def units_of(self, texts: list[str]) -> tuple[list[Unit], np.ndarray, np.ndarray]:
        """The distinct units of texts with a space in front, for each unit of each text its place among them, and how many
        units each text has."""
        own = [SEAM.split(" " + t) for t in texts]
        flat = list(chain.from_iterable(own))
        place = {u: k for k, u in enumerate(dict.fromkeys(flat))}
        codes = np.fromiter(map(place.__getitem__, flat), dtype=np.int64, count=len(flat))
        if len(self.parts) > UNITS:
            self.parts.clear()
        # Units are kept in two generations: what is used moves to the younger one, and the older one goes when that is full.
        if len(self.units) > UNITS:
            self.old, self.units = self.units, {}
        new = [u for u in place if u not in self.units and u not in self.old]
        plain = list(filter(PLAIN.fullmatch, new))
        made: dict[str, Unit] = {}
        for kind in (plain, list(dict.fromkeys(new).keys() - set(plain))):
            made.update(zip(kind, self.make(kind)))
        made.update((u, self.old[u]) for u in place if u not in self.units and u in self.old)
        known = self.units.get
        found = [known(u) or made[u] for u in place]
        self.units.update((u, unit) for u, unit in made.items() if len(u) < 100)
        return found, codes, np.array([len(x) for x in own], dtype=np.int64)


@cache
def aligner(paths: tuple[str, str]) -> Aligner:
    """One per worker process, which keeps its units from one task to the next."""
    return Aligner(paths)


def counted(codes: np.ndarray, distinct: np.ndarray, of: np.ndarray, n: int) -> tuple[pa.ListArray, pa.ListArray]:
    """Distinct keys of each of n owners and how often each occurs, as lists; keys are given by their places in ``distinct``."""
    both = np.sort(of * max(1, len(distinct)) + codes)
    heads = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.empty(0, np.int64)
    times, both = np.diff(np.append(heads, len(both))), both[heads]
    owner, key = np.divmod(both, max(1, len(distinct)))
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(distinct[key], pa.int64())), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))


ITEM = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64()}
ITEMS = "n_a long, n_b long, n_groups long, n_links long, pairs array<long>, times array<int>"


def align_whole(rows: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Rows (doc_id, text) of moderate size as (doc_id, the columns of ITEMS, groups_sha256)."""

    def some(keys: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        at = aligner(paths)
        units, codes, n = at.units_of([t.decode("utf-8", "replace") for t in texts])
        of = np.repeat(np.arange(len(texts)), n)
        total = lambda x: np.bincount(of, weights=np.array(x, dtype=np.int64)[codes], minlength=len(texts)).astype(np.int64)
        good = (total([not u.whole for u in units]) == 0) & np.array([len(t) > 0 for t in texts])
        n_a, n_b, n_groups = (np.where(good, total(x), 0) for x in ([u.n_a for u in units], [u.n_b for u in units], [u.n_groups for u in units]))
        groups = [u.groups for u in units]
        ends = np.cumsum(n).tolist()
        listed = codes.tolist()
        shas = [sha256(";".join([groups[c] for c in listed[e - k : e]]).encode()).hexdigest() if g else "" for e, k, g in zip(ends, n.tolist(), good.tolist())]
        # Pairs: those of every unit, for every time the unit occurs in a text.
        kept = good[of]
        unit, owner = codes[kept], of[kept]
        size = np.array([len(u.pairs) for u in units], dtype=np.int64) // 8
        flat = np.frombuffer(b"".join([u.pairs for u in units]), dtype=np.int64)
        begin = np.cumsum(size) - size
        m = size[unit]
        pair_codes, distinct = pd.factorize(flat)
        places = np.arange(m.sum()) + np.repeat(begin[unit] - (np.cumsum(m) - m), m)
        pairs, times = counted(pair_codes[places], distinct, np.repeat(owner, m), len(texts))
        columns = [keys, *map(pa.array, (n_a, n_b, n_groups, n_a + n_b - n_groups)), pairs, times, pa.array(shas)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", *ITEM, "pairs", "times", "groups_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Units hold no cycles; looking through all of them for some takes a sixth of the time.
        gc.disable()
        try:
            for batch in batches:
                texts = batch.column("text")
                for lo, hi in slices(pc.binary_length(texts).to_pylist(), BYTES):
                    yield some(batch.column("doc_id").slice(lo, hi - lo), texts.slice(lo, hi - lo).to_pylist())
        finally:
            gc.enable()

    return rows.mapInArrow(run, f"doc_id long, {ITEMS}, groups_sha256 string")


def byte_ranges(text: bytes, size: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(number, first byte, last byte, first byte of the text handed on, that text) of the ranges of a long text.

    Bytes are those of a space and ``text``. A range is handed on with as much before and after it as the seams next to it
    ask for, so that its tokens can be found by themselves: from the last seam before it to the first seam after it. Ranges
    are ``size`` long, but where seams are more than ``size`` apart they go on, so no text is handed on more than thrice.
    """
    whole = b" " + text
    seams = np.array([m.start() for m in BYTE_SEAM.finditer(whole)], dtype=np.int64)
    edges = np.concatenate([[0], seams, [len(whole)]])
    bounds = np.arange(size, len(whole), size)
    below, above = edges[np.searchsorted(edges, bounds, side="right") - 1], edges[np.searchsorted(edges, bounds)]
    bounds = np.concatenate([[0], bounds[above - below <= size], [len(whole)]])
    for number, (lo, hi) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
        a = int(edges[np.searchsorted(edges, lo, side="right") - 1])
        yield number, lo, hi, a, whole[a : edges[np.searchsorted(edges, hi)]]


OPEN = ", ".join(f"{side}_{name} array<long>" for side in ("prefix", "suffix") for name in Tokens._fields)
LEAF = f"row long, chunk long, whole boolean, {ITEMS}, groups string, cut boolean, first long, {OPEN}"
#: Fragments on their way up (kind 'node'), and the groups that compositions have closed (kind 'group').
STEP = f"kind string, row long, chunk long, {ITEMS}, groups string, cut boolean, first long, {OPEN}"


def record(kind: str, row: int, chunk: int, fragment: Fragment | None = None, tokens: Tokens = NOTHING, cuts: np.ndarray = NOTHING.a) -> dict:
    """A row of LEAF or STEP: a fragment, closed groups, or both."""
    fragment = fragment or Fragment()
    pairs, times = np.unique(links_of(tokens), return_counts=True)
    opened = {
        f"{side}_{name}": values for side, part in (("prefix", fragment.prefix), ("suffix", fragment.suffix)) for name, values in zip(Tokens._fields, part)
    }
    return {
        "kind": kind, "row": row, "chunk": chunk, "n_a": len(tokens.a), "n_b": len(tokens.b), "n_groups": len(cuts), "n_links": int(times.sum()),
        "pairs": pairs, "times": times.astype(np.int32), "groups": groups_text(tokens, cuts), "cut": fragment.cut, "first": fragment.first, **opened,
    }


def align_chunks(rows: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """Rows (row, text) of long texts as one fragment per byte range: (the columns of LEAF)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
                for number, lo, hi, at, part in byte_ranges(text.as_py(), size):
                    yield pa.RecordBatch.from_pylist([{"row": row, "chunk": number, "lo": lo, "hi": hi, "at": at, "part": part}], schema=cut_shape)

    cut_shape = pa.schema([("row", pa.int64()), ("chunk", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("at", pa.int64()), ("part", pa.binary())])
    leaf_shape = arrow_shape(LEAF)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tokens, whole = aligner(paths).tokens(r["part"].decode("utf-8", "replace"), r["at"])
                own = tokens.part(r["lo"], r["hi"]) if whole else NOTHING
                fragment, closed, cuts = fragment_of(own, r["chunk"])
                yield pa.RecordBatch.from_pylist([{"whole": whole, **record("", r["row"], r["chunk"], fragment, closed, cuts)}], schema=leaf_shape)

    ranges = rows.mapInArrow(cut, "row long, chunk long, lo long, hi long, at long, part binary")
    return ranges.repartition("row", "chunk").mapInArrow(run, LEAF)


def arrow_shape(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in ddl.split(", "))])


def compose(nodes: DataFrame, fan: int, top: bool) -> DataFrame:
    """One level of the reduction: each run of ``fan`` neighbouring fragments of a text becomes one, and the groups this closes.

    At the top the text's own beginning is the leftmost cut, which closes its first group.
    """
    shape = arrow_shape(STEP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, Fragment()
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                own = (r["row"], r["chunk"] // fan)
                if own != key:
                    if key is not None:
                        made.append(record("node", *key, now))
                    key, now = own, Fragment(True) if top else Fragment()
                sides = [Tokens(*(np.array(r[f"{side}_{name}"], dtype=np.int64) for name in Tokens._fields)) for side in ("prefix", "suffix")]
                now, closed = joined(now, Fragment(r["cut"], r["first"], *sides))
                if closed:
                    at, tokens = closed
                    made.append(record("group", r["row"], at, None, tokens, cuts_of(tokens)[-1:]))
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=shape)
        if key is not None:
            yield pa.RecordBatch.from_pylist([record("node", *key, now)], schema=shape)

    taken = nodes.select("row", "chunk", "cut", "first", *[c.split(" ")[0] for c in OPEN.split(", ")])
    return taken.repartition("row", F.expr(f"chunk div {fan}")).sortWithinPartitions("row", "chunk").mapInArrow(run, STEP)


def digests(parts: DataFrame) -> DataFrame:
    """(row, groups_sha256) of rows (row, chunk, closed, groups): the checksum of each text's groups in their order.

    Parts come sorted and go through the checksum one by one, so no text's groups are ever held as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, begun = None, sha256(), False
        for batch in batches:
            out = []
            for row, groups in zip(batch.column("row").to_pylist(), batch.column("groups").to_pylist()):
                if row != key:
                    if key is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest, begun = row, sha256(), False
                if groups:
                    digest.update((";" if begun else "").encode() + groups.encode())
                    begun = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([d for _, d in out])], names=["row", "groups_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([digest.hexdigest()])], names=["row", "groups_sha256"])

    return parts.repartition("row").sortWithinPartitions("row", "chunk", "closed").select("row", "groups").mapInArrow(run, "row long, groups_sha256 string")


def align_long(rows: DataFrame, paths: tuple[str, str], size: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """Long texts (row, doc_id, text): what ``align_whole`` gives for a text as (row, doc_id, groups_sha256), and as many
    rows (row, the columns of ITEMS) per text as it has chunks and groups across chunks. Texts that the tokens don't spell
    have none of these, and an empty checksum.
    """
    leaves = cut_lineage(align_chunks(rows.select("row", "text"), paths, size))
    of_text = cut_lineage(leaves.groupBy("row").agg(F.min("whole").alias("whole"), F.max("chunk").alias("last")))
    good = of_text.filter("whole").select("row")
    nodes, groups = leaves.join(good, "row", "left_semi"), []
    last = of_text.agg(F.max("last")).first()[0] or 0
    closed = nodes.select("row", "chunk", F.lit(1).alias("closed"), "groups", *ITEM, "pairs", "times")
    parts = [closed]
    while True:
        top = last < fan
        level = cut_lineage(compose(nodes, fan, top))
        parts.append(level.filter("kind = 'group'").select("row", "chunk", F.lit(0).alias("closed"), "groups", *ITEM, "pairs", "times"))
        if top:
            break
        nodes, last = level.filter("kind = 'node'"), last // fan
    made = parts[0]
    for part in parts[1:]:
        made = made.unionByName(part)
    shas = digests(made.select("row", "chunk", "closed", "groups"))
    texts = rows.select("row", "doc_id").join(shas, "row", "left").withColumn("groups_sha256", F.coalesce("groups_sha256", F.lit("")))
    return texts, made.select("row", *ITEM, "pairs", "times")


def frequent_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of highest counts, ``most`` at most, in order, and their counts: those from the least count on, in steps of
    1/64 of a doubling, at which no more are left."""
    level = F.floor(F.log2("n") * 64)
    steps = {r["step"]: r["pairs"] for r in counts.groupBy(level.alias("step")).agg(F.count("*").alias("pairs")).collect()}
    above, least = 0, None
    for step in sorted(steps, reverse=True):
        if (above := above + steps[step]) > most:
            break
        least = step
    rows = [] if least is None else counts.filter(level >= least).collect()
    known = np.array(sorted((r["pair"], r["n"]) for r in rows), dtype=np.int64).reshape(-1, 2)
    return known[:, 0].copy(), known[:, 1].copy()


def scored(items: DataFrame, head: int) -> DataFrame:
    """(row, n_best, count_sum) of rows (row, pairs, times): how often a text's links are the corpus-wide best of their second
    token, and the sum of the links' corpus-wide counts.

    Tasks look up the ``head`` most frequent pairs and the highest count of every second token, tables of bounded size; the
    other pairs, each of them rare, meet their counts in a join.
    """
    counts = cut_lineage(
        items.select(F.arrays_zip("pairs", "times").alias("x")).select(F.explode("x").alias("x"))
        .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("n"))
    )
    pairs, n = frequent_pairs(counts, head)
    tops = counts.groupBy((F.col("pair") % PAIR).cast("int").alias("b")).agg(F.max("n").alias("top")).collect()  # one per id of the vocabulary
    top = np.zeros(1 + max([r["b"] for r in tops], default=0), dtype=np.int64)
    for r in tops:
        top[r["b"]] = r["top"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("pairs")
            own, times = pc.list_flatten(listed).to_numpy(), pc.list_flatten(batch.column("times")).to_numpy().astype(np.int64)
            of = np.repeat(np.arange(len(listed)), pc.list_value_length(listed).to_numpy())
            codes, distinct = pd.factorize(own)
            place = np.searchsorted(pairs, distinct)
            near = np.minimum(place, max(0, len(pairs) - 1))
            known = pairs[near] == distinct if len(pairs) else np.zeros(len(distinct), bool)
            count = np.where(known, n[near], 0) if len(pairs) else np.zeros(len(distinct), np.int64)
            best = known & (count == top[distinct % PAIR]) if len(distinct) else known
            sums, bests = np.zeros(len(listed), np.int64), np.zeros(len(listed), np.int64)
            np.add.at(sums, of, times * count[codes])
            np.add.at(bests, of, times * best[codes])
            rest = ~known[codes]
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[rest], minlength=len(listed)))]), pa.int32())
            far = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
                [pa.array(own[rest]), pa.array(times[rest]), pa.array(top[own[rest] % PAIR])], ["pair", "times", "top"]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(bests), pa.array(sums), far], names=["row", "n_best", "count_sum", "far"])

    looked = cut_lineage(items.select("row", "pairs", "times").mapInArrow(run, "row long, n_best long, count_sum long, far array<struct<pair: long, times: long, top: long>>"))
    found = looked.select("row", F.explode("far").alias("f")).select("row", "f.*").join(counts, "pair")
    rare = found.select("row", F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    return looked.select("row", "n_best", "count_sum").unionByName(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, size: int = 65_536, fan: int = 16, head: int = 131_072) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs`` (doc_id, text, …).

    A space and the text are read by both vocabularies, special tokens' strings being plain text. Bytes at which tokens of
    both sides end cut the text into groups; every two tokens of the two sides that share bytes are a link. A pair of ids
    counts as often as links of the whole corpus hold it; a link is best if no pair with its second id counts more. Texts
    that are null, empty or not spelled by their tokens (such as those with U+2581) have no tokens: zeros, and an empty
    checksum. Rows that repeat are counted each; a null doc_id stays null; no row gives no row. Other columns are ignored.

    Texts of up to ``size`` bytes are done by one task, once per distinct unit between two seams. Longer ones are cut into
    byte ranges of that size, dealt to all tasks, whose fragments are composed ``fan`` at a time, level by level; what
    moves up a level are open ends only. A stretch without seams is one task's work.
    """
    paths = paths or model_paths()
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    short = rows.filter(F.octet_length("text") <= size)
    # Numbers of rows: short ones from 0 up, long ones from -1 down.
    number = F.monotonically_increasing_id()
    whole = cut_lineage(align_whole(short, paths).withColumn("row", number))
    long_rows = cut_lineage(rows.filter(F.octet_length("text") > size).withColumn("row", -1 - number))
    texts, parts = align_long(long_rows, paths, size, fan)
    columns: list[Column | str] = ["row", *ITEM, "pairs", "times"]
    items = cut_lineage(whole.select(*columns).unionByName(parts.select(*columns)))
    found = scored(items, head)
    tallies = parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in ITEM])
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    described = whole.select("row", "doc_id", *ITEM, "groups_sha256").unionByName(
        texts.join(tallies, "row", "left").select("row", "doc_id", *ITEM, "groups_sha256")
    )
    return described.join(found, "row", "left").select("doc_id", *[zero(c) for c in (*ITEM, "n_best", "count_sum")], "groups_sha256")


def align_one(text: str, paths: tuple[str, str] | None = None, bounds: Iterable[int] = ()) -> tuple[str, np.ndarray]:
    """Groups and links of one text by fragments between any ``bounds`` (bytes), composed from left to right."""
    tokens, _ = aligner(paths or model_paths()).tokens(" " + text)
    end = 1 + len(text.encode())
    edges = [0, *sorted(b for b in set(bounds) if 0 < b < end), end]
    now, parts = Fragment(True), []
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        fragment, closed, cuts = fragment_of(tokens.part(lo, hi), k)
        now, group = joined(now, fragment)
        if group:
            parts.append((group[0], 0, group[1], cuts_of(group[1])[-1:]))
        parts.append((k, 1, closed, cuts))
    parts.sort(key=lambda p: p[:2])
    return ";".join(filter(None, (groups_text(t, c) for _, _, t, c in parts))), np.concatenate([links_of(t) for _, _, t, _ in parts])

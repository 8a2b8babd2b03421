"""SentencePiece segmentation, sampled from all segmentations of a text, and its inverse."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.common import lengths, slices, text_of

#: The mark by which pieces write a space.
MARK = "▁"
#: The public piece vocabulary, by the installed package's name for it.
MODEL = "piece_bpe_32k.model"
#: Characters of distinct units whose lattices are held together (those of one unit, if it is longer).
BLOCK = 50_000
STEP = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD6E8FEB86659FD93)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that leaves no pattern (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PieceSampler:
    """Draws segmentations with probability proportional to the product of its pieces' weights.

    A piece weighs (rank + 2) ** -sharpness, rank being its place in the vocabulary (the model's score is the negative
    rank). A character without a piece is written as its UTF-8 bytes. No used piece has a space mark but in front or a line
    break or tab anywhere, so the lattice of a text falls into units between these, which are filtered once per batch.
    """

    def __init__(self, path: str, sharpness: float = 1.0, seed: int = 0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes = np.full(256, -1, dtype=np.int32)
        self.spelled: list[bytes] = [b""] * len(ids)
        usable: dict[str, int] = {}
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value], self.spelled[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or MARK in piece[1:]):
                usable[piece], self.spelled[i] = i, piece.replace(MARK, " ").encode()
        self.seed = np.uint64(seed)
        rank = np.array([max(0.0, -model.get_score(i)) for i in ids])
        self.weight = -sharpness * np.log(rank + 2)
        self.byte_weight = -sharpness * np.log(len(ids) + 2)
        cuts = "".join(c for c in "\n\r\t" if not any(c in p for p in usable))
        self.unit = re.compile(f" ?[^ {cuts}]+| |[{cuts}]" if cuts else " ?[^ ]+| ")
        known: dict[int, int] = {}
        for piece, i in usable.items():
            h = 0
            for k, c in enumerate(piece):
                h = (h * int(BASE) + ord(c) + 1) % 2**64
                known.setdefault(h, -1)
                if k == len(piece) - 1:
                    known[h] = i
        self.hashes = np.array(sorted(known), dtype=np.uint64)
        self.piece_of = np.array([known[int(h)] for h in self.hashes], dtype=np.int32)

    def edges(self, points: np.ndarray, ends: np.ndarray):
        """Pieces in the units: start and end character, piece (-1: bytes of one character). ends: of each character's unit."""
        at = np.arange(len(points))
        h = np.zeros(len(points), dtype=np.uint64)
        found, length = [], 0
        while len(at):
            h = h * BASE + points[at + length].astype(np.uint64) + np.uint64(1)
            length += 1
            k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            alive = self.hashes[k] == h
            piece = np.where(alive, self.piece_of[k], -1)
            whole = piece >= 0
            found.append((at[whole], at[whole] + length, piece[whole]))
            if length == 1:
                found.append((at[~whole], at[~whole] + 1, piece[~whole]))
            alive &= at + length < ends[at]
            at, h = at[alive], h[alive]
        return map(np.concatenate, zip(*found))

    def sample(self, keys: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in one array, and where each text's begin."""
        units, per_text = [], np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            if text:
                units += (own := self.unit.findall(" " + text))
                per_text[k] = len(own)
        if not units:
            return np.empty(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        place: dict[str, int] = {}
        codes, distinct = np.array([place.setdefault(u, len(place)) for u in units], dtype=np.int64), list(place)
        del units, place
        length = np.array([len(u) for u in distinct], dtype=np.int64)
        begins = np.concatenate([[0], np.cumsum(length[codes])])
        text_begins = begins[np.concatenate([[0], np.cumsum(per_text)])]
        row = scramble(keys.astype(np.int64).view(np.uint64) + STEP * (self.seed + np.uint64(1)))
        state = np.repeat(row - STEP * text_begins[:-1].astype(np.uint64), per_text)
        # By the character at which a piece begins, the piece; a character written as bytes is -2 less its code point.
        chosen = np.full(begins[-1], -1, dtype=np.int32)
        # Units are drawn apart from each other, so the lattices of a block of them are all that is held at a time.
        by_code = np.argsort(codes, kind="stable")
        upto = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(distinct)))])
        for lo, hi in slices(length.tolist(), BLOCK):
            own = by_code[upto[lo] : upto[hi]]
            self.draw(distinct[lo:hi], codes[own] - lo, begins[own], state[own], chosen)

        at = np.flatnonzero(chosen != -1)
        ids, width = chosen[at], np.ones(len(at), dtype=np.int64)
        if (spelled := np.flatnonzero(ids < 0)).size:
            raw = [chr(-2 - c).encode("utf-8", "surrogatepass") for c in ids[spelled].tolist()]
            width[spelled] = [len(x) for x in raw]
            ids = np.repeat(ids, width)
            ids[ids < 0] = self.bytes[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        upto = np.concatenate([[0], np.cumsum(width)])
        return ids.astype(np.int32), upto[np.searchsorted(at, text_begins)]

    def draw(self, distinct: list[str], codes: np.ndarray, base: np.ndarray, state: np.ndarray, chosen: np.ndarray) -> None:
        """Sample units, given by their place among distinct ones, their first character and their text's state, into ``chosen``."""
        points = np.frombuffer("".join(distinct).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
        space, mark = points == 0x20, points == ord(MARK)
        points[space], points[mark] = ord(MARK), 0x20  # a mark in the text is no space: it has no piece
        length = np.array([len(u) for u in distinct], dtype=np.int64)
        first = np.concatenate([[0], np.cumsum(length)])
        unit = np.repeat(np.arange(len(length)), length)
        start, end, piece = self.edges(points, first[1:][unit])

        # Forward: log weight of all ways to reach a node. A unit has a node before each character and one at its end.
        of = unit[start]
        real = np.where(points == 0x20, ord(MARK), np.where(points == ord(MARK), 0x20, points))
        n_bytes = 1 + (real > 0x7F) + (real > 0x7FF) + (real > 0xFFFF)
        weight = np.where(piece >= 0, self.weight[piece], self.byte_weight * n_bytes[start])
        into, out_of, depth = end + of, start + of, end - first[of]
        order = np.lexsort((into, depth))
        bounds = np.concatenate([[0], np.cumsum(np.bincount(depth))])
        reach = np.zeros(first[-1] + len(length))
        s_into, s_from, s_weight = into[order], out_of[order], weight[order]
        for d in range(1, len(bounds) - 1):
            part = slice(bounds[d], bounds[d + 1])
            nodes = s_into[part]
            if len(nodes):
                heads = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
                reach[nodes[heads]] = np.logaddexp.reduceat(reach[s_from[part]] + s_weight[part], heads)
        chance = np.exp(reach[out_of] + weight - reach[into])

        # Backward: at every node one of the pieces that end there, until the unit's first node.
        order = np.argsort(into, kind="stable")
        into, out_of, piece = into[order], out_of[order].astype(np.int32), piece[order]
        back = (start - first[of])[order].astype(np.int32)  # where in its unit a piece begins
        start = start[order]
        heads = np.flatnonzero(np.concatenate([[True], into[1:] != into[:-1]]))
        total = np.cumsum(chance[order])
        low, spread = np.zeros(len(reach)), np.zeros(len(reach))
        low[into[heads]] = np.concatenate([[0.0], total])[heads]
        # A little less than the whole, so that rounding never leads to the next node's pieces.
        spread[into[heads]] = np.diff(np.concatenate([low[into[heads]], total[-1:]])) * (1 - 1e-8)
        written = np.where(piece >= 0, piece, -2 - real[start].astype(np.int64)).astype(np.int32)
        node = (first[1:] + np.arange(len(length)))[codes].astype(np.int32)
        at = base + length[codes]
        while len(node):
            drawn = scramble(state + STEP * at.astype(np.uint64))
            u = (drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53
            e = np.searchsorted(total, low[node] + u * spread[node], side="right")
            behind = back[e]
            at = base + behind
            chosen[at] = written[e]
            more = np.flatnonzero(behind)
            base, state, at, node = base[more], state[more], at[more], out_of[e[more]]

    def decode(self, ids: list[int]) -> str:
        """The text of the pieces: exactly the one they were sampled from."""
        return b"".join([self.spelled[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def encode(docs: DataFrame, path: str | None = None, sharpness: float = 1.0, seed: int = 0, chars: int = 1_000_000) -> DataFrame:
    """(doc_id, ids, n_pieces, lossless) for every row of ``docs`` (doc_id, text, …): one sampled segmentation of the whole text.

    The draw depends on doc_id, the seed and the place in the text alone, so it is the same on every run and cluster; rows
    that repeat a doc_id and text get the same pieces. ``lossless`` says whether decoding gave the text back. Null and
    empty texts have no pieces; a null doc_id draws as 0 and stays null. Other columns are ignored. About ``chars``
    characters (or one text, if longer) are held at a time.
    """
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = PieceSampler(path, sharpness, seed)
        for batch in batches:
            given, keys = batch.column("text"), batch.column("doc_id").fill_null(0).to_numpy()
            for lo, hi in slices(lengths(given), chars):
                texts = given.slice(lo, hi - lo).to_pylist()
                ids, offsets = sampler.sample(keys[lo:hi], texts)
                same = [sampler.decode(ids[a:b].tolist()) == t for t, a, b in zip(texts, offsets, offsets[1:])]
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                counts = pa.array(np.diff(offsets), pa.int32())
                columns = [batch.column("doc_id").slice(lo, hi - lo), listed, counts, pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_pieces", "lossless"])

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_pieces int, lossless boolean")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids, …); null ids give a null text."""
    path = path or model_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler = PieceSampler(path)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [None if x is None else sampler.decode(list(x)) for x in batch["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")

"""Periodic runs of words: suffix trees of a text and its reversal, constant-time common extensions, Lyndon roots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.common import slices

#: Bytes of text worked on side by side (one text, if longer).
BYTES = 4_000_000
BLOCK = 16


def suffix_tree(text: list[int]) -> tuple[list[int], list[int], list[int], dict[int, int], int]:
    """Ukkonen's suffix tree of ``text`` and an end mark 0 (letters are 1 and up): where each node's edge starts and ends,
    its parent, the edges by (node, first letter), and the factor by which nodes and letters are joined into keys.

    Node 0 is the root. The edge into a leaf ends with the text.
    """
    text = [*text, 0]
    n = len(text)
    base = max(text) + 1
    start, end, parent, link = [0], [0], [0], [0]
    edges: dict[int, int] = {}
    get = edges.get
    node, edge, length, left = 0, 0, 0, 0  # the active point: a node, where an edge's letters are in the text, and how many
    for i in range(n):
        letter = text[i]
        left += 1
        last = 0  # the inner node made before, that still waits for its link
        while left:
            if not length:
                edge = i
            key = node * base + text[edge]
            below = get(key)
            if below is None:
                edges[key] = len(start)
                start.append(i), end.append(n), parent.append(node), link.append(0)
                if last:
                    link[last] = node
                    last = 0
            else:
                s = start[below]
                size = min(end[below], i + 1) - s
                if length >= size:
                    node, edge, length = below, edge + size, length - size
                    continue
                if text[s + length] == letter:
                    length += 1
                    if last:
                        link[last] = node
                    break
                # Split the edge; the new leaf hangs from the new inner node.
                inner = len(start)
                start.append(s), end.append(s + length), parent.append(node), link.append(0)
                edges[key] = inner
                start[below], parent[below] = s + length, inner
                edges[inner * base + text[s + length]] = below
                edges[inner * base + letter] = inner + 1
                start.append(i), end.append(n), parent.append(inner), link.append(0)
                if last:
                    link[last] = inner
                last = inner
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    return start, end, parent, edges, base


class Extensions:
    """Longest common prefixes of any two suffixes of ``text``, each in constant time: the depth of the lowest common
    ancestor of their leaves, which is the least deep node of the tree's Euler tour between them.

    The tour's minima are kept per block of 16, with a table over runs of blocks whose lengths are powers of two. Also
    ``rank``, the order of suffixes by letters, and ``rank_down``, that by letters in opposite order; a suffix that begins
    another one comes first in both.
    """

    def __init__(self, text: list[int]):
        n = len(text)
        start, end, parent, edges, base = suffix_tree(text)
        count = len(start)
        keys = np.fromiter(edges.keys(), dtype=np.int64, count=len(edges))
        child = np.fromiter(edges.values(), dtype=np.int64, count=len(edges))
        del edges
        above, letter = keys // base, keys % base
        start, end, parent = (np.array(x, dtype=np.int64) for x in (start, end, parent))
        width = np.where(end > start, end - start, 0)
        # Children of every node in the order of their letters; the end mark comes first in either order.
        order = np.lexsort((letter, above))
        child, above, letter = child[order], above[order], letter[order]
        first = np.searchsorted(above, np.arange(count + 1))
        self.rank, tour, depth, leaf_at = self.walk(n, count, first, child, width, end)
        down = np.lexsort((np.where(letter == 0, 0, base - letter), above))
        self.rank_down = self.walk(n, count, first, child[down], width, end, ranks_only=True)[0]
        self.depth_of_tour = depth[tour]
        self.at = leaf_at
        whole = -(-len(tour) // BLOCK)
        padded = np.full(whole * BLOCK, n + 1, dtype=np.int32)
        padded[: len(tour)] = self.depth_of_tour
        self.depth_of_tour = padded
        self.table = [padded.reshape(whole, BLOCK).min(1)]
        while 2 ** len(self.table) <= whole:
            half = 2 ** (len(self.table) - 1)
            row = self.table[-1]
            self.table.append(np.minimum(row[: len(row) - half], row[half:]))

    @staticmethod
    def walk(n, count, first, child, width, end, ranks_only=False):
        """The Euler tour: a node whenever it is entered or come back to. Leaves are ranked as they are met."""
        child, first, width = child.tolist(), first.tolist(), width.tolist()
        depth, rank, at = [0] * count, [0] * (n + 1), [0] * (n + 1)
        tour, path, met = [], [0], 0
        upto = first[:count]
        while path:
            node = path[-1]
            if not ranks_only:
                tour.append(node)
            k = upto[node]
            if k < first[node + 1]:
                upto[node] = k + 1
                below = child[k]
                depth[below] = depth[node] + width[below]
                path.append(below)
            else:
                if first[node] == first[node + 1]:
                    suffix = n + 1 - depth[node]
                    rank[suffix] = met
                    met += 1
                    if not ranks_only:
                        at[suffix] = len(tour) - 1
                path.pop()
        return np.array(rank), np.array(tour, dtype=np.int64), np.array(depth, dtype=np.int32), np.array(at, dtype=np.int64)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of the suffixes at ``i`` and ``j``, i and j being different."""
        a, b = self.at[i], self.at[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        found = np.minimum(self.depth_of_tour[lo], self.depth_of_tour[hi])
        left, right = lo // BLOCK, hi // BLOCK
        for step in range(1, BLOCK):  # what lies in the two blocks at the ends
            x = np.minimum(lo + step, np.minimum(hi, left * BLOCK + BLOCK - 1))
            y = np.maximum(hi - step, np.maximum(lo, right * BLOCK))
            found = np.minimum(found, np.minimum(self.depth_of_tour[x], self.depth_of_tour[y]))
        between = right - left - 1
        some = np.flatnonzero(between > 0)
        level = np.zeros(len(some), dtype=np.int64)
        level[:] = np.floor(np.log2(between[some])) if len(some) else 0
        for k in np.unique(level):
            of = some[level == k]
            row = self.table[k]
            found[of] = np.minimum(found[of], np.minimum(row[left[of] + 1], row[right[of] - 2**k]))
        return found.astype(np.int64)


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the next one with a smaller value: where the longest Lyndon word from there ends."""
    out = [0] * len(rank)
    open_: list[int] = []
    values = rank.tolist()
    for k, v in enumerate(values):
        while open_ and values[open_[-1]] > v:
            out[open_.pop()] = k
        open_.append(k)
    return np.array(out, dtype=np.int64)


def all_runs(text: list[int], least_exponent: int = 2) -> np.ndarray:
    """(start, length, period) of every run of ``text``: stretches of smallest period p, at least ``least_exponent`` (2 or
    more) times p long, that neither neighbour extends.

    Every run has a root that is the longest Lyndon word at its first letter, in the order of letters or in the opposite
    one. Candidates are the longest Lyndon words of all places in both orders, each extended to both sides as far as letters
    one period apart agree: forwards by common prefixes of suffixes, backwards by those of the reversed text.
    """
    n = len(text)
    if n < 2:
        return np.zeros((0, 3), dtype=np.int64)
    forwards = Extensions(text)
    places = np.arange(n)
    roots = np.concatenate([
        places * (n + 1) + next_smaller(rank)[:n] - places for rank in (forwards.rank, forwards.rank_down)
    ])
    roots = np.unique(roots)
    i, p = roots // (n + 1), roots % (n + 1)
    ahead = forwards.common(i, i + p)  # the suffix at n is the end mark: nothing in common
    del forwards
    backwards = Extensions(text[::-1])
    back = np.zeros(len(i), dtype=np.int64)
    some = np.flatnonzero(i > 0)
    back[some] = backwards.common(n - i[some], n - (i + p)[some])
    start, length = i - back, p + ahead + back
    good = length >= least_exponent * p
    found = np.unique(np.stack([start, length, p], axis=1)[good], axis=0)
    # Sorted by start, length and period: of one stretch the smallest period stays.
    fresh = np.concatenate([[True], (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) != 0)]) if len(found) else np.zeros(0, bool)
    return found[fresh]


def repeating(words: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """Whether each word of the joined texts is within ``size`` consecutive words of its text that occur twice in it.

    Equal stretches are found by a 64-bit checksum that includes the text's number; a chance match only adds words.
    """
    n = len(words)
    inside = np.zeros(n, dtype=bool)
    if n < size:
        return inside
    step = np.uint64(0x9E3779B97F4A7C15)
    h = words.astype(np.uint64) + np.uint64(1)
    h = (h ^ (h >> np.uint64(15))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    width = 1
    while width < size:  # checksums of 2, 4, 8 … words; ``size`` is a power of two
        h = h[: len(h) - width] * (step + np.uint64(2 * width)) + h[width:]
        h ^= h >> np.uint64(31)
        width *= 2
    own = text[: len(h)] == text[size - 1 :]
    at = np.flatnonzero(own)
    h = h[at] + text[at].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, at[twice], 1)
    np.add.at(marks, at[twice] + size, -1)
    return np.cumsum(marks[:n]) > 0


def runs_of_texts(codes: np.ndarray, sizes: np.ndarray, least: int, exponent: int) -> list[np.ndarray]:
    """(start, length, period) of the runs of every text, by start, then period.

    A run of at least ``least`` words and ``exponent`` periods has at least least * (1 - 1 / exponent) consecutive words
    that come again one period later, so all of it lies in words that ``repeating`` finds for stretches of that many words
    or fewer. A run can't extend beyond them either. Trees are built for these parts of texts only, and nothing is lost.
    """
    text = np.repeat(np.arange(len(sizes)), sizes)
    size = 1 << max(0, int(np.log2(max(1, least - least // exponent))))
    inside = repeating(codes, text, size)
    out = [np.zeros((0, 3), dtype=np.int64) for _ in sizes]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    begin = np.cumsum(sizes) - sizes
    found: dict[int, list[np.ndarray]] = {}
    for lo, hi in zip(edge[::2], edge[1::2]):
        # Neighbouring texts may both be inside: cut there.
        cuts = np.concatenate([[lo], lo + 1 + np.flatnonzero(np.diff(text[lo:hi])), [hi]])
        for a, b in zip(cuts, cuts[1:]):
            if b - a < least:
                continue
            runs = all_runs((pd.factorize(codes[a:b])[0] + 1).tolist(), exponent)
            runs = runs[runs[:, 1] >= np.maximum(least, exponent * runs[:, 2])]
            if len(runs):
                found.setdefault(int(text[a]), []).append(runs + np.array([a - begin[text[a]], 0, 0]))
    for k, parts in found.items():
        runs = np.concatenate(parts)
        out[k] = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run contains after its first period."""
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(marks[:n]) == 0


RUNS = "array<struct<start: long, length: long, period: long>>"


def find_runs(docs: DataFrame, least: int = 24, exponent: int = 3, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs`` (doc_id, text, …), and the columns named in ``extra``.

    Words are what stands between characters of ``[\\x20\\x09-\\x0D]``, numbered from 0. A run is a stretch of words with
    smallest period q, of at least ``least`` words and ``exponent`` (2 or more) times q, that no neighbouring word extends
    with the period kept. ``runs`` lists them by start, then period. ``collapsed`` joins by one space the words that no run
    contains after its first q words. Null, empty and blank texts have no words, no runs and an empty collapsed text. Rows
    that repeat are each looked at; a null doc_id stays null; no row gives no row. Other columns are ignored.

    A text is one task's work, in memory that grows with its longest periodic part (about half a kilobyte a word while a
    tree is built); parts without repeated stretches cost a checksum only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in slices([len(t) for t in texts], BYTES):
                own = [t.split() for t in texts[lo:hi]]
                sizes = np.array([len(w) for w in own], dtype=np.int64)
                codes = pd.factorize(np.array([w for x in own for w in x], dtype=object))[0] if sizes.sum() else np.empty(0, np.int64)
                runs = runs_of_texts(codes, sizes, least, exponent)
                collapsed = [
                    b" ".join(w if not len(r) else [w[k] for k in np.flatnonzero(kept_words(len(w), r))]) for w, r in zip(own, runs)
                ]
                ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
                flat = np.concatenate(runs) if len(runs) else np.zeros((0, 3), np.int64)
                fields = [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)]
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                columns = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", *extra)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(sizes), listed, pa.array(collapsed, pa.binary())],
                    names=["doc_id", *extra, "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), *extra, F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    kinds = dict(rows.dtypes)
    shape = ", ".join(["doc_id long", *[f"`{c}` {kinds[c]}" for c in extra], "n_words long", f"runs {RUNS}", "collapsed binary"])
    return rows.mapInArrow(run, shape).withColumn("collapsed", F.col("collapsed").cast("string"))

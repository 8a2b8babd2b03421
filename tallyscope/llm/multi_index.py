"""Nearest neighbours by cosine through an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tallyscope.functions.lineage import cut_lineage

#: Bytes of entries that a task holds while the queries pass by, and entries and queries that are multiplied at a time: these
#: bound memory and not the search.
HELD, BLOCK, QUERY_BLOCK = 128 << 20, 512, 1024
#: Pairs of a query and an entry for which another part of the entries is worth its copy of the queries, up to so many parts.
PAIRS, PARTS = 1 << 24, 32
#: Numbers gathered at a time when scores are computed exactly.
GATHERED = 1 << 22


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def k_means(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids of the rows of ``x``; of fewer than ``k`` different rows, these."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    if len(x) <= k:
        return x
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.choice(len(x), k)])
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return distances(x, c).argmin(1)


def traverse(first: np.ndarray, second: np.ndarray, filled: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """Cells in ascending order of first[i] + second[j], until those taken hold ``enough`` entries.

    The multi-sequence walk: a heap holds the border of the pairs taken so far in the grid of the two sorted lists.
    ``filled`` has the number of entries of each cell.
    """
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[one].tolist(), second[two].tolist()
    count = filled[np.ix_(one, two)].tolist()
    taken, held, heap, upto = [], 0, [(a[0] + b[0], 0, 0)], [0] * len(a)
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        upto[i] = j + 1
        if count[i][j]:
            held += count[i][j]
            taken.append((int(one[i]), int(two[j])))
        # A pair enters when both its neighbours with a smaller sum are taken.
        if i + 1 < len(a) and upto[i + 1] == j and (j == 0 or upto[i + 1] >= j):
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and upto[i] == j + 1 and (i == 0 or upto[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return taken


def usable(vector: Column) -> Column:
    """Whether a vector can take part: no null or non-finite component, and not zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def binary(parts: list[np.ndarray]) -> pa.Array:
    """Arrays of numbers as values of a binary column."""
    ends = np.cumsum([0, *(x.nbytes for x in parts)], dtype=np.int32)
    data = np.concatenate([np.ascontiguousarray(x).reshape(-1).view(np.uint8) for x in parts]) if parts else np.empty(0, np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def content(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column in a row, and where each value begins and ends in them."""
    width = np.dtype(kind).itemsize
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // width
    data = column.buffers()[2]
    return np.frombuffer(data if data is not None else b"", kind, ends[-1] - ends[0], ends[0] * width), ends - ends[0]


def by_width(column: pa.Array, kind) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, places, matrix) of the vectors of a binary column, one matrix for each width."""
    flat, ends = content(column, kind)
    widths = np.diff(ends)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        yield int(width), at, flat.reshape(-1, width) if len(at) == len(widths) else flat[ends[at][:, None] + np.arange(width)]


def pack(rows: DataFrame, kind, most: int | None = None) -> DataFrame:
    """(vec_id, v) with the numbers of ``v`` as bytes, so equal vectors are equal bytes; 0.0 stands for -0.0, too.

    Of ``most`` the smallest ids of a vector are kept from each batch of rows, once each: copies beyond these are not shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            lists = batch["v"]
            ends = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]
            numbers = lists.values.slice(ends[0], ends[-1] - ends[0]).to_numpy(zero_copy_only=False).astype(kind, copy=False) + kind(0)
            width = np.dtype(kind).itemsize
            v = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer((ends - ends[0]) * np.int32(width)), pa.py_buffer(numbers)])
            out = pa.RecordBatch.from_arrays([batch["vec_id"], v], ["vec_id", "v"])
            found = v.dictionary_encode() if most is not None else None
            if found is not None and len(found.dictionary) < len(v):
                code, ids = found.indices.to_numpy(), batch["vec_id"].to_numpy()
                order = np.lexsort((ids, code))
                code, ids = code[order], ids[order]
                order = order[np.r_[True, (code[1:] != code[:-1]) | (ids[1:] != ids[:-1])]]
                code = found.indices.to_numpy()[order]
                begins = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
                rank = np.arange(len(code)) - np.repeat(begins, np.diff(np.r_[begins, len(code)]))
                out = out.take(pa.array(order[rank < most]))
            yield out

    return rows.mapInArrow(run, "vec_id long, v binary")


def draw(entries: DataFrame, n: int) -> DataFrame:
    """The ``n`` entries that come first by the hash of their ids.

    The counts of 4,096 ranges of the hash tell which ranges can hold them. All others are left out before rows are ordered,
    so what tasks hand on is ``n`` rows and one range, however many entries there are.
    """
    spread = F.xxhash64("ids")
    upper = F.shiftright(spread, 52)  # keeps the sign, and so the order
    held, last = 0, None
    for r in sorted(entries.groupBy(upper.alias("range")).count().collect()):
        held, last = held + r["count"], r["range"]
        if held >= n:
            break
    return entries.filter(upper <= F.lit(last)).orderBy(spread, "v").limit(n).select("v")


def fit(drawn: DataFrame, size: int, centroids: int, kind) -> tuple[np.ndarray, np.ndarray]:
    """Centroids for the halves of the unit vectors. One task has the vectors; the driver gets the centroids only."""
    half = size // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = [content(batch["v"], kind)[0].astype(float).reshape(-1, size) for batch in batches if len(batch)]
        if x:
            x = unit(np.concatenate(x))
            found = k_means(x[:, :half], centroids), k_means(x[:, half:], centroids)
            yield pa.RecordBatch.from_arrays([pa.array([len(c)], pa.int32()) for c in found] + [binary([c]) for c in found], ["n_one", "n_two", "one", "two"])

    r = drawn.coalesce(1).mapInArrow(run, "n_one int, n_two int, one binary, two binary").collect()[0]
    return np.frombuffer(r["one"]).reshape(r["n_one"], half), np.frombuffer(r["two"]).reshape(r["n_two"], size - half)


class Held:
    """The entries of one length and part, in the order of their cells, while blocks of queries are compared with them."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray, pa.Array]], best: int):
        cells = np.concatenate([c for c, _, _ in blocks])
        order = np.argsort(cells, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.cells, self.keep = cells[order], best + 1
        self.ids = pa.concat_arrays([ids for *_, ids in blocks]).take(pa.array(order))
        self.least = self.ids.values.to_numpy()[self.ids.offsets.to_numpy()[:-1]]
        self.x = np.empty((len(order), blocks[0][1].shape[1]), dtype=blocks[0][1].dtype)
        self.norm, lo = np.empty(len(order)), 0
        while blocks:  # a block goes when it is copied
            _, x, _ = blocks.pop()
            at = place[len(order) - lo - len(x) : len(order) - lo]
            self.x[at], self.norm[at], lo = x, np.linalg.norm(x.astype(float), axis=1), lo + len(x)
        if not self.norm.all():  # squares below the smallest double: no cosine
            some = self.norm > 0
            order, self.cells, self.least, self.x, self.norm, self.ids = order[some], self.cells[some], self.least[some], self.x[some], self.norm[some], self.ids.filter(pa.array(some))
        # Cells are multiplied together up to BLOCK entries, larger ones in blocks.
        ends = np.r_[np.flatnonzero(np.diff(self.cells)) + 1, len(order)].tolist()
        self.groups, lo, last = [], 0, 0
        for end in ends:
            if end - lo > BLOCK and last > lo:
                self.groups.append((lo, last))
                lo = last
            while end - lo > BLOCK:
                self.groups.append((lo, lo + BLOCK))
                lo += BLOCK
            last = end
        if lo < len(order):
            self.groups.append((lo, len(order)))

    def search(self, y: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, entry, score) of the best entries of each query among those of the cells in its mask.

        Products of single precision, whose error is bounded, tell which entries can be among the best; only these are
        scored, in double precision. Equal scores go to the smaller first id.
        """
        y = y.astype(float)
        norm = np.linalg.norm(y, axis=1)
        masks = np.asfortranarray(masks & (norm > 0)[:, None])
        norm[norm == 0] = 1
        y32 = (y / norm[:, None]).astype(np.float32)
        error = (y.shape[1] + 8) * 2.0**-22
        score, least, at = np.full((len(y), self.keep), -np.inf), np.zeros((len(y), self.keep), dtype=np.int64), np.full((len(y), self.keep), -1)
        bar = np.full(len(y), -np.inf, dtype=np.float32)
        room = np.empty(len(y) * BLOCK, dtype=np.float32)
        found, n_found = [], 0

        def merge() -> None:
            nonlocal n_found
            k, e, exact = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, dtype=np.int64),) * 3
            found.clear()
            n_found, rows = 0, np.unique(k)
            of = np.concatenate((np.repeat(rows, self.keep), k))
            scores = np.concatenate((score[rows].ravel(), exact))
            ids, places = np.concatenate((least[rows].ravel(), self.least[e])), np.concatenate((at[rows].ravel(), e))
            order = np.lexsort((ids, -scores, of))
            of = of[order]
            begins = np.searchsorted(of, rows)
            rank = np.arange(len(of)) - np.repeat(begins, np.diff(begins, append=len(of)))
            order, of, rank = order[rank < self.keep], of[rank < self.keep], rank[rank < self.keep]
            score[of, rank], least[of, rank], at[of, rank] = scores[order], ids[order], places[order]
            bar[rows] = score[rows, -1] - error

        for lo, hi in self.groups:
            cells = self.cells[lo:hi]
            asked = np.flatnonzero(masks[:, cells[0]] if cells[0] == cells[-1] else masks[:, np.unique(cells)].any(axis=1))
            if not len(asked):
                continue
            x = self.x[lo:hi]
            product = room[: len(asked) * len(x)].reshape(-1, len(x))
            np.matmul(y32 if len(asked) == len(y) else y32[asked], (x / self.norm[lo:hi, None]).astype(np.float32).T, out=product)
            low = bar[asked]
            fresh = np.flatnonzero(low == -np.inf)
            if len(fresh) and hi - lo > self.keep:
                some = product[fresh]
                some[~masks[asked[fresh]][:, cells]] = -np.inf
                low[fresh] = np.partition(some, -self.keep, axis=1)[:, -self.keep] - np.float32(2 * error)
            some = np.flatnonzero(product.max(axis=1) >= low)
            k, e = np.nonzero(product[some] >= low[some, None])
            k = asked[some[k]]
            seen = masks[k, cells[e]]
            k, e = k[seen], e[seen]
            exact = np.empty(len(k))
            step = max(1, GATHERED // y.shape[1])
            for i in range(0, len(k), step):
                to = slice(i, i + step)
                exact[to] = np.einsum("ij,ij->i", y[k[to]], x[e[to]].astype(float)) / (norm[k[to]] * self.norm[lo + e[to]])
            good = np.isfinite(exact) & (exact >= score[k, -1])
            found.append((k[good], e[good] + lo, exact[good]))
            n_found += len(found[-1][0])
            if len(fresh) or n_found > len(y):
                merge()
        merge()
        k, n = np.nonzero(at >= 0)
        return k, at[k, n], score[k, n]


def search(
    rows: DataFrame, every: int = 50, best: int = 5, visited: float = 0.7, centroids: int = 32, sample: int = 20_000
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest ``best`` rows by cosine of every row whose vec_id is divisible by ``every``.

    Scores are cosines of the original vectors in double precision; ties go to the smaller vec_id, and a row is no
    candidate of its own. With fewer candidates, all found are returned. Vectors that are null, zero, or hold a null or
    non-finite component, and rows without vec_id, take no part. A cosine needs two vectors of one length, so the candidates
    of a query are the vectors as long as its own. Rows that repeat a vec_id and vector count once. Other columns are ignored.

    The index: ``centroids`` k-means centroids for each half of the unit vectors, from ``sample`` vectors drawn by hash;
    every vector of the most common length (of equally common ones, the smallest) is indexed. A query visits cells in the
    order of summed distances until they hold the share ``visited`` of all entries; all entries of a visited cell are scored
    exactly. The share sets the recall: neighbours of vectors without structure lie in many cells. Each other length is one
    cell, searched in full.

    Equal vectors are one entry that carries its smallest ids, one more than are asked for: enough for every answer. So
    very many copies of a vector are neither a hot cell nor repeated searches. Entries are dealt over parts; a task holds one
    part and all queries pass by in blocks. No vector reaches the driver.
    """
    wide = rows.schema["embedding"].dataType
    single = isinstance(wide, ArrayType) and isinstance(wide.elementType, FloatType)
    kind = np.float32 if single else np.float64  # the given numbers, no longer than they are
    item = np.dtype(kind).itemsize
    given = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("v")).filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    common = given.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    shape = "query_id long, rank int, vec_id long, score double"
    spark = rows.sparkSession
    if common is None:
        return spark.createDataFrame([], shape)
    size = common["n"]
    half = size // 2
    # All rows of a vector meet once: its ids are ranked and gathered there.
    ids = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    gathered = pack(given, kind, best + 1).repartition("v").withColumn("n", ids).filter(F.col("n") <= best + 1)
    entries = cut_lineage(gathered.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")).withColumn("width", (F.octet_length("v") / item).cast("int")))
    asking = cut_lineage(pack(given.filter(F.col("vec_id") % every == 0), kind).distinct())
    asked = asking.groupBy("v").agg(F.min("vec_id").alias("q"))
    codebooks = fit(draw(entries.filter(F.col("width") == size), sample), size, centroids, kind)
    n_second = len(codebooks[1])
    n_cells = len(codebooks[0]) * n_second

    def cells_of(column: pa.Array) -> np.ndarray:
        """The cells of the vectors of a column; the first one for vectors of another length, of which each length is one cell."""
        cells = np.zeros(len(column), dtype=np.int32)
        for width, at, x in by_width(column, kind):
            if width == size:
                x = unit(x.astype(float))
                cells[at] = nearest(x[:, :half], codebooks[0]) * n_second + nearest(x[:, half:], codebooks[1])
        return cells

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, n = np.unique(cells_of(batch["v"]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(n, pa.int64())], ["cell", "n"])

    # One row per cell: centroids squared at most.
    counts = entries.filter(F.col("width") == size).select("v").mapInArrow(tally, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    filled = np.zeros(n_cells, dtype=np.int64)
    for r in counts:
        filled[r["cell"]] = r["n"]
    enough = max(best + 1, visited * int(filled.sum()))  # fewer could not answer
    filled = filled.reshape(-1, n_second)

    # Parts of entries, as many as keep a part below HELD bytes; every query meets every part once.
    n_asked = asked.count()
    n_entries, n_numbers = entries.agg(F.count("width"), F.sum("width")).first()
    parts = max(ceil(n_numbers * item / HELD), min(PARTS, ceil(n_entries * n_asked / PAIRS)), 1)
    dealt_shape = "part int, asks boolean, width int, cells binary, ids array<array<long>>, qs binary, vectors binary"
    named = ["part", "asks", "width", "cells", "ids", "qs", "vectors"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of the entries of one part and length."""
        for batch in batches:
            if not len(batch):
                continue
            part, widths = batch["part"].to_numpy(), batch["width"].to_numpy()
            order = np.lexsort((widths, part))
            some = batch.take(pa.array(order))
            part, widths = part[order], widths[order]
            numbers, ends = content(some["v"], kind)
            cells = cells_of(some["v"])
            cuts = np.r_[0, np.flatnonzero((part[1:] != part[:-1]) | (widths[1:] != widths[:-1])) + 1, len(part)]
            n, pairs = len(cuts) - 1, list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[cuts[:-1]], pa.int32()),
                    pa.array(np.zeros(n, dtype=bool)),
                    pa.array(widths[cuts[:-1]], pa.int32()),
                    binary([cells[lo:hi] for lo, hi in pairs]),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), some["ids"]),
                    pa.nulls(n, pa.binary()),
                    binary([numbers[ends[lo] : ends[hi]] for lo, hi in pairs]),
                ],
                named,
            )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of queries of one length, each query with the cells it visits."""
        for batch in batches:
            if not len(batch):
                continue
            q = batch["q"].to_numpy()
            out = []
            for width, at, y in by_width(batch["v"], kind):
                masks = np.ones((len(at), 1), dtype=bool)
                if width == size:
                    x = unit(y.astype(float))
                    d1, d2 = distances(x[:, :half], codebooks[0]), distances(x[:, half:], codebooks[1])
                    masks = np.zeros((len(at), n_cells), dtype=bool)
                    for k in range(len(at)):
                        taken = np.array(traverse(d1[k], d2[k], filled, enough))
                        masks[k, taken[:, 0] * n_second + taken[:, 1]] = True
                for lo in range(0, len(at), QUERY_BLOCK):
                    hi = min(lo + QUERY_BLOCK, len(at))
                    out.append((width, np.packbits(masks[lo:hi], axis=1), q[at[lo:hi]], y[lo:hi]))
            widths, masks, qs, y = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(widths, pa.int32()), binary(masks), binary(qs), binary(y)], ["width", "cells", "qs", "vectors"]
            )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best entries of a part for each query; of every part entries come first, then the queries in blocks."""

        def answers(width: int) -> pa.RecordBatch:
            masks, qs, y = (np.concatenate(x) for x in zip(*waiting.pop(width), strict=True))
            held = entries_of[width]
            k, e, s = held.search(y, np.unpackbits(masks, axis=1, count=n_cells if width == size else 1).view(bool))
            return pa.RecordBatch.from_arrays([pa.array(qs[k]), held.ids.take(pa.array(e)), pa.array(s)], ["q", "ids", "score"])

        part, blocks, entries_of, waiting = None, {}, {}, {}
        for batch in batches:
            for r in range(len(batch)):
                now, asks, width = (batch[c][r].as_py() for c in ("part", "asks", "width"))
                if now != part:
                    for w in list(waiting):
                        yield answers(w)
                    part, blocks, entries_of = now, {}, {}
                data = content(batch["vectors"].slice(r, 1), kind)[0].reshape(-1, width)
                cells = content(batch["cells"].slice(r, 1), np.uint8 if asks else np.int32)[0]
                if not asks:
                    blocks.setdefault(width, []).append((cells, data, batch["ids"].slice(r, 1).flatten()))
                    continue
                if width not in entries_of and width not in blocks:
                    continue
                if width in blocks:
                    entries_of[width] = Held(blocks.pop(width), best)
                waiting.setdefault(width, []).append((cells.reshape(len(data), -1), content(batch["qs"].slice(r, 1), np.int64)[0], data))
                if sum(len(y) for *_, y in waiting[width]) >= QUERY_BLOCK:
                    yield answers(width)
        for w in list(waiting):
            yield answers(w)

    dealt = entries.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int")).mapInArrow(deal, dealt_shape)
    routed = asked.repartition(max(1, ceil(n_asked / QUERY_BLOCK)), "q").mapInArrow(route, "width int, cells binary, qs binary, vectors binary")
    routed = routed.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(True).alias("asks"), "width", "cells", F.lit(None).cast("array<array<long>>").alias("ids"), "qs", "vectors"
    )
    met = dealt.unionByName(routed).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "asks")
    found = met.mapInArrow(score, "q long, ids array<long>, score double")
    # Per distinct query vector the best entries, then the answers of each query that has this vector.
    by_score = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    listed = (
        found.select("q", "score", F.explode("ids").alias("vec_id"))
        .withColumn("n", F.row_number().over(by_score))
        .filter(F.col("n") <= best + 1)
        .select("q", "score", "vec_id")
    )
    queries = asking.join(asked, "v").select(F.col("vec_id").alias("query_id"), "q")
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.join(listed, "q")
        .filter("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(of_query))
        .filter(F.col("rank") <= best)
        .select("query_id", "rank", "vec_id", "score")
    )

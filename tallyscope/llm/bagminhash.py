"""Near-duplicate groups by BagMinHash signatures of word shingles."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage
from tallyscope.llm.common import lengths, slices, text_of
from tallyscope.llm.graph import components
from tallyscope.llm.pieces import STEP, scramble

#: Characters of text that a task looks at together (one text, if it is longer).
CHARS = 2_000_000
SHIFT = np.uint64(0xA0761D6478BD642F)
#: A text's name: 126 bits of its words' fingerprint as one number, which aggregates and joins take in place.
NODE = "decimal(38,0)"


def words_of(text: str) -> list[bytes]:
    """Words between blanks, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingles(texts: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word shingles of texts given as words: text, hash and count, ordered by text and hash.

    A text of fewer than ``width`` words has one shingle of all its words; one without words has none.
    """
    n = np.array([len(w) for w in texts], dtype=np.int64)
    total = int(n.sum())
    if not total:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    flat = np.empty(total, dtype=object)
    flat[:] = [w for words in texts for w in words]
    codes, distinct = pd.factorize(flat)
    word = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], dtype=np.uint64)[codes]
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    text = np.repeat(np.arange(len(n)), n)
    size = np.minimum(n, width)[text]
    whole = np.arange(total) - first[text] + size <= n[text]
    at, size = np.flatnonzero(whole), size[whole]
    h = size.astype(np.uint64)
    for k in range(width):
        reach = size > k
        h[reach] = h[reach] * SHIFT + word[at[reach] + k]
    h, text = scramble(h), text[at]
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    heads = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])]))
    return text[heads], h[heads], np.diff(np.concatenate([heads, [len(h)]]))


def signatures(text: np.ndarray, h: np.ndarray, weight: np.ndarray, texts: int, m: int) -> np.ndarray:
    """BagMinHash signatures (texts x m) of weighted elements: equal in a place with probability weighted Jaccard.

    Every element has a Poisson process of points over its weight axis, m per unit of weight and time, and each point falls
    to one of the m places; a place keeps the earliest point below the element's weight. The axis is halved again and again:
    [0, 1), [1, 2), [2, 4), [4, 8) … each have a process of their own, drawn from the element's hash, so a weight uses as
    many processes as its logarithm; in the one where it ends, points above it don't count. Points are drawn in the order
    of time and only as far as a text can still use them: the horizon is set by its total weight, and pushed out
    for texts that have an empty place at its end.
    """
    best = np.full(texts * m, np.inf)
    total = np.bincount(text, weights=weight, minlength=texts)
    horizon = np.divide(np.log(m) + 3, total, out=np.zeros(texts), where=total > 0)
    # Processes: one per element and interval of its weight axis.
    rows, low, span = [np.arange(len(text))], [np.zeros(len(text))], [np.ones(len(text))]
    start = 1
    while len(more := np.flatnonzero(weight > start)):
        rows.append(more), low.append(np.full(len(more), start)), span.append(np.full(len(more), start))
        start *= 2
    element, low, span = np.concatenate(rows), np.concatenate(low), np.concatenate(span)
    owner, inside = text[element], (weight[element] - low) / span
    state = scramble(h[element] + STEP * (low + 1).astype(np.uint64))
    rate = 1.0 / (m * span)
    todo = np.arange(len(element))
    while len(todo):
        at, own = np.zeros(len(todo)), owner[todo]
        until, own_state, own_rate, own_inside = horizon[own], state[todo], rate[todo], inside[todo]
        while len(at):
            own_state = own_state + STEP
            bits = scramble(own_state)
            at = at - np.log(((bits >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32) * own_rate
            keep = np.flatnonzero(at <= until)
            at, own, until, own_state, own_rate, own_inside, bits = (x[keep] for x in (at, own, until, own_state, own_rate, own_inside, bits))
            place = ((bits & np.uint64(0xFFFF)) * np.uint64(m)) >> np.uint64(16)
            below = ((bits >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float64) < own_inside * 65536
            cell = own * m + place.astype(np.int64)
            np.minimum.at(best, cell[below], at[below])
        open_texts = np.isinf(best.reshape(texts, m)).any(axis=1) & (total > 0)
        horizon = np.where(open_texts, horizon * 2, 0.0)
        todo = np.flatnonzero(open_texts[owner])
    return best.reshape(texts, m)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of a signature."""
    cells = signature.view(np.uint64).reshape(len(signature), bands, -1)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cells.shape[:2]).copy()
    for k in range(cells.shape[2]):
        h = scramble(h * SHIFT + cells[:, :, k])
    return h.view(np.int64)


def node_of(words_a: str = "words_a", words_b: str = "words_b") -> Column:
    low = lambda c: F.col(c).bitwiseAND(2**32 - 1).cast("decimal(20,0)")
    high = lambda c, n: F.shiftrightunsigned(c, n).cast("decimal(20,0)")
    power = lambda n: F.lit(str(2**n)).cast("decimal(20,0)")
    unsigned = (high(words_b, 32) * power(32)).cast("decimal(20,0)") + low(words_b)
    return ((high(words_a, 2) * power(64)).cast(NODE) + unsigned).cast(NODE)


def sign(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, raw: hash of the text, words_a, words_b: a fingerprint of its words, size: shingles, keys: one per band)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in slices(lengths(texts), CHARS):
                words = [words_of(t) for t in texts.slice(lo, hi - lo).to_pylist()]
                text, h, count = shingles(words, width)
                keys = band_keys(signatures(text, h, count, hi - lo, bands * rows), bands)
                size = np.bincount(text, weights=count, minlength=hi - lo).astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))])
                prints = np.frombuffer(b"".join(blake2b(b" ".join(w), digest_size=16).digest() for w in words), dtype=np.int64)
                columns = [
                    batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("raw").slice(lo, hi - lo),
                    pa.array(prints[0::2]),
                    pa.array(prints[1::2]),
                    pa.array(size),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[size > 0].ravel())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "raw", "words_a", "words_b", "size", "keys"])

    shape = "doc_id long, raw long, words_a long, words_b long, size long, keys array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("raw"), text_of().alias("text")).mapInArrow(run, shape)


def overlaps(pairs: DataFrame, width: int) -> DataFrame:
    """(a, b, similarity, common) of rows (a, b, text_a, text_b): the exact weighted Jaccard similarity of their shingles, and
    how many they have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("text_a"), batch.column("text_b")
            for lo, hi in slices([x + y for x, y in zip(lengths(left), lengths(right))], CHARS):
                n = hi - lo
                text, h, count = shingles([words_of(t) for side in (left, right) for t in side.slice(lo, n).to_pylist()], width)
                size = np.bincount(text, weights=count, minlength=2 * n)
                pair = text % n
                order = np.lexsort((h, pair))
                pair, h, count = pair[order], h[order], count[order]
                twice = np.flatnonzero((h[1:] == h[:-1]) & (pair[1:] == pair[:-1]))
                common = np.bincount(pair[twice], weights=np.minimum(count[twice], count[twice + 1]), minlength=n)
                union = size[:n] + size[n:] - common
                same = np.divide(common, union, out=np.zeros(n), where=union > 0)
                columns = [batch.column("a").slice(lo, n), batch.column("b").slice(lo, n), pa.array(same), pa.array(common.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "similarity", "common"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {NODE}, b {NODE}, similarity double, common long")


def compared(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``overlaps`` of pairs (a, b) of the texts (id, text)."""
    with_b = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return overlaps(with_b.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a"), width)


def shingle_rows(texts: DataFrame, width: int) -> DataFrame:
    """(id, shingle, n) of the texts (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, ids = batch.column("text"), batch.column("id")
            for lo, hi in slices(lengths(given), CHARS):
                text, h, count = shingles([words_of(t) for t in given.slice(lo, hi - lo).to_pylist()], width)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo).take(pa.array(text)), pa.array(h.view(np.int64)), pa.array(count)], names=["id", "shingle", "n"])

    return texts.select("id", "text").mapInArrow(run, f"id {NODE}, shingle long, n long")


def unconnected(member: DataFrame, texts: DataFrame, width: int, least: float, rare: int = 16, crowd: int = 32) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of texts in different components that may still reach ``least``, of buckets with three or more texts; and
    links (a, b) that were found on the way.

    ``member`` has (key, id, size, component) of every text of a bucket. No pair that reaches the threshold is left out:
    a pair of sizes m and n needs a common part of least / (1 + least) * (m + n) shingles. A shingle that at most ``rare``
    of the texts have can be common to few pairs, which are listed; all other pairs have in common at most what either text
    has of shingles that are not rare. So texts that each differ from a much copied one in words of their own, many enough
    to part them, are told apart by counting, without being paired.

    Where more than ``crowd`` texts of a bucket are left, they are first compared with its centre, the text with the smallest
    share of rare shingles: the original of a much edited text, or what is nearest to it. That joins most of their components.
    It also parts what is not rare of each text in two, in common with the centre and beyond it, and a pair has no
    more in common than the smaller of either part: texts that lack different passages of the centre are told apart, too.
    """
    need = least / (1 + least) * (1 - 1e-9)
    per = member.groupBy("key", "component").agg(F.count("*").alias("n"))
    open_keys = (
        per.groupBy("key")
        .agg(F.sum("n").alias("texts"), F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts"))
        .filter("parts > 1 and texts > 2")
        .select("key", F.col("most.component").alias("major"))
    )
    inside = cut_lineage(member.join(open_keys, "key"))
    nodes = inside.select("id", "size", "component").distinct()
    rows = cut_lineage(shingle_rows(texts.join(nodes.select("id"), "id", "left_semi"), width))
    few = rows.groupBy("shingle").agg(F.count("*").alias("texts")).filter(F.col("texts") <= rare).select("shingle", "texts")
    scarce = cut_lineage(rows.join(few, "shingle"))
    own = scarce.groupBy("id").agg(F.sum("n").alias("scarce"))
    known = cut_lineage(nodes.join(own, "id", "left").withColumn("plain", F.col("size") - F.coalesce("scarce", F.lit(0))).select("id", "size", "component", "plain"))

    def ends(pairs: DataFrame) -> DataFrame:
        for k in ("a", "b"):
            pairs = pairs.join(known.select(*[F.col(c).alias(k if c == "id" else f"{c}_{k}") for c in known.columns]), k)
        return pairs

    # Pairs with rare shingles in common: at most rare ** 2 / 2 for each of these.
    listed = scarce.filter("texts > 1").groupBy("shingle").agg(F.collect_list(F.struct("id", "n")).alias("of"))
    one = listed.select("of", F.explode("of").alias("x")).select("x", F.explode("of").alias("y")).filter("x.id < y.id")
    common = cut_lineage(one.groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b")).agg(F.sum(F.least("x.n", "y.n")).alias("extra")))
    may = F.col("extra") + F.least("plain_a", "plain_b") >= need * (F.col("size_a") + F.col("size_b"))
    with_rare = ends(common).filter(F.col("component_a") != F.col("component_b")).filter(may).select("a", "b")

    # The others: a text outside its bucket's largest component against the rest of the bucket.
    kept = inside.drop("major").join(known.select("id", "plain"), "id")
    smallest = kept.groupBy("key").agg(F.min("size").alias("smallest"))
    kept = kept.join(smallest, "key").filter(F.col("plain") >= need * (F.col("size") + F.col("smallest")))
    kept = cut_lineage(kept)
    fewest = F.max(F.struct((F.col("plain") / F.col("size")).alias("share"), "id")).alias("fewest")
    centres = kept.groupBy("key").agg(F.count("*").alias("n"), fewest).filter(F.col("n") > crowd).select("key", F.col("fewest.id").alias("centre"))
    centred = cut_lineage(kept.join(centres, "key", "left"))
    a, b = F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")
    near = cut_lineage(compared(centred.filter("id <> centre").select(a, b).distinct(), texts, width))
    found = near.filter(F.col("similarity") >= least).select("a", "b")
    of = nodes.select("id", "component")
    joint = found.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = components(joint).toDF("component", "whole")
    shared = near.join(common, ["a", "b"], "left").select("a", "b", (F.col("common") - F.coalesce("extra", F.lit(0))).alias("within"))
    shared = shared.unionByName(shared.select(F.col("b").alias("a"), F.col("a").alias("b"), "within")).toDF("id", "centre", "within")
    placed = centred.join(joined, "component", "left").withColumn("component", F.coalesce("whole", "component")).drop("whole")
    within = F.coalesce("within", "plain")  # the centre itself; and without a centre, no more is known
    placed = cut_lineage(placed.join(shared, ["id", "centre"], "left").withColumn("within", within).withColumn("beyond", F.col("plain") - F.col("within")))
    majors = placed.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "component"))["component"].alias("major"))
    # A pair that shares several buckets is taken in the one of the lowest key.
    placed = placed.join(placed.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("keys")), "id").join(majors, "key")
    placed = cut_lineage(placed)
    x, y = (placed.select("key", *[F.col(c).alias(f"{c}_{k}") for c in ("id", "size", "component", "within", "beyond", "major", "keys")]) for k in ("x", "y"))
    outside = x.filter("component_x <> major_x")
    # What reaches none of the texts outside, by the most that any of them has, meets none.
    most = outside.groupBy("key").agg(F.max("within_x").alias("within"), F.max("beyond_x").alias("beyond"), F.min("size_x").alias("size"))
    reach = F.least("within_y", "within") + F.least("beyond_y", "beyond") >= need * (F.col("size_y") + F.col("size"))
    y = y.join(most, "key").filter(reach).drop("within", "beyond", "size")
    meets = (
        (F.col("component_x") != F.col("component_y"))
        & ((F.col("id_x") < F.col("id_y")) | (F.col("component_y") == F.col("major_y")))
        & (F.least("within_x", "within_y") + F.least("beyond_x", "beyond_y") >= need * (F.col("size_x") + F.col("size_y")))
        & (F.get(F.array_intersect("keys_x", "keys_y"), F.lit(0)) == F.col("x.key"))
    )
    plain = outside.alias("x").join(y.alias("y"), (F.col("x.key") == F.col("y.key")) & meets)
    return plain.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).unionByName(with_rare).distinct(), found


def near_duplicates(docs: DataFrame, width: int = 5, least: float = 0.8, bands: int = 32, rows: int = 6) -> DataFrame:
    """(doc_id, class_id, class_size, n_links, kept) for every row of ``docs`` (doc_id, text, …).

    Classes are the connected components of the links between texts whose multisets of ``width``-word shingles have a
    weighted Jaccard similarity of ``least`` or more; class_id is the smallest doc_id of a class, whose row is kept. Texts
    of fewer words have one shingle of all of them. Null, empty and blank texts have no shingle and are classes of their
    own; so are rows without a doc_id (class_id null, kept). Rows that share a doc_id are judged by their texts: each has
    the class of its text, and classes that the same doc_id names count apart in class_size. n_links counts the links found
    between different texts at the document's text. Other columns are ignored.

    Rows of equal words are one node, named by a fingerprint of the words. A pair is a candidate if all ``rows`` places of
    one of ``bands`` bands agree: at similarity 0.8 all but one pair in 17,000, at 0.9 all but one in 10 billion. In each
    bucket of equal keys every text is first compared with the bucket's smallest node, a star and not all pairs. Where that
    leaves texts of a bucket in different components, those of their pairs that can still reach the threshold are compared,
    too (``unconnected``), in large buckets after a second star around a centre. So no text loses its class, and a group of
    near copies never meets itself pairwise. All candidates are
    verified on whole texts.
    """
    return judged(docs, width, least, bands, rows).drop("raw")


def judged(docs: DataFrame, width: int, least: float, bands: int, rows: int) -> DataFrame:
    """``near_duplicates`` with ``raw``, a hash of the row's text that tells rows of one doc_id apart."""
    signed = cut_lineage(sign(docs, width, bands, rows).withColumn("node", node_of()).drop("words_a", "words_b"))
    known = signed.filter("doc_id is not null and size > 0")
    # Equal words have equal keys; one row stands for them: that of the smallest doc_id, then of the smallest text hash.
    first = F.min(F.struct("doc_id", "raw")).alias("first")
    copies = cut_lineage(known.groupBy("node").agg(first, F.count("*").alias("n")).select("node", "first.*", "n"))
    reps = known.join(copies.select("node", "doc_id", "raw"), ["node", "doc_id", "raw"]).dropDuplicates(["node"])
    buckets = cut_lineage(reps.select("node", "size", F.explode("keys").alias("key")))
    # A bucket's smallest node, and whether there is another one.
    leaders = buckets.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("top")).filter("a < top")
    shared = cut_lineage(buckets.join(leaders, "key").select("key", "a", F.col("node").alias("b"), "size"))
    stars = shared.filter("a < b").select("a", "b").distinct()
    wanted = copies.join(shared.select(F.col("b").alias("node")).distinct(), "node", "left_semi").select("doc_id", "raw", F.col("node").alias("id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("raw", F.xxhash64("text"))
    held = cut_lineage(texts.join(wanted, ["doc_id", "raw"]).dropDuplicates(["id"]).select("id", "text"))

    def verified(pairs: DataFrame) -> DataFrame:
        return cut_lineage(compared(pairs, held, width).filter(F.col("similarity") >= least).select("a", "b").distinct())

    links = verified(stars)
    grouped = components(links)
    member = shared.join(grouped.withColumnRenamed("node", "b"), "b", "left")
    member = member.select("key", F.col("b").alias("id"), "size", F.coalesce("component", "b").alias("component"))
    rest, found = unconnected(cut_lineage(member), held, width, least)
    links = cut_lineage(links.unionByName(found).unionByName(verified(rest.join(stars, ["a", "b"], "left_anti"))).distinct())
    ends = F.explode(F.array("a", "b")).alias("node")
    degree = links.select(ends).groupBy("node").agg(F.count("*").alias("n_links"))
    # Only linked texts have a class beyond their own copies.
    linked = cut_lineage(copies.join(components(links), "node").join(degree, "node").select("node", "component", "doc_id", "n", "n_links"))
    classes = linked.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"))
    placed = linked.join(classes, "component").select("node", "class_id", "class_size", "n_links")
    named = copies.join(placed, "node", "left").select(
        "node", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_size", "n").alias("class_size"), "n_links"
    )
    known_row = F.col("doc_id").isNotNull() & (F.col("size") > 0)
    found = signed.select("doc_id", "raw", "size", "node").join(named, "node", "left")
    return found.select(
        "doc_id",
        F.when(known_row, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(known_row, F.col("class_size")).otherwise(F.lit(1)).cast("long").alias("class_size"),
        F.when(known_row, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(known_row, F.col("doc_id") == F.col("class_id")).otherwise(F.lit(True)).alias("kept"),
        "raw",
    )


def drop_near_copies(docs: DataFrame, width: int = 5, least: float = 0.8, bands: int = 32, rows: int = 6) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns."""
    gone = judged(docs, width, least, bands, rows).filter("not kept").select(F.col("doc_id").alias("_gone"), F.col("raw").alias("_raw")).distinct()
    same = (docs["doc_id"] == F.col("_gone")) & (F.xxhash64(text_of()) == F.col("_raw"))
    return docs.join(gone, same, "left_anti")

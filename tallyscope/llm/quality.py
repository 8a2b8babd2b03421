"""Quality by compression: how much better a text packs with a dictionary of good than with one of bad text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.llm.common import fold, spread, text_of

#: Bytes compressed at a time. Short blocks keep the dictionary, and not the text itself, the main source of matches.
BLOCK = 1024
SHAPE = "doc_id long, difference double, lowest double, rate double"


def blocks(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "replace")
    return [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)] or [b""]


def packer(dictionary: bytes) -> zstandard.ZstdCompressor:
    plain = dict(level=3, write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), **plain)


def features(texts: pd.Series, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    """Per text: compressed-size difference by raw size, its lowest value in a block, and the compression rate."""
    out = np.zeros((len(texts), 3))
    for k, text in enumerate(texts):
        parts = blocks(text or "")
        raw = np.array([len(x) for x in parts], dtype=float)
        a = np.array([len(good.compress(x)) for x in parts], dtype=float)
        b = np.array([len(bad.compress(x)) for x in parts], dtype=float)
        whole = max(1.0, raw.sum())
        # A short block says little: its difference counts as that of 256 bytes at least.
        out[k] = ((b - a).sum() / whole, ((b - a) / np.maximum(raw, 256)).min(), np.minimum(a, b).sum() / whole)
    return out


def build_dictionary(texts: list[str], size: int) -> bytes:
    """Zstandard dictionary of the texts' blocks; too little text to train on serves as it is."""
    parts = [x for t in texts for x in blocks(t) if x]
    try:
        return zstandard.train_dictionary(size, parts, k=200, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-size:] or b" "


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression, by Newton steps; the last one is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


class CompressionClassifier:
    """Dictionaries of both classes and a calibration; a few hundred kilobytes, sent to every task."""

    def __init__(self, good: bytes, bad: bytes, center=(0.0,) * 3, scale=(1.0,) * 3, weights=(0.0,) * 4):
        self.good, self.bad = good, bad
        self.center, self.scale, self.weights = map(np.asarray, (center, scale, weights))

    def measure(self, docs: DataFrame) -> DataFrame:
        good, bad = self.good, self.bad

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            packers = packer(good), packer(bad)
            for batch in batches:
                out = pd.DataFrame(features(batch["text"], *packers), columns=["difference", "lowest", "rate"])
                out.insert(0, "doc_id", batch["doc_id"].to_numpy())
                yield out

        return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInPandas(run, SHAPE)

    def probability(self, values: np.ndarray) -> np.ndarray:
        z = (values - self.center) / self.scale @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def scored(self, docs: DataFrame) -> DataFrame:
        """All columns of ``docs`` with ``score``; a column of that name is replaced."""
        model = self

        @F.pandas_udf("double")
        def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            packers = packer(model.good), packer(model.bad)
            for texts in parts:
                yield pd.Series(model.probability(features(texts, *packers)))

        return docs.drop("score").withColumn("score", score(text_of()))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, calibration: int = 6000, excerpt: int = 4096, size: int = 110_000):
    """A classifier from the rows of ``labels`` (doc_id, quality) whose crc32(doc_id) mod 3 is not 1.

    What is learned from is bounded: dictionaries from ``per_class`` documents of each class with an excerpt of
    ``excerpt`` characters of each, starting anywhere in the text, the calibration from ``calibration`` other documents,
    read whole. Both are drawn by hash from all labelled documents. Labels that are null, neither 0 nor 1, or contradict
    each other for a document are left out. Where a class has no document, every score is the share of good labels (0.5
    without any).
    """
    known = (
        labels.filter((fold("doc_id", 3) != 1) & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .filter("quality = other")
        .select("doc_id", "quality", spread(F.col("doc_id")).alias("draw"))
    )
    half = F.conv(F.substring("draw", 1, 1), 16, 10).cast("int") % 2
    texts = docs.select("doc_id", text_of().alias("text"))

    def drawn(rows: DataFrame, n: int) -> DataFrame:
        chosen = rows.orderBy("draw").limit(n)  # n rows of three short columns
        return texts.join(F.broadcast(chosen), "doc_id")

    start = F.conv(F.substring("draw", 2, 7), 16, 10).cast("int") % F.greatest(F.length("text") - excerpt + 1, F.lit(1)) + 1
    first = known.filter(half == 0)
    pieces = (
        drawn(first.filter("quality = 1"), per_class)
        .unionByName(drawn(first.filter("quality = 0"), per_class))
        .groupBy("doc_id", "quality")
        .agg(F.min(F.substring(F.col("text"), start, F.lit(excerpt))).alias("text"))
        .orderBy("doc_id")
        .collect()  # 2 * per_class excerpts at most
    )
    by_class = {q: [r["text"] for r in pieces if r["quality"] == q] for q in (0, 1)}
    model = CompressionClassifier(build_dictionary(by_class[1], size), build_dictionary(by_class[0], size))
    held = drawn(known.filter(half == 1), calibration)
    seen = model.measure(held).dropDuplicates(["doc_id"]).join(F.broadcast(known.filter(half == 1).orderBy("draw").limit(calibration)), "doc_id")
    rows = seen.select("difference", "lowest", "rate", "quality").collect()  # ``calibration`` rows of numbers at most
    x, y = np.array([r[:3] for r in rows]).reshape(-1, 3), np.array([r[3] for r in rows], dtype=float)
    if all(by_class.values()) and 0 < y.sum() < len(y):
        model.center, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        model.weights = logistic((x - model.center) / model.scale, y)
    else:
        n, ones = len(pieces) + len(y), len(by_class[1]) + y.sum()
        model.weights = np.array([0.0, 0.0, 0.0, np.log((ones + 1) / (n - ones + 1))])
    return model


def score_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Every row of ``docs`` with ``score``, the probability that its text is good, and ``predicted`` (1 if 0.5 or more).

    The score depends on the text alone. Null texts count as empty; empty texts get the score of a text in which neither
    dictionary finds anything. Columns score and predicted of ``docs`` are replaced.
    """
    return fit(docs, labels, **options).scored(docs).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

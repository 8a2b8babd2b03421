"""Scoring documents with a gated recurrent language model that is trained on the corpus itself."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage
from tallyscope.llm import gru
from tallyscope.llm.common import fold, slices, text_of

#: The end of a text as a word: no word is empty.
END = b""
#: Numbers of a piece of the weights that tasks hand over for averaging.
PIECE = 4096
#: Bytes of text split into words at a time, and tokens trained on or scored side by side (one text, if longer): the more
#: tokens, the less do lanes with long texts run on alone.
BYTES, TOKENS = 8_000_000, 2_000_000
#: Tokens as they are kept in the shared table.
TOKEN = np.dtype("<u2")
LOG10 = np.log(10)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of texts, the number of each token among them, and each text's number of tokens.

    Words lie between blanks, A-Z in lower case; every text ends with the word ``END``.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    n = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    types, number = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(zero_copy_only=False)
    end = pc.index(types, END).as_py()
    if end < 0:
        end, types = len(types), pa.concat_arrays([types, pa.array([END], pa.binary())])
    # A text without words is split into one empty word, which is its end already.
    blank = n == 1
    blank[blank] = number[(np.cumsum(n) - n)[blank]] == end
    n[blank] = 0
    out = np.full(n.sum() + len(n), end, dtype=np.int64)
    word = np.ones(len(out), dtype=bool)
    word[np.cumsum(n + 1) - 1] = False
    out[word] = number[number != end]
    return types, out, n + 1


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts have about ``BYTES`` bytes."""
    for batch in batches:
        for lo, hi in slices(pc.binary_length(batch.column("text")).to_pylist(), BYTES):
            yield batch.slice(lo, hi - lo)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of all texts, each text ending with the word ``END``; counted in each task before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches):
            types, number, _ = words_of(part.column("text"))
            yield pa.RecordBatch.from_arrays([types, pa.array(np.bincount(number, minlength=len(types)))], names=["word", "n"]).filter(pc.field("n") > 0)

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """What every task knows of the words: bounded tables of the ``head``, the classes of all other words, and totals.

    Words fall into ``shape.frequent`` words that the network tells apart and classes of all others by their last two
    bytes: the byte pairs in order, cut so that all classes have about the same number of tokens. A class gives its words
    their share of its tokens, but for the share of words seen once, which it keeps for words never seen (``unseen``).
    """

    def __init__(self, tokens: int, types: int, head: list[tuple[bytes, int]], endings: np.ndarray, once: np.ndarray, frequent: int, width: int, tail: int, hidden: int):
        self.tokens, self.types = tokens, types
        self.shape = shape = gru.Shape(frequent, width, tail, hidden)
        head = sorted(head, key=lambda x: (x[0] != END, -x[1], x[0]))
        if shape.inputs > np.iinfo(TOKEN).max:
            raise ValueError("more input tokens than the table of tokens can tell apart")
        self.words = pa.array([w for w, _ in head], pa.binary())
        self.count = np.array([n for _, n in head], dtype=np.int64)
        rest, single = endings.astype(np.int64), once.astype(np.int64)
        for w, n in head[: shape.frequent]:
            rest[ending(w)] -= n
            single[ending(w)] -= n == 1
        goal = rest.sum() * np.arange(1, tail) / tail
        self.class_of_ending = np.searchsorted(np.searchsorted(np.cumsum(rest), goal), np.arange(65536), side="right").clip(0, tail - 1)
        self.class_tokens = np.bincount(self.class_of_ending, weights=rest, minlength=tail)
        seen_once = np.bincount(self.class_of_ending, weights=single, minlength=tail)
        self.unseen = np.clip((seen_once + 1) / (self.class_tokens + 2), 1e-9, 0.9)
        own = np.arange(len(head))
        self.token = np.where(own < shape.frequent, own, 0).astype(np.int32)
        self.static = np.zeros(len(head))
        if len(head) > shape.frequent:
            k = self.class_of_ending[[ending(w) for w, _ in head[shape.frequent :]]]
            self.token[shape.frequent :] = shape.frequent + k
            self.static[shape.frequent :] = np.log10((1 - self.unseen[k]) * self.count[shape.frequent :] / self.class_tokens[k])
        self.base = np.log10((self.count + 1) / (tokens + types + 1))

    def shares(self) -> tuple[np.ndarray, np.ndarray]:
        """Shares of the classes in all tokens, and of frequent words in their class; never 0."""
        own = np.zeros(self.shape.frequent)
        n = min(len(self.count), len(own))
        own[:n] = self.count[:n]
        own = (own + 1e-3).reshape(-1, self.shape.width)
        classes = np.concatenate([own.sum(1), self.class_tokens + 1e-3])
        return classes / classes.sum(), (own / own.sum(1, keepdims=True)).ravel()

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Input tokens of words, and their places in the head (-1: not there)."""
        place = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.where(place >= 0, self.token[place], self.shape.frequent + self.class_of_ending[endings(words)]), place


def endings(words: pa.Array) -> np.ndarray:
    """``ending`` of every word of a binary array."""
    cut = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or bytes(2), dtype=np.uint8).astype(np.int64)
    if len(data) == 0:
        return np.zeros(len(words), dtype=np.int64)
    byte = lambda back: np.where(cut[1:] - back >= cut[:-1], data[np.maximum(cut[1:] - back, 0)], 0)
    return byte(1) << 8 | byte(2)


def ending(word: bytes) -> int:
    """The last byte and the one before as a number."""
    return word[-1] << 8 | (word[-2] if len(word) > 1 else 0) if word else 0


def vocabulary(counted: DataFrame, head: int, frequent: int, width: int, tail: int, hidden: int) -> Vocabulary:
    """Everything the driver takes from the counted words: no more than ``head`` words and tables of fixed size."""
    totals = counted.agg(F.sum("n"), F.count("*")).first()
    # The head: words from the least count on, in steps of 1/64 of a doubling, at which no more than ``head`` are left.
    level = F.floor(F.log2("n") * 64)
    steps = {r["step"]: r["words"] for r in counted.groupBy(level.alias("step")).agg(F.count("*").alias("words")).collect()}
    above, least = 0, None
    for step in sorted(steps, reverse=True):
        if (above := above + steps[step]) > head:
            break
        least = step
    words = [] if least is None else [(bytes(r["word"]), r["n"]) for r in counted.filter((level >= least) & (F.col("word") != F.lit(END))).collect()]
    end = counted.filter(F.col("word") == F.lit(END)).first()
    words.append((END, end["n"] if end else 0))
    last = F.right(F.concat(F.lit("0000"), F.hex("word")), F.lit(4))
    key = F.conv(F.concat(F.right(last, F.lit(2)), F.left(last, F.lit(2))), 16, 10).cast("int")
    by_ending = counted.groupBy(key.alias("key")).agg(F.sum("n").alias("n"), F.sum((F.col("n") == 1).cast("long")).alias("once")).collect()  # 65536 rows at most
    endings, once = np.zeros(65536, dtype=np.int64), np.zeros(65536, dtype=np.int64)
    for r in by_ending:
        endings[r["key"]], once[r["key"]] = r["n"], r["once"]
    return Vocabulary(totals[0] or 0, totals[1], words, endings, once, frequent, width, tail, hidden)


ENCODED = (
    "row long, doc_id long, held_out boolean, mix long, n_tokens long, n_known long, base double, static double, "
    "far array<struct<word: binary, cls: int, times: int>>, tokens binary"
)


def encode_rows(rows: DataFrame, words: Vocabulary) -> DataFrame:
    """Per row (row, doc_id, held_out, mix, text) its tokens, the scores of all that a task knows by itself, and the words
    beyond the head, with their classes."""
    names = ["row", "doc_id", "held_out", "mix", "n_tokens", "n_known", "base", "static", "far", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches):
            types, number, n = words_of(part.column("text"))
            token, place = words.encode(types)
            known = place >= 0
            # A word without tokens (the end, if nothing was trained on) has its probability, but is not known.
            seen = known & (words.count[place] > 0)
            text = np.repeat(np.arange(len(n)), n)
            total = lambda x: np.bincount(text, weights=x[number], minlength=len(n))
            at = np.flatnonzero(~known[number])
            pairs, times = np.unique(text[at] * len(types) + number[at], return_counts=True)
            word = types.take(pa.array(pairs % len(types)))
            cls = words.class_of_ending[endings(word)]
            far = pa.StructArray.from_arrays([word, pa.array(cls, pa.int32()), pa.array(times, pa.int32())], names=["word", "cls", "times"])
            bounds = np.searchsorted(pairs // len(types), np.arange(len(n) + 1))
            cuts = np.concatenate([[0], np.cumsum(n * TOKEN.itemsize)]).astype(np.int32)
            kept = [None, pa.py_buffer(cuts), pa.py_buffer(token[number].astype(TOKEN))]
            yield pa.RecordBatch.from_arrays(
                [
                    *[part.column(c) for c in names[:4]],
                    pa.array(n),
                    pa.array(total(seen).astype(np.int64)),
                    pa.array(total(np.where(known, words.base[place], 0.0))),
                    pa.array(total(np.where(known, words.static[place], 0.0))),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), far),
                    pa.Array.from_buffers(pa.binary(), len(n), kept),
                ],
                names=names,
            )

    return rows.select("row", "doc_id", "held_out", "mix", "text").mapInArrow(run, ENCODED)


def tokens_in(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=TOKEN).astype(np.int32) for x in batch.column("tokens").to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Texts as tokens, in lists of about ``TOKENS`` tokens."""
    held, size = [], 0
    for batch in batches:
        for tokens in tokens_in(batch):
            held.append(tokens)
            if (size := size + len(tokens)) >= TOKENS:
                yield held
                held, size = [], 0
    if held:
        yield held


def train_round(encoded: DataFrame, shape: gru.Shape, weights: dict, rate: float, shards: int) -> tuple[dict, int]:
    """Weights after each shard of the texts has trained its own copy, averaged by the tokens it saw; and all tokens.

    Texts are dealt to shards by ``mix`` and ordered by it, so neither files nor tasks of the input change the weights.
    """
    names = list(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {k: v.copy() for k, v in weights.items()}
        seen, _ = gru.train(own, shape, chunks(batches), rate)
        flat = np.concatenate([own[k].ravel() for k in names])
        if seen:
            parts = [flat[i : i + PIECE].astype(np.float64) * seen for i in range(0, len(flat), PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([seen] * len(parts), pa.int64()), pa.array(parts, pa.list_(pa.float64()))], names=["piece", "seen", "part"])

    def total(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, part = 0, 0.0
        for batch in batches:
            for n, values in zip(batch.column("seen").to_pylist(), batch.column("part")):
                seen, part = seen + n, part + values.values.to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([seen], pa.int64()), pa.array([part / seen])], names=["piece", "seen", "part"])

    handed = "piece int, seen long, part array<double>"
    dealt = encoded.select("mix", "doc_id", "tokens").repartition(shards, "mix").sortWithinPartitions("mix", "doc_id", "tokens")
    trained = dealt.mapInArrow(run, handed)
    averaged = sorted(trained.groupBy("piece").applyInArrow(total, handed).collect(), key=lambda r: r["piece"])  # the size of the model
    if not averaged:
        return weights, 0
    flat, out, at = np.concatenate([np.array(r["part"]) for r in averaged]).astype(np.float32), {}, 0
    for k in names:
        out[k], at = flat[at : at + weights[k].size].reshape(weights[k].shape), at + weights[k].size
    return out, averaged[0]["seen"]


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def score_rows(encoded: DataFrame, shape: gru.Shape, weights: dict) -> DataFrame:
    """Per row of ``encode_rows`` the score of its tokens, words beyond the head counted by their class only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices([n.as_py() for n in batch.column("n_tokens")], TOKENS):
                part = batch.slice(lo, hi - lo)
                tokens = tokens_in(part)
                starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])[:-1]])
                logs = np.add.reduceat(gru.score(weights, shape, tokens), starts) / LOG10 + part.column("static").to_numpy()
                yield pa.RecordBatch.from_arrays([*part.columns[:6], pa.array(logs)], names=[field.split()[0] for field in SCORED.split(", ")])

    return encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "static", "tokens").mapInArrow(run, SCORED)


def score_documents(
    docs: DataFrame,
    head: int = 131_072,
    frequent: int = 512,
    width: int = 32,
    tail: int = 32,
    hidden: int = 16,
    rounds: tuple[tuple[int, float], ...] = ((1, 0.01), (3, 0.01), (8, 0.005)),
    shard: int = 2_000_000,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text, …).

    Held-out rows, those whose crc32(doc_id as text) mod 7 is 2, are scored but never learned from. A text's tokens are
    its words, A-Z in lower case, and one end; null texts count as empty and are one token, the end. base_score is the
    add-one unigram score. score is the model's log10 probability of the whole text: the network starts with an empty
    state and carries it through every window to the end. The probability of a token is that of its class given the state
    times, for the ``frequent`` most frequent words, that of the word given class and state; for other words it is the
    word's share of the class's tokens, and for words never seen the class's share for those: they are told apart by class
    only. Without training rows all tokens are unknown and the scores are those of the untrained model.

    Training goes over every token of every training document once. ``rounds`` lists (eighths of the documents up to which,
    step size): within a round shards of about ``shard`` tokens of all rounds, dealt by hash, are trained on by one task
    each by truncated backpropagation, and their weights are averaged by tokens. Word counts are taken from all training
    documents. Every text is split into words twice, for the counts and for a table of tokens that all rounds read. The
    driver and tasks hold the ``head`` most frequent words at most; all others meet their counts in a join. A null doc_id
    counts as the text '' for the fold; rows that repeat a doc_id are scored each. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).withColumn("held_out", fold("doc_id", 7) == 2)
    counted = cut_lineage(count_words(rows.filter("not held_out")))
    words = vocabulary(counted, head, frequent, width, tail, hidden)
    weights = gru.initial(words.shape, *words.shares())
    numbered = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("mix", F.xxhash64("doc_id", "text"))
    encoded = cut_lineage(encode_rows(numbered, words))
    drawn, before = F.pmod("mix", F.lit(8)), 0
    for upto, rate in rounds:
        share = encoded.filter(~F.col("held_out") & (drawn >= before) & (drawn < upto))
        weights, _ = train_round(share, words.shape, weights, rate, ceil(max(1, words.tokens) / shard))
        before = upto
    scored = cut_lineage(score_rows(encoded, words.shape, weights))
    # Words beyond the head: their counts by a join, added up per document.
    far = encoded.select("row", F.explode("far").alias("f")).select("row", "f.*")
    found = far.join(counted.withColumnRenamed("n", "c"), "word", "left")
    of_class = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("cls") + 1)
    known = F.log10((1 - of_class(words.unseen)) * F.col("c") / of_class(words.class_tokens))
    logs = found.select(
        "row",
        F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 1) / float(words.tokens + words.types + 1))).alias("base"),
        (F.col("times") * F.coalesce(known, F.log10(of_class(words.unseen)))).alias("score"),
    )
    added = logs.groupBy("row").agg(*[F.sum(c).alias(f"far_{c}") for c in ("known", "base", "score")])
    plus = lambda c: F.col(c) + F.coalesce(f"far_{c}", F.lit(0))
    return scored.join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("far_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        plus("base").alias("base_score"),
        plus("score").alias("score"),
    )

"""Packing token sequences: best fit planned over a histogram of lengths, then taken up by rank within each length."""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain, compress, pairwise
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage
from tallyscope.llm.common import slices

#: The public vocabulary, by the installed package's name for it.
MODEL = "word_bpe_49k.json"
#: Parts of words, and other words, whose tokens a Python worker keeps besides those of its texts at hand, and bytes of text split into words at a time.
KEPT, BYTES = 300_000, 8_000_000
#: Words of these letters, digits and signs are in normal form and have plain lower cases; all others go through the library.
PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]+")
#: The kind of each byte of plain words in lower case, line breaks between them. All bytes beyond ASCII are of letters.
LETTER, SIGN, DIGIT, BREAK = range(4)
KINDS = np.array([LETTER if chr(b).islower() or b >= 0x80 else DIGIT if chr(b).isdigit() else BREAK if b == 0x0A else SIGN for b in range(256)], dtype=np.uint8)
#: Blanks, after any of which a word begins.
BLANKS = (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def parts_of(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, each but the last ending before a blank; a word is never cut."""
    at = 0
    while len(text) - at > size:
        ends = [k for k in (text.find(blank, at + size) for blank in BLANKS) if k >= 0]
        if not ends:
            break
        yield text[at : min(ends)]
        at = min(ends)
    yield text[at:]


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if it is a visible one, else one after U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(others)}


def plain(word: str) -> bool:
    """Whether a word's tokens are those of its parts; a sign such as ``<|endoftext|>`` has a token of its own."""
    return "<|" not in word and ((word.isascii() and word.isprintable()) or PLAIN.fullmatch(word) is not None)


def split_parts(lines: bytes) -> tuple[pa.Array, np.ndarray]:
    """The parts of plain words in lower case, every word ended by a line break, and which of these parts are line breaks.

    This is the vocabulary's rule ``'s|'t|'re|'ve|'m|'ll|'d|letters|digit|signs``: a part ends where the kind changes, a digit
    is a part alone, and an apostrophe that begins a part takes one of these endings with it.
    """
    text = np.frombuffer(lines, np.uint8)
    kind = KINDS[text]
    begins = np.ones(len(text), dtype=bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] >= DIGIT)
    marks = np.flatnonzero(begins & (text == ord("'")))  # a line break comes after each
    first, second = text[marks + 1], text[np.minimum(marks + 2, len(text) - 1)]
    of_two = (np.isin(first, list(b"rv")) & (second == ord("e"))) | ((first == ord("l")) & (second == ord("l")))
    for ending, size in ((np.isin(first, list(b"stmd")), 1), (of_two, 2)):
        begins[marks[ending] + 1] = False
        begins[marks[ending] + 1 + size] = True
    at = np.flatnonzero(begins)
    offsets = np.append(at, len(text)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(lines)]), np.flatnonzero(kind[at] == BREAK)


def strings_of(distinct: pa.Array, between: str) -> list[str]:
    """An Arrow array of bytes as strings; none of them holds ``between``."""
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(distinct)], distinct), between.encode())[0]
    return joined.as_py().decode("utf-8", "replace").split(between)


class Kept(dict):
    """Ids by part or word, worked out once. Where they are too many, only those asked for last stay."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, key: str) -> bytes:
        ids = self[key] = self.find(key)
        return ids

    def of(self, keys: list[str]) -> pa.Array:
        ids = list(map(self.__getitem__, keys))
        if len(self) > KEPT:
            self.clear()
            self.update(zip(keys, ids))
        return pa.array(ids, pa.large_binary())


class WordTokens:
    """Token ids of words, as little-endian unsigned 32-bit numbers, worked out once per distinct word of the texts at hand.

    The vocabulary's rules drop white space and let no token cross it, so a text's tokens are those of its words. Plain words
    are taken apart together; each distinct part, by the vocabulary's rule for splitting, is given to its merges by itself.
    Ids of parts and of all other words are kept from one call to the next.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        letters = byte_letters()
        self.id_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.written = [letters[b] for b in range(256)]
        self.parts, self.others = Kept(self.of_part), Kept(self.of_other)

    def of_part(self, part: str) -> bytes:
        if part == "\n":
            return b""
        written = part if part.isascii() else "".join([self.written[b] for b in part.encode()])
        return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(written)])

    def of_other(self, word: str) -> bytes:
        return b"".join([self.id_bytes[i] for i in self.tokenizer.encode(word, add_special_tokens=False).ids])

    def of_plain_words(self, words: list[str]) -> pa.Array:
        parts, breaks = split_parts("\n".join([*words, ""]).lower().encode())
        parts = parts.dictionary_encode()
        ids = self.parts.of(strings_of(parts.dictionary, " ")).take(parts.indices)
        ends = np.append(0, np.cumsum(pc.binary_length(ids))[breaks])
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), ids.buffers()[2]])

    def of_words(self, words: list[str]) -> pa.Array:
        """Ids of words without white space in them."""
        are_plain = np.fromiter(map(plain, words), dtype=bool, count=len(words))
        if are_plain.all():
            return self.of_plain_words(words)
        first, then = list(compress(words, are_plain)), list(compress(words, ~are_plain))
        ids = [self.of_plain_words(first)] if first else []
        place = np.where(are_plain, np.cumsum(are_plain), len(first) + np.cumsum(~are_plain)) - 1
        return pa.concat_arrays([*ids, self.others.of(then)]).take(pa.array(place))

    def of_word(self, word: bytes) -> bytes:
        return self.of_words([word.decode("utf-8", "replace")])[0].as_py()

    def of_lists(self, texts: pa.ListArray) -> list[bytes]:
        """Ids of texts that are given as lists of words."""
        words = texts.flatten().view(pa.binary()).dictionary_encode()
        if not len(words):
            return [b""] * len(texts)
        ids = self.of_words(strings_of(words.dictionary, "\n")).take(words.indices)
        joined = memoryview(ids.buffers()[2] or b"")
        ends = np.append(0, np.cumsum(pc.binary_length(ids)))[texts.offsets].tolist()
        return [bytes(joined[lo:hi]) for lo, hi in pairwise(ends)]

    def encode(self, texts: list[list[bytes]]) -> list[bytes]:
        """Ids of texts that are given as words."""
        return self.of_lists(pa.array(texts, pa.list_(pa.binary())))

    def encode_texts(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts that are given whole, in UTF-8; Arrow splits at the same white space as Python splits bytes."""
        return self.of_lists(pc.ascii_split_whitespace(texts.cast(pa.binary()).view(pa.string())))


@cache
def word_tokens(path: str) -> WordTokens:
    """One per worker process, which keeps what it has worked out from one task to the next."""
    return WordTokens(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def tokenized(docs: DataFrame, capacity: int, path: str, end: int) -> DataFrame:
    """One row per piece of every document: its place in the document, its length and checksum, and ``place``, its number
    among the pieces of its length that task ``part`` has made, from 0."""

    size, last = 4 * capacity, end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = word_tokens(path), TaskContext.get().partitionId()
        made = np.zeros(capacity + 1, dtype=np.int64)

        def pieces(key: int | None, ids: Iterable[bytes]) -> Iterator[tuple]:
            """The pieces of one document whose ids come in parts."""
            left, piece = b"", 0
            for some in ids:
                left = left + some if left else some
                whole = len(left) // size * size
                for at in range(0, whole, size):
                    yield key, piece, piece * capacity, capacity, crc32(left[at : at + size])
                    piece += 1
                left = left[whole:]
            if left:
                yield key, piece, piece * capacity, len(left) // 4, crc32(left)

        def table(rows: list[tuple]) -> pa.RecordBatch:
            doc_id, piece, start, length, crc = zip(*rows)
            of = pd.Series(length)
            place = made[of] + of.groupby(of).cumcount().to_numpy()
            made[:] += np.bincount(of, minlength=capacity + 1)
            columns = [pa.array(doc_id, pa.int64()), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            return pa.RecordBatch.from_arrays([*columns, pa.array([part] * len(rows), pa.int32()), pa.array(place)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"])

        for batch in batches:
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            rows: list[tuple] = []
            sizes = pc.binary_length(texts).to_pylist()
            for lo, hi in slices(sizes, BYTES):
                if sizes[lo] > BYTES:  # a long text, alone
                    ids = (tokens.encode([some.split()])[0] for some in parts_of(texts[lo].as_py(), BYTES))
                    rows.extend(pieces(keys[lo], chain(ids, [last])))
                else:
                    for key, ids in zip(keys[lo:hi], tokens.encode_texts(texts.slice(lo, hi - lo))):
                        rows.extend(pieces(key, (ids + last,)))
            if rows:
                yield table(rows)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(run, PIECES)


def plan_best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where pieces go, from the number of pieces of each length alone: (length, first rank, pieces, sequence, each, offset).

    Ranks count the pieces of a length from 0. ``each`` pieces in a row go into one sequence, from ``offset`` on; then come
    the next sequence's. Lengths go from the longest to the shortest, every piece into the fullest sequence that still has
    room for it (best fit, decreasing). Sequences that were filled alike are one entry, however many they are: at a length
    all entries that it meets are used up but the last one, which is split in three at most. So there are at most three
    entries per length, each with as many steps as it holds different lengths, of which those of 1 to ``capacity`` add up to:
    for 2,048 tokens no more than 6,144 entries of 63 steps, whatever the number of documents.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    plan, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in free:
                free[room] = []
                insort(rooms, room)
            free[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, n = 0, histogram[length]
        while n:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, like = free[room].pop()
                if not free[room]:
                    del free[room], rooms[k]
            else:
                room, first, like = capacity, sequences, -(-n // (capacity // length))
                sequences += like
            each = room // length
            whole = min(like, n // each)
            if whole:
                plan.append((length, rank, whole * each, first, each, capacity - room))
                put(room - each * length, first, whole)
                rank, n, first, like = rank + whole * each, n - whole * each, first + whole, like - whole
            if n and like:
                plan.append((length, rank, n, first, n, capacity - room))
                put(room - n * length, first, 1)
                n, first, like = 0, first + 1, like - 1
            put(room, first, like)
    return plan


def take_slots(pieces: DataFrame, plan: list[tuple], histogram: dict[int, int]) -> DataFrame:
    """``pieces`` with their planned sequence and offset, by a join on the rank within their length.

    A length's ranks are cut into as many cells as the plan has steps for it; steps meet the cells they reach into, which
    makes at most twice as many rows as steps, and the join at most twice as many as pieces before the ranks are compared.
    The plan is bounded (see ``plan_best_fit``) and is broadcast. Ranks come from the counts of all tasks before a piece's
    own, so no length, however frequent, is sorted or collected anywhere.
    """
    spark = pieces.sparkSession
    steps = pd.Series([p[0] for p in plan]).value_counts().to_dict()
    width = {length: -(-histogram[length] // steps[length]) for length in steps}
    slots = spark.createDataFrame(
        [(length, width[length], cell, rank, rank + n, seq, each, offset)
         for length, rank, n, seq, each, offset in plan for cell in range(rank // width[length], (rank + n - 1) // width[length] + 1)],
        "length long, width long, cell long, lo long, hi long, sequence long, each long, at long",
    )
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    of_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    starts = of_task.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    widths = spark.createDataFrame(list(width.items()), "length long, width long")
    ranked = (
        pieces.join(starts, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("place"))
        .join(F.broadcast(widths), "length")
        .withColumn("cell", F.expr("rank div width"))
        .drop("width")
    )
    own = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    nth = F.col("rank") - F.col("lo")
    placed = ranked.join(F.broadcast(slots), ["length", "cell"]).filter(own)
    return placed.withColumn("sequence_id", F.col("sequence") + F.expr("(rank - lo) div each")).withColumn("offset", F.col("at") + nth % F.col("each") * F.col("length"))


def pack(docs: DataFrame, capacity: int = 2048, path: str | None = None, end: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of ``docs`` (doc_id, text, …).

    A document's tokens are the vocabulary's ids of its text, then the id ``end``; a null or empty text has the end only.
    Documents of more than ``capacity`` tokens are cut into pieces of that many, the last of which may be shorter; all others
    are one piece. A sequence's pieces lie one after the other from 0 and sum to ``capacity`` at most. ``ids_crc32`` is that
    of the piece's ids as little-endian unsigned 32-bit numbers. Rows that repeat a doc_id are packed each; a null doc_id
    stays null; no row gives no row. Other columns are ignored. Which of several pieces of one length takes which slot
    depends on the layout of the input, the number of sequences does not.

    Tokenizing is one pass over whole texts that leaves a narrow table; the driver takes one count per length from it.
    """
    pieces = cut_lineage(tokenized(docs, capacity, path or model_path(), end))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    placed = take_slots(pieces, plan_best_fit(histogram, capacity), histogram) if histogram else (
        pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    )
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

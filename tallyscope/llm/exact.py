"""Exact deduplication through an extendible-hash index on shared files."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage
from tallyscope.llm.common import SPACE, text_of

#: Finest prefix of the hash that the directory can address.
MAX_DEPTH = 24


def prefix(h: Column, depth: int) -> Column:
    return F.shiftrightunsigned(h, 64 - depth)


def directory(entries: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """Slots of an extendible-hash directory over the column ``h``, and its depth.

    The directory starts at the depth at which evenly filled buckets would fit and doubles as long as a bucket holds more
    than ``capacity`` entries. A slot whose bucket was not overfull before the last doublings shares it with its
    neighbours: ``bucket`` is the first slot, ``local_depth`` the number of hash bits that all entries of the bucket share.
    """
    fine = cut_lineage(entries.groupBy(prefix(F.col("h"), MAX_DEPTH).alias("leaf")).agg(F.count("*").alias("n")))
    total = fine.agg(F.sum("n")).first()[0] or 0
    first = depth = min(MAX_DEPTH, max(1, ceil(log2(max(1, total / capacity)))))
    slot = lambda d: F.shiftright("leaf", MAX_DEPTH - d)
    while depth < MAX_DEPTH and (
        fine.groupBy(slot(depth).alias("s")).agg(F.sum("n").alias("n")).filter(F.col("n") > capacity).limit(1).count()
    ):
        depth += 1
    slots = fine.groupBy(slot(depth).alias("slot")).agg(F.sum("n").alias("n"))
    fits = F.lit(None).cast("int")
    for d in range(depth, first - 1, -1):
        of_bucket = F.sum("n").over(Window.partitionBy(F.shiftright("slot", depth - d)))
        slots = slots.withColumn(f"n{d}", of_bucket)
        fits = F.when(F.col(f"n{d}") <= capacity, F.lit(d)).otherwise(fits)
    local = F.coalesce(fits, F.lit(depth))
    bucket = F.expr("shiftleft(shiftright(slot, free), free)")
    return (
        slots.select("slot", local.alias("local_depth"))
        .withColumn("free", F.lit(depth) - F.col("local_depth"))
        .select("slot", bucket.alias("bucket"), "local_depth"),
        depth,
    )


class Index(NamedTuple):
    """``entries`` on shared files, ordered by bucket and hash, and the directory that leads to them."""

    entries: DataFrame
    slots: DataFrame
    depth: int

    def bucket_of(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the bucket that the directory names for their column ``h``; rows without a slot drop out."""
        return rows.withColumn("slot", prefix(F.col("h"), self.depth)).join(self.slots, "slot").drop("slot", "local_depth")

    def look_up(self, rows: DataFrame) -> DataFrame:
        """``rows`` (h, text_sha256, …) with what the index says of their text: slot, bucket, then the chain of the hash."""
        return self.bucket_of(rows).join(self.entries, ["bucket", "h", "text_sha256"])


def build_index(
    docs: DataFrame,
    capacity: int = 65_536,
    hasher: Callable[[Column], Column] = F.xxhash64,
    key: str = "doc_id",
    text: str = "text",
    parts: int = 32,
) -> Index:
    """An extendible-hash index of the distinct normalised texts; a bucket has no more than ``capacity`` hashes.

    Columns of its entries: ``h``, ``bucket``, ``chain`` (position among different texts of one hash), ``text_sha256``,
    ``keep_id``, ``keep_points`` (its code points), ``group_size``.

    Every owner task holds a range of buckets and the hashes in them. The directory deals texts to the owners, who compare
    the texts of a hash byte by byte. Before that, copies are collapsed in each task and in ``parts`` parts by id, so a
    group of any size reaches its owner as no more than ``parts`` rows.
    """
    rows = docs.select(F.col(key).alias("id"), text_of(text).alias("text")).select(
        "id", F.length("text").alias("points"), F.regexp_replace("text", SPACE, "").alias("norm")
    )

    def collapsed(some: DataFrame, *by: str) -> DataFrame:
        # Most code points first, then the smallest id (null last): one decimal, as its aggregate works in place.
        last = F.coalesce("id", F.lit(2**63 - 1)).cast("decimal(20,0)")
        order = F.col("points").cast("decimal(10,0)") * F.lit(str(2**64)).cast("decimal(20,0)") - last
        return some.groupBy(*by, "norm").agg(F.max_by("id", order).alias("id"), F.max("points").alias("points"), F.sum("n").alias("n"))

    hashed = rows.select("id", "points", "norm", hasher(F.col("norm")).alias("h"), F.lit(1).cast("long").alias("n"))
    entries = cut_lineage(collapsed(hashed.withColumn("part", F.pmod(F.xxhash64("id", "points"), F.lit(parts))), "h", "part"))
    slots, depth = directory(entries.select("h").distinct(), capacity)
    index = Index(entries, cut_lineage(slots), depth)
    owners = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owned = collapsed(index.bucket_of(entries).repartitionByRange(owners, "bucket", "h"), "bucket", "h")
    named = owned.select(
        "bucket", "h", F.sha2("norm", 256).alias("text_sha256"), F.col("id").alias("keep_id"), F.col("points").alias("keep_points"), F.col("n").alias("group_size")
    )
    chain = F.row_number().over(Window.partitionBy("bucket", "h").orderBy("text_sha256"))
    return index._replace(entries=cut_lineage(named.withColumn("chain", chain)))


def exact_dedup(docs: DataFrame, capacity: int = 65_536, hasher: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """Decide for every row of ``docs`` (doc_id, text, …) whether it stays.

    Texts are equal if identical without the characters ``[\\x20\\x09-\\x0D]``; null counts as empty, so null, empty and
    blank texts are one group. Of a group the text with most code points stays, then the smallest doc_id (a null doc_id
    after all others). Of rows that agree in doc_id, text and length only one is kept. No row gives no row. Other columns
    of ``docs`` are ignored, so their names can't clash.

    Columns: doc_id, keep_id, group_size, kept, text_sha256, raw_hash (xxhash64 of the original text).
    """
    index = build_index(docs, capacity, hasher)
    norm = F.regexp_replace("text", SPACE, "")
    rows = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id",
        F.length("text").alias("points"),
        F.xxhash64("text").alias("raw_hash"),
        hasher(norm).alias("h"),
        F.sha2(norm, 256).alias("text_sha256"),
    )
    found = index.look_up(rows)
    twin = F.row_number().over(Window.partitionBy("doc_id", "text_sha256", "points").orderBy("raw_hash"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points")) & (twin == 1)
    return found.withColumn("kept", stays).select("doc_id", "keep_id", "group_size", "kept", "text_sha256", "raw_hash")


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns."""
    kept = exact_dedup(docs, **options).filter("kept").select(F.col("doc_id").alias("_id"), F.col("raw_hash").alias("_raw"))
    raw = F.xxhash64(text_of())
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_raw"))
    rows = docs.withColumn("_hash", raw).join(kept, same, "inner")
    first = F.row_number().over(Window.partitionBy("doc_id", "_hash").orderBy("_id"))
    return rows.withColumn("_n", first).filter("_n = 1").select(*docs.columns)

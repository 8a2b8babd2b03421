"""A corpus from raw documents: each stage reads what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyscope.functions.lineage import cut_lineage
from tallyscope.llm import bagminhash, exact, mixing, pieces, quality
from tallyscope.llm.common import read


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject; it learns from ``labels`` and the documents given."""
    scored = quality.score_quality(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored.filter("predicted = 1").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return bagminhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, repeated as often as the mix passes over them."""
    return mixing.training_order(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every text of the training order."""
    return pieces.encode(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mix sources", mix_sources),
    ("sampled pieces", encode_pieces),
]

#: Compression, signatures and sampled segmentations can't be written in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs

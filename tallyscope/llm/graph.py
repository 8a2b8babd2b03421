"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component's name is its smallest node.

    Alternates the large-star and small-star steps of Kiveris et al.: each node hands its larger (its smaller) neighbours
    to the smallest node it knows, until nothing changes. Each round groups and joins edges, with partial aggregates, so a
    node with very many neighbours is no task of its own, and is written as a table. The number of rounds is about the
    logarithm of the longest path.
    """
    now = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    before = None
    for _ in range(rounds):
        # Large star: every neighbour above a node goes to the smallest of the node and its neighbours.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        # Small star: a node and its smaller neighbours go to the smallest of these.
        lowest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(lowest, "b")
            .select(F.explode(F.array(F.col("a"), F.col("b"))).alias("b"), F.col("m").alias("a"))
            .filter("a < b")
            .distinct()
        )
        now = cut_lineage(small.select("a", "b"))
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )

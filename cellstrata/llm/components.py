"""Connected components of an edge table, without collecting edges or nodes anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges: a, b (long). Returns node and root (the least node that it reaches), one row for each node of an edge.

    Alternates two steps until the edges stand still: every node sends its
    larger neighbours to the least neighbour (large star), then its smaller ones
    (small star). Each step is one aggregation for the least neighbour, whose
    partial sums merge before the shuffle, and one join; a node of very high
    degree is a skewed join key, which adaptive execution splits.
    """
    edges = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(smallest.withColumnRenamed("m", "b"))
        edges = cut_lineage(small.distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

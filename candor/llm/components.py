"""Connected components of a table of edges, by shuffles of narrow rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candor.session import scratch_root


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component` (the smallest node it reaches) of all nodes in `edges` (columns `a`, `b`).

    Large-star and small-star steps in turn: each node passes the smallest neighbour on to its other neighbours. The smallest neighbour is an aggregate and
    meets the edges in a plain join, so a node with very many neighbours is no single group. Only a checksum of the edges reaches the driver.
    """
    scratch_root(edges.sparkSession)
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
    before = None
    while True:
        total = both.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(total) == before:
            # Every edge now points from a node to the smallest of its component.
            smallest = both.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return both.select(F.col("a").alias("node"), F.col("b").alias("component")).union(smallest)
        before = tuple(total)
        sides = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = sides.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = sides.join(lowest, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        both = small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().checkpoint()

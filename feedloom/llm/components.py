"""Connected components by alternating stars; every step is an aggregation and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.storage import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) from edges a, b; nodes without an edge to another do not appear.

    Large star, then small star, until nothing changes: a number of rounds that
    grows with the logarithm of a component's size. No neighbourhood is
    collected; smallest neighbours are aggregated before the shuffle.
    """
    edges = _distinct(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"))
    edges = materialize(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = _distinct(large)
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(smallest, "u")
        small = linked.select("u", F.col("m").alias("v")).unionByName(
            linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = materialize(_distinct(small), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").distinct()

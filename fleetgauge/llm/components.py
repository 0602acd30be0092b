"""Connected components of a graph given as edges, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """node, label for each node of edges (a, b: long): label is the smallest node that it can reach.

    Each step links every node to the smallest node near it, so that a component becomes a star in about log(nodes) steps.
    The neighbours of a node are never gathered: steps are joins with the smallest neighbour, which is a partial aggregate.
    Loops and repeated edges change nothing; null ends are dropped; no edges give no rows.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        near = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(near, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m")), F.struct(F.col("b").alias("a"), F.col("m")))).alias("x"))
        e = cut(small.select(F.col("x.a").alias("a"), F.col("x.m").alias("b")).where("a <> b").distinct())
        now = e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == state:
            break
        state = now
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        roots.select("node", F.col("node").alias("label")))

"""Connected components of a distributed edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())


def star_forest(edges: DataFrame) -> DataFrame:
    """u, v with u > v: each node of the edges that isn't its component's smallest, and that smallest node.

    A step groups the neighbours of each node to their minimum, with partial sums before the shuffle, and joins it back to
    the edges. Both sides of the join are written tables, so a hub's rows can be split over tasks. The number of steps
    grows with the logarithm of the number of nodes; every step is written, and a lost executor repeats one step at most.
    """
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "edges")
    before = None
    while before != (state := _state(edges)):
        before = state
        # Large star: every larger neighbour of a node is tied to the node's smallest neighbour.
        both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star")
        edges = written(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        # Small star: a node and its smaller neighbours are tied to the smallest of them.
        least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        kept = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        edges = written(kept.union(least).distinct(), "edges")
    return edges

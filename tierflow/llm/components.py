"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    moved = both.filter("b > a").join(smallest, F.col("a") == F.col("node"))
    return moved.select(F.col("b").alias("a"), F.least("node", "m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them; ``a > b`` in every row."""
    smallest = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    moved = edges.join(smallest, F.col("a") == F.col("node")).filter("b <> m")
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(smallest.select(F.col("node").alias("a"), F.col("m").alias("b")))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: each node that has an edge upwards has one, and none comes up to it."""
    up = edges.select(F.col("a").alias("node"), F.lit(1).alias("ups"), F.lit(0).alias("root"))
    down = edges.select(F.col("b").alias("node"), F.lit(0).alias("ups"), F.lit(1).alias("root"))
    roles = up.union(down).groupBy("node").agg(F.sum("ups").alias("ups"), F.max("root").alias("root"))
    return roles.filter("ups > 1 or ups + root > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node that it reaches.

    Each round is written to the shared folder, so a lost executor costs at most one round.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    for _ in range(MOST_ROUNDS):
        edges = common.stage(_small_star(_large_star(edges)).distinct(), "edges")
        if _settled(edges):
            break
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)

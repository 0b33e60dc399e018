"""Connected components by alternating large and small stars. DataFrame functions only, unless a caller folds edges first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str, fold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(node, component): the least node that is connected with each node of edges (a, b); nodes that are least themselves have no row.

    fold may replace the edges (a > b) of a partition by fewer that connect the same nodes, so that rounds move about one edge a
    node. Each round is a table, which cuts the lineage; the loop ends when all nodes are leaves of stars, or their centres.
    """
    thin = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.table((fold(thin) if fold else thin).distinct(), f"{name}-0")
    k = 0
    while not _stars(edges):
        # large stars: the larger neighbours of a node go to the least of its neighbours
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).where("m < a")
        moved = edges.join(least.select(F.col("a").alias("b"), "m"), "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        large = moved.union(edges.join(least.select(F.col("a").alias("b"), "m"), "b").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        # small stars: a node and its smaller neighbours go to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = low.select("a", F.col("m").alias("b")).union(large.join(low.where("n > 1"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        k += 1
        edges = scratch.table(small.distinct(), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one edge, to a node that has none to a smaller one."""
    nodes = edges.groupBy("a").agg(F.count("*").alias("n"))
    return nodes.where("n > 1").isEmpty() and edges.join(nodes.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()

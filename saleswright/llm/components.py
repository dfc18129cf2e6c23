"""Connected components of a graph given as an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fixed


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; root is the least node reachable.

    Alternates two rewrites until nothing changes, a number of rounds that grows
    with the logarithm of the longest path: each node hands the least of its
    neighbours and itself to its larger neighbours, then to its smaller ones.
    Only edges are kept, one row each; no neighbour list is ever gathered, since
    the least neighbour is found by a grouped minimum and joined back. Every
    round is written to the shared checkpoint folder.
    """
    edges = fixed(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    seen = None
    while True:
        two_way = _both_ways(edges)
        least = two_way.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = two_way.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
        large = larger.filter("a <> b").distinct()
        # Now every edge runs from a smaller to a larger node: by the larger one.
        down = large.select(F.col("b").alias("n"), F.col("a").alias("s"))
        low = down.groupBy("n").agg(F.min("s").alias("m"))
        small = (
            down.join(low, "n")
            .select(F.col("m").alias("a"), F.col("s").alias("b"))
            .union(low.select(F.col("m").alias("a"), F.col("n").alias("b")))
            .filter("a <> b")
            .distinct()
        )
        edges = fixed(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def forest(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from nodes to the least node that they reach over the given links."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            at = np.flatnonzero(root != np.arange(size))
            return root[at], at
        root = new

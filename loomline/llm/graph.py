"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node that it reaches) of all nodes with an edge to another.

    ``edges`` has columns a and b. Large and small stars by turns: every node's larger neighbours
    are linked to its smallest one, then every node and its smaller neighbours. The edge table
    never grows, a node's neighbours are only aggregated, and the end is exact: nothing changes
    any more. Rounds grow with the logarithm of the longest path.
    """
    links = materialize(edges.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.filter("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            lowest.select("a", F.col("m").alias("b"))).filter("a != b").distinct()
        links = materialize(small)
        new = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == state:
            break
        state = new
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select(F.col("b"), F.col("b")).distinct())


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Of n nodes with links a-b: each node's smallest reachable node."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        np.minimum.at(root, before[a], low)
        np.minimum.at(root, before[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root

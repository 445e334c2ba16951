"""Connected components of a distributed edge list, in rounds of stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .handover import handover


class Forest:
    """Union of index pairs inside one task, in arrays; roots are the smallest index."""

    def __init__(self, n: int):
        self.parent = np.arange(n, dtype=np.int64)

    def roots(self) -> np.ndarray:
        """Root of every index; every path becomes one step long."""
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return self.parent
            self.parent = up

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join a[i] with b[i] for all i: hook larger roots under smaller ones until none differ."""
        while len(a):
            top = self.roots()
            a, b = top[a], top[b]
            differ = a != b
            a, b = a[differ], b[differ]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(self.parent, high, low)
        self.roots()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest node.

    Alternating large-star and small-star rounds: in a large-star step every
    node sends its larger neighbours to its smallest one, in a small-star step
    its smaller ones and itself. Both keep the components, and when nothing
    changes the edges are stars round the smallest node of each. The number of
    rounds grows with the logarithm of the longest path. Each step aggregates
    map-side and joins the aggregate back on the node, where Spark splits a
    node with very many edges; the driver sees two numbers a round. Every step
    ends in a hand-over, so a lost executor costs at most one step. Loops and
    repeated edges are allowed; null ends are not. No edges give no rows.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def stars(links: DataFrame, larger: bool) -> DataFrame:
        least = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        met = links.join(least, "a")
        if larger:
            sent = met.where("b > a").select(F.col("b").alias("x"), "m")
        else:
            sent = met.select(F.col("b").alias("x"), "m").union(least.select(F.col("a").alias("x"), "m"))
        return (sent.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")).distinct())

    def seal(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)), F.sum((F.xxhash64("a", "b") % 1_000_003).cast("long"))).first()
        return tuple(row)

    now = handover(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = seal(now)
    while mark[0]:
        far = handover(stars(both(now), True), "large-star")
        now = handover(stars(far.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False),
                       "small-star")
        last, mark = mark, seal(now)
        if last == mark:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()

"""Connected components of an edge table by alternating large and small stars, and union-find inside one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import spool


class UnionFind:
    """Sets over places 0..n-1; the smallest place is the root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.parent))], dtype=np.int64)


def star_edges(names: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges between places of ``names`` contracted to one edge per member of each set: (smaller name, member)."""
    sets = UnionFind(len(names))
    for i, j in zip(left.tolist(), right.tolist()):
        sets.union(i, j)
    roots = sets.roots()
    member = np.flatnonzero(roots != np.arange(len(names)))
    return names[roots[member]], names[member]


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of an edge table (a, b); the root is the smallest node of its component.

    Every round works with minima per node (partial aggregation, so a hub is no burden) and is written to the shared
    folder. The number of rounds grows with the logarithm of the longest path.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def stars(current: DataFrame, large: bool) -> DataFrame:
        # (u, v): at large stars both directions, at small stars towards the smaller neighbour only.
        pairs = current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        if large:
            pairs = pairs.unionByName(current.select(F.col("a").alias("u"), F.col("b").alias("v")))
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        least = least.withColumn("m", F.least("u", "m"))
        met = pairs.join(least, "u")
        moved = met.filter(F.col("v") > F.col("u")) if large else met.filter(F.col("v") != F.col("m"))
        out = moved.select(F.col("m").alias("a"), F.col("v").alias("b"))
        if not large:
            out = out.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.filter(F.col("a") < F.col("b")).distinct()

    a, b = F.least("a", "b"), F.greatest("a", "b")
    current = spool(edges.select(a.alias("a"), b.alias("b")).filter("a < b").distinct(), f"{name}-edges")
    before = mark(current)
    while before[0]:
        current = spool(stars(stars(current, True), False), f"{name}-stars")
        after = mark(current)
        if after == before:
            break
        before = after
    return current.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )

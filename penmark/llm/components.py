"""Connected components of a graph given as edges, by alternating large-star and small-star.

Kiveris, Lattanzi, Mirrokni, Rastogi and Vassilvitskii (2014). Each half-step is a
minimum per node (combined before the exchange) and a join of the edges with these
minima; both sides are written tables, so adaptive execution can split the edges of a
hub. Nothing is gathered per node or on the driver but two numbers a round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penmark.llm.common import materialise


def _signature(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return (r.n, r.h)


def _least(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (at, other) as a written table, and the least of a node and what it links to."""
    links = materialise(links, "cc-links")
    return links, materialise(links.groupBy("at").agg(F.least(F.col("at"), F.min("other")).alias("m")), "cc-least")


def large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around (or to the node itself)."""
    both = e.select(F.col("u").alias("at"), F.col("v").alias("other")).unionByName(
        e.select(F.col("v").alias("at"), F.col("u").alias("other")))
    both, least = _least(both)
    return (both.filter(F.col("other") > F.col("at")).join(least, "at")
            .select(F.col("other").alias("u"), F.col("m").alias("v")).distinct())


def small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down, least = _least(e.select(F.col("u").alias("at"), F.col("v").alias("other")))
    rest = (down.join(least, "at").filter(F.col("other") != F.col("m"))
            .select(F.col("other").alias("u"), F.col("m").alias("v")))
    return rest.unionByName(least.select(F.col("at").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v); root is the least node reachable.

    Self-loops and repeated edges are allowed. Edges with a null end are ignored.
    """
    e = edges.select("u", "v").filter(F.col("u") != F.col("v"))
    e = materialise(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    seen = _signature(e)
    while seen[0]:
        e = materialise(small_star(large_star(e)), "cc-edges")
        now = _signature(e)
        if now == seen:
            break
        seen = now
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


class Forest:
    """Spanning links within one task: remembers which rows are connected already."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links = [np.empty((0, 2), np.int64)]

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs (a, b) are not connected yet."""
        return self.root[a] != self.root[b]

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Connect the pairs; keeps those that were apart before the call."""
        new = self.apart(a, b)
        a, b = a[new], b[new]
        if not len(a):
            return
        x, y = self.root[a], self.root[b]
        _, first = np.unique(np.minimum(x, y) * len(self.root) + np.maximum(x, y), return_index=True)
        self.links.append(np.stack([a[first], b[first]], axis=1))
        while (x != y).any():   # hook the larger root on the smaller, then point every row at its root again
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]
            x, y = self.root[x], self.root[y]

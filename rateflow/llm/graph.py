"""Connected components of a table of links."""

import numpy as np
from pyspark.sql import functions as F

from rateflow.llm.arrays import batch
from rateflow.session import stage

FOREST_IDS = 200_000


class Forest:
    """Union-find over ids met one by one; the smallest id of a tree is its root."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        top = self.parent.setdefault(x, x)
        while self.parent[top] != top:
            top = self.parent[top]
        while self.parent[x] != top:
            self.parent[x], x = top, self.parent[x]
        return top

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)

    def rows(self):
        pairs = [(x, top) for x in self.parent if (top := self.root(x)) != x]
        found = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return batch(a=found[:, 0], b=found[:, 1])


def _contract(batches):
    forest = Forest()
    for rows in batches:
        for a, b in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            forest.join(a, b)
        if len(forest.parent) > FOREST_IDS:
            yield forest.rows()
            forest = Forest()
    yield forest.rows()


def _large_star(edges):
    """Every larger neighbour of an id is linked to that id's smallest neighbour."""
    pairs = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    moved = pairs.join(least, pairs.a == least.u).where("b > u")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges):
    """An id and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = edges.join(least, edges.a == least.u).where("b > m")
    moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges):
    """Table ``id, component`` of every id in ``edges(a, b)``; component is the smallest id.

    Links are first contracted within each partition; then large-star and small-star steps
    alternate until nothing changes, each result written to the shared folder. A hot id is
    a skewed join, which adaptive execution splits. Ids without links are not in the result.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    edges = stage(edges.distinct().mapInArrow(_contract, "a long, b long"), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state or not state[0]:
            break
        seen = state
        moved = _small_star(_large_star(edges)).distinct()
        edges = stage(moved.mapInArrow(_contract, "a long, b long").distinct(), "links")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)

"""Connected components of a graph given by its edges, without the driver seeing any of them.

Each partition first reduces its edges to stars by union-find. Then two steps alternate
until nothing changes: every node links its larger neighbours to its smallest one, and links
its smaller neighbours and itself to the smallest of those (Kiveris et al. 2014). The number
of rounds grows with the logarithm of the graph. Every round is a written table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tunesmith.llm.common import lookup_join
from tunesmith.sources.scratch import stored


class Forest:
    """Union-find; the root of a tree is its smallest node."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, node: int) -> int:
        top = node
        while (above := self.up.get(top, top)) != top:
            top = above
        while node != top:
            self.up[node], node = top, self.up[node]
        return top

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
    nodes = list(forest.up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([forest.root(n) for n in nodes], pa.int64())], ["a", "b"])


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.count("*").alias("n"), F.min(F.least("a", "b")).alias("m"))
    return lookup_join(both, least, "a", "n").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("m"))
    linked = lookup_join(pairs, least, "a", "n").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first())


def components(edges: DataFrame) -> DataFrame:
    """Per node with an edge to another: ``node`` and ``root``, the smallest node it reaches.

    ``edges`` has two columns of longs, in any order; loops, repeated edges and an empty
    table are fine, nulls are dropped.
    """
    a, b = edges.columns
    given = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(F.col(a).alias("a"), F.col(b).alias("b"))
    pairs = stored(given.mapInArrow(_stars, "a long, b long").distinct(), "stars")
    before, now = None, _mark(pairs)
    while now != before and now[0]:
        pairs = stored(_small_star(stored(_large_star(pairs), "large")), "stars")
        before, now = now, _mark(pairs)
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)

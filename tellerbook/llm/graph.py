"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerbook.llm.store import stored


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge.

    ``edges`` has two long columns a and b. Large-star and small-star steps hang
    every node below the smallest neighbour until all are stars; the number of
    rounds grows with the logarithm of the longest path, and each begins with what
    the edges of a batch show by themselves. Only minima are gathered
    by key, and each round is written to the shared folder. Edges never grow in number.
    Loops (a = b) and repeated edges do no harm; no edges give no rows.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    now = stored(links.distinct(), purpose)
    while not _stars(now):
        now = stored(_small(_large(now.mapInArrow(_shortened, "u long, v long"))), purpose)
    node = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return node.union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every node hangs below one node that hangs below none."""
    # A node that others hang below counts as hanging below itself.
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("up")).union(links.select("v", "v"))
    ups = ends.groupBy("node").agg(F.min("up").alias("least"), F.max("up").alias("most"))
    return ups.where("least < most").isEmpty()


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars with the connected sets of each batch."""
    for batch in batches:
        if batch.num_rows:
            ends = np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))])
            nodes, at = np.unique(ends, return_inverse=True)
            trees = Forest(len(nodes))
            for x, y in at.reshape(2, -1).T.tolist():
                trees.join(x, y)
            roots = trees.roots()
            hung = np.flatnonzero(roots != np.arange(len(nodes)))
            yield pa.RecordBatch.from_pydict({"u": nodes[hung], "v": nodes[roots[hung]]})


def _large(links: DataFrame) -> DataFrame:
    """Hang each larger neighbour of a node below the node's smallest."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.where("v > u").join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours below the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    # The edge to the smallest neighbour stays and stands for the node itself.
    node = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
    return down.join(least, "u").select(node.alias("u"), F.col("m").alias("v"))


class Forest:
    """Union-find over 0..n-1, for what one task holds."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        """True if they were apart."""
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.up))])

"""Connected components of links too many for one machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import stored

LINKS = "a long, b long"


def components(links: DataFrame) -> DataFrame:
    """The component of every node that occurs in ``links`` (a, b).

    Returns (node, root): root is the smallest node that can be reached. Nulls and
    links of a node with itself are ignored. Stars are built around the smallest
    neighbours, over the larger and the smaller side in turn, until nothing changes;
    rounds grow with the logarithm of the longest chain. A node with many neighbours
    is the smallest of all of them soon, and then only has one row for each.
    """
    edges = links.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = stored(edges.distinct().mapInArrow(_contract, LINKS), "links")
    before = None
    while (state := _state(edges)) != before:
        before = state
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as stars around the smallest node of each group."""
    parent: dict[int, int] = {}

    def find(node: int) -> int:
        root = node
        while (above := parent.get(root, root)) != root:
            root = above
        while node != root:
            parent[node], node = root, parent.get(node, node)
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [node for node in parent if find(node) != node]
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([find(n) for n in nodes], pa.int64())], ["a", "b"]
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node with the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (
        both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours with the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("low"))
    joined = edges.join(smallest, "a")
    moved = joined.filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    kept = smallest.select("a", F.col("low").alias("b"))
    return moved.unionByName(kept).filter("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(mark % 1_000_003)).first())

"""Connected components by alternating large-star and small-star rounds, each cut by a reliable checkpoint.

An empty table of edges gives no rows. Loops, repeated edges, and edges in both directions don't matter; nodes without an
edge are absent; a null end makes no edge. A node with many neighbours is joined by broadcast (see ``joined_hot``).

A round takes about twenty stages, whatever the number of edges, and the driver keeps what it knows of every task. So
ONE_TASK edges between longs or fewer, 16 MB of them, are joined by one task that reads them all; the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmine.llm.base import checkpointed, joined_hot

#: Edges up to which one task joins them all.
ONE_TASK = 1 << 20


def _least(edges: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours, and their number: partial sums before the shuffle, so hot nodes are cheap."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = joined_hot(both.filter("b > a"), _least(both), "a", 2 * n, "n")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    moved = joined_hot(down, least, "a", n, "n").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, roots): the smallest node of the component of each node; a, b: the ends of the edges."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[root]
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := root[root], root):
            root = up


def _in_one_task(edges: DataFrame) -> DataFrame:
    """node, root of few edges, which one task reads from where they are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
        if held:
            found = pa.RecordBatch.from_arrays([pa.array(x) for x in roots_of(*(np.concatenate(x) for x in zip(*held)))], ["node", "root"])
            for start in range(0, found.num_rows, 1 << 16):
                yield found.slice(start, 1 << 16)

    return edges.coalesce(1).mapInArrow(run, "node bigint, root bigint")


def components(edges: DataFrame, most_rounds: int = 60, one_task: int = ONE_TASK) -> DataFrame:
    """node, root (the smallest node of its component) of every node that has an edge; edges: two columns, a and b.

    Only a count and a checksum per round reach the driver.
    """

    def counted(edges: DataFrame) -> tuple[int, int]:
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("s")).first()
        return row["n"], row["s"]

    edges = checkpointed(edges.toDF("a", "b").filter("a <> b").distinct())
    before = counted(edges)
    if before[0] <= one_task and {kind for _, kind in edges.dtypes} == {"bigint"}:
        return checkpointed(_in_one_task(edges))
    for _ in range(most_rounds):
        if not before[0]:
            break
        starred = checkpointed(_large_star(edges, before[0]))
        edges = checkpointed(_small_star(starred, before[0]))
        now = counted(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled after {most_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)

"""Connected components by union-find in tasks, with one shuffle a round.

In a round each edge goes to the tasks of both its ends, so that a vertex meets all its
neighbours; a task joins the edges of each bounded chunk it reads with union-find and gives out
every vertex with the smallest vertex that the chunk connects it to, unless that is an edge it read
at the larger end: the task of the smaller end has it too.  Reach at least doubles in a round.  The rounds end when the edges were a star forest already: no vertex with two smaller
neighbours, or with a smaller and a larger one.  No part of the graph reaches the driver; a
round's edges are written to the shared folder, and those of the round before are deleted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.shipping import arrow_map
from cohortlens.llm.staging import dropped, staged

CHUNK_EDGES = 1 << 19


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All vertices of the edges (a, b), ascending, and the smallest each is connected to."""
    vertex, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    parent = np.arange(len(vertex))
    while len(x):
        # hook the larger root of each edge under the smaller, then point all to their roots
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent[parent] != parent).any():
            parent = parent[parent]
        x, y = parent[x], parent[y]
        open_ = x != y
        x, y = x[open_], y[open_]
    return vertex, vertex[parent]


def _round(batches):
    """Edges sorted by (key, other) to (a, b, open): each vertex with its root in the chunk, and
    whether the edges read so far were no star forest."""
    last: tuple[int, int] | None = None
    chunk: list[tuple[np.ndarray, np.ndarray]] = []
    size, open_ = 0, False

    def joined():
        a, b = (np.concatenate(x) for x in zip(*chunk, strict=True))
        vertex, root = roots(a, b)
        moved = vertex != root
        first = root[np.searchsorted(vertex, np.maximum(a, b))] == np.minimum(a, b)  # edges to a root
        here, there = (np.isin(vertex, x) for x in (b[first & (a < b)], a[first & (a > b)]))
        new = moved & (here | ~there)
        if not open_ or new.any():  # an open forest is told by its rows
            moved = new
        n = int(moved.sum())
        return pa.RecordBatch.from_arrays([pa.array(vertex[moved]), pa.array(root[moved]), pa.array(np.full(n, open_))],
                                          ["a", "b", "open"])

    for batch in batches:
        key, other = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(key):
            continue
        if last is not None:
            key, other = np.r_[last[0], key], np.r_[last[1], other]
        # a smaller neighbour comes first; nothing else may follow it
        again = (key[1:] == key[:-1]) & (other[1:] != other[:-1]) & (other[:-1] < key[:-1])
        open_ = open_ or bool(again.any())
        last = int(key[-1]), int(other[-1])
        chunk.append((key, other))
        size += len(key)
        if size >= CHUNK_EDGES:
            yield joined()
            chunk, size = [], 0
    if chunk:
        yield joined()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of bigint vertices -> (node, component): every vertex of an edge with
    the smallest vertex it reaches.  Null ends and loops are dropped; no edges, no rows."""
    edges, old = edges.select("a", "b").filter("a <> b"), None
    while True:
        ends = F.explode(F.array(F.struct(F.col("a").alias("key"), F.col("b").alias("other")),
                                 F.struct(F.col("b").alias("key"), F.col("a").alias("other"))))
        both = edges.select(ends.alias("e")).select("e.*").repartition("key").sortWithinPartitions("key", "other")
        now = staged(arrow_map(both, _round, "a long, b long, open boolean"), "edges")
        if old is not None:
            dropped(old)
        if not now.filter("open").take(1):
            break
        edges = old = now
    stars = now.select("a", "b").distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

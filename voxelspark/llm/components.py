"""Connected components of an edge table, by local contraction and star steps.

A partition of about ``LOCAL`` edges is reduced to the flat stars of its own components.  If all
edges fit in one partition, that is the answer.  Otherwise a large-star and a small-star step, each
a grouped minimum and a join, bring the partitions' parts together, and so on until nothing changes;
the rounds grow with the logarithm of the size.  Every round is written to the checkpoint folder,
and nothing but a partition's edges is ever held.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelspark.llm.common import cut

LOCAL = 500_000


def local_components(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (u, v) -> their nodes in order, and the least node that each reaches: roots hook onto
    smaller ones, then every node jumps to its root, until no edge joins two roots."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        if (root[a] == root[b]).all():
            return nodes, nodes[root]
        for end in (root[a], root[b]):
            np.minimum.at(root, end, low)
        while (root[root] != root).any():
            root = root[root]


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of a partition -> (node, least node of its component) of all but those."""
    held = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches]
    if not held:
        return
    nodes, roots = local_components(np.concatenate([u for u, _ in held]), np.concatenate([v for _, v in held]))
    nodes, roots = nodes[nodes != roots], roots[nodes != roots]
    for low in range(0, len(nodes), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[low : low + (1 << 16)]), pa.array(roots[low : low + (1 << 16)])], ["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v.  Large: each node's larger neighbours point to its least one.
    Small: its smaller neighbours, and itself, do."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        near = both.join(least, "u").filter(F.col("v") > F.col("u"))
        return near.select(F.col("v").alias("u"), F.col("m").alias("v")).filter(F.col("u") > F.col("v")).distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(least, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, local: int = LOCAL) -> DataFrame:
    """edges (a, b) of long -> (node, component): the least node reachable, for each node that has
    an edge.  Loops, repeats, either direction and an empty table are fine."""
    now = cut(edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).filter(F.col("a") != F.col("b")))
    mark = None
    while True:
        parts = max(1, math.ceil(now.count() / local))
        now = cut(now.repartition(parts).mapInArrow(_flat, "u long, v long"))
        if parts == 1:
            break
        now = cut(_star(_star(now, True), False))
        seen = tuple(now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.count_distinct("u")).first())
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""Connected components of tables, by grouped minima; nothing is held on the driver."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: what ``spark.checkpoint.dir`` names (its own where none is)."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            import tempfile

            named = tempfile.mkdtemp(prefix="checkpoints")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """The table, written to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes (node), edges (a, b) -> (node, component), the least node that each reaches.

    Every round each node takes the least label among its neighbours and then the label of its
    label (pointer jumping), so the rounds grow with the logarithm of the longest path.
    """
    both = checkpointed(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    now = checkpointed(nodes.select("node", F.col("node").alias("component")))
    while True:
        near = both.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = now.join(near, "node", "left").select("node", F.col("component").alias("old"), F.least("component", "near").alias("to"))
        jump = now.select(F.col("node").alias("to"), F.col("component").alias("far"))
        step = checkpointed(step.join(jump, "to", "left").select("node", "old", F.least("to", "far").alias("component")))
        changed = step.filter(F.col("old") != F.col("component")).limit(1).count()
        now = step.select("node", "component")
        if not changed:
            return now


def face_edges(cells: DataFrame, axes: str = "zyx") -> DataFrame:
    """Cells (node, coordinates) -> edges between face neighbours."""
    out = None
    for a in axes:
        shifted = cells.select(F.col("node").alias("b"), *[(F.col(c) - 1).alias(c) if c == a else F.col(c) for c in axes])
        part = cells.withColumnRenamed("node", "a").join(shifted, list(axes)).select("a", "b")
        out = part if out is None else out.union(part)
    return out


def block_components(labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A block (z, y, x) of labels -> its cells with a label and, for each, the first cell of its
    component, both as flat places.  Cells of a row with one label are a run; runs that touch are joined
    by their least members until nothing changes."""
    held = labels != 0
    start = held.copy()
    start[:, :, 1:] &= ~held[:, :, :-1] | (labels[:, :, 1:] != labels[:, :, :-1])
    run = np.cumsum(start.ravel()).reshape(labels.shape) - 1
    pairs = [np.zeros((0, 2), np.int64)]
    for here, there in (((slice(1, None),), (slice(None, -1),)), ((slice(None), slice(1, None)), (slice(None), slice(None, -1)))):
        touch = held[here] & (labels[here] == labels[there])
        pairs.append(np.stack([run[here][touch], run[there][touch]], axis=1))
    a, b = np.unique(np.concatenate(pairs), axis=0).T
    root = np.arange(int(start.sum()))
    while (root[a] != root[b]).any():
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    cells = np.flatnonzero(held)
    return cells, np.flatnonzero(start)[root[run.ravel()[cells]]]


def voxel_components(voxels: DataFrame, label: str = "label", block: Sequence[int] = (64, 64, 64)) -> DataFrame:
    """Voxels (z, y, x, label), coordinates from 0 -> (z, y, x, label, component): the number of the
    first voxel, by (z, y, x), of those of its label that it reaches across faces.  Label 0 is none.

    Components are found within blocks; only voxels on the faces between blocks make edges, and only the
    components that they belong to are joined over the whole volume."""
    bits = 21  # of each coordinate
    at = [F.col(a).cast("long").alias(a) for a in "zyx"]
    cells = voxels.filter(F.col(label) != 0).select(*at, F.col(label).cast("long").alias("label"))
    spot = [F.floor(F.col(a) / n).alias(f"b{a}") for a, n in zip("zyx", block, strict=True)]

    def find(keys, t):
        low = [k.as_py() * n for k, n in zip(keys, block, strict=True)]
        place = [t.column(a).to_numpy() - o for a, o in zip("zyx", low, strict=True)]
        if max(c.max() + o for c, o in zip(place, low, strict=True)) >> bits:
            raise ValueError(f"a coordinate is beyond {1 << bits}")
        dense = np.zeros(block, np.int64)
        dense[tuple(place)] = t.column("label").to_numpy()
        cells, first = block_components(dense)
        z, y, x = (i + o for i, o in zip(np.unravel_index(cells, block), low, strict=True))
        fz, fy, fx = (i + o for i, o in zip(np.unravel_index(first, block), low, strict=True))
        return pa.table({"z": z, "y": y, "x": x, "label": dense.ravel()[cells], "root": fz << 2 * bits | fy << bits | fx})

    found = cells.withColumns({f"b{a}": c for a, c in zip("zyx", spot, strict=True)}).groupBy("bz", "by", "bx").applyInArrow(find, "z long, y long, x long, label long, root long")
    found = checkpointed(found)
    edges = None
    for a, n in zip("zyx", block, strict=True):
        low = found.filter((F.col(a) % n == 0) & (F.col(a) > 0)).select(*[(F.col(c) - 1).alias(c) if c == a else F.col(c) for c in "zyx"], "label", F.col("root").alias("a"))
        high = found.filter(F.col(a) % n == n - 1).select(*"zyx", "label", F.col("root").alias("b"))
        part = low.join(high, [*"zyx", "label"]).select("a", "b")
        edges = part if edges is None else edges.union(part)
    edges = checkpointed(edges.distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    joined = connected(nodes, edges).withColumnRenamed("node", "root")
    return found.join(joined, "root", "left").select(*"zyx", "label", F.coalesce("component", "root").alias("component"))

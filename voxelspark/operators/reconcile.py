"""Reconciling the labels of neighbouring blocks into one labeling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.operators.components import connected
from voxelspark.operators.numbering import numbered


def block_overlaps(voxels: DataFrame) -> DataFrame:
    """Voxels (block, z, y, x, label) of blocks with halos -> overlap of objects of two blocks:
    (block_a, a, block_b, b, n, iou, share_a, share_b) over the cells that both blocks cover."""
    l, r = voxels.alias("l"), voxels.alias("r")
    cell = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in "zyx"]
    both = l.join(r, [*cell, F.col("l.block") < F.col("r.block")]).select(F.col("l.block").alias("block_a"), F.col("l.label").alias("a"), F.col("r.block").alias("block_b"), F.col("r.label").alias("b"))
    pairs = both.groupBy("block_a", "a", "block_b", "b").agg(F.count("*").alias("n"))
    side = lambda x: F.sum("n").over(W.partitionBy("block_a", "block_b", x))
    pairs = pairs.withColumn("size_a", side("a")).withColumn("size_b", side("b")).filter((F.col("a") > 0) & (F.col("b") > 0))
    n = F.col("n").cast("double")
    return pairs.select("block_a", "a", "block_b", "b", "n", (n / (F.col("size_a") + F.col("size_b") - F.col("n"))).alias("iou"), (n / F.col("size_a")).alias("share_a"), (n / F.col("size_b")).alias("share_b"))


def merge_edges(overlaps: DataFrame, iou: float = 0.5, share: float = 0.8) -> DataFrame:
    """Pairs to merge: enough overlap by IoU, or each holding most of the other; never by one side
    alone."""
    both = (F.col("share_a") >= share) & (F.col("share_b") >= share)
    return overlaps.filter((F.col("iou") >= iou) | both)


def global_ids(objects: DataFrame, edges: DataFrame) -> DataFrame:
    """objects (block, label), edges (block_a, a, block_b, b) -> (block, label, id): ids 1, 2, ...
    in order of each component's first (block, label)."""
    code = lambda b, l: F.col(b).cast("long") * (1 << 32) + F.col(l)
    found = connected(objects.select(code("block", "label").alias("node")).distinct(), edges.select(code("block_a", "a").alias("a"), code("block_b", "b").alias("b")))
    roots = numbered(found.select("component").distinct(), ["component"], "id", first=1)
    named = found.join(roots, "component")
    return objects.withColumn("node", code("block", "label")).join(named, "node").select("block", "label", "id")

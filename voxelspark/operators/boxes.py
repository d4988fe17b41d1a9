"""Half-open axis-aligned boxes in columns z0, z1, y0, y1, x0, x1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = "zyx"
BROADCAST_BOXES = 10_000


def volume(prefix: str = "") -> Column:
    out = F.lit(1).cast("long")
    for a in AXES:
        out = out * (F.col(f"{prefix}{a}1") - F.col(f"{prefix}{a}0"))
    return out


def intersects(left: str, right: str) -> Column:
    """Whether the boxes of two aliased tables share a voxel."""
    out = F.lit(True)
    for a in AXES:
        out = out & (F.col(f"{left}.{a}0") < F.col(f"{right}.{a}1")) & (F.col(f"{right}.{a}0") < F.col(f"{left}.{a}1"))
    return out


def contains(left: str, right: str) -> Column:
    """Whether a box of the left table holds one of the right whole."""
    out = F.lit(True)
    for a in AXES:
        out = out & (F.col(f"{left}.{a}0") <= F.col(f"{right}.{a}0")) & (F.col(f"{right}.{a}1") <= F.col(f"{left}.{a}1"))
    return out


def _cells(boxes: DataFrame, edge: dict[str, int]) -> DataFrame:
    """Each box once for every cell of a grid that it touches: cz, cy, cx."""
    for a in AXES:
        low, high = F.floor(F.col(f"{a}0") / edge[a]), F.floor((F.col(f"{a}1") - 1) / edge[a])
        boxes = boxes.withColumn(f"c{a}", F.explode(F.sequence(low, F.greatest(low, high))))
    return boxes


_SIDES = [f"{a}{e}" for a in AXES for e in "01"]


def meeting(left: DataFrame, right: DataFrame, few: int = BROADCAST_BOXES) -> DataFrame:
    """The distinct boxes of the left table that share a voxel with one of the right.  At most ``few``
    right boxes are sent to all tasks; beyond, both sides meet by grid cell, the cells being as long
    as the longest left box, so that such a box is in eight cells at most."""
    l = left.select(*_SIDES).distinct()
    if right.limit(few + 1).count() <= few:
        return l.alias("b").join(F.broadcast(right.select(*_SIDES)).alias("g"), intersects("b", "g"), "left_semi")
    longest = l.agg(*[F.max(F.col(f"{a}1") - F.col(f"{a}0")).alias(a) for a in AXES]).first()
    edge = {a: max(1, int(longest[a] or 1)) for a in AXES}
    b, g = _cells(l, edge).alias("b"), _cells(right.select(*_SIDES), edge).alias("g")
    same = [F.col(f"b.c{a}") == F.col(f"g.c{a}") for a in AXES]
    return b.join(g, [*same, intersects("b", "g")], "left_semi").select(*_SIDES).distinct()


def within(points: DataFrame, boxes: DataFrame, few: int = BROADCAST_BOXES) -> DataFrame:
    """Points (z, y, x, ...) with the columns of each box that holds them.  At most ``few`` boxes are sent
    to all tasks; beyond, a box goes to the grid cells that it touches, cells being as long as the longest
    box, and a point to its own."""
    inside = F.lit(True)
    for a in AXES:
        inside = inside & (F.col(f"p.{a}") >= F.col(f"b.{a}0")) & (F.col(f"p.{a}") < F.col(f"b.{a}1"))
    if boxes.limit(few + 1).count() <= few:
        return points.alias("p").join(F.broadcast(boxes).alias("b"), inside).select("p.*", "b.*")
    longest = boxes.agg(*[F.max(F.col(f"{a}1") - F.col(f"{a}0")).alias(a) for a in AXES]).first()
    edge = {a: max(1, int(longest[a])) for a in AXES}
    same = F.lit(True)
    for a in AXES:
        same = same & (F.floor(F.col(f"p.{a}") / edge[a]) == F.col(f"b.c{a}"))
    both = points.alias("p").join(_cells(boxes, edge).alias("b"), same & inside)
    return both.select("p.*", *[f"b.`{c}`" for c in boxes.columns])


def pairs(left: DataFrame, right: DataFrame, few: int = BROADCAST_BOXES) -> DataFrame:
    """(left, right): the ids of boxes (id, z0 .. x1) of two tables that share a voxel, each pair once; the
    right ones are sent to all tasks if they are at most ``few``, else both sides meet by grid cell."""
    l, r = left.select("id", *_SIDES), right.select("id", *_SIDES)
    if right.limit(few + 1).count() <= few:
        return l.alias("b").join(F.broadcast(r).alias("g"), intersects("b", "g")).select(F.col("b.id").alias("left"), F.col("g.id").alias("right"))
    longest = l.agg(*[F.max(F.col(f"{a}1") - F.col(f"{a}0")).alias(a) for a in AXES]).first()
    edge = {a: max(1, int(longest[a] or 1)) for a in AXES}
    b, g = _cells(l, edge).alias("b"), _cells(r, edge).alias("g")
    same = [F.col(f"b.c{a}") == F.col(f"g.c{a}") for a in AXES]
    return b.join(g, [*same, intersects("b", "g")]).select(F.col("b.id").alias("left"), F.col("g.id").alias("right")).distinct()


def without(boxes: DataFrame, guards: DataFrame, few: int = BROADCAST_BOXES) -> DataFrame:
    """Boxes that meet no guard."""
    return boxes.join(meeting(boxes, guards, few), _SIDES, "left_anti")


def guarded(candidates: DataFrame, guards: DataFrame) -> DataFrame:
    """(size_id, kept, rejected): candidates by size that meet no guard and that meet one; sizes
    without any left are there."""
    hit = meeting(candidates, guards).withColumn("hit", F.lit(True))
    both = candidates.join(hit, _SIDES, "left")
    return both.groupBy("size_id").agg(F.count_if(F.col("hit").isNull()).alias("kept"), F.count("hit").alias("rejected"))


def valid(start: Column, end: Column, most: Column) -> Column:
    return (start >= 0) & (start < end) & (end <= most)


def crop(voxels: DataFrame, box: dict[str, tuple[int, int]]) -> DataFrame:
    """Voxels of a box; the bounds reach the scan as filters."""
    for a, (low, high) in box.items():
        voxels = voxels.filter((F.col(a) >= low) & (F.col(a) < high))
    return voxels


def edge_pad(voxels: DataFrame, axis: str, size: int, target: int) -> DataFrame:
    """Fits an axis to ``target``: cut where it is longer, else the last plane repeated."""
    kept = voxels.filter(F.col(axis) < target)
    if target <= size:
        return kept
    last = voxels.filter(F.col(axis) == size - 1).withColumn(axis, F.explode(F.sequence(F.lit(size), F.lit(target - 1))))
    return kept.unionByName(last)

"""Statistics of label volumes: sizes, spans, borders, boundaries, slices, components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def histogram(voxels: DataFrame, label: str = "pred", limit: int | None = None) -> DataFrame:
    """(label, n); with ``limit`` the first values in order."""
    out = voxels.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    return out.orderBy("label").limit(limit) if limit else out


def on_border(shape: Sequence[int]) -> Column:
    out = F.lit(False)
    for a, n in zip("zyx", shape, strict=True):
        out = out | F.col(a).isin(0, n - 1)
    return out


def object_metrics(voxels: DataFrame, shape: Sequence[int], label: str = "pred") -> DataFrame:
    """One row an object: voxels, box, spans along z, whether it touches the border."""
    out = voxels.filter(F.col(label) > 0).groupBy(F.col(label).alias("label"))
    box = [f(a).alias(f"{a}{e}") for a in "zyx" for f, e in ((F.min, "0"), (F.max, "1"))]
    out = out.agg(F.count("*").alias("n"), *box, F.bool_or(on_border(shape)).alias("border"))
    return out.withColumn("z_span", (F.col("z1") - F.col("z0") + 1).cast("long"))


def sizes(objects: DataFrame) -> DataFrame:
    """Minimum, median and maximum of the objects' voxels, 0 without objects."""
    zero = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind)
    return objects.agg(F.count("*").alias("objects"), zero(F.min("n"), "long").alias("size_min"), zero(F.median("n"), "double").alias("size_median"), zero(F.max("n"), "long").alias("size_max"))


def quality(voxels: DataFrame, shape: Sequence[int], label: str = "pred") -> DataFrame:
    """One row: objects, foreground share of the whole grid, sizes, spans, objects on the border,
    and whether the mask is empty or full."""
    cells = 1
    for n in shape:
        cells *= n
    o = object_metrics(voxels, shape, label)
    zero = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind)
    return o.agg(
        F.count("*").alias("objects"), (zero(F.sum("n"), "double") / cells).alias("foreground_share"),
        zero(F.min("n"), "long").alias("size_min"), zero(F.median("n"), "double").alias("size_median"), zero(F.max("n"), "long").alias("size_max"),
        zero(F.min("z_span"), "long").alias("span_min"), zero(F.median("z_span"), "double").alias("span_median"), zero(F.max("z_span"), "long").alias("span_max"),
        F.count_if("border").alias("border_objects"), F.coalesce(F.sum("n") == cells, F.lit(False)).alias("full"), (F.count("*") == 0).alias("empty"),
    )


def boundary(dense: DataFrame, label: str = "pred") -> DataFrame:
    """Foreground cells that differ from the cell above or to the left; outside is no neighbour."""
    up = F.lag(label).over(W.partitionBy("z", "x").orderBy("y"))
    left = F.lag(label).over(W.partitionBy("z", "y").orderBy("x"))
    marked = dense.withColumn("up", up).withColumn("left", left)
    edge = (F.col(label) > 0) & (F.coalesce(F.col("up") != F.col(label), F.lit(False)) | F.coalesce(F.col("left") != F.col(label), F.lit(False)))
    return marked.filter(edge).select("z", "y", "x", F.col(label).alias("label"))


def union_foreground(voxels: DataFrame, labels: Sequence[str], axis: str = "z") -> DataFrame:
    """(axis, n): cells of each plane that any labeling marks; one pass, no union of tables."""
    some = F.lit(False)
    for c in labels:
        some = some | (F.col(c) > 0)
    return voxels.filter(some).groupBy(F.col(axis).alias("plane")).agg(F.count("*").alias("n"))


def best_slice(planes: DataFrame, size: int, centre: bool = True) -> DataFrame:
    """The plane with most foreground; ties to the one nearest the centre (or, without
    ``centre``, none of that) and then the lowest.  The centre if no plane has any."""
    order = [F.col("n").desc(), *([F.abs(F.col("plane") - size // 2)] if centre else []), F.col("plane")]
    best = planes.orderBy(*order).limit(1)
    return best.agg(F.coalesce(F.max("plane"), F.lit(size // 2)).cast("int").alias("plane"), F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("n"))


def size_span_filter(voxels: DataFrame, least_size: int, least_span: int, label: str = "pred") -> DataFrame:
    """Voxels of objects that are large and long enough."""
    keep = voxels.filter(F.col(label) > 0).groupBy(label).agg(F.count("*").alias("n"), (F.max("z") - F.min("z") + 1).alias("span"))
    return voxels.join(keep.filter((F.col("n") >= least_size) & (F.col("span") >= least_span)).select(label), label, "left_semi")


def plane_vote(voxels: DataFrame, labels: Sequence[str], votes: int = 2) -> DataFrame:
    """Voxels that at least ``votes`` labelings mark."""
    total = sum((F.col(c) > 0).cast("int") for c in labels)
    return voxels.withColumn("votes", total).filter(F.col("votes") >= votes)


def stack_median(dense: DataFrame, value: str, radius: int = 1) -> DataFrame:
    """Median over the planes within ``radius`` of each voxel's."""
    w = W.partitionBy("y", "x").orderBy("z").rowsBetween(-radius, radius)
    return dense.withColumn("median", F.expr(f"percentile({value}, 0.5)").over(w))


def invalid_labels(values: DataFrame, column: str, capacity: int) -> DataFrame:
    """Values that no label may have: missing, not finite, negative, fractional or too large."""
    v = F.col(column).cast("double")
    bad = v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")) | (v < 0) | (v != F.floor(v)) | (v > capacity)
    return values.filter(bad)


PLANES = {"xy": "z", "xz": "y", "yz": "x"}


def plane_slice(voxels: DataFrame, plane: str, shape: Sequence[int], index: int | None = None) -> DataFrame:
    """The voxels of one plane, the middle one unless an index is given; its own axis goes.  An index
    outside the volume is an error."""
    axis = PLANES[plane]
    size = shape["zyx".index(axis)]
    at = size // 2 if index is None else index
    if not 0 <= at < size:
        raise ValueError(f"plane {at} is outside 0 .. {size - 1}")
    return voxels.filter(F.col(axis) == at).drop(axis)


def with_label(voxels: DataFrame, value, label: str = "pred") -> DataFrame:
    """Voxels whose label is meant by ``value``: any but 0 (null), one of a list, or the one."""
    c = F.col(label)
    return voxels.filter(c != 0 if value is None else c.isin(list(value)) if isinstance(value, (list, tuple, set)) else c == value)


def unique_in_planes(voxels: DataFrame, label: str = "pred", axis: str = "z") -> DataFrame:
    """(plane, labels): distinct labels, background included where it has voxels."""
    return voxels.groupBy(F.col(axis).alias("plane")).agg(F.count_distinct(label).alias("labels"))


def tissue(value: Column, low: int = 1, high: int = 249) -> Column:
    """Intensities of tissue: neither empty nor saturated."""
    return value.between(low, high)


def selected(rows: DataFrame, key: str, wanted: Sequence) -> DataFrame:
    """The rows with these ids; an id that no row has is an error.  Without ids, all rows."""
    if not wanted:
        return rows
    ids = rows.sparkSession.createDataFrame([(w,) for w in dict.fromkeys(wanted)], f"{key} {dict(rows.dtypes)[key]}")
    unknown = ids.join(rows.select(key).distinct(), key, "left_anti").orderBy(key).limit(5).collect()
    if unknown:
        raise ValueError("unknown ids: " + ", ".join(str(r[0]) for r in unknown))
    return rows.join(F.broadcast(ids), key, "left_semi")


def relabelled_axes(rows: DataFrame, axes: str) -> DataFrame:
    """Rows of an array with axes in any order (columns a0, a1, ...) as z, y, x: a channel axis is
    dropped, a missing z is plane 0."""
    if len(set(axes)) != len(axes) or not set("yx") <= set(axes) <= set("czyx"):
        raise ValueError(f"axes {axes} are not of czyx, each once, with y and x")
    at = {a: F.col(f"a{i}") for i, a in enumerate(axes)}
    rest = [c for c in rows.columns if c not in {f"a{i}" for i in range(len(axes))}]
    return rows.select(at.get("z", F.lit(0)).cast("int").alias("z"), at["y"].alias("y"), at["x"].alias("x"), *rest)


def affinity_planes(voxels: DataFrame, channels: int = 3) -> DataFrame:
    """Voxels (c, y, x, value) of a plane -> (y, x, c0, c1, ...): the first channels side by side."""
    pick = [F.max(F.when(F.col("c") == i, F.col("value"))).alias(f"c{i}") for i in range(channels)]
    return voxels.filter(F.col("c") < channels).groupBy("y", "x").agg(*pick)


def boundary_faces(voxels: DataFrame, label: str = "pred") -> DataFrame:
    """The surface of each object as unit faces: (label, z, y, x, axis, side) for every face of a voxel
    whose neighbour there is not of the object; outside the table is background."""
    cells = voxels.filter(F.col(label) > 0).select("z", "y", "x", F.col(label).alias("label"))
    sides = F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.lit(s).alias("side")) for a in "zyx" for s in (-1, 1)]))
    asked = cells.withColumn("f", sides).select("*", "f.axis", "f.side")
    there = [(F.col(a) + F.when(F.col("axis") == a, F.col("side")).otherwise(0)).alias(f"n{a}") for a in "zyx"]
    other = cells.select(*[F.col(a).alias(f"n{a}") for a in "zyx"], "label")
    return asked.select("*", *there).join(other, ["nz", "ny", "nx", "label"], "left_anti").select("label", "z", "y", "x", "axis", "side")

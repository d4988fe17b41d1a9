"""Resampling volumes and aligning layers in physical space."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.operators.boxes import within


def nearest_index(i: Column, source: int, target: int) -> Column:
    """Source index of a target index, without a shift by half a pixel."""
    return F.least(F.floor(i * source / target), F.lit(source - 1)).cast("int")


def nearest(voxels: DataFrame, source: Sequence[int], target: Sequence[int], keep: Sequence[str]) -> DataFrame:
    """Sparse voxels of one grid on another, by nearest source index.  Each voxel finds the range
    of targets that read it, so absent voxels cost nothing."""
    out = voxels
    for a, s, t in zip("zyx", source, target, strict=True):
        up = lambda i, s=s, t=t: F.floor((i.cast("long") * t + (s - 1)) / s)
        low, high = up(F.col(a)), up(F.col(a) + 1) - 1
        out = out.withColumn("__low", low.cast("int")).withColumn("__high", high.cast("int")).filter("__low <= __high")
        out = out.withColumn(a, F.explode(F.sequence("__low", "__high"))).drop("__low", "__high")
    return out.select("z", "y", "x", *keep)


def linear(dense: DataFrame, value: str, axis: str, source: int, target: int) -> DataFrame:
    """Linear interpolation along one axis, first and last cells kept in place."""
    others = [a for a in "zyx" if a != axis]
    step = (source - 1) / max(1, target - 1)
    at = F.col("to") * F.lit(step)
    low = F.least(F.floor(at), F.lit(source - 1)).cast("int")
    rows = dense.select(*others).distinct().withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(target - 1)))).withColumn("lo", low).withColumn("w", at - F.col("lo"))
    pick = lambda c, name: dense.select(*others, F.col(axis).alias(c), F.col(value).cast("double").alias(name))
    both = rows.withColumn("hi", F.least(F.col("lo") + 1, F.lit(source - 1))).join(pick("lo", "a"), [*others, "lo"]).join(pick("hi", "b"), [*others, "hi"])
    return both.select(*others, F.col("to").alias(axis), (F.col("a") * (1 - F.col("w")) + F.col("b") * F.col("w")).alias(value))


def block_mean(dense: DataFrame, value: str, factor: int) -> DataFrame:
    """Area reduction of planes by a whole factor."""
    return dense.groupBy("z", F.floor(F.col("y") / factor).cast("int").alias("y"), F.floor(F.col("x") / factor).cast("int").alias("x")).agg(F.avg(value).alias(value))


def choose_mip(mips: DataFrame, targets: DataFrame, finer: bool = False) -> DataFrame:
    """(name, mip, resolution), (name, target) -> the mip nearest in log resolution, ties to the
    lower mip; with ``finer`` none coarser than the target if there is one."""
    both = mips.join(targets, "name")
    far = F.abs(F.ln(F.col("resolution") / F.col("target")))
    order = [*([F.col("resolution") > F.col("target")] if finer else []), far, F.col("mip")]
    return both.withColumn("place", F.row_number().over(W.partitionBy("name").orderBy(*order))).filter("place = 1").select("name", "target", "mip", "resolution")


def nearest_mip(mips: Column, target: Column, finer: bool = False) -> Column:
    """The same for a row that holds its mips, an array of (mip, resolution): that one of them."""
    far = lambda m: F.abs(F.ln(m["resolution"] / target))
    places = lambda m: [*([(m["resolution"] > target).alias("coarser")] if finer else []), far(m).alias("far"), m["mip"].alias("mip"), m["resolution"].alias("resolution")]
    best = F.array_min(F.transform(mips, lambda m: F.struct(*places(m))))
    return F.struct(best["mip"].alias("mip"), best["resolution"].alias("resolution"))


def aligned(raw: DataFrame, layer: DataFrame, raw_res: Sequence[float], layer_res: Sequence[float], offset_nm: Sequence[float] = (0, 0, 0)) -> DataFrame:
    """Raw voxels with the label of the layer's voxel at the same physical place, 0 outside."""
    for a, r, l, o in zip("zyx", raw_res, layer_res, offset_nm, strict=True):
        raw = raw.withColumn(f"l{a}", F.floor(((F.col(a) + 0.5) * r - o) / l).cast("int"))
    found = layer.select(*[F.col(a).alias(f"l{a}") for a in "zyx"], F.col("label"))
    return raw.join(found, ["lz", "ly", "lx"], "left").fillna(0, ["label"]).drop("lz", "ly", "lx")


def clip_cast(value: Column, low: int, high: int) -> Column:
    """Half-even rounding, cut to a range of integers."""
    return F.least(F.greatest(F.rint(value), F.lit(float(low))), F.lit(float(high))).cast("long")


def patch_scaled(pixels: DataFrame, value: str = "v") -> DataFrame:
    """Pixels (patch_id, v) as z-scores of their patch; values above 1.5 are bytes and are divided
    by 255 first; above 255 there is none and ``ok`` is false."""
    w = W.partitionBy("patch_id")
    top = F.max(value).over(w)
    unit = F.when(top > 1.5, F.col(value) / 255.0).otherwise(F.col(value).cast("double"))
    out = pixels.withColumn("ok", top <= 255).withColumn("unit", unit)
    return out.withColumn("scaled", (F.col("unit") - F.avg("unit").over(w)) / F.greatest(F.stddev_pop("unit").over(w), F.lit(1e-6))).drop("unit")


def area(dense: DataFrame, value: str, axis: str, source: int, target: int) -> DataFrame:
    """Area reduction of one axis to any smaller length: each target cell is the mean of what it
    covers, cells in part by their share."""
    others = [a for a in "zyx" if a != axis]
    scale = source / target
    at = F.col(axis)
    cells = dense.withColumn("__to", F.explode(F.sequence(F.floor(at / scale).cast("int"), F.least(F.ceil((at + 1) / scale).cast("int") - 1, F.lit(target - 1)))))
    held = F.greatest(F.least(at + 1.0, (F.col("__to") + 1) * F.lit(scale)) - F.greatest(at.cast("double"), F.col("__to") * F.lit(scale)), F.lit(0.0))
    out = cells.groupBy(*others, F.col("__to").alias(axis)).agg((F.sum(held * F.col(value)) / F.lit(scale)).alias(value))
    return out.select("z", "y", "x", value)


def restored(voxels: DataFrame, model: Sequence[int], source: Sequence[int], label: str = "pred") -> DataFrame:
    """(label, state): ids that a way back to the source grid loses or adds; none if it is whole."""
    back = nearest(voxels, model, source, [label])
    ids = lambda d: d.filter(F.col(label) > 0).select(F.col(label).alias("label")).distinct()
    lost, added = ids(voxels).subtract(ids(back)), ids(back).subtract(ids(voxels))
    return lost.withColumn("state", F.lit("lost")).unionByName(added.withColumn("state", F.lit("added")))


def tiles_equal_bulk(voxels: DataFrame, tiles: DataFrame, value: str) -> DataFrame:
    """(tile_id, voxels, bulk, same): cells read tile by tile against the same cells counted from the
    whole, by the core boxes."""
    part = within(voxels.select(*"zyx", value), tiles.select("tile_id", *[f"{a}{e}" for a in "zyx" for e in "01"])).groupBy("tile_id").agg(F.count("*").alias("voxels"), F.sum(value).alias("total"))
    whole = voxels.agg(F.count("*").alias("all_voxels"), F.sum(value).alias("all_total"))
    sums = part.agg(F.sum("voxels").alias("sum_voxels"), F.sum("total").alias("sum_total"))
    checked = sums.join(F.broadcast(whole)).select(((F.col("sum_voxels") == F.col("all_voxels")) & (F.col("sum_total") == F.col("all_total"))).alias("same"))
    return part.join(F.broadcast(checked))

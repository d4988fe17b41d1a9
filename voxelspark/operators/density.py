"""Binned densities, quantile ranges, box means and blurs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.operators.numbering import quantiles


MOST_REGIONS = 10_000  # sent to every task


def binned(points: DataFrame, y: str, x: str, size: int, valid: Column, positive: Column) -> DataFrame:
    """(by, bx, valid, positive, percent) of square bins; an empty denominator gives 0."""
    out = points.groupBy(F.floor(F.col(y) / size).cast("int").alias("by"), F.floor(F.col(x) / size).cast("int").alias("bx"))
    out = out.agg(F.count_if(valid).alias("valid"), F.count_if(valid & positive).alias("positive"))
    return out.withColumn("percent", F.when(F.col("valid") == 0, 0.0).otherwise(100.0 * F.col("positive") / F.greatest("valid", F.lit(1))))


def occupancy(voxels: DataFrame, regions: DataFrame, positive: Column, valid: Column) -> DataFrame:
    """Share of positive among valid voxels of each region (name and box), 0 without valid ones.
    Regions are few and the voxels are read once."""
    if regions.limit(MOST_REGIONS + 1).count() > MOST_REGIONS:
        raise ValueError(f"more than {MOST_REGIONS} regions")
    inside = F.lit(True)
    for a in "zyx":
        inside = inside & (F.col(a) >= F.col(f"{a}0")) & (F.col(a) < F.col(f"{a}1"))
    both = F.broadcast(regions).join(voxels, inside, "left")
    out = both.groupBy("name").agg(F.count_if(valid).alias("valid"), F.count_if(valid & positive).alias("positive"))
    return out.withColumn("percent", F.when(F.col("valid") == 0, 0.0).otherwise(100.0 * F.col("positive") / F.greatest("valid", F.lit(1))))


def display_limit(bins: DataFrame, q: float = 0.99, floor: float = 0.01) -> DataFrame:
    """The q-quantile of positive bins (1 without any), at least ``floor``."""
    top = quantiles(bins.filter(F.col("percent") > 0), "percent", [q])[0]
    return bins.sparkSession.createDataFrame([(max(1.0 if top is None else top, floor),)], "vmax double")


def normalised(values: DataFrame, column: str, low: float = 0.01, high: float = 0.99, flat: str = "zero") -> DataFrame:
    """Adds ``scaled``: the value between two exact quantiles of the finite values, cut to 0..1;
    a flat range gives 0 (with ``flat="step"``: 1 from it on, 0 below), and so do values that are not finite."""
    if flat not in ("zero", "step"):
        raise ValueError(f"unknown way {flat}")
    v = F.col(column)
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    lo, hi = quantiles(values, column, [low, high])
    if flat == "step" and lo is not None and hi <= lo:
        return values.withColumn("scaled", F.when(finite & (v >= lo), 1.0).otherwise(0.0))
    if lo is None or hi <= lo:
        return values.withColumn("scaled", F.lit(0.0))
    scaled = F.least(F.greatest((v - F.lit(lo)) / F.lit(hi - lo), F.lit(0.0)), F.lit(1.0))
    return values.withColumn("scaled", F.when(finite, scaled).otherwise(0.0))


def _bordered(dense: DataFrame, value: str, axis: str, size: int, radius: int) -> DataFrame:
    """The cells with those beyond both ends, which mirror the ones within (edge cells repeated)."""
    i = F.col(axis)
    low = dense.filter(i < radius).withColumn(axis, -i - 1)
    high = dense.filter(i >= size - radius).withColumn(axis, F.lit(2 * size - 1) - i)
    return dense.unionByName(low).unionByName(high)


def box_mean(dense: DataFrame, value: str, radius: int, border: str = "cut", shape: Sequence[int] | None = None) -> DataFrame:
    """Mean and standard deviation over the square around each cell of a plane, by two separable
    passes of sums.  ``border``: beyond the plane there is nothing (``cut``), zeros (``zero``, as for a
    coverage) or the mirrored plane (``reflect``, as for intensities; needs the planes' shape)."""
    if border not in ("cut", "zero", "reflect"):
        raise ValueError(f"unknown border {border}")
    rows = W.partitionBy("z", "y").orderBy("x").rowsBetween(-radius, radius)
    columns = W.partitionBy("z", "x").orderBy("y").rowsBetween(-radius, radius)
    cells = dense.select("z", "y", "x", F.col(value).alias("v"))
    if border == "reflect":
        if shape is None or min(shape) < radius:
            raise ValueError("a mirrored border needs the planes' shape, no shorter than the radius")
        cells = _bordered(_bordered(cells, "v", "x", shape[1], radius), "v", "y", shape[0], radius)
    v = F.col("v")
    out = cells.select("z", "y", "x", F.sum(v).over(rows).alias("s"), F.sum(v * v).over(rows).alias("q"), F.count(v).over(rows).alias("n"))
    out = out.select("z", "y", "x", F.sum("s").over(columns).alias("s"), F.sum("q").over(columns).alias("q"), F.sum("n").over(columns).alias("n"))
    if border == "reflect":
        out = out.filter(F.col("x").between(0, shape[1] - 1) & F.col("y").between(0, shape[0] - 1))
    n = F.lit((2 * radius + 1) ** 2) if border == "zero" else F.col("n")
    mean = F.col("s") / n
    return out.select("z", "y", "x", mean.alias("mean"), F.sqrt(F.greatest(F.col("q") / n - mean * mean, F.lit(0.0))).alias("std"))


def gaussian_weights(sigma: float) -> list[float]:
    """Weights of a kernel of odd size 2 round(4 sigma) + 1, normalised."""
    radius = max(1, round(4 * sigma))
    w = [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-radius, radius + 1)]
    return [x / sum(w) for x in w]


def _mirror(i: Column, n: int) -> Column:
    """Index reflected at the first and last cell, which are not repeated."""
    period = max(1, 2 * (n - 1))
    m = F.pmod(i, F.lit(period))
    return F.when(m >= n, period - m).otherwise(m)


def blur(grid: DataFrame, value: str, shape: Sequence[int], sigma: float) -> DataFrame:
    """Separable Gaussian blur of a (by, bx) grid: each cell gives its value to those around it."""
    weights = gaussian_weights(sigma)
    radius = len(weights) // 2
    taps = F.array(*[F.struct(F.lit(i - radius).alias("d"), F.lit(w).alias("w")) for i, w in enumerate(weights)])
    out = grid.select("by", "bx", F.col(value).cast("double").alias("v"))
    for axis, n in (("by", shape[0]), ("bx", shape[1])):
        other = "bx" if axis == "by" else "by"
        cells = out.select(other).distinct().withColumn(axis, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        asked = cells.select(other, F.col(axis).alias("at"), F.explode(taps).alias("t")).select(other, "at", _mirror(F.col("at") + F.col("t.d"), n).cast("int").alias(axis), F.col("t.w").alias("w"))
        out = asked.join(out, [other, axis]).groupBy(other, F.col("at").alias(axis)).agg(F.sum(F.col("w") * F.col("v")).alias("v"))
    return out.select("by", "bx", F.col("v").alias("blurred"))


def bands(points: DataFrame, x: str, score: str, parts: int) -> DataFrame:
    """The best point of each of ``parts`` bands between exact quantiles of x; ties to lower x."""
    cuts = [c for c in quantiles(points, x, [i / parts for i in range(1, parts)]) if c is not None]
    band = sum(((F.lit(c) < F.col(x)).cast("int") for c in cuts), F.lit(0))
    tagged = points.withColumn("band", band)
    return tagged.withColumn("place", F.row_number().over(W.partitionBy("band").orderBy(F.col(score).desc(), x))).filter("place = 1").drop("place")


def _bin_sums(cells: DataFrame, size: int, shape: Sequence[int], mask: Column, tissue: Column) -> DataFrame:
    """(by, bx, num, den) of every bin that the plane touches; what is padded to whole bins is empty."""
    sums = cells.groupBy(F.floor(F.col("y") / size).cast("int").alias("by"), F.floor(F.col("x") / size).cast("int").alias("bx"))
    sums = sums.agg(F.count_if(mask).alias("num"), F.count_if(tissue).alias("den"))
    h, w = (-(-n // size) for n in shape)
    grid = cells.sparkSession.range(h * w).select(F.floor(F.col("id") / w).cast("int").alias("by"), (F.col("id") % w).cast("int").alias("bx"))
    return grid.join(sums, ["by", "bx"], "left").fillna(0, ["num", "den"])


def density_blurred_sums(cells: DataFrame, size: int, shape: Sequence[int], mask: Column, tissue: Column, sigma: float = 1.25, least: float = 0.06) -> DataFrame:
    """Cells (y, x) of a plane -> (by, bx, percent, valid): mask and tissue are summed by bin, both
    blurred, then divided; a bin is valid if its blurred tissue is more than a share of its area.  The
    mask is not cut to the tissue, so a percentage can exceed 100."""
    sums = _bin_sums(cells, size, shape, mask, tissue)
    bins = [-(-n // size) for n in shape]
    num, den = (blur(sums, c, bins, sigma).withColumnRenamed("blurred", c) for c in ("num", "den"))
    both = num.join(den, ["by", "bx"])
    percent = F.when(F.col("den") > 0, 100 * F.col("num") / F.when(F.col("den") > 0, F.col("den")).otherwise(1.0)).otherwise(0.0)
    return both.select("by", "bx", percent.alias("percent"), (F.col("den") > size * size * least).alias("valid"))


def density_blurred_share(cells: DataFrame, size: int, shape: Sequence[int], mask: Column, tissue: Column, sigma: float = 0.8) -> DataFrame:
    """The same with the mask cut to the tissue, divided first and blurred then: (by, bx, percent, num,
    den), the sums being those of the bin before the blur."""
    sums = _bin_sums(cells, size, shape, mask & tissue, tissue)
    share = sums.withColumn("share", F.when(F.col("den") > 0, 100.0 * F.col("num") / F.greatest("den", F.lit(1))).otherwise(0.0))
    smooth = blur(share, "share", [-(-n // size) for n in shape], sigma).withColumnRenamed("blurred", "percent")
    return smooth.join(sums, ["by", "bx"])


def without_margins(scores: DataFrame, score: str, width: int, height: int, margin: int) -> DataFrame:
    """Scores (y, x) with -1 in the margins of the plane."""
    inside = (F.col("x") >= margin) & (F.col("x") < width - margin) & (F.col("y") >= margin) & (F.col("y") < height - margin)
    return scores.withColumn(score, F.when(inside, F.col(score)).otherwise(-1.0))

"""Pixels of views: display windows, overlays, heat, letterboxes, contexts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelspark.functions.scalars import clamp, hue


def window(value: Column, low: float, high: float) -> Column:
    """Intensity in a display window as 0..255."""
    return F.floor(clamp((value - low) / (high - low)) * 255).cast("int")


def rgb(h: Column, s: float = 0.75, v: float = 1.0) -> list[Column]:
    """Red, green and blue (0..1) of a hue."""
    out = []
    for n in (5, 3, 1):
        k = (F.lit(float(n)) + h * 6) % 6
        out.append(v - v * s * F.greatest(F.lit(0.0), F.least(k, 4 - k, F.lit(1.0))))
    return out


def overlay(pixels: DataFrame, label: str, grey: str, boundary: str, alpha: float = 0.4) -> DataFrame:
    """Adds r, g, b (0..255): the label's colour over the grey value, boundaries white."""
    colour = rgb(hue(F.col(label)))
    for name, c in zip("rgb", colour, strict=True):
        mixed = F.when(F.col(label) > 0, (1 - alpha) * F.col(grey) + alpha * 255 * c).otherwise(F.col(grey).cast("double"))
        pixels = pixels.withColumn(name, F.when(F.col(boundary), 255).otherwise(F.rint(mixed)).cast("int"))
    return pixels


def heat(bins: DataFrame, vmax: float, valid: str = "valid") -> DataFrame:
    """Adds ``level`` (0..255, cut down) of a density for a colour map, and ``opacity``: 0.76 where the
    bin has valid cells, else 0."""
    share = clamp(F.col("percent") / vmax)
    return bins.withColumn("level", F.floor(share * 255).cast("int")).withColumn("opacity", F.when(F.col(valid) > 0, 0.76).otherwise(0.0))


def letterbox(sizes: DataFrame, width: int, height: int) -> DataFrame:
    """(w, h) -> the scale, size and offsets that fit an image in a frame."""
    scale = F.least(F.lit(width) / F.col("w"), F.lit(height) / F.col("h"))
    out = sizes.withColumn("scale", scale)
    out = out.withColumn("fit_w", F.greatest(F.rint(F.col("w") * F.col("scale")), F.lit(1.0)).cast("int")).withColumn("fit_h", F.greatest(F.rint(F.col("h") * F.col("scale")), F.lit(1.0)).cast("int"))
    return out.withColumn("left", F.floor((width - F.col("fit_w")) / 2).cast("int")).withColumn("top", F.floor((height - F.col("fit_h")) / 2).cast("int"))


def strip(stops: DataFrame, margin: float) -> DataFrame:
    """The box around all stops with a margin on every side."""
    side = lambda f, c, s: (f(c) + s * margin).alias(f"{c}{'0' if s < 0 else '1'}")
    return stops.agg(side(F.min, "x", -1), side(F.max, "x", 1), side(F.min, "y", -1), side(F.max, "y", 1))


def context(view: DataFrame, pixel: float) -> DataFrame:
    """A physical window (x0, x1, y0, y1) in preview pixels: floor of starts, ceiling of ends."""
    for a in "xy":
        view = view.withColumn(f"p{a}0", F.floor(F.col(f"{a}0") / pixel)).withColumn(f"p{a}1", F.ceil(F.col(f"{a}1") / pixel))
    return view


def rotated(vertex: DataFrame, yaw: float, pitch: float) -> DataFrame:
    """Vertices turned about y, then about x; the orthographic view drops z."""
    cy, sy, cp, sp = (f(F.lit(a)) for a in (yaw, pitch) for f in (F.cos, F.sin))
    v = vertex.withColumn("rx", cy * F.col("x") + sy * F.col("z")).withColumn("t", cy * F.col("z") - sy * F.col("x"))
    return v.withColumn("ry", cp * F.col("y") - sp * F.col("t")).withColumn("rz", sp * F.col("y") + cp * F.col("t")).drop("t")


def shade(nx: Column, ny: Column, nz: Column, light=(0.3, 0.4, 0.866), ambient: float = 0.25) -> Column:
    """Lambert's light on a unit normal, either side."""
    return ambient + (1 - ambient) * F.abs(nx * light[0] + ny * light[1] + nz * light[2])


def camera_crop(views: DataFrame, bounds: tuple[float, float, float, float], width: int, height: int, ratio: float) -> DataFrame:
    """(x, y, fov) -> the pixels (px0, px1, py0, py1) of an image of ``bounds`` (x0, x1, y0, y1) that a
    view shows: the field no larger than the image, the centre drawn in so that the view stays
    within; starts rounded down, ends up."""
    x0, x1, y0, y1 = bounds
    v = views.withColumn("fov_x", F.least(F.col("fov"), F.lit(x1 - x0)))
    v = v.withColumn("fov_y", F.least(F.col("fov_x") * ratio, F.lit(y1 - y0)))
    for a, low, high, n in (("x", x0, x1, width), ("y", y0, y1, height)):
        half = F.col(f"fov_{a}") / 2
        v = v.withColumn(f"c{a}", F.least(F.greatest(F.col(a), F.lit(low) + half), F.lit(high) - half))
        start, end = ((F.col(f"c{a}") + s * half - low) / (high - low) * n for s in (-1, 1))
        v = v.withColumn(f"p{a}0", F.greatest(F.floor(start), F.lit(0)).cast("int")).withColumn(f"p{a}1", F.least(F.ceil(end), F.lit(n)).cast("int"))
    return v


def occupancy_bars(values: DataFrame, left: int, right: int, room: float = 1.12) -> DataFrame:
    """(region, layer, percent) -> with ``bar``: where its bar ends between two pixels, the largest
    value (1 at least) leaving some room."""
    top = values.agg((F.greatest(F.max("percent"), F.lit(1.0)) * room).alias("top"))
    end = left + F.rint((right - left) * F.col("percent") / F.col("top"))
    return values.join(F.broadcast(top)).withColumn("bar", end.cast("int")).drop("top")

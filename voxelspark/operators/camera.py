"""Timelines and camera poses as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.functions.scalars import ease, smoothstep
from voxelspark.operators.numbering import numbered, running_totals


def timeline(states: DataFrame, fps: float, transition: float = 0.32) -> DataFrame:
    """states (position, name, seconds) -> frames of each hold: (first, last, mid), a transition
    before each state but the first."""
    gap = F.rint(F.lit(transition * fps)).cast("long")
    out = states.withColumn("hold", F.rint(F.col("seconds") * fps).cast("long"))
    out = running_totals(out.withColumn("__each", F.col("hold") + gap), ["position"], {"__end": "__each"})
    out = out.withColumn("last", F.col("__end") - gap - 1).withColumn("first", F.col("last") - F.col("hold") + 1)
    return out.withColumn("mid", F.floor((F.col("first") + F.col("last")) / 2)).select("position", "name", "hold", "first", "last", "mid")


def segments(spark: SparkSession, stops: list[tuple[float, float]], fov: float, entry: tuple[float, float, float, float] | None, hold: float, move: float, zoom_out: float) -> DataFrame:
    """Segments (start, length, kind, x0, y0, x1, y1, f0, f1, bump) of a tour: an optional entry
    (x, y, field multiplier, seconds), then hold, move, hold, ... over the stops."""
    rows, t = [], 0.0
    if entry:
        x, y, times, seconds = entry
        rows.append((t, seconds, "entry", x, y, *stops[0], fov * times, fov, 0.0))
        t += seconds
    for i, stop in enumerate(stops):
        rows.append((t, hold, "hold", *stop, *stop, fov, fov, 0.0))
        t += hold
        if i + 1 < len(stops):
            rows.append((t, move, "move", *stop, *stops[i + 1], fov, fov, zoom_out))
            t += move
    rows = [tuple(map(lambda v: v if isinstance(v, str) else float(v), r)) for r in rows]
    return spark.createDataFrame(rows, "start double, length double, kind string, x0 double, y0 double, x1 double, y1 double, f0 double, f1 double, bump double")


def tour(stops: DataFrame, fov: float, entry: tuple[float, float, float, float] | None, hold: float, move: float, zoom_out: float) -> DataFrame:
    """The same segments of stops in a table (position from 0 without gaps, x, y): a stop meets the next
    one by its position, and when a segment starts follows from it."""
    p, after = F.col("position"), float(entry[3]) if entry else 0.0
    names = ["start", "length", "kind", "x0", "y0", "x1", "y1", "f0", "f1", "bump"]
    row = lambda *values: [(F.lit(v) if not isinstance(v, Column) else v).alias(n) for v, n in zip(values, names, strict=True)]
    x, y, wide, each = F.col("x"), F.col("y"), float(fov), float(hold + move)
    out = stops.select(*row(after + p * each, float(hold), "hold", x, y, x, y, wide, wide, 0.0))
    ahead = stops.select((p - 1).alias("position"), x.alias("nx"), y.alias("ny"))
    moves = stops.join(ahead, "position").select(*row(after + p * each + float(hold), float(move), "move", x, y, F.col("nx"), F.col("ny"), wide, wide, float(zoom_out)))
    out = out.union(moves)
    if entry:
        out = out.union(stops.filter(p == 0).select(*row(0.0, after, "entry", float(entry[0]), float(entry[1]), x, y, wide * entry[2], wide, 0.0)))
    return out


def poses(segments: DataFrame, fps: float, easing: str = "smoothstep") -> DataFrame:
    """(frame, kind, x, y, fov) of every frame: each segment opens to its own frames, so there is
    no join by time.  Moves widen the field by a parabola that peaks half way."""
    low, high = F.ceil(F.col("start") * fps), F.ceil((F.col("start") + F.col("length")) * fps) - 1
    out = segments.filter(low <= high).withColumn("frame", F.explode(F.sequence(low, high)))
    u = (F.col("frame") / fps - F.col("start")) / F.col("length")
    e = F.when(F.col("kind") == "hold", 0.0).otherwise(ease(u, easing))
    out = out.withColumn("u", u).withColumn("e", e)
    mid = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * F.col("e")
    fov = mid("f0", "f1") * (1 + 4 * F.col("u") * (1 - F.col("u")) * F.col("bump"))
    return out.select("frame", "kind", mid("x0", "x1").alias("x"), mid("y0", "y1").alias("y"), fov.alias("fov"))


def durations(stamps: DataFrame) -> DataFrame:
    """(t, url) -> seconds until the next, null for the last."""
    return stamps.withColumn("seconds", F.lead("t").over(W.orderBy("t")) - F.col("t"))


def montage(items: DataFrame, order: str, columns: int) -> DataFrame:
    """Row and column of each item of a contact sheet."""
    i = F.col("__place")
    return numbered(items, [order], "__place").withColumn("row", F.floor(i / columns).cast("int")).withColumn("column", (i % columns).cast("int")).drop("__place")


def crossfade(segments: DataFrame, fade: int) -> DataFrame:
    """(segment, frames) -> (segment, j, weight) of every frame: over the first ``fade`` frames of a
    segment but the first one its picture comes in by a smooth step, then stands alone."""
    j = F.explode(F.sequence(F.lit(0), F.col("frames") - 1)).alias("j")
    out = segments.filter("frames > 0").select("segment", j)
    mixed = (F.col("segment") > 0) & (F.col("j") < fade)
    return out.withColumn("weight", F.when(mixed, smoothstep(F.col("j") / float(max(1, fade - 1)))).otherwise(1.0))


def dissolve(poses: DataFrame) -> DataFrame:
    """Poses (kind, progress) with the weight of the local view against the overview: the progress
    within the entry, else 1."""
    return poses.withColumn("weight", F.when(F.col("kind") == "entry", F.col("progress")).otherwise(1.0))


def duration(tours: DataFrame, fps: float) -> DataFrame:
    """(layers, metadata, isolated, density, together, zoom, stops, hold, move) -> seconds, frames."""
    before = F.col("metadata") + F.col("layers") * (F.col("isolated") + F.col("density")) + F.col("together") + F.col("zoom")
    seconds = before + F.col("stops") * F.col("hold") + F.greatest(F.col("stops") - 1, F.lit(0)) * F.col("move")
    return tours.withColumn("seconds", seconds).withColumn("frames", F.rint(F.col("seconds") * fps).cast("long"))


def video_lines(states: DataFrame, key: str) -> DataFrame:
    """(key, t, url) -> (key, line, text): for each state its URL and then the seconds until the next
    one, 0 for the last."""
    w = W.partitionBy(key).orderBy("t")
    rows = states.withColumn("at", F.row_number().over(w) - 1).withColumn("seconds", F.coalesce(F.lead("t").over(w) - F.col("t"), F.lit(0.0)))
    pair = F.posexplode(F.array("url", F.col("seconds").cast("string")))
    return rows.select(key, "at", pair.alias("i", "text")).select(key, (F.col("at") * 2 + F.col("i")).cast("int").alias("line"), "text")

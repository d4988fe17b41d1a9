"""Checks of what was written: sample boxes, read-back, frames, order of states, splits."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.operators.boxes import AXES, pairs, within


def sample_boxes(spark: SparkSession, shape: Sequence[int], chunk: Sequence[int]) -> DataFrame:
    """Boxes of a chunk's size at the origin, the centre and the end; repeats left out in order."""
    size = [min(c, s) for c, s in zip(chunk, shape, strict=True)]
    starts = [tuple(0 for _ in shape), tuple((s - c) // 2 for s, c in zip(shape, size, strict=True)), tuple(s - c for s, c in zip(shape, size, strict=True))]
    rows = [(i, *[v for a, c in zip(s, size, strict=True) for v in (a, a + c)]) for i, s in enumerate(dict.fromkeys(starts))]
    return spark.createDataFrame(rows, "place int, " + ", ".join(f"{a}{e} int" for a in AXES for e in "01"))


def read_back(source: DataFrame, written: DataFrame, boxes: DataFrame, value: str) -> DataFrame:
    """(place, voxels, different, same): each box's voxels in both tables; one that only one table
    has differs."""
    inside = lambda d: within(d.select(*AXES, F.col(value).alias("v")), boxes).select("place", *AXES, "v")
    both = inside(source).alias("s").join(inside(written).withColumnRenamed("v", "u").alias("w"), ["place", *AXES], "full_outer")
    out = both.groupBy("place").agg(F.count("*").alias("voxels"), F.count_if(~F.col("v").eqNullSafe(F.col("u"))).alias("different"))
    return out.withColumn("same", F.col("different") == 0)


def frame_difference(frames: DataFrame) -> DataFrame:
    """frames (frame, y, x, v) -> (frame, mae): mean absolute difference to the frame before."""
    before = frames.select((F.col("frame") + 1).alias("frame"), "y", "x", F.col("v").alias("u"))
    return frames.join(before, ["frame", "y", "x"]).groupBy("frame").agg(F.avg(F.abs(F.col("v") - F.col("u"))).alias("mae"))


def frame_shift(frames: DataFrame, height: int, width: int) -> DataFrame:
    """(frame, dy, dx): the shift from the frame before by phase correlation.  A task gets the
    pixels of two frames."""
    both = frames.select("frame", "y", "x", "v", F.lit(1).alias("now")).union(frames.select(F.col("frame") + 1, "y", "x", "v", F.lit(0)))

    def shift(part: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((2, height, width))
        image[part.now, part.y, part.x] = part.v
        if part.now.nunique() < 2:
            return pd.DataFrame({"frame": [], "dy": [], "dx": []})
        a, b = np.fft.rfft2(image[0]), np.fft.rfft2(image[1])
        cross = np.conj(a) * b
        peak = np.fft.irfft2(cross / np.maximum(np.abs(cross), 1e-12), s=(height, width)).argmax()
        dy, dx = divmod(int(peak), width)
        wrap = lambda d, n: d - n if d > n // 2 else d
        return pd.DataFrame({"frame": [part.frame.iloc[0]], "dy": [wrap(dy, height)], "dx": [wrap(dx, width)]})

    return both.groupBy("frame").applyInPandas(shift, "frame long, dy long, dx long")


def in_order(states: DataFrame, kind: str, after: str, before: str) -> DataFrame:
    """One row, ok: states of a kind all stand after the last ``after`` and before the first
    ``before``."""
    at = lambda f, k: f(F.when(F.col("kind") == k, F.col("position")))
    ok = (at(F.min, kind) > at(F.max, after)) & (at(F.max, kind) < at(F.min, before))
    return states.agg(F.coalesce(ok, F.lit(False)).alias("ok"))


def disjoint(training: DataFrame, validation: DataFrame) -> DataFrame:
    """Pairs of boxes of two sets that share a voxel; none in a proper split."""
    return pairs(training, validation).toDF("training", "validation")


def random_baseline(candidates: DataFrame, seed: str, budget: int) -> DataFrame:
    """Candidates in an order by hash while their running cost fits the budget."""
    turn = F.md5(F.concat(F.lit(f"{seed}:"), F.col("ord").cast("string")))
    total = F.sum("cost").over(W.orderBy("turn", "ord").rowsBetween(W.unboundedPreceding, 0))
    # Costs are positive, so only as many of the first can fit as the budget has units of the least.
    least = candidates.agg(F.min("cost")).first()[0] or 1
    first = candidates.withColumn("turn", turn).orderBy("turn", "ord").limit(int(budget // least) + 1)
    return first.withColumn("total", total).filter(F.col("total") <= budget).drop("turn")

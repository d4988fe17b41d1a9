"""A function of blocks, run tile by tile over a volume with what surrounds each tile."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_AXES = "zyx"


def apply_tiled(voxels: DataFrame, shape: Sequence[int], tile: Sequence[int], halo: Sequence[int], function: Callable[[np.ndarray], np.ndarray], value: str = "value", sparse: bool = True) -> DataFrame:
    """(z, y, x, value) -> the same of ``function``, which takes a block of float64 and gives one of its shape.

    A voxel goes to every tile whose read box it lies in, that is the tile and ``halo`` voxels on each
    side; a task lays out one read box, zero where there is no voxel, and gives the tile's core back.
    Read boxes end where the volume ends, so the function sees its true edges.  A function that looks no
    further than the halo gives what it would give on the whole volume, whatever the tiles.  ``sparse``
    leaves zeros out.  Tiles without voxels are run too.  Voxels outside the shape are an error.
    """
    if any(t < 1 or h < 0 for t, h in zip(tile, halo, strict=True)):
        raise ValueError("tiles have at least one voxel on an axis, halos none or more")
    counts = [-(-n // t) for n, t in zip(shape, tile, strict=True)]
    sound = F.lit(True)
    for a, n in zip(_AXES, shape, strict=True):
        sound = sound & F.col(a).between(0, n - 1)
    read = voxels.select(*[F.col(a).cast("long").alias(a) for a in _AXES], F.when(sound, F.col(value).cast("double")).otherwise(F.raise_error(F.lit("a voxel is outside the shape")).cast("double")).alias("value"))
    for a, n, t, h in zip(_AXES, counts, tile, halo, strict=True):
        first, last = F.floor((F.col(a) - h) / t), F.floor((F.col(a) + h) / t)
        read = read.withColumn(f"t{a}", F.explode(F.sequence(F.greatest(first, F.lit(0)), F.least(last, F.lit(n - 1)))))
    i = F.col("id")
    none = [F.lit(None).cast(k).alias(c) for c, k in ((*[(a, "long") for a in _AXES], ("value", "double")))]
    every = voxels.sparkSession.range(int(np.prod(counts))).select(*none, F.floor(i / (counts[1] * counts[2])).alias("tz"), (F.floor(i / counts[2]) % counts[1]).alias("ty"), (i % counts[2]).alias("tx"))

    def run(keys, t):
        at = [k.as_py() for k in keys]
        low = [max(k * n - h, 0) for k, n, h in zip(at, tile, halo, strict=True)]
        high = [min((k + 1) * n + h, m) for k, n, h, m in zip(at, tile, halo, shape, strict=True)]
        block = np.zeros([b - a for a, b in zip(low, high, strict=True)])
        held = t.filter(pa.compute.is_valid(t.column("z")))
        block[tuple(held.column(a).to_numpy() - o for a, o in zip(_AXES, low, strict=True))] = held.column("value").to_numpy()
        made = np.asarray(function(block), dtype=np.float64)
        if made.shape != block.shape:
            raise ValueError(f"the function made {made.shape} of {block.shape}")
        core = made[tuple(slice(k * n - o, min((k + 1) * n, m) - o) for k, n, o, m in zip(at, tile, low, shape, strict=True))]
        found = np.nonzero(core) if sparse else np.unravel_index(np.arange(core.size), core.shape)
        return pa.table({**{a: pa.array((f + k * n).astype(np.int32)) for a, f, k, n in zip(_AXES, found, at, tile, strict=True)}, "value": pa.array(core[found])})

    return read.unionByName(every).groupBy("tz", "ty", "tx").applyInArrow(run, "z int, y int, x int, value double")


def neighbourhood(reduce: Callable[[list[np.ndarray]], np.ndarray], reach: Sequence[int], outside: float = 0.0) -> Callable[[np.ndarray], np.ndarray]:
    """A function of blocks for ``apply_tiled``: ``reduce`` of the values up to ``reach`` away on each axis."""

    def run(block: np.ndarray) -> np.ndarray:
        wide = np.pad(block, [(r, r) for r in reach], constant_values=outside)
        moved = [wide[tuple(slice(o, o + n) for o, n in zip(offset, block.shape, strict=True))] for offset in np.ndindex(*[2 * r + 1 for r in reach])]
        return reduce(moved)

    return run

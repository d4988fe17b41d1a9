"""The weighted neighbour graph that a projection of embeddings is laid out by."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps of the bisection, how near its sum must come, and the least bandwidth as a share of the mean distance.
STEPS, NEAR, LEAST = 64, 1e-5, 1e-3


def bandwidths(distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest, sigma) of rows of distances to the other neighbours, the point itself left out: the
    least distance that is not 0, and the width for which sum(exp(-max(d - nearest, 0) / sigma)) is the
    binary logarithm of the number of neighbours, the point itself counted.

    The bisection starts at 1 and doubles until it has passed the target."""
    n, k = distance.shape
    nearest = np.where(distance > 0, distance, np.inf).min(axis=1, initial=np.inf)
    nearest = np.where(np.isfinite(nearest), nearest, 0.0)
    target, beyond = np.log2(k + 1), np.maximum(distance - nearest[:, None], 0.0)
    low, high, sigma, found = np.zeros(n), np.full(n, np.inf), np.ones(n), np.zeros(n, bool)
    for _ in range(STEPS):
        total = np.exp(-beyond / sigma[:, None]).sum(axis=1)
        found |= np.abs(total - target) < NEAR
        above = total > target
        high, low = np.where(~found & above, sigma, high), np.where(~found & ~above, sigma, low)
        sigma = np.where(found, sigma, np.where(np.isinf(high), sigma * 2, (low + high) / 2))
    return nearest, np.maximum(sigma, LEAST * distance.sum(axis=1) / (k + 1))


def memberships(neighbours: DataFrame) -> DataFrame:
    """(id, place, neighbour, distance) of k nearest neighbours, the point itself among them ->
    (id, neighbour, weight) to the others.  A group is the k rows of a point."""
    lists = neighbours.filter(F.col("id") != F.col("neighbour")).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("distance", "neighbour"))).alias("near"))
    lists = lists.select("id", F.col("near.distance").alias("d"), F.col("near.neighbour").alias("to"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column("d").offsets))
            for size in np.unique(sizes):  # points with a copy beyond the k-th place keep k others
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                d = np.asarray(part.column("d").flatten()).reshape(part.num_rows, size)
                nearest, sigma = bandwidths(d)
                beyond = d - nearest[:, None]
                weight = np.where((beyond <= 0) | (sigma[:, None] == 0), 1.0, np.exp(-np.maximum(beyond, 0) / np.where(sigma == 0, 1, sigma)[:, None]))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(part.column("id")), size)), part.column("to").flatten(), pa.array(weight.ravel())], ["id", "neighbour", "weight"])

    return lists.mapInArrow(weigh, "id long, neighbour long, weight double")


def fuzzy_union(directed: DataFrame) -> DataFrame:
    """(id, neighbour, weight) -> (a, b, weight), a < b: p + q - p * q of both directions, 0 for a missing one."""
    a, b = F.least("id", "neighbour").alias("a"), F.greatest("id", "neighbour").alias("b")
    # The two directions are told apart, so that their sum is taken in one order.
    ways = directed.groupBy(a, b).agg(*[F.coalesce(F.max(F.when(side, F.col("weight"))), F.lit(0.0)).alias(n) for n, side in (("p", F.col("id") < F.col("neighbour")), ("q", F.col("id") > F.col("neighbour")))])
    return ways.select("a", "b", (F.col("p") + F.col("q") - F.col("p") * F.col("q")).alias("weight"))

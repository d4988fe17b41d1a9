"""Exact nearest neighbours of embeddings, block against block."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.operators.components import checkpointed

BLOCK = 65536  # candidates in a block at most
LEAST = 256  # and at least, where the table has as many
QUERIES = 256  # compared at once
GROUPS = 64  # candidates of which the nearest is looked at first
MOST = 1 << 16  # candidates measured at once
PIVOTS, PIVOT_BYTES = 1024, 16 << 20


def _prepared(cand: np.ndarray, metric: str) -> dict:
    """A block's candidates as the searches use them: in columns, with one row more, so that one product gives
    the squared distances but for the query's own part, and filled up to whole groups; in single precision
    where the values allow it."""
    zero = metric == "cosine" and bool((~cand.any(axis=1)).any())
    cand = cand.astype(np.float64)
    if metric == "cosine" and not zero:
        cand = cand / np.linalg.norm(cand, axis=1)[:, None]
    squares = np.square(cand).sum(1)
    longest = math.sqrt(squares.max())
    kind = np.float32 if 1e-12 < longest < 1e15 else np.float64
    columns = np.zeros((cand.shape[1] + 1, -(-len(cand) // GROUPS) * GROUPS), kind)
    columns[:-1, : len(cand)], columns[-1, : len(cand)], columns[-1, len(cand) :] = cand.T, squares, np.inf
    return {"cand": cand, "columns": columns, "longest": longest, "zero": zero, "sound": longest < 1e150}


def _nearest(asks: np.ndarray, block: dict, ids: np.ndarray, k: int, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, distance) of the k nearest of a block, by (query, distance, id).

    The least of each group of candidates bounds the k-th distance.  Groups below the bound are looked
    through, and every candidate that rounding could bring among the k nearest is measured directly."""
    asks, cand, columns = asks.astype(np.float64), block["cand"], block["columns"]
    if metric == "cosine":
        norms = np.linalg.norm(asks, axis=1)
        if block["zero"] or (norms == 0).any():
            raise ValueError("a vector of norm 0 has no cosine distance")
        asks = asks / norms[:, None]
    sizes = np.sqrt(np.square(asks).sum(1))
    if columns.dtype == np.float32 and sizes.max() > 1e15:
        columns = columns.astype(np.float64)
    left = np.concatenate([-2 * asks, np.ones((len(asks), 1))], axis=1).astype(columns.dtype)
    fast = (left @ columns).reshape(len(asks), GROUPS, -1)
    # A place is a row of groups' members and a group: members of a group are far apart, rows are whole.
    least, m = fast.min(axis=1), min(k, len(ids))
    flat = least if least.shape[1] >= m else fast.reshape(len(asks), -1)
    off = (asks.shape[1] + 8) * float(np.finfo(columns.dtype).eps) * (2 * sizes * block["longest"] + block["longest"] ** 2)
    bound = np.partition(flat, m - 1, axis=1)[:, m - 1].astype(np.float64) + 2 * off
    # Values that are not finite, or too large to square, leave no bound: all are measured.
    loose = ~((sizes < 1e150) & block["sound"])
    query, group = np.nonzero((least <= bound[:, None]) | loose[:, None])
    out = []
    # Copies may bring in whole blocks: so many places at once, and whole queries.
    ends = np.searchsorted(query, np.arange(1, len(asks) + 1))
    low = 0
    while low < len(asks):
        start = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, start + MOST // GROUPS, "right")))
        q, g = query[start : ends[high - 1]], group[start : ends[high - 1]]
        pair, member = np.nonzero((fast[q, :, g] <= bound[q][:, None]) | loose[q][:, None])
        q, at = q[pair], member * least.shape[1] + g[pair]
        q, at = q[at < len(ids)], at[at < len(ids)]
        exact = np.square(cand[at] - asks[q]).sum(1) if metric == "euclidean" else 1 - (cand[at] * asks[q]).sum(1)
        order = np.lexsort((ids[at], exact, q))
        q, at, exact = q[order], at[order], exact[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        out.append((q[place < k], ids[at[place < k]], exact[place < k]))
        low = high
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _searcher(k: int, metric: str):
    """Rows (block, kind, id, v) in order, a block's candidates (0) before its queries (1) -> the k nearest
    candidates of each query."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, cand, ids = None, [], None, None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)) for c in ("block", "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                grid = np.asarray(part.column("v").flatten()).reshape(part.num_rows, -1)
                asked = np.asarray(part.column("id"))
                if now != keys[low][0]:
                    now, held, cand = keys[low][0], [], None
                if not keys[low][1]:
                    held.append((grid, asked))
                elif held:
                    if cand is None:
                        grids, ids = (np.concatenate(c) for c in zip(*held, strict=True))
                        held, cand = held[:1], _prepared(grids, metric)
                    for at in range(0, len(grid), QUERIES):
                        q, near, far = _nearest(grid[at : at + QUERIES], cand, ids, k, metric)
                        yield pa.RecordBatch.from_arrays([pa.array(asked[at + q], pa.int64()), pa.array(near, pa.int64()), pa.array(far, pa.float64())], ["id", "neighbour", "distance"])

    return search


def _plain(vectors: DataFrame) -> Column:
    """The vectors as they are, if of floats, else as doubles."""
    kind = vectors.schema["embedding"].dataType.elementType.typeName()
    return F.col("embedding") if kind == "float" else F.transform("embedding", lambda x: x.cast("double"))


def _parts(vectors: DataFrame, n: int, block: int) -> int:
    """Blocks for n rows: a whole multiple of the tasks that run at once, but for small tables."""
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(n / block)) if n < LEAST * cores else cores * math.ceil(n / (block * cores))


def neighbours(vectors: DataFrame, k: int, metric: str = "euclidean", block: int = BLOCK) -> DataFrame:
    """(id, embedding) -> (id, place, neighbour, distance): the k nearest rows of each, itself
    included, in order of (distance, id); the distance is squared for ``euclidean``.

    Every row is a candidate in one block, dealt by its id, and a query in all of them.  A task reads
    the candidates of a block first and then meets the queries batch by batch, so it holds one block
    and one batch; each query gets k rows from each block.  Blocks are as many as the cores, or a whole
    multiple, as every row is sent to all of them.  ``k`` beyond the number of rows is an error.
    """
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"unknown metric {metric}")
    n = vectors.count()
    if k > n:
        raise ValueError("k is larger than the number of rows")
    parts = _parts(vectors, n, block)
    own = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    places = F.array(F.struct(own.alias("block"), F.lit(0).alias("kind")))
    every = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda b: F.struct(b.alias("block"), F.lit(1).alias("kind")))
    dealt = vectors.select(F.explode(F.concat(places, every)).alias("at"), F.col("id").cast("long"), _plain(vectors).alias("v"))
    dealt = dealt.select("at.block", "at.kind", "id", "v").repartitionById(parts, "block").sortWithinPartitions("block", "kind")

    near = dealt.mapInArrow(_searcher(k, metric), "id long, neighbour long, distance double")
    place = F.row_number().over(W.partitionBy("id").orderBy("distance", "neighbour"))
    return near.withColumn("place", place).filter(F.col("place") <= k)


def _unit(x: np.ndarray, metric: str) -> np.ndarray:
    """Vectors among which plain distances order as the metric does."""
    return x / np.linalg.norm(x, axis=1)[:, None] if metric == "cosine" else x


def _apart(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = np.square(x).sum(1)[:, None] + np.square(centres).sum(1)[None] - 2 * (x @ centres.T)
    return np.sqrt(np.maximum(squares, 0))


def pruned(vectors: DataFrame, k: int, metric: str = "euclidean", pivots: int | None = None, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """What ``neighbours`` gives, and (id, visited, blocks): how many of the blocks each query went to.

    Some rows, by hash, are pivots, at most ``PIVOTS`` of them and ``PIVOT_BYTES``; each row belongs to
    the nearest one, and the rows of a pivot lie in a ball.  A ball of more than ``block`` rows is cut into
    blocks.  A query first meets its own block, which bounds its k-th distance; then, by the triangle
    inequality, only the blocks of balls that reach as near.  Distances to pivots are rounded, so a margin
    beyond their error is left.  Where vectors don't cluster, most balls reach everywhere and all blocks
    are visited: the answer is the same."""
    if metric not in ("euclidean", "cosine"):
        raise ValueError(f"unknown metric {metric}")
    n, dims = vectors.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if k > n:
        raise ValueError("k is larger than the number of rows")
    rows = vectors.select(F.col("id").cast("long"), _plain(vectors).alias("v"))
    vector = rows.schema["v"].dataType.simpleString()
    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    many = pivots or max(1, min(PIVOTS, PIVOT_BYTES // (8 * dims), max(math.ceil(n / block), min(2 * tasks, n // LEAST))))
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(many).select("v").collect()
    centres = _unit(np.array([r.v for r in picked], dtype=np.float64), metric)
    grid = lambda batch: np.asarray(batch.column("v").flatten(), dtype=np.float64).reshape(batch.num_rows, -1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(grid(batch), metric)
            far = _apart(x, centres)
            near = far.argmin(axis=1)
            columns = [batch.column("id"), batch.column("v"), pa.array(near.astype(np.int32)), pa.array(far[np.arange(len(x)), near]), pa.array(np.linalg.norm(x, axis=1))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "pivot", "far", "norm"])

    placed = checkpointed(rows.mapInArrow(place, f"id long, v {vector}, pivot int, far double, norm double"))
    balls = {r.pivot: (r["count"], r.radius) for r in placed.groupBy("pivot").agg(F.count("*").alias("count"), F.max("far").alias("radius")).collect()}
    margin = 4e-6 * (1 + (placed.agg(F.max("norm")).first()[0] or 0))
    subs = [math.ceil(balls.get(i, (0,))[0] / block) for i in range(many)]
    first, radius = np.cumsum([0, *subs]).tolist(), np.array([balls.get(i, (0, -np.inf))[1] for i in range(many)])
    at = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("pivot") + 1)
    own = (at(first) + F.pmod(F.xxhash64("id"), F.greatest(at(subs), F.lit(1)))).cast("int")
    placed = placed.withColumn("block", own)
    found = "id long, neighbour long, distance double"

    def met(asked: DataFrame) -> DataFrame:
        dealt = placed.select("block", F.lit(0).alias("kind"), "id", "v").union(asked.select("block", F.lit(1), "id", "v"))
        return dealt.repartitionById(first[-1], "block").sortWithinPartitions("block", "kind").mapInArrow(_searcher(k, metric), found)

    near = checkpointed(met(placed))
    # Squared distances, or cosine distances, as plain ones of the vectors above.
    reach = F.when(F.count("*") < k, F.lit(float("inf"))).otherwise(F.sqrt(F.max("distance") * (2 if metric == "cosine" else 1)))
    asked = placed.join(near.groupBy("id").agg(reach.alias("reach")), "id").select("id", "v", "block", "reach")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = _apart(_unit(grid(batch), metric), centres) - radius[None] <= np.asarray(batch.column("reach"))[:, None] + margin
            home = np.asarray(batch.column("block"))
            blocks = [[b for i in np.flatnonzero(row) for b in range(first[i], first[i + 1]) if b != h] for row, h in zip(hit, home, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(blocks, pa.list_(pa.int32()))], ["id", "v", "blocks"])

    asked = checkpointed(asked.mapInArrow(choose, f"id long, v {vector}, blocks array<int>"))
    more = met(asked.select("id", "v", F.explode("blocks").alias("block")))
    order = W.partitionBy("id").orderBy("distance", "neighbour")
    out = near.union(more).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return out, asked.select("id", (F.size("blocks") + 1).alias("visited"), F.lit(first[-1]).alias("blocks"))


def sound(vectors: DataFrame, dims: int) -> DataFrame:
    """One row: rows, rows of another length, rows with values that are not finite."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.agg(F.count("*").alias("rows"), F.count_if(F.size("embedding") != dims).alias("odd_length"), F.count_if(bad).alias("not_finite"))

"""Exact top-k by inner product with Fagin's threshold algorithm, in blocks.

Each vector becomes integers floor(scale * x).  Every row is a candidate in one block, dealt by a
hash of the row; only the queries are copied, once to each block.  A task reads a block's candidates
first, sorts their lists once, and then meets the queries batch by batch, so it holds one block
and one batch.  In a block every dimension has its list of candidates sorted by value.  For a query
the lists are read from the end that its sign prefers, deeper each round; newly seen candidates are
scored by random access; the bound is the sum of what the lists' next entries would give.  A query
stops once the bound is below its k-th score (a tie could still have a smaller id, so equality goes
on).  The k best of each block meet in one ranking per query, which gets k rows from each block.

Defined cases: vectors that are null or hold a null, NaN or infinity take no part, nor do those
with a null id; only vectors of equal length are compared, so an empty vector scores 0 against
empty ones; equal scores go to the smaller id; a query leaves out its own row and no other, so rows
that share an id (or repeat) are queries and candidates each for itself; a query with fewer than k
candidates returns all; an empty table gives an empty result.  Scores are exact at any size of the
components: a block whose products may leave 64 bits is searched with Python's integers.  A scaled
component or a resulting score that itself leaves 64 bits raises an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.llm.common import partitions, table

K = 10
SCALE = 1024
BLOCK_BYTES = 32 << 20  # of candidates in a block
LEAST = 1024  # candidates in a block, where the table has as many
STEP = 16  # entries of each list read in the first round; each later round reads four times as many


def _best(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places by falling score, then by id."""
    by_id = np.argsort(ids, kind="stable")
    return by_id[np.argsort(-scores[by_id], kind="stable")]


class Lists:
    """A block of candidates with a list for each dimension, ascending."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        self.vectors, self.ids, self.rows = vectors, ids, rows
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)
        self.ranked = np.take_along_axis(vectors, self.order, axis=0)
        self.most = float(np.abs(vectors).max(initial=0)) * max(vectors.shape[1], 1)
        self._as: dict[type, tuple[np.ndarray, np.ndarray]] = {np.int64: (vectors, self.ranked)}

    def read_as(self, kind: type) -> tuple[np.ndarray, np.ndarray]:
        if kind not in self._as:
            self._as[kind] = (self.vectors.astype(kind), self.ranked.astype(kind))
        return self._as[kind]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The k best (scores, ids) for each query; the candidate whose row is in ``own`` is left out."""
        n, dims = self.vectors.shape
        largest = self.most * float(np.abs(queries).max(initial=0))
        # Floats add such integers exactly, and faster; Python's integers have no bound.
        exact = np.float64 if largest < 1 << 53 else np.int64 if largest < 1 << 62 else object
        held, ranked = self.read_as(exact)
        for q, mine in zip(queries.astype(exact), own, strict=True):
            up, down = np.flatnonzero(q >= 0), np.flatnonzero(q < 0)
            left = self.rows != mine  # candidates not yet seen
            scores, best = np.zeros(0, exact), np.zeros(0, np.int64)
            depth, more = 0, step
            while depth < n:
                stop = min(n, depth + more) if dims else n
                fresh = np.zeros(n, dtype=bool)
                if dims:
                    fresh[self.order[n - stop : n - depth][:, up]] = True
                    fresh[self.order[depth:stop][:, down]] = True
                else:
                    fresh[:] = True
                fresh &= left
                left &= ~fresh
                at = np.flatnonzero(fresh)
                if len(at):
                    scores, best = np.concatenate([scores, held[at] @ q]), np.concatenate([best, self.ids[at]])
                    if len(best) > k:
                        high = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        scores, best = scores[high], best[high]
                        keep = _best(scores, best)[:k]
                        scores, best = scores[keep], best[keep]
                depth, more = stop, more * 4
                if depth < n and len(best) >= k:
                    bound = np.where(q >= 0, ranked[n - depth - 1], ranked[depth]) @ q
                    if bound < scores.min() or not left.any():
                        break
            keep = _best(scores, best)[:k]
            yield scores[keep].astype(np.int64), best[keep]


def threshold_search(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, step: int = STEP):
    """The k best (scores, ids) of ``vectors`` for each query; ids in ``own`` are left out."""
    return list(Lists(vectors, ids, ids).search(queries, own, k, step))


def _grid(batch: pa.RecordBatch) -> np.ndarray:
    out = np.asarray(batch.column("v").flatten(), dtype=np.int64).reshape(batch.num_rows, -1)
    ends = np.iinfo(np.int64)
    if ((out == ends.min) | (out == ends.max)).any():  # where floor() ends
        raise ValueError("a scaled component leaves 64 bits")
    return out


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, blocks: int | None = None) -> DataFrame:
    """(vec_id, embedding) -> (query_id, rank, vec_id, score); ``is_query`` is a Column."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    whole = vectors.filter(F.coalesce(sound, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.size("embedding").alias("dims"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.transform(x, lambda v: F.floor(v * scale)).alias("v")
    )
    if blocks is None:
        n, size = whole.agg(F.count("*"), F.coalesce(F.sum(F.col("dims").cast("long") * 8), F.lit(0))).first()
        blocks = max(1, math.ceil(size / BLOCK_BYTES), min(partitions(vectors.sparkSession), n // LEAST))
    # A row goes to its own block as a candidate (0), and a query to all of them (1).
    own = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    places = F.array(F.struct(own.alias("block"), F.lit(0).alias("kind")))
    every = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.struct(b.alias("block"), F.lit(1).alias("kind")))
    dealt = whole.withColumn("at", F.explode(F.when(F.col("asks"), F.concat(places, every)).otherwise(places))).select("at.block", "dims", "at.kind", "row", "vec_id", "v")
    dealt = dealt.repartition(blocks, "block").sortWithinPartitions("block", "dims", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, lists = None, [], None
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)) for c in ("block", "dims", "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if low == high:
                    continue
                part, (block, dims, kind) = batch.slice(low, high - low), keys[low].tolist()
                if now != (block, dims):
                    now, held, lists = (block, dims), [], None
                if not kind:
                    held.append((_grid(part), np.asarray(part.column("vec_id")), np.asarray(part.column("row"))))
                elif held:
                    if lists is None:
                        lists = Lists(*(np.concatenate(c) for c in zip(*held, strict=True)))
                        held = [()]
                    asked, row, out = np.asarray(part.column("vec_id")), np.asarray(part.column("row")), []
                    for i, (scores, best) in enumerate(lists.search(_grid(part), row, k)):
                        out.append((np.full(len(best), row[i]), np.full(len(best), asked[i]), best, scores))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], ["row", "query_id", "vec_id", "score"])

    near = dealt.mapInArrow(run, "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")).cast("int")
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""

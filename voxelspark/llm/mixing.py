"""Mixing sources to target weights by systematic sampling.

Targets: sources in code-point order (null last) weigh ``weights`` in turn and share ``share``
times all sizes.  No target exceeds ``cap`` times its source's size; the excess is shared among
the others by weight until none is above.  With sources ordered by size / weight the capped ones
come first, so that fixed point is one running sum over the sources and not a loop.

Copies: every document of a source expects e = target / source size copies.  Documents stand so
that sizes rise and then fall: ranked by (size, id), even ranks come first and odd ones follow in
reverse; the prefix sum of the expected copies is e times the place.  One offset in [0, 1) for each
source, drawn by hash from the seed, is added, and a document is emitted once for each integer that
its interval crosses.  Where sizes rise an offset takes too few words, and where they fall by as much
too many, so the words taken stay close to the target.

Defined cases: a null source is a source of its own; a null or empty text has size 0 and takes
part like others; equal ids and sizes are told apart by a hash of the text; rows equal in all of
these are interchangeable; an empty table gives an empty result; a source of size 0 has target 0
and gives no copies.  Columns of the input other than doc_id, text and source are ignored by
``copies`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.llm.common import SPACE_WORD, cut, numbered, ranked, small, space_words, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = "mix-1"


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, rows) -> with target.  One row a source."""
    turn = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    t = sizes.withColumn("turn", turn).withColumn("w", weight)
    t = t.withColumn("most", F.col("source_size").cast("double") * cap).withColumn("fill", F.col("most") / F.col("w"))
    every, order = W.partitionBy(), W.orderBy("fill", "turn")
    goal = F.sum("source_size").over(every).cast("double") * share
    before = F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    onward = F.sum("w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    t = t.withColumn("level", (goal - before) / onward)
    # The first source in this order that its share doesn't overfill sets the level for the rest.
    first = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "turn", "level"))).over(every)
    t = t.withColumn("level", first["level"])
    return t.select("source", "source_size", "rows", F.least("most", F.col("level") * F.col("w")).alias("target"))


def offset(source, seed: str = SEED):
    """The random offset of a source, in [0, 1)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED, size=None, keep=()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each document.

    ``size`` is a Column, words of ``text`` if not given; ``keep`` are Columns to carry along.  Texts
    are read once and not shuffled.
    """
    size = space_words(F.col("text")) if size is None else size
    rows = cut(docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("tie"), *keep))
    place = ranked(rows, ["size", "doc_id", "tie"], "rank", ["source"])
    goal = place.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    goal = small(targets(goal, weights, share, cap))
    both = place.alias("l").join(goal.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    both = both.select("l.*", "r.source_size", "r.rows", "r.target")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = offset(F.col("source"), seed)
    half = F.floor(F.col("rank") / 2)
    at = F.when(F.col("rank") % 2 == 0, half).otherwise(F.col("rows") - 1 - half)
    crossed = F.floor(each * (at + 1) + u) - F.floor(each * at + u)
    return both.withColumn("copies", F.least(crossed, F.ceil(F.lit(cap))).cast("long")).drop("rank", "rows", "tie")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs``, with its columns, as often as it was drawn.

    The draw knows rows by their numbers and not by their texts, which are read again; it is broadcast
    if it is small and else joined.
    """
    rows = numbered(docs)
    drawn = copies(rows.select("row.doc_id", "row.source", "row.text", "at"), keep=[F.col("at")], **options)
    drawn = small(drawn.filter(F.col("copies") > 0).select("at", "copies"))
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return rows.join(drawn, "at").select("row", each).select("row.*")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = copies(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{SPACE_WORD}')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS rows FROM d GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn FROM s),
f AS (
  SELECT source, source_size, rows, turn, CASE turn % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
    source_size::DOUBLE * 2.0::DOUBLE AS most FROM w),
g AS (
  SELECT *, most / w AS fill,
    ((SELECT sum(source_size)::DOUBLE FROM s) * 1.5::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY most / w, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (ORDER BY most / w, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM f),
t AS (
  SELECT source, source_size, rows,
    least(most, w * (SELECT lev FROM g WHERE lev <= fill ORDER BY fill, turn LIMIT 1)) AS target FROM g),
k AS (
  SELECT d.doc_id, d.size, d.source, t.source_size, t.target,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST) - 1 AS k, t.rows,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS e,
    CAST('0x' || substr(md5('{SEED}:' || coalesce('s' || d.source, 'n')), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, CASE WHEN k % 2 = 0 THEN k // 2 ELSE rows - 1 - k // 2 END AS rank FROM k)
SELECT doc_id, size, source_size, target,
  CAST(least(floor(e * (rank + 1) + u) - floor(e * rank + u), 2) AS BIGINT) * size AS taken, source,
  CAST(least(floor(e * (rank + 1) + u) - floor(e * rank + u), 2) AS BIGINT) AS copies
FROM r
"""

"""The driver's tables as imaging relations: voxels, patches, points, decisions, meshes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NZ, NY, NX = 7, 64, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse voxels (z, y, x, pred, truth, poor, raw) on a 7 x 64 x 64 grid; one row a cell."""
    t = table(spark, sf_dir, "lineitem")
    cell = [(F.col("l_linenumber") - 1).cast("int").alias("z"), (F.col("l_orderkey") % NY).cast("int").alias("y"), (F.col("l_partkey") % NX).cast("int").alias("x")]
    v = t.groupBy(*cell).agg(F.min(F.col("l_suppkey") % 6).cast("long").alias("pred"), F.max("l_quantity").cast("double").alias("raw"))
    truth = F.when((F.col("y") + F.col("x")) % 7 == 0, F.lit(0)).otherwise(F.col("pred") * 5 % 6).cast("long")
    poor = F.when(F.col("pred").isin(1, 2), F.lit(1)).otherwise(F.col("pred")).cast("long")
    return v.select("z", "y", "x", "pred", truth.alias("truth"), poor.alias("poor"), "raw")


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the grid, absent voxels as label and intensity 0."""
    i = F.col("id")
    grid = spark.range(NZ * NY * NX).select(F.floor(i / (NY * NX)).cast("int").alias("z"), (F.floor(i / NX) % NY).cast("int").alias("y"), (i % NX).cast("int").alias("x"))
    full = grid.join(vox(spark, sf_dir), ["z", "y", "x"], "left")
    return full.fillna(0, ["pred", "truth", "poor"]).fillna(0.0, ["raw"])


def patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        v.cast("int").alias("patch_id"), F.floor(v / 100).cast("int").alias("gz"), (F.floor(v / 10).cast("int") % 10).alias("gy"), (v % 10).cast("int").alias("gx"), "embedding", "label"
    )


def pts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.floor(F.col("value") / 10).cast("int").alias("by_"), F.floor(F.col("user_id") / 10).cast("int").alias("bx"), (F.col("event_type") != "error").alias("valid"), (F.col("event_type") == "purchase").alias("positive"), "ts"
    )


def decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("candidate_id"), F.when(F.col("quality") == 1, "accept").otherwise("reject").alias("decision"))


def vertex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("vid"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"), (F.col("p_partkey") % 13).cast("double").alias("z"))


def face(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    last = p.agg(F.max("p_partkey").alias("last"))
    return p.join(F.broadcast(last)).filter((k % 3 == 0) & (k + 2 <= F.col("last"))).select(k.alias("fid"), k.alias("a"), (k + 1).alias("b"), (k + 2).alias("c"))


#: The same relations for the SQL counterparts.
VOX = """(SELECT z, y, x, pred, CASE WHEN (y + x) % 7 = 0 THEN 0 ELSE (pred * 5) % 6 END AS truth, CASE WHEN pred IN (1, 2) THEN 1 ELSE pred END AS poor, raw
  FROM (SELECT CAST(l_linenumber - 1 AS INT) AS z, CAST(l_orderkey % 64 AS INT) AS y, CAST(l_partkey % 64 AS INT) AS x,
      CAST(min(l_suppkey % 6) AS BIGINT) AS pred, CAST(max(l_quantity) AS DOUBLE) AS raw FROM lineitem GROUP BY 1, 2, 3) t)"""
DENSE = f"""(SELECT g.z, g.y, g.x, coalesce(v.pred, 0) AS pred, coalesce(v.truth, 0) AS truth, coalesce(v.poor, 0) AS poor, coalesce(v.raw, 0) AS raw
  FROM (SELECT CAST(i // 4096 AS INT) AS z, CAST(i // 64 % 64 AS INT) AS y, CAST(i % 64 AS INT) AS x FROM range(28672) r(i)) g LEFT JOIN {VOX} v USING (z, y, x))"""
PATCH = "(SELECT CAST(vec_id AS INT) AS patch_id, CAST(vec_id // 100 AS INT) AS gz, CAST(vec_id // 10 % 10 AS INT) AS gy, CAST(vec_id % 10 AS INT) AS gx, embedding, label FROM embeddings)"
PTS = "(SELECT event_id, CAST(floor(value / 10) AS INT) AS by_, CAST(floor(user_id / 10.0) AS INT) AS bx, event_type <> 'error' AS valid, event_type = 'purchase' AS positive, ts FROM events)"
DECISION = "(SELECT doc_id AS candidate_id, CASE WHEN quality = 1 THEN 'accept' ELSE 'reject' END AS decision FROM labels)"
VERTEX = "(SELECT p_partkey AS vid, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, CAST(p_partkey % 13 AS DOUBLE) AS z FROM part)"
FACE = "(SELECT p_partkey AS fid, p_partkey AS a, p_partkey + 1 AS b, p_partkey + 2 AS c FROM part WHERE p_partkey % 3 = 0 AND p_partkey + 2 <= (SELECT max(p_partkey) FROM part))"


def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Voxels (z, y, x, label, raw) of planes of 32 x 32, one for each order, so that planes grow with
    the table: blocks of labels 1 .. 3 and background with holes; missing orders are missing voxels."""
    k = F.col("l_orderkey")
    at = [F.floor(k / 1024).cast("int").alias("z"), (F.floor(k / 32) % 32).cast("int").alias("y"), (k % 32).cast("int").alias("x")]
    v = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.min("l_suppkey") % 5 == 0).alias("hole"), F.max("l_quantity").alias("raw"))
    v = v.select(*at, "hole", "raw")
    block = (F.floor(F.col("z") / 3) + F.floor(F.col("y") / 6) + F.floor(F.col("x") / 7)) % 4
    return v.select("z", "y", "x", F.when(F.col("hole"), F.lit(0)).otherwise(block).cast("long").alias("label"), "raw")


VOLUME = """(SELECT z, y, x, CASE WHEN hole THEN 0 ELSE (z // 3 + y // 6 + x // 7) % 4 END::BIGINT AS label, raw
  FROM (SELECT CAST(l_orderkey // 1024 AS INT) AS z, CAST(l_orderkey // 32 % 32 AS INT) AS y, CAST(l_orderkey % 32 AS INT) AS x, min(l_suppkey) % 5 = 0 AS hole, max(l_quantity) AS raw
    FROM lineitem GROUP BY l_orderkey) t)"""


def planes(spark: SparkSession, sf_dir: str) -> int:
    """Planes of a stack that grows with the orders."""
    return 7 + table(spark, sf_dir, "lineitem").agg(F.max("l_orderkey")).first()[0] // 1024


PLANES = "(SELECT 7 + max(l_orderkey) // 1024 FROM lineitem)"


def patch_planes(spark: SparkSession, sf_dir: str) -> int:
    """Planes of the grid of 10 x 10 patches that the embeddings fill."""
    return table(spark, sf_dir, "embeddings").count() // 100


PATCH_PLANES = "(SELECT count(*) // 100 FROM embeddings)"

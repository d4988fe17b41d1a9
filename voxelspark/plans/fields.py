"""Registered queries over grids, volumes, densities, selections and meshes, with SQL counterparts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark import views
from voxelspark.operators import boxes, camera, components, density, display, labels, mesh, numbering, overlap, resample, select, tiling, verify
from voxelspark.plans.registry import query
from voxelspark.sources import volumes
from voxelspark.views import DENSE, FACE, NX, NY, NZ, PLANES, PTS, VERTEX, VOX

SHAPE = (NZ, NY, NX)
WINDOWS = ((1, 1, 1), (1, 2, 2), (2, 2, 2))
PATCH, STRIDE = (2, 16, 16), (1, 8, 12)


def _manifest(ends: dict[str, int | str], clipped: str = "") -> str:
    """Candidates over starts, those of y and x given by hand; ``ends`` are the axis lengths."""
    starts = ", ".join(f"('{a}', {i}, {v})" for a in "yx" for i, v in enumerate(_STARTS[clipped or "align_end"][a]))
    sizes = ", ".join(f"({i}, {', '.join(map(str, w))})" for i, w in enumerate(WINDOWS))
    lo = ", ".join(f"{a}.v AS {a}0" for a in "zyx")
    hi = ", ".join(f"least({a}l.v + {p}, {ends[a]}) AS {a}1" for a, p in zip("zyx", PATCH, strict=True))
    joins = " ".join(f"JOIN s {a} ON {a}.ax = '{a}' JOIN s {a}l ON {a}l.ax = '{a}' AND {a}l.i = {a}.i + w.w{a} - 1" for a in "zyx")
    return f"""(WITH s(ax, i, v) AS (VALUES {starts} UNION ALL SELECT 'z', i, i FROM range({PLANES} - 1) r(i)), w(size_id, wz, wy, wx) AS (VALUES {sizes})
SELECT printf('sv-s%02d-%dx%dx%d-%04d-%04d-%04d', w.size_id, wz, wy, wx, z.i, y.i, x.i) AS candidate_id, w.size_id, {lo}, {hi} FROM w {joins})"""


#: First coordinates of the patches, written out (planes of 2 by 1 are every one but the last): 67 rows of 16 by 8, 60 columns of 16 by 12.
_STARTS = {
    "align_end": {"y": [0, 8, 16, 24, 32, 40, 48, 51], "x": [0, 12, 24, 36, 44]},
    "reflect": {"y": [0, 8, 16, 24, 32, 40, 48, 56], "x": [0, 12, 24, 36, 48]},
}
_ENDS = {"z": PLANES, "y": 67, "x": 60}
_NM = {"z": 30.0, "y": 6.5, "x": 6.5}
_COST = "CAST((z1 - z0) * (y1 - y0) * (x1 - x0) AS BIGINT) AS cost"


def _candidates(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return tiling.candidate_manifest(spark, (views.planes(spark, sf_dir), _ENDS["y"], _ENDS["x"]), PATCH, STRIDE, WINDOWS, mode, tuple(_NM.values()))


@query(f"""SELECT candidate_id, size_id, z0, z1, y0, y1, x0, x1, {_COST}, {', '.join(f'round({a}{e} * {_NM[a]}::DOUBLE, 6) AS nm_{a}{e}' for a in 'zyx' for e in '01')} FROM {_manifest(_ENDS)}""")
def candidate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [f"{n}{a}{e}" for n in ("", "nm_") for a in "zyx" for e in "01"]
    return _candidates(spark, sf_dir, "align_end").select("candidate_id", "size_id", "cost", *sides)


@query(f"SELECT candidate_id, size_id, z0, z1, y0, y1, x0, x1, {_COST} FROM {_manifest(_ENDS, 'reflect')}")
def candidate_manifest_reflect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir, "reflect").select("candidate_id", "size_id", "cost", *[f"{a}{e}" for a in "zyx" for e in "01"])


@query(f"""WITH c AS {_manifest(_ENDS)}, g AS (SELECT n_nationkey % 7 AS z0, n_nationkey % 7 + 1 AS z1, n_nationkey * 11 % 60 AS y0, n_nationkey * 11 % 60 + 5 AS y1, n_nationkey * 7 % 55 AS x0, n_nationkey * 7 % 55 + 4 AS x1 FROM nation)
SELECT size_id, count(*) FILTER (WHERE NOT hit) AS kept, count(*) FILTER (WHERE hit) AS rejected FROM (SELECT size_id,
  EXISTS (SELECT 1 FROM g WHERE c.z0 < g.z1 AND g.z0 < c.z1 AND c.y0 < g.y1 AND g.y0 < c.y1 AND c.x0 < g.x1 AND g.x0 < c.x1) AS hit FROM c) t GROUP BY 1""")
def guard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    z, y, x = k % 7, k * 11 % 60, k * 7 % 55
    guards = views.table(spark, sf_dir, "nation").select(z.alias("z0"), (z + 1).alias("z1"), y.alias("y0"), (y + 5).alias("y1"), x.alias("x0"), (x + 4).alias("x1"))
    return boxes.guarded(_candidates(spark, sf_dir, "align_end"), guards)


@query("""WITH m AS (SELECT i AS patch_id, i // 100 AS gz, i // 10 % 10 AS gy, i % 10 AS gx FROM range((SELECT count(*) FROM embeddings) + 5) r(i)),
p AS (SELECT vec_id AS patch_id, vec_id // 100 AS gz, vec_id // 10 % 10 AS gy, CASE WHEN vec_id % 97 = 5 THEN 0 ELSE vec_id % 10 END AS gx FROM embeddings)
SELECT patch_id, CASE WHEN p.gz IS NULL THEN 'missing' ELSE 'moved' END AS state FROM m LEFT JOIN p USING (patch_id) WHERE p.gz IS NULL OR m.gx <> p.gx""")
def positions_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.patch(spark, sf_dir).select(F.col("patch_id").cast("long"), "gz", "gy", F.when(F.col("patch_id") % 97 == 5, 0).otherwise(F.col("gx")).alias("gx"))
    i = F.col("id")
    m = spark.range(p.count() + 5).select(i.alias("patch_id"), F.floor(i / 100).cast("int").alias("gz"), (F.floor(i / 10) % 10).cast("int").alias("gy"), (i % 10).cast("int").alias("gx"))
    return tiling.positions_differ(m, p)


_SHAPES = [("zyx", ["n", 64, 60], 8), ("yx", ["n", 60], 2), ("czyx", [1, 3, 4, "n"], 4), ("czyx", [2, 3, 4, "n"], 4), ("zyx", [3, "n"], 1), ("xyz", ["n", 4, 3], 1)]


@query("""WITH p AS (SELECT p_partkey AS id, p_partkey % 6 AS k, p_size AS n FROM part)
SELECT id, CASE k WHEN 0 THEN 60 WHEN 1 THEN 60 WHEN 4 THEN NULL ELSE n END AS x, CASE k WHEN 0 THEN 64 WHEN 1 THEN n WHEN 4 THEN n ELSE 4 END AS y, CASE k WHEN 0 THEN n WHEN 1 THEN 1 ELSE 3 END AS z,
  k NOT IN (3, 4) AS ok, n * CASE k WHEN 0 THEN 3840 WHEN 1 THEN 60 WHEN 3 THEN 24 WHEN 4 THEN 3 ELSE 12 END AS voxels,
  n * CASE k WHEN 0 THEN 30720 WHEN 1 THEN 120 WHEN 2 THEN 48 WHEN 3 THEN 96 WHEN 4 THEN 3 ELSE 12 END AS bytes FROM p""")
def volume_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(a).alias("axes"), F.array(*[F.col("p_size") if n == "n" else F.lit(n) for n in shape]).alias("shape"), F.lit(size).alias("itemsize")) for a, shape, size in _SHAPES])
    v = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.get(kinds, (F.col("p_partkey") % 6).cast("int")).alias("v")).select("id", "v.axes", "v.shape", "v.itemsize")
    return tiling.storage(tiling.shape_xyz(v)).select("id", "x", "y", "z", F.coalesce("ok", F.lit(False)).alias("ok"), "voxels", "bytes")


@query("""SELECT p_partkey AS id, p_size - 4.0::DOUBLE AS x0, p_size + 4.0::DOUBLE AS x1, p_retailprice - 2.5::DOUBLE AS y0, p_retailprice + 2.5::DOUBLE AS y1,
  p_size * 40 / 1000.0::DOUBLE AS height_um, (p_partkey % 100) * 8 / 1000.0::DOUBLE AS width_um FROM part""")
def physical_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.table(spark, sf_dir, "part")
    v = p.select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("y"), F.col("p_size").alias("rows"), (F.col("p_partkey") % 100).alias("columns"), F.lit(40.0).alias("row_nm"), F.lit(8.0).alias("column_nm"))
    return tiling.extent_um(tiling.bounds_of(v, 8.0, 5.0)).select("id", "x0", "x1", "y0", "y1", "height_um", "width_um")


@query("""WITH b AS (SELECT p_partkey AS id, p_size AS z0, p_size + 3 AS z1, p_partkey % 50 AS y0, p_partkey % 50 + 7 AS y1, p_partkey % 30 AS x0, p_partkey % 30 + 5 AS x1 FROM part),
c AS (SELECT id, CAST(k AS INT) AS corner, [CASE WHEN k & 1 > 0 THEN z1 ELSE z0 END * 40, CASE WHEN k & 2 > 0 THEN y1 ELSE y0 END * 8, CASE WHEN k & 4 > 0 THEN x1 ELSE x0 END * 8]::DOUBLE[] AS p FROM b, range(8) r(k))
SELECT id, corner, greatest(abs(round_even(p[1] / 50, 0) * 50 - p[1]), abs(round_even(p[2] / 12, 0) * 12 - p[2]), abs(round_even(p[3] / 12, 0) * 12 - p[3])) AS error_nm FROM c""")
def corner_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    b = views.table(spark, sf_dir, "part").select(k.alias("id"), n.alias("z0"), (n + 3).alias("z1"), (k % 50).alias("y0"), (k % 50 + 7).alias("y1"), (k % 30).alias("x0"), (k % 30 + 5).alias("x1"))
    return tiling.corner_round_trip(b, (40.0, 8.0, 8.0), (50.0, 12.0, 12.0))


@query("""WITH b AS (SELECT p_partkey AS id, p_size AS z0, p_size + 3 AS z1, p_partkey % 50 AS y0, p_partkey % 50 + 7 AS y1, p_partkey % 30 AS x0, p_partkey % 30 + 5 AS x1 FROM part)
SELECT id, CAST(floor(z0 * 40.0 / 50.0) AS BIGINT) AS z0, CAST(ceil(z1 * 40.0 / 50.0) AS BIGINT) AS z1, CAST(floor(y0 * 8.0 / 12.0) AS BIGINT) AS y0, CAST(ceil(y1 * 8.0 / 12.0) AS BIGINT) AS y1,
  CAST(floor(x0 * 8.0 / 12.0) AS BIGINT) AS x0, CAST(ceil(x1 * 8.0 / 12.0) AS BIGINT) AS x1 FROM b""")
def grid_to_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size")
    b = views.table(spark, sf_dir, "part").select(k.alias("id"), n.alias("z0"), (n + 3).alias("z1"), (k % 50).alias("y0"), (k % 50 + 7).alias("y1"), (k % 30).alias("x0"), (k % 30 + 5).alias("x1"))
    return tiling.map_box(b, (40.0, 8.0, 8.0), (50.0, 12.0, 12.0))


# Volumes -----------------------------------------------------------------------------------------


@query(f"SELECT z, x, pred FROM {VOX} WHERE y = 32")
def plane_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.plane_slice(views.vox(spark, sf_dir), "xz", SHAPE).select("z", "x", "pred")


@query(f"""SELECT 'any' AS kind, count(*) AS n FROM {VOX} WHERE pred <> 0 UNION ALL SELECT 'list', count(*) FROM {VOX} WHERE pred IN (1, 4) UNION ALL SELECT 'one', count(*) FROM {VOX} WHERE pred = 3""")
def label_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, out = views.vox(spark, sf_dir), None
    for kind, value in (("any", None), ("list", [1, 4]), ("one", 3)):
        part = labels.with_label(v, value).agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"SELECT z AS plane, count(DISTINCT pred) AS labels FROM {VOX} GROUP BY 1")
def unique_in_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.unique_in_planes(views.vox(spark, sf_dir))


@query(f"SELECT z, y, x, pred FROM {VOX}")
def axis_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = views.vox(spark, sf_dir).select(F.col("x").alias("a0"), F.col("y").alias("a1"), F.col("z").alias("a2"), F.lit(0).alias("a3"), "pred")
    return labels.relabelled_axes(given, "xyzc")


@query("SELECT vec_id, label FROM embeddings WHERE vec_id IN (3, 17, 42, 99)")
def select_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.selected(views.table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id", [42, 3, 17, 99, 3])


@query(f"SELECT y, x, max(raw) FILTER (WHERE z = 0) AS c0, max(raw) FILTER (WHERE z = 1) AS c1, max(raw) FILTER (WHERE z = 2) AS c2 FROM {VOX} WHERE z < 3 GROUP BY 1, 2")
def affinity_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.affinity_planes(views.vox(spark, sf_dir).select(F.col("z").alias("c"), "y", "x", F.col("raw").alias("value")))


@query("SELECT event_id, value FROM events WHERE value < 0 OR value <> floor(value) OR value > 50")
def invalid_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.invalid_labels(views.table(spark, sf_dir, "events"), "value", 50).select("event_id", "value")


@query(f"""WITH f AS (SELECT v.pred AS label, v.z, v.y, v.x, s.axis, s.side, v.z + CASE WHEN s.axis = 'z' THEN s.side ELSE 0 END AS nz, v.y + CASE WHEN s.axis = 'y' THEN s.side ELSE 0 END AS ny, v.x + CASE WHEN s.axis = 'x' THEN s.side ELSE 0 END AS nx
  FROM {VOX} v, (VALUES ('z', -1), ('z', 1), ('y', -1), ('y', 1), ('x', -1), ('x', 1)) s(axis, side) WHERE v.pred > 0)
SELECT label, axis, count(*) AS faces FROM f LEFT JOIN {VOX} n ON n.z = nz AND n.y = ny AND n.x = f.nx AND n.pred = f.label WHERE n.pred IS NULL GROUP BY 1, 2""")
def surface_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.boundary_faces(views.vox(spark, sf_dir)).groupBy("label", "axis").agg(F.count("*").alias("faces"))


@query(f"""WITH m AS (SELECT tz AS z, ty AS y, tx AS x, v.pred FROM {VOX} v, range(5) a(tz), range(30) b(ty), range(30) c(tx) WHERE v.z = least(tz * 7 // 5, 6) AND v.y = least(ty * 64 // 30, 63) AND v.x = least(tx * 64 // 30, 63)),
b AS (SELECT m.pred FROM m, range(7) a(tz), range(64) b(ty), range(64) c(tx) WHERE m.z = least(tz * 5 // 7, 4) AND m.y = least(ty * 30 // 64, 29) AND m.x = least(tx * 30 // 64, 29)),
f AS (SELECT DISTINCT pred FROM b WHERE pred > 0), o AS (SELECT DISTINCT pred FROM m WHERE pred > 0)
SELECT pred AS label, 'lost' AS state FROM o WHERE pred NOT IN (SELECT pred FROM f) UNION ALL SELECT pred, 'added' FROM f WHERE pred NOT IN (SELECT pred FROM o)""")
def restored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = resample.nearest(views.vox(spark, sf_dir), SHAPE, (5, 30, 30), ["pred"])
    return resample.restored(model, (5, 30, 30), SHAPE)


@query(f"""SELECT z, y, CAST(t AS INT) AS x, round(sum(greatest(least(d.x + 1.0::DOUBLE, (t + 1) * 2.56::DOUBLE) - greatest(d.x::DOUBLE, t * 2.56::DOUBLE), 0) * raw) / 2.56::DOUBLE, 6) AS raw
FROM {DENSE} d, range(25) r(t) WHERE d.x + 1 > t * 2.56::DOUBLE AND d.x < (t + 1) * 2.56::DOUBLE GROUP BY 1, 2, 3""")
def area_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.area(views.dense(spark, sf_dir), "raw", "x", NX, 25).withColumn("raw", F.round("raw", 6))


@query(f"""WITH t AS (SELECT printf('tile_%05d', (z // 4 * 4 + y // 20) * 3 + x // 30) AS tile_id, count(*) AS voxels FROM {VOX} GROUP BY 1) SELECT tile_id, voxels, true AS same FROM t""")
def tiled_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = tiling.tile_plan(spark, SHAPE, (4, 20, 30), (1, 2, 2)).select("tile_id", "z0", "z1", "y0", "y1", "x0", "x1")
    return resample.tiles_equal_bulk(views.vox(spark, sf_dir), tiles, "pred").select("tile_id", "voxels", "same")


@query(f"SELECT z, y, x, CAST(least(greatest(round_even(raw * 7.5, 0), 0), 255) AS BIGINT) AS byte, CAST(floor(least(greatest((raw - 10) / 30.0::DOUBLE, 0), 1) * 255) AS INT) AS shown FROM {VOX}")
def display_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.vox(spark, sf_dir)
    return v.select("z", "y", "x", resample.clip_cast(F.col("raw") * 7.5, 0, 255).alias("byte"), display.window(F.col("raw"), 10.0, 40.0).alias("shown"))


@query(f"""WITH p AS (SELECT CAST(z AS BIGINT) AS patch_id, y * 64 + x AS i, raw AS v FROM {VOX}), s AS (SELECT *, max(v) OVER w AS top FROM p WINDOW w AS (PARTITION BY patch_id)),
u AS (SELECT *, CASE WHEN top > 1.5 THEN v / 255.0::DOUBLE ELSE v END AS unit FROM s)
SELECT patch_id, i, round((unit - avg(unit) OVER w) / greatest(stddev_pop(unit) OVER w, 1e-6::DOUBLE), 6) AS scaled FROM u WINDOW w AS (PARTITION BY patch_id)""")
def patch_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.vox(spark, sf_dir).select(F.col("z").cast("long").alias("patch_id"), (F.col("y") * 64 + F.col("x")).alias("i"), F.col("raw").alias("v"))
    return resample.patch_scaled(v).select("patch_id", "i", F.round("scaled", 6).alias("scaled"))


# Overlaps across planes and views ---------------------------------------------------------------


@query(f"""WITH RECURSIVE h AS (SELECT z, y, x, pred AS a FROM {VOX} WHERE pred > 0), s AS MATERIALIZED (SELECT z, a, count(*) AS n FROM h GROUP BY 1, 2),
e AS MATERIALIZED (SELECT p.z, p.a, p.b FROM (SELECT h.z, h.a, g.a AS b, count(*) AS n FROM h JOIN h g ON g.z = h.z + 1 AND g.y = h.y AND g.x = h.x GROUP BY 1, 2, 3) p
  JOIN s ON s.z = p.z AND s.a = p.a JOIN s t ON t.z = p.z + 1 AND t.a = p.b WHERE p.n::DOUBLE / least(s.n, t.n) >= 0.21),
d AS MATERIALIZED (SELECT z * 4294967296 + a AS u, (z + 1) * 4294967296 + b AS v FROM e UNION ALL SELECT (z + 1) * 4294967296 + b, z * 4294967296 + a FROM e),
r(node, other) AS (SELECT z * 4294967296 + a, z * 4294967296 + a FROM s UNION SELECT r.node, d.v FROM r JOIN d ON d.u = r.other)
SELECT CAST(node // 4294967296 AS INT) AS z, CAST(node % 4294967296 AS BIGINT) AS label, CAST(min(other) AS BIGINT) AS id FROM r GROUP BY 1, 2""")
def slice_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.vox(spark, sf_dir)
    return overlap.chained(overlap.slice_edges(v), v.filter("pred > 0").select("z", F.col("pred").alias("label")).distinct(), 0.21)


def _view_pairs(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS view_a, p.a, '{b}' AS view_b, p.b, p.n, p.n::DOUBLE / (s.n + t.n - p.n) AS iou FROM (SELECT {a} AS a, {b} AS b, count(*) AS n FROM {VOX} WHERE {a} > 0 AND {b} > 0 GROUP BY 1, 2) p
  JOIN (SELECT {a} AS a, count(*) AS n FROM {VOX} WHERE {a} > 0 GROUP BY 1) s USING (a) JOIN (SELECT {b} AS b, count(*) AS n FROM {VOX} WHERE {b} > 0 GROUP BY 1) t USING (b) WHERE p.n::DOUBLE / (s.n + t.n - p.n) >= 0.4"""


@query(" UNION ALL ".join(_view_pairs(a, b) for a, b in (("pred", "truth"), ("pred", "poor"), ("truth", "poor"))))
def view_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.consensus(views.vox(spark, sf_dir), ["pred", "truth", "poor"], 0.4)


_DOUBT = f"""(SELECT p.a AS pred, p.b AS truth, p.n, s.n AS size_pred, t.n AS size_truth, p.n::DOUBLE / (s.n + t.n - p.n) AS iou FROM (SELECT pred AS a, x % 4 + 1 AS b, count(*) AS n FROM {VOX} WHERE pred > 0 GROUP BY 1, 2) p
  JOIN (SELECT pred AS a, count(*) AS n FROM {VOX} WHERE pred > 0 GROUP BY 1) s USING (a) JOIN (SELECT x % 4 + 1 AS b, count(*) AS n FROM {VOX} GROUP BY 1) t USING (b))"""


@query(f"""WITH q AS MATERIALIZED {_DOUBT}, r AS (SELECT *, row_number() OVER (PARTITION BY pred ORDER BY iou DESC, truth DESC) AS k FROM q)
SELECT pred, 'several' AS kind FROM q GROUP BY 1 HAVING count(*) FILTER (WHERE n::DOUBLE / size_pred >= 0.24) > 1
UNION ALL SELECT a.pred, 'close' FROM r a JOIN r b ON b.pred = a.pred AND a.k = 1 AND b.k = 2 WHERE a.iou - b.iou < 0.002
UNION ALL SELECT pred, 'large' FROM r WHERE k = 1 AND size_pred + size_truth - n > 1500""")
def doubtful_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.vox(spark, sf_dir).withColumn("other", (F.col("x") % 4 + 1).cast("long"))
    return overlap.doubtful(overlap.pair_overlap(v, "pred", "other"), 0.24, 0.002, 1500)


_CHAIN = "(SELECT i // 2 + 1 AS pred, (i + 1) // 2 + 1 AS truth, 1 AS n, (i % 997 + 1) / 1000.0::DOUBLE AS iou FROM range(2 * (SELECT count(*) FROM part)) r(i))"


@query(f"""WITH RECURSIVE q AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY pred, truth) AS k FROM {_CHAIN}),
t AS MATERIALIZED (SELECT a.pred, a.truth, a.n, a.iou, a.k,
    b.k IS NOT NULL AND (b.iou, b.pred, b.truth) > (a.iou, a.pred, a.truth) AS before, c.k IS NOT NULL AND (c.iou, c.pred, c.truth) > (a.iou, a.pred, a.truth) AS after
  FROM q a LEFT JOIN q b ON b.k = a.k - 1 LEFT JOIN q c ON c.k = a.k + 1),
u(k, way, taken) AS (SELECT k, 0, true FROM t WHERE NOT before AND NOT after
  UNION ALL SELECT t.k, s.way, NOT u.taken FROM u, (VALUES (-1), (1)) s(way), t WHERE (u.way = 0 OR u.way = s.way) AND t.k = u.k + s.way AND CASE WHEN s.way > 0 THEN t.before ELSE t.after END),
f AS (SELECT t.*, bool_and(u.taken) AS ok FROM t JOIN u USING (k) GROUP BY ALL)
SELECT pred, truth, n, iou FROM f WHERE ok""")
def greedy_match_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("id")
    n = views.table(spark, sf_dir, "part").count()
    chain = spark.range(2 * n).select((F.floor(i / 2) + 1).alias("pred"), (F.floor((i + 1) / 2) + 1).alias("truth"), F.lit(1).alias("n"), ((i % 997 + 1) / 1000.0).alias("iou"))
    return overlap.match_greedy(chain, 0.0005)


# Densities -----------------------------------------------------------------------------------------


def _blurred(table: str, value: str, n: int, sigma: float) -> str:
    """A blur of an n x n grid ``table`` (by_, bx) as a table (by_, bx, v)."""
    w = density.gaussian_weights(sigma)
    taps = ", ".join(f"({i - len(w) // 2}, {x!r}::DOUBLE)" for i, x in enumerate(w))
    return f"""(WITH k(d, w) AS (VALUES {taps}), m AS (SELECT a AS at, w, CASE WHEN abs(a + d) > {n - 1} THEN {2 * n - 2} - abs(a + d) ELSE abs(a + d) END AS src FROM range({n}) r(a), k),
r AS (SELECT m.at AS by_, g.bx, sum(m.w * g.{value}) AS v FROM m JOIN {table} g ON g.by_ = m.src GROUP BY 1, 2)
SELECT r.by_, m.at AS bx, sum(m.w * r.v) AS v FROM m JOIN r ON r.bx = m.src GROUP BY 1, 2)"""


def _sums(mask: str) -> str:
    return f"""s AS MATERIALIZED (SELECT y // 6 AS by_, x // 6 AS bx, CAST(count(*) FILTER (WHERE {mask}) AS DOUBLE) AS num, CAST(count(*) FILTER (WHERE raw BETWEEN 20 AND 45) AS DOUBLE) AS den FROM {DENSE} WHERE z = 3 GROUP BY 1, 2)"""


@query(f"""WITH {_sums('pred = 2')}, n AS {_blurred('s', 'num', 11, 1.25)}, d AS {_blurred('s', 'den', 11, 1.25)}
SELECT CAST(by_ AS INT) AS "by", CAST(bx AS INT) AS bx, round(CASE WHEN d.v > 0 THEN 100 * n.v / d.v ELSE 0 END, 6) AS percent, d.v > 36 * 0.06 AS valid FROM n JOIN d USING (by_, bx)""")
def density_blurred_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    plane = views.dense(spark, sf_dir).filter("z = 3")
    return density.density_blurred_sums(plane, 6, (NY, NX), F.col("pred") == 2, labels.tissue(F.col("raw"), 20, 45)).withColumn("percent", F.round("percent", 6))


@query(f"""WITH {_sums('pred = 2 AND raw BETWEEN 20 AND 45')}, p AS (SELECT *, CASE WHEN den > 0 THEN 100 * num / den ELSE 0 END AS share FROM s), b AS {_blurred('p', 'share', 11, 0.8)}
SELECT CAST(by_ AS INT) AS "by", CAST(bx AS INT) AS bx, round(b.v, 6) AS percent, CAST(num AS BIGINT) AS num, CAST(den AS BIGINT) AS den FROM b JOIN s USING (by_, bx)""")
def density_blurred_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    plane = views.dense(spark, sf_dir).filter("z = 3")
    out = density.density_blurred_share(plane, 6, (NY, NX), F.col("pred") == 2, labels.tissue(F.col("raw"), 20, 45))
    return out.select("by", "bx", F.round("percent", 6).alias("percent"), "num", "den")


@query(f"SELECT z, y, x, CASE WHEN x >= 5 AND x < 59 AND y >= 5 AND y < 59 THEN raw ELSE -1 END::DOUBLE AS raw FROM {DENSE}")
def margin_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.without_margins(views.dense(spark, sf_dir), "raw", NX, NY, 5).select("z", "y", "x", "raw")


@query("SELECT quantile_cont(value, 0.01)::DOUBLE AS low, quantile_cont(value, 0.5)::DOUBLE AS middle, quantile_cont(value, 0.99)::DOUBLE AS high FROM events")
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = numbering.quantiles(views.table(spark, sf_dir, "events"), "value", [0.01, 0.5, 0.99])
    return spark.createDataFrame([tuple(q)], "low double, middle double, high double")


# Selections -----------------------------------------------------------------------------------------

_TAKEN = """WITH RECURSIVE o AS (SELECT *, row_number() OVER (ORDER BY turn) AS k FROM ({points})),
r(k, xs, ys, ids) AS (SELECT 0::BIGINT, []::DOUBLE[], []::DOUBLE[], []::BIGINT[] UNION ALL
  SELECT nk, CASE WHEN ok THEN list_append(xs, nx) ELSE xs END, CASE WHEN ok THEN list_append(ys, ny) ELSE ys END, CASE WHEN ok THEN list_append(ids, ni) ELSE ids END
  FROM (SELECT r.xs, r.ys, r.ids, o.k AS nk, o.x AS nx, o.y AS ny, o.id AS ni, len(list_filter(list_zip(r.xs, r.ys), lambda p: (p[1] - o.x) * (p[1] - o.x) + (p[2] - o.y) * (p[2] - o.y) < {far})) = 0 AS ok FROM r JOIN o ON o.k = r.k + 1 WHERE len(r.ids) < {n}) o2)
SELECT CAST(i AS INT) AS rank, ids[i] AS id, xs[i] AS x, ys[i] AS y FROM (SELECT * FROM r ORDER BY k DESC LIMIT 1), range(1, {n} + 1) t(i)"""


@query(_TAKEN.format(points="SELECT event_id AS id, CAST(user_id AS DOUBLE) AS x, value AS y, md5('stops-2:' || event_id) AS turn FROM events WHERE user_id >= 10 AND user_id < 90 AND value >= 10 AND value < 90 AND (event_id % 100) / 100.0::DOUBLE >= 0.7", far=100, n=3))
def eligible_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").cast("double").alias("x"), F.col("value").alias("y"), (F.col("event_id") % 100 / 100.0).alias("share"))
    return select.spaced(select.eligible(p, "share", 0.7, 100, 100, 10), "stops-2", 3, 10.0)


_UNIT = "(CAST('0x' || substr(md5('draw-1:{a}:' || i), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE)"


@query(_TAKEN.format(points=f"""SELECT i AS id, 10.0::DOUBLE + {_UNIT.format(a='x')} * 80.0::DOUBLE AS x, 5.0::DOUBLE + {_UNIT.format(a='y')} * 90.0::DOUBLE AS y, lpad(i::VARCHAR, 10, '0') AS turn FROM range(1, 2001) r(i)
  WHERE CAST(floor(10.0::DOUBLE + {_UNIT.format(a='x')} * 80.0::DOUBLE) AS BIGINT) % 15 IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) % 3 <> 0)""", far=900, n=4))
def rejection_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = select.draws(spark, "draw-1", (10.0, 90.0, 5.0, 95.0)).withColumn("user_id", F.floor("x") % 15)
    d = d.join(views.table(spark, sf_dir, "events").groupBy("user_id").count().filter("count % 3 <> 0"), "user_id", "left_semi")
    return select.first_apart(d, 4, 30.0)


@query("WITH n AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS place, count(*) OVER () AS total FROM events) SELECT event_id, place FROM n WHERE place IN (SELECT i * (total - 1) // 49 FROM range(50) r(i))")
def linspace_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = views.table(spark, sf_dir, "events").select("event_id")
    return select.evenly(numbering.numbered(e, ["event_id"], "place"), "place", 50, e.count())


@query("SELECT p_partkey AS id, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS place FROM part")
def numeric_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return numbering.numbered(p, ["p_retailprice", "p_partkey"], "place").select(F.col("p_partkey").alias("id"), "place")


@query(f"""WITH c AS (SELECT *, {_COST}, row_number() OVER (ORDER BY candidate_id) - 1 AS place, count(*) OVER () AS total FROM {_manifest(_ENDS)})
SELECT candidate_id, cost FROM c WHERE place IN (SELECT i * (total - 1) // 11 FROM range(12) r(i))""")
def equispaced_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.equispaced(_candidates(spark, sf_dir, "align_end").select("candidate_id", "cost"), "candidate_id", 12).select("candidate_id", "cost")


@query(f"""WITH c AS (SELECT s.seed, m.candidate_id, {_COST}, md5(s.seed || ':' || candidate_id) AS t FROM {_manifest(_ENDS)} m, (VALUES ('a'), ('b'), ('c'), ('d'), ('e')) s(seed) WHERE size_id = 1),
r AS (SELECT *, CAST(sum(cost) OVER (PARTITION BY seed ORDER BY t, candidate_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM c) SELECT seed, candidate_id, total FROM r WHERE total <= 9000""")
def multi_seed_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _candidates(spark, sf_dir, "align_end").filter("size_id = 1").select(F.col("candidate_id").alias("ord"), "cost")
    out = None
    for seed in "abcde":
        part = verify.random_baseline(c, seed, 9000).select(F.lit(seed).alias("seed"), F.col("ord").alias("candidate_id"), "total")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""WITH k AS (SELECT c, CAST('0x' || substr(md5('split-1:' || c), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE < 0.4 AS v FROM range({PLANES} // 2 + 1) r(c)),
t AS (SELECT m.candidate_id, bool_and(k.v) AS a, bool_or(k.v) AS b FROM {_manifest(_ENDS)} m JOIN k ON k.c >= m.z0 // 2 AND k.c <= (m.z1 - 1) // 2 GROUP BY 1)
SELECT candidate_id, CASE WHEN a THEN 'validation' ELSE 'training' END AS part FROM t WHERE a OR NOT b""")
def disjoint_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.split_by_cell(_candidates(spark, sf_dir, "align_end"), 2, 0.4, "split-1").select("candidate_id", "part")


@query(f"""WITH c AS (SELECT size_id, candidate_id, {_COST}, row_number() OVER (ORDER BY candidate_id) AS rank FROM {_manifest(_ENDS)}), r AS (SELECT *, CAST(sum(cost) OVER (ORDER BY rank) AS BIGINT) AS total_cost FROM c)
SELECT rank, cost, total_cost, 5000000 - total_cost AS rest, rank::DOUBLE / 1000 AS rate FROM r""")
def coverage_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = numbering.numbered(_candidates(spark, sf_dir, "align_end").select("candidate_id", "cost"), ["candidate_id"], "rank", first=1)
    return select.running(c.withColumn("gain", F.lit(1)), 5_000_000, 1000).select("rank", "cost", "total_cost", "rest", "rate")


# Cameras and meshes ---------------------------------------------------------------------------------


@query("""WITH v AS (SELECT p_partkey AS id, p_size * 20.0::DOUBLE AS x, p_partkey % 997 * 1.0::DOUBLE AS y, least(50.0::DOUBLE + p_size * 30, 1000) AS fx FROM part),
c AS (SELECT *, least(fx * 0.5625::DOUBLE, 1000) AS fy FROM v), d AS (SELECT *, least(greatest(x, fx / 2), 1000 - fx / 2) AS cx, least(greatest(y, fy / 2), 1000 - fy / 2) AS cy FROM c)
SELECT id, CAST(greatest(floor((cx - fx / 2) / 1000 * 640), 0) AS INT) AS px0, CAST(least(ceil((cx + fx / 2) / 1000 * 640), 640) AS INT) AS px1,
  CAST(greatest(floor((cy - fy / 2) / 1000 * 640), 0) AS INT) AS py0, CAST(least(ceil((cy + fy / 2) / 1000 * 640), 640) AS INT) AS py1 FROM d""")
def camera_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size")
    v = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (n * 20.0).alias("x"), (F.col("p_partkey") % 997).cast("double").alias("y"), (n * 30 + 50.0).alias("fov"))
    return display.camera_crop(v, (0.0, 1000.0, 0.0, 1000.0), 640, 640, 0.5625).select("id", "px0", "px1", "py0", "py1")


@query("""WITH f AS (SELECT p_partkey AS segment, j FROM part, range(12) r(j) WHERE j < p_size % 12), u AS (SELECT *, least(j / 7.0::DOUBLE, 1) AS u FROM f)
SELECT segment, CAST(j AS INT) AS j, CASE WHEN segment > 0 AND j < 8 THEN u * u * (3 - 2 * u) ELSE 1 END::DOUBLE AS weight FROM u""")
def crossfade(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("segment"), (F.col("p_size") % 12).alias("frames"))
    return camera.crossfade(s, 8)


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN p_size / 50.0::DOUBLE ELSE 1 END::DOUBLE AS weight FROM part")
def camera_dissolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    p = views.table(spark, sf_dir, "part").select(k.alias("id"), F.when(k % 3 == 0, "entry").when(k % 3 == 1, "hold").otherwise("move").alias("kind"), (F.col("p_size") / 50.0).alias("progress"))
    return camera.dissolve(p).select("id", "weight")


@query("""SELECT p_partkey AS id, seconds, CAST(round_even(seconds * 24, 0) AS BIGINT) AS frames FROM (SELECT p_partkey, 3.0::DOUBLE + p_size % 4 * 4.5 + 2 + 4 + (p_size % 6) * 2.5 + greatest(p_size % 6 - 1, 0) * 1.5 AS seconds FROM part) t""")
def duration_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_size")
    d = {"metadata": 3.0, "isolated": 2.0, "density": 2.5, "together": 2.0, "zoom": 4.0, "hold": 2.5, "move": 1.5}
    t = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (n % 4).alias("layers"), (n % 6).alias("stops"), *[F.lit(v).alias(k) for k, v in d.items()])
    return camera.duration(t, 24.0).select("id", "seconds", "frames")


@query("""WITH v AS (SELECT p_brand AS region, p_type AS layer, avg(p_size) AS percent FROM part GROUP BY 1, 2), m AS (SELECT greatest(max(percent), 1) * 1.12::DOUBLE AS top FROM v)
SELECT region, layer, CAST(520 + round_even(990 * percent / top, 0) AS INT) AS bar FROM v, m""")
def occupancy_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("region"), F.col("p_type").alias("layer")).agg(F.avg("p_size").alias("percent"))
    return display.occupancy_bars(v, 520, 1510).select("region", "layer", "bar")


@query(f"""WITH m AS (SELECT 0 AS mesh, vid, x FROM {VERTEX} UNION ALL SELECT 1, vid, x + 1000 FROM {VERTEX}), n AS (SELECT count(*) AS n FROM {VERTEX}) SELECT CAST(vid + mesh * n AS BIGINT) AS vid, x FROM m, n""")
def mesh_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, f = views.vertex(spark, sf_dir), views.face(spark, sf_dir)
    both = v.withColumn("mesh", F.lit(0)).unionByName(v.withColumn("mesh", F.lit(1)).withColumn("x", F.col("x") + 1000))
    return mesh.merged(both, f.withColumn("mesh", F.lit(0)).unionByName(f.withColumn("mesh", F.lit(1))))[0].select("vid", "x")


_TURN = (0.4, -0.3)


@query(f"""SELECT vid, round(rx, 6) + 0 AS rx, round(cos({_TURN[1]}::DOUBLE) * y - sin({_TURN[1]}::DOUBLE) * t, 6) + 0 AS ry, round(sin({_TURN[1]}::DOUBLE) * y + cos({_TURN[1]}::DOUBLE) * t, 6) + 0 AS rz
FROM (SELECT vid, y, cos({_TURN[0]}::DOUBLE) * x + sin({_TURN[0]}::DOUBLE) * z AS rx, cos({_TURN[0]}::DOUBLE) * z - sin({_TURN[0]}::DOUBLE) * x AS t FROM {VERTEX}) r""")
def mesh_rotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.rotated(views.vertex(spark, sf_dir), *_TURN).select("vid", *[(F.round(c, 6) + 0).alias(c) for c in ("rx", "ry", "rz")])


@query(f"""SELECT vid, (x + 3) * 8.0::DOUBLE AS x, (y - 1) * 8.0::DOUBLE AS y, (z + 2) * 40.0::DOUBLE AS z FROM {VERTEX}""")
def mesh_nanometres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mesh.to_nm(views.vertex(spark, sf_dir), (8.0, 8.0, 40.0), (3, -1, 2))


@query(f"""WITH c AS (SELECT f.fid, a.x % 40 AS xa, a.y % 40 AS ya, a.z AS za, b.x % 40 AS xb, b.y % 40 AS yb, b.z AS zb, c.x % 40 AS xc, c.y % 40 AS yc, c.z AS zc FROM {FACE} f JOIN {VERTEX} a ON a.vid = f.a JOIN {VERTEX} b ON b.vid = f.b JOIN {VERTEX} c ON c.vid = f.c),
p AS (SELECT c.*, px, py, (yb - yc) * (xa - xc) + (xc - xb) * (ya - yc) AS den FROM c, range(40) i(px), range(40) j(py) WHERE px >= floor(least(xa, xb, xc)) AND px <= ceil(greatest(xa, xb, xc)) AND py >= floor(least(ya, yb, yc)) AND py <= ceil(greatest(ya, yb, yc))),
w AS (SELECT *, ((yb - yc) * (px - xc) + (xc - xb) * (py - yc)) / den AS w0, ((yc - ya) * (px - xc) + (xa - xc) * (py - yc)) / den AS w1 FROM p WHERE den <> 0),
d AS (SELECT px, py, fid, w0 * za + w1 * zb + (1 - w0 - w1) * zc AS depth FROM w WHERE w0 >= 0 AND w1 >= 0 AND 1 - w0 - w1 >= 0)
SELECT px, py, round(min(depth), 6) + 0 AS depth FROM d GROUP BY 1, 2""")
def mesh_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.vertex(spark, sf_dir).select("vid", (F.col("x") % 40).alias("x"), (F.col("y") % 40).alias("y"), "z")
    return mesh.pixels(views.face(spark, sf_dir), v, 40, 40).select("px", "py", (F.round("depth", 6) + 0).alias("depth"))


@query(f"SELECT event_id, bx // 3 AS column_, by_ // 3 AS row_ FROM {PTS}")
def context_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = views.pts(spark, sf_dir).select("event_id", F.col("bx").cast("double").alias("x0"), (F.col("bx") + 1.0).alias("x1"), F.col("by_").cast("double").alias("y0"), (F.col("by_") + 1.0).alias("y1"))
    return display.context(p, 3.0).select("event_id", F.col("px0").alias("column_"), F.col("py0").alias("row_"))


# Files ---------------------------------------------------------------------------------------------


def _written(spark: SparkSession) -> str:
    return f"{components.shared_folder(spark)}/volume-{uuid.uuid4().hex}"


@query(f"SELECT z, y, x, pred AS value FROM {DENSE} WHERE z BETWEEN 1 AND 4 AND y BETWEEN 10 AND 39 AND x >= 20")
def precomputed_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of a volume of raw chunks: only files that meet it are opened; cells of absent chunks are 0."""
    path = _written(spark)
    volumes.write_precomputed(views.vox(spark, sf_dir).withColumnRenamed("pred", "value"), path, SHAPE, (2, 16, 24), (40.0, 8.0, 8.0))
    return volumes.scan(spark, path, "precomputed", [(1, 5), (10, 40), (20, NX)])


@query(f"SELECT z, y, x, pred AS value FROM {VOX} WHERE pred <> 0")
def precomputed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sparse form of a stored label volume."""
    path = _written(spark)
    volumes.write_precomputed(views.vox(spark, sf_dir).withColumnRenamed("pred", "value"), path, SHAPE, (4, 32, 32), (40.0, 8.0, 8.0))
    return volumes.scan(spark, path, "precomputed", drop_zero=True)


@query(f"SELECT z, y, x, raw AS value FROM {DENSE}")
def tiff_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark) + ".tif"
    volumes.write_tiff(views.vox(spark, sf_dir).withColumnRenamed("raw", "value"), path, SHAPE, "float64")
    return volumes.scan_tiff(spark, path, slab=2)

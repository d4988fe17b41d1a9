"""Registered queries over volumes that grow with the tables: surfaces, objects, tiles and graphs."""

from __future__ import annotations

import itertools
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark import views
from voxelspark.operators import agglomerate, camera, components, display, fuzzy, halo, knn, surface, verify
from voxelspark.operators.components import checkpointed, shared_folder
from voxelspark.plans.registry import query
from voxelspark.sources import precomputed
from voxelspark.streaming import runs
from voxelspark.views import PTS, VOLUME

NM = (30.0, 6.5, 6.5)

# Surfaces ---------------------------------------------------------------------------------------------


def _cut_tetrahedra() -> str:
    """(corners inside as four bits, tetrahedron, area, volume, faces) of a tetrahedron cut half-way along
    its edges, from its geometry: one corner is cut off by a quarter of the face before it, two by a
    parallelogram of half their sides; what is cut off is an eighth, or a half, of the whole."""
    rows, whole = [], NM[0] * NM[1] * NM[2] / 6
    for t, order in enumerate(itertools.permutations(range(3))):
        path = np.cumsum([np.zeros(3), *np.eye(3)[list(order)]], axis=0) * NM
        for inside in range(1, 15):
            some = [i for i in range(4) if inside >> i & 1]
            rest = [i for i in range(4) if i not in some]
            if len(some) == 2:
                area = np.linalg.norm(np.cross(path[some[1]] - path[some[0]], path[rest[1]] - path[rest[0]])) / 4
                rows.append((t, inside, float(area), whole / 2, 2))
            else:
                a, b, c = path[rest if len(some) == 1 else some]
                rows.append((t, inside, float(np.linalg.norm(np.cross(b - a, c - a))) / 8, whole / 8 if len(some) == 1 else whole * 7 / 8, 1))
        rows.append((t, 15, 0.0, whole, 0))
    return ", ".join(f"({t}, {i}, {a!r}::DOUBLE, {v!r}::DOUBLE, {f})" for t, i, a, v, f in rows)


def _bits() -> str:
    """The four corners of each tetrahedron that are inside, as bits, from flags f000 .. f111 (z, y, x)."""
    out = []
    for t, order in enumerate(itertools.permutations(range(3))):
        path = np.cumsum([np.zeros(3, int), *np.eye(3, dtype=int)[list(order)]], axis=0)
        out.append(f"SELECT label, {t} AS t, " + " + ".join(f"{1 << i} * f{''.join(map(str, p))}" for i, p in enumerate(path)) + " AS inside FROM c")
    return " UNION ALL ".join(out)


_CORNERS = list(itertools.product((0, 1), repeat=3))
_SIDES = "i AS MATERIALIZED (SELECT label, z, y, x FROM " + VOLUME + " WHERE label > 0), d(dz, dy, dx) AS (VALUES " + ", ".join(str(c) for c in _CORNERS[1:]) + ")"
_CUT = f"""WITH {_SIDES}, e AS (
  SELECT i.label, 2 * i.z + s * dz AS z, 2 * i.y + s * dy AS y, 2 * i.x + s * dx AS x
  FROM i, d, (VALUES (1), (-1)) w(s) WHERE NOT EXISTS (SELECT 1 FROM i j WHERE j.label = i.label AND j.z = i.z + s * dz AND j.y = i.y + s * dy AND j.x = i.x + s * dx))"""


@query(f"""{_CUT}, c AS MATERIALIZED (
  SELECT label, cz, cy, cx, {', '.join(f"max(CASE WHEN oz = {a} AND oy = {b} AND ox = {c} THEN 1 ELSE 0 END) AS f{a}{b}{c}" for a, b, c in _CORNERS)}
  FROM (SELECT label, z - oz AS cz, y - oy AS cy, x - ox AS cx, oz, oy, ox FROM i, (VALUES {', '.join(str(c) for c in _CORNERS)}) o(oz, oy, ox)) GROUP BY 1, 2, 3, 4),
  b AS ({_bits()}), k(t, inside, area, volume, faces) AS (VALUES {_cut_tetrahedra()}),
  m AS (SELECT label, CAST(sum(faces) AS BIGINT) AS faces, sum(area) AS area, sum(volume) AS volume FROM b JOIN k USING (t, inside) GROUP BY label),
  v AS (SELECT label, count(*) AS vertices FROM (SELECT DISTINCT * FROM e) GROUP BY label)
SELECT label, faces, vertices, faces * 3 // 2 AS edges, 0::BIGINT AS open_edges, vertices - faces // 2 AS euler, round(area / 1000, 3) AS area, round(volume / 1000, 3) AS volume FROM m JOIN v USING (label)""")
def surface_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed surfaces of the labels: counts, and area and volume in thousands of square and cubic nanometres."""
    out = surface.cell_measures(surface.cells(views.volume(spark, sf_dir)), NM)
    return out.withColumns({"area": F.round(F.col("area") / 1000, 3), "volume": F.round(F.col("volume") / 1000, 3)})


@query(f"""{_CUT} SELECT DISTINCT label, (z / 2.0::DOUBLE + 4) * 30.0::DOUBLE AS z, (y / 2.0::DOUBLE + 5) * 6.5::DOUBLE AS y, (x / 2.0::DOUBLE + 6) * 6.5::DOUBLE AS x FROM e""")
def surface_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices of the surfaces in nanometres, the region's corner at (4, 5, 6)."""
    return surface.cell_vertices(surface.cells(views.volume(spark, sf_dir)), NM, (4, 5, 6)).drop("vid")


@query(f"""WITH {_SIDES.replace("SELECT label, z, y, x", "SELECT 1 AS label, z, y, x").replace("label > 0", "label IN (1, 3)")}, e AS (
  SELECT 2 * i.z + s * dz AS z, 2 * i.y + s * dy AS y, 2 * i.x + s * dx AS x
  FROM i, d, (VALUES (1), (-1)) w(s) WHERE NOT EXISTS (SELECT 1 FROM i j WHERE j.z = i.z + s * dz AND j.y = i.y + s * dy AND j.x = i.x + s * dx))
SELECT count(DISTINCT (z, y, x)) AS vertices, min(z) / 2.0::DOUBLE AS z0, max(z) / 2.0::DOUBLE AS z1, min(x) / 2.0::DOUBLE AS x0, max(x) / 2.0::DOUBLE AS x1 FROM e""")
def surface_of_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two labels as one object: what lies between them is no surface."""
    v = surface.cell_vertices(surface.cells(surface.merged(views.volume(spark, sf_dir), [1, 3])))
    return v.agg(F.count("*").alias("vertices"), F.min("z").alias("z0"), F.max("z").alias("z1"), F.min("x").alias("x0"), F.max("x").alias("x1"))


# Stored volumes ---------------------------------------------------------------------------------------


def _remove(spark: SparkSession, folder: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _through_store(spark: SparkSession, voxels: DataFrame, chunk: tuple, box: list | None, **how) -> DataFrame:
    """What is read back of a volume written to the shared folder; the volume is removed."""
    folder = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    planes = voxels.agg(F.max("z")).first()[0] + 1
    precomputed.write(voxels, folder, (planes, 32, 32), chunk, NM, offset=(0, 0, 0), **how)
    out = checkpointed(precomputed.scan(spark, folder, box=box, drop_zero=box is None))
    _remove(spark, folder)
    return out


#: A label for each voxel's block and order, beyond 32 bits.
_WIDE = f"(SELECT z, y, x, label * 10000000000 + CASE WHEN label > 0 THEN CAST(raw AS BIGINT) ELSE 0 END AS value FROM {VOLUME})"


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = views.volume(spark, sf_dir)
    return v.select("z", "y", "x", (F.col("label") * 10_000_000_000 + F.when(F.col("label") > 0, F.col("raw").cast("long")).otherwise(0)).alias("value"))


@query(f"SELECT z, y, x, value FROM {_WIDE} WHERE value <> 0")
def segmentation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels through compressed segmentation in packed shards of hashed chunks."""
    return _through_store(spark, _wide(spark, sf_dir), (4, 16, 12), None, block=(2, 8, 8), sharding=precomputed.sharded_by(2, 2, preshift=1, scrambled=True))


@query(f"""SELECT g.z, g.y, g.x, coalesce(value, 0)::BIGINT AS value FROM (SELECT CAST(a.i AS INT) AS z, CAST(b.i AS INT) AS y, CAST(c.i AS INT) AS x
  FROM range((SELECT max(z) + 1 FROM {_WIDE})) a(i), range(5, 29) b(i), range(32) c(i)) g LEFT JOIN {_WIDE} v USING (z, y, x)""")
def segmentation_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All planes of a box out of plain shards: chunks that don't meet it are not read."""
    return _through_store(spark, _wide(spark, sf_dir), (3, 10, 32), [(-5, 10**6), (5, 29), (0, 32)], sharding=precomputed.sharded_by(1, 1, packed=False))


@query(f"SELECT z, y, x, value FROM {_WIDE} WHERE value <> 0")
def segmentation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels through compressed segmentation in a file for each chunk."""
    return _through_store(spark, _wide(spark, sf_dir), (8, 32, 32), None, block=(8, 8, 8))


# Keyed state ------------------------------------------------------------------------------------------

_KEEP, _LATE_HOURS = 24 * 60, 2
_BUCKET, _PART = 50_000, 10_000_000  # records of a bucket of keys and of a part of the state, over the whole stream
_RUNS = f"""e AS (SELECT user_id AS key, event_id AS id, ts, event_type AS status, epoch_us(ts) AS us FROM events),
g AS (SELECT *, CASE WHEN coalesce(us - lag(us) OVER w > {_KEEP * 60_000_000}, true) THEN 1 ELSE 0 END AS new, lag(status) OVER w AS before FROM e WINDOW w AS (PARTITION BY key ORDER BY us, id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY key ORDER BY us, id) AS run FROM g),
runs AS (SELECT key, min(ts) AS start, max(ts) AS "end", count(*) AS records, CAST(sum(CASE WHEN new = 0 AND status <> before THEN 1 ELSE 0 END) AS BIGINT) AS changes,
  arg_max(status, (us, id)) AS last, max(us) AS b FROM r GROUP BY key, run)"""


def _stage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("status"))


@query(f"""WITH {_RUNS} SELECT key, start, "end", records, changes, last FROM runs""")
def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each user's records, split where a day passes without one."""
    return runs.batch_runs(_stage_log(spark, sf_dir), _KEEP)


@query(f"""WITH {_RUNS} SELECT key, start, "end", records, changes, last FROM runs
WHERE CAST(ceil(b / 1000.0) AS BIGINT) + {_KEEP * 60_000} < (SELECT max(us) // 1000 FROM e) - {_LATE_HOURS * 3_600_000}""")
def stage_runs_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs that are over at the end of a stream of the same records, in six parts, some repeated and
    up to 90 minutes out of order."""
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    log = _stage_log(spark, sf_dir)
    low, high, n = log.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts")), F.count("*")).first()
    arrives = F.unix_micros("ts") + F.pmod(F.xxhash64("id"), F.lit(90 * 60_000_000))
    part = F.least(F.floor((arrives - low) * 6 / (high - low + 1)), F.lit(5))
    log = log.withColumn("times", F.explode(F.when(F.col("id") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("times")
    for i in range(6):  # one after the other, as a stream takes files by age: what arrives is a part's number, its records are many files
        log.filter(part == i).write.parquet(f"{folder}/log/part={i}")
        spark.range(i, i + 1, 1, 1).toDF("part").write.mode("append").parquet(f"{folder}/parts")
    store, parts = "spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"
    before = {key: spark.conf.get(key) for key in (store, parts)}
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # Every part of the state costs a task and a store in each batch, so there are as few as keep all cores busy.
    spark.conf.set(parts, min(int(before[parts]), max(spark.sparkContext.defaultParallelism, n // _PART)))
    try:
        arrived = spark.readStream.schema("part long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/parts")
        stream = spark.read.parquet(f"{folder}/log").join(F.broadcast(arrived), "part").drop("part")
        found = runs.stream_runs(stream, _KEEP, f"{_LATE_HOURS} hours", max(64, n // _BUCKET))
        found.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/runs").trigger(availableNow=True).start().awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    out = checkpointed(spark.read.schema(found.schema).parquet(f"{folder}/runs"))
    _remove(spark, folder)
    return out


# Tiles, objects and graphs ----------------------------------------------------------------------------

_REACHED = f"""WITH RECURSIVE c AS MATERIALIZED (SELECT z, y, x, label, z * 4398046511104 + y * 2097152 + x AS n FROM {VOLUME} WHERE label <> 0),
s AS MATERIALIZED (SELECT a.n AS a, b.n AS b FROM c a JOIN c b ON a.label = b.label AND abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) = 1
  AND b.z BETWEEN a.z - 1 AND a.z + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 AND b.x BETWEEN a.x - 1 AND a.x + 1),
r(n, o) AS (SELECT n, n FROM c UNION SELECT r.n, s.b FROM r JOIN s ON s.a = r.o),
p AS MATERIALIZED (SELECT n, min(o) AS component FROM r GROUP BY n)"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.voxel_components(views.volume(spark, sf_dir), block=(4, 8, 10))


@query(f"{_REACHED} SELECT CAST(z AS BIGINT) AS z, CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x, label, CAST(component AS BIGINT) AS component FROM c JOIN p USING (n)")
def voxel_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected components of the labels, found in blocks and joined over their faces."""
    return _parts(spark, sf_dir)


@query(f"""WITH v AS (SELECT z, y, x, raw FROM {VOLUME}), n AS (SELECT CAST(max(z) + 1 AS INT) AS planes FROM v),
m AS (SELECT a.z + dz AS z, a.y + dy AS y, a.x + dx AS x, raw FROM v a, (VALUES (-1), (0), (1)) i(dz), (VALUES (-1), (0), (1)) j(dy), (VALUES (-1), (0), (1)) k(dx))
SELECT z, y, x, sum(raw)::DOUBLE AS value FROM m, n WHERE z >= 0 AND z < planes AND y >= 0 AND y < 32 AND x >= 0 AND x < 32 GROUP BY 1, 2, 3 HAVING sum(raw) <> 0""")
def tiled_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function of 3 x 3 x 3 neighbourhoods, run on tiles with a halo of one voxel."""
    v = views.volume(spark, sf_dir)
    shape = (v.agg(F.max("z")).first()[0] + 1, 32, 32)
    return halo.apply_tiled(v, shape, (5, 12, 32), (1, 1, 1), halo.neighbourhood(sum, (1, 1, 1)), "raw")


_CONTACTS = f"""SELECT least(a.r, b.r) AS a, greatest(a.r, b.r) AS b, CAST(sum(least(a.v, b.v)) AS BIGINT) AS total, count(*) AS n
FROM u a JOIN u b ON a.r <> b.r AND ((b.z = a.z + 1 AND b.y = a.y AND b.x = a.x) OR (b.z = a.z AND b.y = a.y + 1 AND b.x = a.x) OR (b.z = a.z AND b.y = a.y AND b.x = a.x + 1)) GROUP BY 1, 2"""
_FRAGMENTS = f"u AS MATERIALIZED (SELECT z, y, x, CAST(raw AS BIGINT) AS v, 1 + (z // 2) * 1000000 + (y // 4) * 1000 + x // 4 AS r FROM {VOLUME})"


def _fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small boxes as regions, the intensity as affinity."""
    region = 1 + F.floor(F.col("z") / 2) * 1_000_000 + F.floor(F.col("y") / 4) * 1000 + F.floor(F.col("x") / 4)
    return views.volume(spark, sf_dir).select("z", "y", "x", region.cast("long").alias("r"), F.col("raw").cast("long").alias("v"))


@query(f"WITH {_FRAGMENTS} {_CONTACTS}")
def region_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts of regions and the affinity across them."""
    return agglomerate.adjacency(_fragments(spark, sf_dir), "r", "v")


@query()
def affinity_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions contracted from the strongest contact on, down to a mean affinity of 33."""
    return agglomerate.contract(agglomerate.adjacency(_fragments(spark, sf_dir), "r", "v"), 33.0)


_NEAR = """n AS (SELECT q.vec_id AS id, c.vec_id AS neighbour, sqrt(list_sum(list_transform(list_zip(q.embedding, c.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ** 2))) AS distance
  FROM embeddings q, embeddings c),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS place FROM n) WHERE place <= 15 AND id <> neighbour)"""


@query(f"""WITH RECURSIVE {_NEAR}, l AS (SELECT id, list(distance ORDER BY distance) AS d, min(distance) FILTER (WHERE distance > 0) AS rho, count(*) AS k FROM t GROUP BY id),
b AS (SELECT id, d, coalesce(rho, 0) AS rho, k, 0.0::DOUBLE AS lo, 'inf'::DOUBLE AS hi, 1.0::DOUBLE AS s, false AS found, 0 AS step FROM l
  UNION ALL
  SELECT id, d, rho, k, CASE WHEN NOT hit AND psum <= log2(k + 1) THEN s ELSE lo END, CASE WHEN NOT hit AND psum > log2(k + 1) THEN s ELSE hi END,
    CASE WHEN hit THEN s WHEN psum > log2(k + 1) THEN (lo + s) / 2 WHEN isinf(hi) THEN s * 2 ELSE (s + hi) / 2 END, hit, step + 1
  FROM (SELECT *, found OR abs(psum - log2(k + 1)) < 1e-5 AS hit FROM (SELECT *, list_sum(list_transform(d, lambda x: exp(-greatest(x - rho, 0) / s))) AS psum FROM b WHERE step < 64))),
w AS (SELECT t.id, t.neighbour, exp(-greatest(distance - rho, 0) / greatest(s, 0.001 * list_sum(d) / (k + 1))) AS weight FROM t JOIN b ON b.id = t.id AND step = 64),
u AS (SELECT least(id, neighbour) AS a, greatest(id, neighbour) AS b, max(CASE WHEN id < neighbour THEN weight ELSE 0 END) AS p, max(CASE WHEN id > neighbour THEN weight ELSE 0 END) AS q FROM w GROUP BY 1, 2)
SELECT a, b, round(p + q - p * q, 4) AS weight FROM u""")
def fuzzy_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbour graph of the embeddings with a bandwidth for each point, both directions united."""
    near = knn.neighbours(views.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), 15).withColumn("distance", F.sqrt("distance"))
    graph = fuzzy.fuzzy_union(fuzzy.memberships(near))
    return graph.withColumn("weight", F.round("weight", 4))


# Display ----------------------------------------------------------------------------------------------


def _channel(n: int) -> str:
    k = f"(({n}.0::DOUBLE + (label * 0.61803398875::DOUBLE) % 1 * 6) % 6)"
    return f"(1 - 0.75::DOUBLE * greatest(0, least({k}, 4 - {k}, 1)))"


@query(f"""SELECT z, y, x, {', '.join(f"CASE WHEN raw >= 49 THEN 255 WHEN label > 0 THEN CAST(round_even(0.6::DOUBLE * raw + 0.4::DOUBLE * 255 * {_channel(n)}, 0) AS INT) ELSE CAST(raw AS INT) END AS {c}" for c, n in zip("rgb", (5, 3, 1)))} FROM {VOLUME}""")
def label_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours of labels over the intensity, the brightest voxels as white boundary."""
    out = display.overlay(views.volume(spark, sf_dir).withColumn("edge", F.col("raw") >= 49), "label", "raw", "edge")
    return out.select("z", "y", "x", "r", "g", "b")


@query(f"SELECT min(bx) - 2.5::DOUBLE AS x0, max(bx) + 2.5::DOUBLE AS x1, min(by_) - 2.5::DOUBLE AS y0, max(by_) + 2.5::DOUBLE AS y1 FROM {PTS}")
def detail_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window around all points, with a margin."""
    return display.strip(views.pts(spark, sf_dir).select(F.col("bx").alias("x"), F.col("by_").alias("y")), 2.5)


@query("""WITH n AS (SELECT p_partkey AS id, p_size - 25.0::DOUBLE AS nx, p_retailprice / 100 AS ny, p_partkey % 7 - 3.0::DOUBLE AS nz FROM part)
SELECT id, round(0.25::DOUBLE + 0.75::DOUBLE * abs(nx * 0.3::DOUBLE + ny * 0.4::DOUBLE + nz * 0.866::DOUBLE) / sqrt(nx * nx + ny * ny + nz * nz), 6) AS light FROM n""")
def lambert_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light on unit normals, either side."""
    n = views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") - 25.0).alias("x"), (F.col("p_retailprice") / 100).alias("y"), (F.col("p_partkey") % 7 - 3.0).alias("z"))
    size = F.sqrt(sum(F.col(a) * F.col(a) for a in "xyz"))
    return n.select("id", F.round(display.shade(*[F.col(a) / size for a in "xyz"]), 6).alias("light"))


@query("SELECT p_partkey AS id, CAST((row_number() OVER (ORDER BY p_partkey) - 1) // 6 AS INT) AS row, CAST((row_number() OVER (ORDER BY p_partkey) - 1) % 6 AS INT) AS column FROM part")
def contact_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of a contact sheet of six columns."""
    return camera.montage(views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id")), "id", 6)


@query("""WITH s AS (SELECT p_partkey AS position, CASE WHEN p_size < 3 THEN 'context' WHEN p_size > 48 THEN 'end' ELSE 'field' END AS kind FROM part)
SELECT coalesce((SELECT min(position) FROM s WHERE kind = 'field') > (SELECT max(position) FROM s WHERE kind = 'context') AND (SELECT max(position) FROM s WHERE kind = 'field') < (SELECT min(position) FROM s WHERE kind = 'end'), false) AS ok""")
def story_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all fields of a story stand between its context and its end."""
    kind = F.when(F.col("p_size") < 3, "context").when(F.col("p_size") > 48, "end").otherwise("field")
    return verify.in_order(views.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("position"), kind.alias("kind")), "field", "context", "end")

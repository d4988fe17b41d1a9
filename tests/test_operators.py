"""Known answers and invariants of the imaging operators on literal tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelspark.functions import scalars as S
from voxelspark.operators import boxes, camera, components, constraints, density, display, knn, labels, mesh, numbering, overlap, reconcile, resample, select, tiling, verify, workflow
from voxelspark.sources import arrays, documents, meshes
from voxelspark.streaming import stages

GRID, PATCH, WINDOWS = (2, 2, 4), (1, 2, 2), ((1, 1, 1), (1, 1, 2))


def voxels(spark, pred, truth):
    """Planes of nested lists as a voxel table."""
    p, t = np.atleast_3d(np.array(pred).T).T, np.atleast_3d(np.array(truth).T).T
    rows = [(*map(int, at), int(p[at]), int(t[at])) for at in np.ndindex(p.shape)]
    return spark.createDataFrame(rows, "z int, y int, x int, pred long, truth long")


def one(df):
    return df.first().asDict()


def test_axis_starts():
    assert tiling.axis_starts(11, 4, 3) == [0, 3, 6]
    assert tiling.axis_starts(11, 4, 3, "align_end") == [0, 3, 6, 7]
    assert tiling.axis_starts(11, 4, 3, "reflect") == [0, 3, 6, 9]
    with pytest.raises(ValueError):
        tiling.axis_starts(3, 4, 1)


def test_patches_and_windows(spark):
    assert tiling.patch_manifest(spark, (2, 4, 8), PATCH, PATCH).count() == 16
    c = tiling.candidate_windows(spark, GRID, WINDOWS, PATCH, PATCH)
    assert c.count() == 28 == sum(tiling.window_counts(GRID, WINDOWS))
    guard = spark.createDataFrame([(1, 2, 0, 4, 0, 8)], "z0 long, z1 long, y0 long, y1 long, x0 long, x1 long")
    assert boxes.without(c, guard).count() == 14
    with pytest.raises(ValueError):
        tiling.candidate_windows(spark, GRID, ((3, 1, 1),), PATCH, PATCH)


def test_recorded_geometry(spark):
    m = tiling.patch_manifest(spark, (256, 1024, 1024), (32, 128, 128), (16, 64, 64), "align_end")
    assert m.count() == 3375
    assert tiling.tile_plan(spark, (25, 260, 270), (12, 96, 96), (4, 16, 16)).count() == 27


def test_model_grid(spark):
    jobs = spark.createDataFrame([("j", "z", 320.0, 40.0), ("j", "y", 512.0, 16.0), ("j", "x", 20.0, 8.0)], "job string, axis string, extent double, target double")
    assert [r.cells for r in tiling.model_grid(jobs).orderBy(F.desc("extent")).collect()] == [32, 8, 2]


def test_greedy_coverage(spark):
    c = tiling.candidate_windows(spark, GRID, WINDOWS, PATCH, PATCH)
    members = tiling.membership(c, GRID)
    vectors = spark.createDataFrame([(i, [float(i // 8), float(i // 4 % 2), float(i % 4)]) for i in range(16)], "id long, embedding array<double>")
    near = knn.neighbours(vectors, 3).select("id", "neighbour")
    picks = select.greedy(c, members, near, budget=32, most=2).collect()
    assert len(picks) == 2 and picks[-1].spent <= 32 and picks[0].covered < picks[1].covered
    cells = [{r.patch_id for r in members.filter(F.col("ord") == p.ord).collect()} for p in picks]
    assert not cells[0] & cells[1]
    unit = spark.createDataFrame([(i, [float(i == j) for j in range(16)]) for i in range(16)], "id long, embedding array<double>")
    small = select.greedy(c, members, knn.neighbours(unit, 1).select("id", "neighbour"), budget=4, most=1).first()
    assert small.cost == 4
    with pytest.raises(ValueError):
        select.greedy(c, members, near, budget=1, most=1)
    r = select.running(spark.createDataFrame(picks), 32, 16).orderBy("rank").collect()
    assert [x.total_cost for x in r] == [p.spent for p in picks] and r[-1].rate == picks[-1].covered / 16


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_neighbours(spark, metric):
    rng = np.random.default_rng(0)
    e = rng.normal(size=(90, 6))
    e[50] = e[3]  # a tie: the smaller id first
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(e)], "id long, embedding array<double>")
    got = {}
    for r in knn.neighbours(df, 5, metric, block=32).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    u = e / np.linalg.norm(e, axis=1)[:, None]
    for i in range(90):
        d = np.square(e - e[i]).sum(1) if metric == "euclidean" else 1 - u @ u[i]
        assert got[i] == list(np.lexsort((np.arange(90), d.round(12)))[:5])
    with pytest.raises(ValueError):
        knn.neighbours(df, 91)


def test_foreground(spark):
    m = one(overlap.foreground_metrics(voxels(spark, [[0, 1], [0, 0]], [[0, 1], [0, 1]])))
    assert m["dice"] == pytest.approx(2 / 3) and m["iou"] == 0.5
    m = one(overlap.foreground_metrics(voxels(spark, [[0]], [[0]])))
    assert (m["dice"], m["iou"], m["precision"], m["recall"]) == (1, 1, 1, 1)
    m = one(overlap.foreground_metrics(voxels(spark, [[0]], [[1]])))
    assert (m["precision"], m["recall"]) == (0, 0)


def test_matching(spark):
    v = voxels(spark, [[1, 1, 0, 1, 1]], [[1, 1, 0, 2, 2]])
    pairs = overlap.pair_overlap(v)
    m = overlap.match_greedy(pairs, 0.5)
    assert [(r.pred, r.truth) for r in m.collect()] == [(1, 2)]
    s = one(overlap.match_scores(m, overlap.object_counts(v)))
    assert (s["tp"], s["fp"], s["fn"]) == (1, 0, 1) and s["f1"] == pytest.approx(2 / 3)
    same = voxels(spark, [[1, 1, 0, 2, 2]], [[1, 1, 0, 2, 2]])
    assert one(overlap.match_scores(overlap.match_greedy(overlap.pair_overlap(same), 0.5), overlap.object_counts(same)))["f1"] == 1
    with pytest.raises(ValueError):
        overlap.match_strict(pairs, 0.5)


def test_matching_is_the_sequential_one(spark):
    rng = np.random.default_rng(7)
    v = voxels(spark, rng.integers(0, 6, (3, 8, 8)), rng.integers(0, 5, (3, 8, 8)))
    pairs = overlap.pair_overlap(v)
    free, want = (set(), set()), []
    for r in sorted(pairs.collect(), key=lambda r: (-r.iou, -r.pred, -r.truth)):
        if r.pred not in free[0] and r.truth not in free[1]:
            free[0].add(r.pred)
            free[1].add(r.truth)
            want.append((r.pred, r.truth))
    assert sorted(want) == sorted((r.pred, r.truth) for r in overlap.match_greedy(pairs, 0.01).collect())


def test_labels(spark):
    box = np.zeros((4, 8, 8), int)
    box[:, 0:3, 0:3] = 1
    box[1:3, 5:7, 5:7] = 2
    v = voxels(spark, box, box).filter("pred > 0")
    q = one(labels.quality(v, (4, 8, 8)))
    assert (q["objects"], q["span_max"], q["border_objects"], q["size_min"], q["size_max"]) == (2, 4, 1, 8, 36)
    none = one(labels.quality(v.limit(0), (4, 8, 8)))
    assert none["objects"] == 0 and none["size_median"] == 0 and none["empty"]
    for axis, n, want in (("z", 6, 3), ("y", 8, 4), ("x", 10, 5)):
        planes = spark.range(n).select(F.col("id").cast("int").alias("plane"), F.lit(7).cast("long").alias("n"))
        assert labels.best_slice(planes, n).first().plane == want
        assert labels.best_slice(planes, n, centre=False).first().plane == 0
    assert labels.best_slice(planes.limit(0), 9).first().plane == 4
    bad = spark.createDataFrame([(1.0,), (-1.0,), (0.5,), (float("nan"),), (float("inf"),), (None,), (9.0,)], "v double")
    assert labels.invalid_labels(bad, "v", 8).count() == 6


def test_components_and_reconciliation(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(60, 50)], "a long, b long")
    found = {r.node: r.component for r in components.connected(spark.range(61).withColumnRenamed("id", "node"), edges).collect()}
    assert found[20] == 0 and found[40] == 21 and found[60] == 50 and found[55] == 55
    blocks = spark.createDataFrame([(b, 0, 0, x, l) for b, x, l in ((0, 0, 1), (0, 1, 1), (0, 2, 2), (1, 1, 5), (1, 2, 6), (1, 3, 6))], "block int, z int, y int, x int, label int")
    ids = reconcile.global_ids(blocks.select("block", "label").distinct(), reconcile.merge_edges(reconcile.block_overlaps(blocks)))
    assert sorted(map(tuple, ids.collect())) == [(0, 1, 1), (0, 2, 2), (1, 5, 1), (1, 6, 2)]


def test_density(spark):
    flat = spark.createDataFrame([(1.0,), (1.0,), (float("nan"),)], "v double")
    assert [r.scaled for r in density.normalised(flat, "v").collect()] == [0, 0, 0]
    ten = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    got = sorted(r.scaled for r in density.normalised(ten, "v").collect())
    assert got[0] == 0 and got[-1] == 1 and got[4] == pytest.approx((5 - 1.09) / (9.91 - 1.09))
    grid = spark.createDataFrame([(y, x, 3.0) for y in range(5) for x in range(6)], "by int, bx int, v double")
    assert all(r.blurred == pytest.approx(3) for r in density.blur(grid, "v", (5, 6), 0.8).collect())


def test_resample(spark):
    a = np.arange(2 * 3 * 5).reshape(2, 3, 5) + 1
    out = {(r.z, r.y, r.x): r.pred for r in resample.nearest(voxels(spark, a, a), a.shape, (3, 2, 7), ["pred"]).collect()}
    assert out == {(z, y, x): a[z * 2 // 3, y * 3 // 2, x * 5 // 7] for z in range(3) for y in range(2) for x in range(7)}
    line = spark.createDataFrame([(0, 0, x, float(x * x)) for x in range(4)], "z int, y int, x int, v double")
    got = [r.v for r in resample.linear(line, "v", "x", 4, 7).orderBy("x").collect()]
    assert got == pytest.approx([0, 0.5, 1, 2.5, 4, 6.5, 9])
    r = spark.createDataFrame([(0.5,), (1.5,), (300.0,), (-3.0,)], "v double").select(resample.clip_cast(F.col("v"), 0, 255).alias("c"))
    assert [x.c for x in r.collect()] == [0, 2, 255, 0]
    z = resample.patch_scaled(spark.createDataFrame([(1, i) for i in range(32)] + [(2, 4095)], "patch_id int, v int"))
    s = [x.scaled for x in z.filter("patch_id = 1").collect()]
    assert np.mean(s) == pytest.approx(0) and np.std(s) == pytest.approx(1) and not z.filter("patch_id = 2").first().ok


def cube(spark):
    v = [(i, 2.0 * (i & 1), 2.0 * (i >> 1 & 1), 2.0 * (i >> 2)) for i in range(8)]
    quads = [(0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3)]
    f = [t for a, b, c, d in quads for t in ((a, b, c), (a, c, d))]
    return spark.createDataFrame(v, "vid long, x double, y double, z double"), spark.createDataFrame([(i, *t) for i, t in enumerate(f)], "fid long, a long, b long, c long")


def test_mesh(spark, tmp_path):
    v, f = cube(spark)
    s = one(mesh.summary(f, v))
    assert (s["faces"], s["area"], s["orphans"], s["extent_x"], s["sound"]) == (12, 24, 0, 2, True)
    assert mesh.dangling(f.union(spark.createDataFrame([(12, 0, 1, 99)], f.schema)), v).count() == 1
    n = mesh.normals(f, v).collect()
    assert all(math.isclose(r.nx**2 + r.ny**2 + r.nz**2, 1, abs_tol=1e-9) for r in n)
    text = "\n".join(r.value for r in meshes.ply_lines(v, f).orderBy("line").collect())
    (tmp_path / "c.ply").write_text(text + "\n")
    v2, f2 = meshes.read(spark, str(tmp_path / "c.ply"))
    assert sorted(v2.collect()) == sorted(v.collect()) and sorted(f2.collect()) == sorted(f.collect())
    both = mesh.merged(v.withColumn("mesh", F.lit(0)).unionByName(v.withColumn("mesh", F.lit(1))), f.withColumn("mesh", F.lit(0)).unionByName(f.withColumn("mesh", F.lit(1))))
    assert both[0].select("vid").distinct().count() == 16 and both[1].agg(F.max("a")).first()[0] > 7
    seen = mesh.pixels(f, v, 4, 4)
    assert seen.count() == 9 and seen.agg(F.max("depth")).first()[0] == pytest.approx(0)


def test_camera(spark):
    s = camera.segments(spark, [(100000.0, 200000.0), (500000.0, 350000.0)], 200000.0, (300000.0, 275000.0, 1.4, 4.0), 3.0, 2.0, 0.35)
    p = camera.poses(s, 24.0).orderBy("frame").collect()
    assert len(p) == 12 * 24 and p[0].fov == pytest.approx(280000) and [r.frame for r in p] == list(range(288))
    assert p[7 * 24 - 1].x == 100000 and p[7 * 24].x == pytest.approx(100000, abs=0.1) and max(r.fov for r in p if r.kind == "move") == pytest.approx(270000)
    states = spark.createDataFrame([(0, "a", 1.65), (1, "b", 1.7)], "position int, name string, seconds double")
    t = camera.timeline(states, 24.0).orderBy("position").collect()
    assert [(r.first, r.last, r.mid) for r in t] == [(0, 39, 19), (48, 88, 68)]


def test_review(spark):
    p = spark.createDataFrame([("a",), ("b",), ("c",)], "candidate_id string")
    d = spark.createDataFrame([("a", "accept", None), ("b", "reject", " "), ("d", "accept", None)], "candidate_id string, decision string, reason string")
    assert dict(map(tuple, workflow.review(p, d).collect())) == {"a": "accept", "b": "reject", "c": "missing", "d": "extra"}
    with pytest.raises(ValueError):
        workflow.finalize(p, d)
    ok = spark.createDataFrame([("a", "accept", None), ("b", "reject", "blurred"), ("c", "accept", None)], d.schema)
    assert workflow.finalize(p, ok).count() == 3


def test_rules(spark):
    row = ("p", [12, 96, 96], [20, 128, 128], [4, 16, 16], 0.25, "a" * 40, "b" * 64)
    bad = ("q", [30, 96, 96], [20, 128, 128], [10, 16, 16], 1.5, "main", None)
    df = spark.createDataFrame([row, bad], "name string, core array<int>, patch array<int>, halo array<int>, beta double, commit string, digest string")
    found = {r.rule for r in constraints.violations(df, constraints.tile_rules(), "name").collect()}
    assert found == {"core_in_patch", "halo_under_half", "beta", "commit", "digest"}
    with pytest.raises(ValueError):
        constraints.enforce(df, constraints.tile_rules(), "name")
    u = spark.createDataFrame([("https://a.org/x",), ("https://u:p@a.org/x",), ("https://a.org/x?k=1",), ("ftp://a.org",)], "u string")
    assert [r[0] for r in u.select(S.plain_url(F.col("u"))).collect()] == [True, False, False, False]
    t = spark.createDataFrame([("1, 2,3",), ("1,2",), ("a,1,2",), ("0,1,2",)], "t string")
    assert [r[0] for r in t.select(S.triplet(F.col("t"))).collect()] == [[1.0, 2.0, 3.0], None, None, None]


def test_array_source(spark, tmp_path):
    a = np.arange(60, dtype=np.uint16).reshape(3, 4, 5)
    np.save(tmp_path / "a.npy", a)
    df = arrays.read(spark, str(tmp_path / "a.npy"), slab="1")
    assert df.count() == 60 and df.filter("z = 2 AND y = 1 AND x = 3").first().value == a[2, 1, 3]
    assert arrays.read(spark, str(tmp_path / "a.npy"), dropZero="true").count() == 59
    np.savez(tmp_path / "two.npz", labels=a, other=a)
    assert arrays.read(spark, str(tmp_path / "two.npz"), arrayKey="labels").count() == 60
    with pytest.raises(Exception):
        arrays.read(spark, str(tmp_path / "two.npz")).count()
    arrays.write_chunks(df, str(tmp_path / "chunks"), (2, 3, 2))
    back = spark.read.parquet(str(tmp_path / "chunks"))
    assert back.count() == 60 and back.select("cz", "cy", "cx").distinct().count() == 2 * 2 * 3
    with pytest.raises(Exception):
        arrays.write_chunks(df, str(tmp_path / "chunks"), (2, 3, 2))
    assert arrays.infer_format("s3://x/y.zarr/") == "zarr" and arrays.infer_format("a.npy", "tiff") == "tiff"


def test_documents(spark, tmp_path):
    assert documents.digest({"b": 1, "a": [1]}) == documents.digest({"a": [1], "b": 1})
    documents.write(str(tmp_path / "d.json"), {"a": 1})
    with pytest.raises(FileExistsError):
        documents.write(str(tmp_path / "d.json"), {})
    assert documents.overlaid({"a": {"x": 1, "y": 2}, "b": 1}, {"a": {"x": 5}}) == {"a": {"x": 5, "y": 2}, "b": 1}
    assert documents.checksums(spark, str(tmp_path)).count() == 1
    ids = spark.createDataFrame([("10", "b"), ("9", "a")], "id string, name string")
    assert '"ids":["9","10"]' in documents.segment_properties(ids).first().json


def test_streams(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    events = spark.read.parquet(src)
    events.limit(200).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = stages.windowed(stream).writeStream.outputMode("complete").format("memory").queryName("windows").start()
    q.processAllAvailable()
    q.stop()
    batch = stages.windowed(spark.read.parquet(str(tmp_path / "in")))
    seen = lambda df: sorted(map(str, df.select(F.col("start").cast("string"), "event_type", "n").collect()))
    assert seen(spark.table("windows")) == seen(batch)
    q = stream.writeStream.foreachBatch(stages.keep_latest(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(str(tmp_path / "in")).select("user_id", "event_type").distinct().count()


def test_windows_by_true_starts(spark):
    """Boxes end where the mode puts the last patch; the recorded counts of windows come out."""
    c = tiling.candidate_manifest(spark, (11, 4, 4), (4, 4, 4), (3, 4, 4), ((1, 1, 1), (2, 1, 1)), "align_end", (30.0, 6.0, 6.0))
    got = {r.candidate_id: (r.z0, r.z1, r.cost, r.nm_z1) for r in c.collect()}
    assert got["sv-s00-1x1x1-0003-0000-0000"] == (7, 11, 64, 330.0) and got["sv-s01-2x1x1-0002-0000-0000"] == (6, 11, 80, 330.0) and len(got) == 7
    r = tiling.candidate_manifest(spark, (11, 4, 4), (4, 4, 4), (3, 4, 4), ((1, 1, 1),), "reflect").orderBy("ord").collect()
    assert [(x.z0, x.z1) for x in r] == [(0, 4), (3, 7), (6, 10), (9, 11)]
    big = tiling.candidate_manifest(spark, (256, 1024, 1024), (32, 128, 128), (16, 64, 64), ((2, 2, 2), (3, 3, 3)), "align_end")
    assert {x.size_id: x["count"] for x in big.groupBy("size_id").count().collect()} == {0: 14**3, 1: 13**3}


def test_boxes_meet_by_cell(spark):
    rng = np.random.default_rng(4)
    def some(n, size):
        low = rng.integers(0, 60, (n, 3))
        return spark.createDataFrame([tuple(int(v) for a, s in zip(p, rng.integers(1, size, 3), strict=True) for v in (a, a + s)) for p in low], "z0 long, z1 long, y0 long, y1 long, x0 long, x1 long")
    b, g = some(120, 9), some(40, 30)
    few, many = (sorted(map(tuple, boxes.without(b, g, n).collect())) for n in (1000, 3))
    assert few == many and 0 < len(few) < 120


def test_long_chains_and_many_picks(spark):
    """Matching a chain of 400 pairs and choosing 40 windows take no growing plans."""
    rng = np.random.default_rng(2)
    rows = [(i // 2 + 1, (i + 1) // 2 + 1, 1, float(v)) for i, v in enumerate(rng.permutation(400) / 500 + 0.1)]
    pairs, free, want = spark.createDataFrame(rows, "pred long, truth long, n long, iou double"), (set(), set()), []
    for p, t, _, _ in sorted(rows, key=lambda r: (-r[3], -r[0], -r[1])):
        if p not in free[0] and t not in free[1]:
            free[0].add(p)
            free[1].add(t)
            want.append((p, t))
    assert sorted((r.pred, r.truth) for r in overlap.match_greedy(pairs, 0.05).collect()) == sorted(want)
    short = spark.createDataFrame([r for r in rows if r[0] <= 8 or r[0] > 190], pairs.schema)
    split = overlap.match_greedy(short, 0.05, most=18)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, overlap.match_greedy(short, 0.05).collect()))
    c = tiling.candidate_windows(spark, (1, 8, 8), ((1, 1, 1),), PATCH, PATCH)
    near = spark.range(64).select("id", F.col("id").alias("neighbour"))
    picks = select.greedy(c, tiling.membership(c, (1, 8, 8)), near, budget=10_000, most=40)
    assert [r.ord for r in picks.orderBy("rank").collect()] == list(range(40))


def test_order_over_parts(spark):
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=500), 2)
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,), (float("nan"),), (float("inf"),)], "v double")
    assert numbering.quantiles(df, "v", [0, 0.01, 0.37, 0.5, 1]) == pytest.approx(np.quantile(v, [0, 0.01, 0.37, 0.5, 1]))
    assert numbering.quantiles(df.limit(0), "v", [0.5]) == [None]
    n = numbering.numbered(spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k")), ["k"], "place", first=1).collect()
    assert all(r.place == r.k + 1 for r in n) and len(n) == 1000
    assert numbering.numbered(spark.range(0), ["id"], "place").count() == 0


def test_box_borders(spark):
    a = np.arange(20.0).reshape(4, 5)
    d = spark.createDataFrame([(0, y, x, float(a[y, x])) for y in range(4) for x in range(5)], "z int, y int, x int, v double")
    for border, mode in (("zero", "constant"), ("reflect", "symmetric")):
        p = np.pad(a, 1, mode=mode)
        for r in density.box_mean(d, "v", 1, border, (4, 5)).collect():
            w = p[r.y : r.y + 3, r.x : r.x + 3]
            assert r["mean"] == pytest.approx(w.mean()) and r["std"] == pytest.approx(w.std())


def test_files_and_commands(spark, tmp_path):
    import sys

    df = spark.createDataFrame([(2, 2.5), (0, 1.0), (1, -1.0)], "i int, v double")
    arrays.write_npy(df, str(tmp_path / "v.npy"), ["i", "v"], "i")
    assert np.load(tmp_path / "v.npy").tolist() == [[0, 1], [1, -1], [2, 2.5]]
    with pytest.raises(FileExistsError):
        arrays.write_npy(df, str(tmp_path / "v.npy"), ["v"], "i")
    with pytest.raises((ImportError, FileNotFoundError)):
        arrays.read(spark, str(tmp_path / "x.tif"))
    (tmp_path / "s.json").write_text('{"a": 1}')
    assert documents.read_settings(str(tmp_path / "s.json")) == {"a": 1}
    out = tmp_path / "made.txt"
    argv = [sys.executable, "-c", f"open({str(out)!r}, 'w').write('x'); print('said')"]
    assert workflow.executed(argv, [str(out)], str(tmp_path / "run"))["status"] == "completed"
    assert (tmp_path / "run" / "stdout.txt").read_text().strip() == "said"
    with pytest.raises(FileExistsError):
        workflow.executed(argv, [str(out)], str(tmp_path / "run"))
    with pytest.raises(RuntimeError):
        workflow.executed([sys.executable, "-c", "raise SystemExit(3)"], [], str(tmp_path / "run2"))
    with pytest.raises(ValueError):
        labels.selected(df, "i", [7])
    with pytest.raises(ValueError):
        labels.plane_slice(df, "xy", (3, 1, 1), 5)
    many = "\n".join(["ply", "format ascii 1.0", *[f"comment {i}" for i in range(90)], "element vertex 3", "property float x", "element face 1", "end_header", "0 0 0", "1 0 0", "0 1 0", "3 0 1 2", ""])
    (tmp_path / "m.ply").write_text(many)
    v, f = meshes.read(spark, str(tmp_path / "m.ply"))
    assert v.count() == 3 and f.first().asDict() == {"fid": 0, "a": 0, "b": 1, "c": 2}


def test_scalars(spark):
    one_row = spark.range(1)
    at = lambda c: one_row.select(c.alias("c")).first().c
    for kind in ("linear", "smoothstep", "smootherstep", "cosine"):
        v = [at(S.ease(F.lit(u), kind)) for u in (-1.0, 0.0, 0.25, 0.5, 0.75, 1.0, 2.0)]
        assert v[:2] == [0, 0] and v[-2:] == pytest.approx([1, 1]) and v == sorted(v) and v[3] == pytest.approx(0.5)
    assert at(S.ladder_125(F.lit(1000.0))) == 200 and at(S.ceil_div(F.lit(7), 3)) == 3 and at(S.short_number(F.lit(2.5))) == "2.5" and at(S.short_number(F.lit(10.0))) == "10"
    assert at(S.truth(F.lit(" Yes "))) is True and at(S.truth(F.lit("maybe"))) is None and at(S.secret_key(F.lit("API_KEY"))) is True


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_verify(spark):
    b = verify.sample_boxes(spark, (3, 4, 5), (3, 2, 5)).orderBy("place").collect()
    assert [(r.z0, r.y0, r.y1, r.x1) for r in b] == [(0, 0, 2, 5), (0, 1, 3, 5), (0, 2, 4, 5)]
    assert verify.sample_boxes(spark, (2, 2, 2), (4, 4, 4)).count() == 1
    rng = np.random.default_rng(0)
    image = rng.random((16, 24))
    frames = [image, np.roll(image, (2, -3), (0, 1)), np.roll(image, (2, -3), (0, 1))]
    df = spark.createDataFrame([(f, y, x, float(a[y, x])) for f, a in enumerate(frames) for y in range(16) for x in range(24)], "frame long, y int, x int, v double")
    assert sorted(map(tuple, verify.frame_shift(df, 16, 24).collect())) == [(1, 2, -3), (2, 0, 0)]
    assert {r.frame: r.mae for r in verify.frame_difference(df).collect()}[2] == 0
    states = spark.createDataFrame([(0, "overlay"), (1, "density"), (2, "move")], "position int, kind string")
    assert verify.in_order(states, "density", "overlay", "move").first().ok and not verify.in_order(states, "move", "overlay", "density").first().ok


def test_display(spark):
    px = spark.createDataFrame([(0, 100, False), (3, 100, False), (3, 100, True)], "label int, grey int, edge boolean")
    got = [(r.r, r.g, r.b) for r in display.overlay(px, "label", "grey", "edge").collect()]
    assert got[0] == (100, 100, 100) and got[2] == (255, 255, 255) and len(set(got[1])) > 1
    p = [r.c for r in spark.createDataFrame([(0.0,), (50.0,), (500.0,)], "v double").select(display.window(F.col("v"), 0, 100).alias("c")).collect()]
    assert p == [0, 127, 255]
    v = display.rotated(cube(spark)[0], 0.0, math.pi / 2).collect()
    assert all(r.ry == pytest.approx(-r.z) and r.rz == pytest.approx(r.y) for r in v)


def test_a_long_chain_is_matched_in_few_rounds(spark, monkeypatch):
    """Overlaps that rise along a chain took a round a link; blocks settle all but their ends."""
    rounds, plain = [], overlap._round
    monkeypatch.setattr(overlap, "_round", lambda *a: rounds.append(1) or plain(*a))
    rng = np.random.default_rng(4)
    chain = [(i // 2 + 1, (i + 1) // 2 + 1, 1, (i + 1) / 1000) for i in range(600)]
    some = sorted({(int(p), int(t)) for p, t in rng.integers(1, 40, (400, 2))})
    mixed = [(p, t, 1, float(rng.integers(1, 6)) / 10) for p, t in some]
    for rows, most in ((chain, 100), (mixed, 60)):
        free, want = (set(), set()), []
        for p, t, _, _ in sorted(rows, key=lambda r: (-r[3], -r[0], -r[1])):
            if p not in free[0] and t not in free[1]:
                free[0].add(p)
                free[1].add(t)
                want.append((p, t))
        rounds.clear()
        got = overlap.match_greedy(spark.createDataFrame(rows, "pred long, truth long, n long, iou double"), 0.0005, most=most)
        assert sorted((r.pred, r.truth) for r in got.collect()) == sorted(want)
        assert len(rounds) <= 12


def test_neighbours_of_copies_and_odd_values(spark):
    """Many copies, values that a single precision does not hold apart, and values that are not finite."""
    rng = np.random.default_rng(6)
    grid = rng.integers(0, 3, (700, 3)).astype(float)
    grid[:40] += 1000
    grid[40:80] = 1e6 + rng.random((40, 3)) * 1e-3
    for odd in (False, True):
        if odd:
            grid[650, 1], grid[651, 0], grid[652, 2] = np.nan, np.inf, 1e200
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(grid)], "id long, embedding array<double>")
        with np.errstate(all="ignore"):
            far = np.square(grid[:, None] - grid[None]).sum(2)
        want = {(i, p + 1): int(c) for i in range(700) for p, c in enumerate(np.lexsort((np.arange(700), far[i]))[:12])}
        for block in (200, knn.BLOCK):
            assert {(r.id, r.place): r.neighbour for r in knn.neighbours(rows, 12, block=block).collect()} == want


def test_each_block_of_neighbours_is_a_task_of_its_own(spark):
    """Blocks dealt by a hash shared tasks, and others had none: every row is sent to as many as the cores."""
    rows = spark.range(4096).select("id", F.array(*[F.rand(i) for i in range(4)]).alias("embedding"))
    assert knn._parts(rows, 4096, knn.BLOCK) == 4 and knn._parts(rows, 720_000, knn.BLOCK) == 12
    near = knn.neighbours(rows, 3)
    assert near.count() == 3 * 4096


def test_nearest_mip_of_a_row_is_the_joined_choice(spark):
    rows = [(n, t, [(m, 3.0 * 2**m) for m in range(4)]) for n, t in enumerate((1.0, 3.0, 3 * 2**0.5, 7.0, 20.0, 99.0))]
    table = spark.createDataFrame(rows, "name long, target double, mips array<struct<mip:int,resolution:double>>")
    each = table.select("name", F.explode("mips").alias("m")).select("name", "m.mip", "m.resolution")
    for finer in (False, True):
        want = {(r.name, r.mip, r.resolution) for r in resample.choose_mip(each, table.select("name", "target"), finer).select("name", "mip", "resolution").collect()}
        got = table.select("name", resample.nearest_mip(F.col("mips"), F.col("target"), finer).alias("m"))
        assert {(r.name, r.m.mip, r.m.resolution) for r in got.collect()} == want

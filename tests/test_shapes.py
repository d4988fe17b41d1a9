"""Surfaces, stored volumes, tiles, contraction, keyed state and neighbour graphs on known answers."""

import datetime
import itertools
import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelspark import views
from voxelspark.operators import agglomerate, boxes, camera, components, fuzzy, halo, knn, surface, workflow
from voxelspark.plans import catalogue
from voxelspark.sources import precomputed
from voxelspark.streaming import runs

VOXEL = "z int, y int, x int, label long"


def grid(spark, array, name="value", kind="long"):
    at = np.nonzero(array)
    rows = [(*map(int, p), array[p].item()) for p in zip(*at, strict=True)]
    return spark.createDataFrame(rows, f"z int, y int, x int, {name} {kind}")


# Surfaces ---------------------------------------------------------------------------------------------


def test_every_case_is_closed_towards_the_next_cell():
    """The edges that a mask's triangles leave open lie on the cell's sides, and are those of its neighbours."""
    for mask in range(256):
        edges = {}
        for t in surface.triangles(mask):
            assert len(set(t)) == 3
            for p, q in zip(t, t[1:] + t[:1], strict=True):
                edges[p, q] = edges.get((p, q), 0) + 1
        assert all(n == 1 for n in edges.values())
        for p, q in edges:
            if (q, p) not in edges:
                assert any(p[k] == q[k] and p[k] in (0, 2) for k in range(3))


def test_surface_of_simple_shapes(spark):
    ball = np.zeros((9, 9, 9), np.int64)
    place = np.indices(ball.shape) - 4
    ball[(place**2).sum(axis=0) <= 9] = 1
    ring = np.zeros_like(ball)
    ring[4, 2:7, 2:7] = 2
    ring[4, 4, 4] = 0
    one = np.zeros_like(ball)
    one[0, 0, 8] = 3
    for array, label, euler in ((ball, 1, 2), (ring, 2, 0), (one, 3, 2)):
        faces = surface.surface(grid(spark, array, "label"))
        m = surface.measures(faces).first()
        assert (m.label, m.open_edges, m.euler) == (label, 0, euler) and m.edges * 2 == m.faces * 3
        assert faces.select("fid").distinct().count() == m.faces
    # A voxel alone: the eight cells around it hold 24 tetrahedra that each cut an eighth of a sixth off.
    assert m.volume == pytest.approx(24 / 48) and surface.vertices(faces).agg(F.min("z"), F.max("x")).first() == (-0.5, 8.5)
    scaled = surface.measures(faces, (3.0, 1.0, 2.0)).first()
    assert scaled.volume == pytest.approx(6 * m.volume)


def test_parts_weld_by_the_names_of_their_vertices(spark):
    pick = np.random.default_rng(4)
    array = pick.integers(0, 3, (6, 7, 8))
    whole = surface.surface(grid(spark, array, "label"))
    halves = []
    for low, high in ((0, 3), (3, 6)):  # each part has the planes of its cells
        part = grid(spark, array, "label").filter(F.col("z").between(low - 1, high))
        cells = surface.cells(part).filter((F.col("z") >= low) | (F.lit(low) == 0)).filter((F.col("z") < high) | (F.lit(high) == 6))
        halves.append(cells)
    assert sorted(map(tuple, halves[0].union(halves[1]).collect())) == sorted(map(tuple, surface.cells(grid(spark, array, "label")).collect()))
    assert surface.measures(whole).agg(F.sum("open_edges")).first()[0] == 0


def _rows(frame):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in frame.collect())


@pytest.mark.parametrize(("shape", "labels", "size"), [((5, 6, 7), 3, (1.0, 1.0, 1.0)), ((3, 4, 130), 2, (30.0, 6.5, 4.0)), ((2, 2, 63), 2, (2.0, 3.0, 5.0))])
def test_cells_alone_measure_as_their_faces_do(spark, shape, labels, size):
    """Also where rows of bits end: a row has 62 cells, the first from -1."""
    array = np.random.default_rng(8).integers(0, labels, shape)
    array[:, :, 60:64] = np.minimum(array[:, :, 60:64], 1)
    array[0, 0, ::61] = 1
    voxels = grid(spark, array, "label")
    cells = surface.cells(voxels.union(voxels.limit(9)))
    wide, brute = np.pad(array, 1), []
    for label in range(1, labels):
        mask = np.zeros([n + 1 for n in shape], int)
        for i, d in enumerate(itertools.product((0, 1), repeat=3)):
            mask |= (wide[tuple(slice(o, o + n + 1) for o, n in zip(d, shape, strict=True))] == label).astype(int) << i
        brute += [(label, *(int(v) - 1 for v in p), int(mask[p])) for p in zip(*np.nonzero((mask > 0) & (mask < 255)), strict=True)]
    assert sorted(map(tuple, cells.collect())) == sorted(brute)
    faces = surface.surface(voxels)
    assert _rows(surface.cell_measures(cells, size)) == _rows(surface.measures(faces, size))
    assert _rows(surface.cell_vertices(cells, size, (4, 5, 6))) == _rows(surface.vertices(faces, size, (4, 5, 6)))


def test_no_mask_leaves_an_edge_open():
    for mask in range(1, 255):
        assert surface.counts(mask)[3] == 0
    # A voxel alone, as eight cells hold it.
    assert [sum(c) for c in zip(*[surface.counts(1 << i) for i in range(8)], strict=True)] == [24, 14, 36, 0]


@pytest.mark.parametrize("name", ["surface_measures", "surface_vertices", "surface_of_merged"])
def test_surfaces_hold_no_table_of_cells_or_edges(spark, name):
    """No grouping has more groups than the volume has voxels, though the surfaces have many more edges."""
    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = catalogue.QUERIES[name](spark, sf)
        frame.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    groups, left = [], [frame._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        left += [node.children().apply(i) for i in range(node.children().size())]
        if "Aggregate" in node.nodeName():
            groups.append(node.metrics().apply("numOutputRows").value())
    assert 0 < max(groups) <= views.volume(spark, sf).count()


def test_surface_refuses(spark):
    with pytest.raises(Exception, match="not in 0"):
        surface.surface(spark.createDataFrame([(-1, 0, 0, 1)], VOXEL)).count()
    voxels = spark.createDataFrame([(0, 0, 0, 1)], VOXEL)
    for ids in ([], [0, 1], [7]):
        with pytest.raises(ValueError):
            surface.merged(voxels, ids)
    assert surface.surface(voxels.filter("label = 0")).count() == 0


# Stored volumes ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("dtype", ["uint32", "uint64"])
def test_compressed_segmentation(dtype):
    pick = np.random.default_rng(1)
    top = 1 << (31 if dtype == "uint32" else 62)
    for shape, block, labels in (((1, 1, 1), (8, 8, 8), 1), ((5, 9, 17), (2, 4, 8), 3), ((8, 8, 8), (8, 8, 8), 500), ((20, 33, 40), (16, 16, 16), 4096), ((4, 4, 4), (3, 3, 3), 2), ((66, 66, 66), (66, 66, 66), 70_000)):
        names = pick.integers(0, top, labels).astype(dtype)
        array = names[pick.integers(0, labels, shape)]
        packed = precomputed.encode_labels(array, block)
        assert (precomputed.decode_labels(packed, shape, block, f"<{dtype[0]}{int(dtype[4:]) // 8}") == array).all()
    assert len(precomputed.encode_labels(np.full((64, 64, 64), 7, dtype), (8, 8, 8))) < 512 * 8 + 20


def test_a_block_written_by_hand():
    """Two channels' worth of header words, one block of 2 x 1 x 1 with labels 5 and 9, one bit each."""
    words = np.array([1, (3 | 1 << 24), 2, 0b10, 5, 9], "<u4")
    assert precomputed.decode_labels(words.tobytes(), (1, 1, 2), (1, 1, 2), "<u4").tolist() == [[[5, 9]]]


def test_chunk_numbers():
    counts = (5, 3, 1)
    numbers = [precomputed.morton(p, counts) for p in itertools.product(*map(range, counts))]
    assert len(set(numbers)) == 15 and max(numbers) < 1 << 5
    assert [precomputed.morton(p, (4, 4, 4)) for p in ((1, 0, 0), (0, 1, 0), (0, 0, 1), (2, 0, 0), (3, 3, 3))] == [1, 2, 4, 8, 63]
    assert len({precomputed.murmur(i) for i in range(5000)}) == 5000 and all(0 <= precomputed.murmur(i) < 1 << 64 for i in (0, 1, (1 << 64) - 1))


HOW = [
    {"encoding": "raw"}, {"block": (2, 4, 8)}, {"sharding": precomputed.sharded_by(0, 0, packed=False)}, {"sharding": precomputed.sharded_by(3, 2, preshift=1)},
    {"encoding": "raw", "sharding": precomputed.sharded_by(1, 3, scrambled=True)},
]


@pytest.mark.parametrize("how", HOW)
def test_stored_volumes_are_read_back(spark, tmp_path, how):
    pick = np.random.default_rng(2)
    array = pick.integers(0, 4, (7, 13, 21)) * (1 << 40)
    array[:, :6, 8:] = 0  # chunks without a voxel
    offset, voxels = (10, 0, 5), grid(spark, array).select(F.col("z") + 10, "y", F.col("x") + 5, "value").toDF("z", "y", "x", "value")
    path = f"file:{tmp_path}/v"
    assert precomputed.write(voxels, path, array.shape, (3, 6, 8), (30, 4, 4), offset=offset, **how) > 0
    whole = np.full(array.shape, -1)
    for r in precomputed.scan(spark, path).collect():
        whole[r.z - 10, r.y, r.x - 5] = r.value
    assert (whole == array).all()
    for box in ([(11, 13), (5, 7), (6, 20)], [(0, 99), (12, 13), (25, 99)], [(0, 5), (0, 5), (0, 5)]):
        got = {(r.z, r.y, r.x): r.value for r in precomputed.scan(spark, path, box=box).collect()}
        want = {(z, y, x): array[z - 10, y, x - 5] for z in range(10, 17) for y in range(13) for x in range(5, 26) if all(a <= c < b for c, (a, b) in zip((z, y, x), box, strict=True))}
        assert got == want
        sparse = {(r.z, r.y, r.x): r.value for r in precomputed.scan(spark, path, box=box, drop_zero=True).collect()}
        assert sparse == {k: v for k, v in want.items() if v}
    with pytest.raises(FileExistsError):
        precomputed.write(voxels, path, array.shape, (3, 6, 8), (30, 4, 4))
    assert not [f for f in tmp_path.rglob(".*") if f.is_file() and not f.name.endswith(".crc")]


def test_only_the_needed_ranges_are_read(spark, tmp_path):
    """What other chunks of a shard hold may be spoilt: a box does not open them."""
    array = np.arange(1, 513).reshape(8, 8, 8)
    path = f"{tmp_path}/v"
    precomputed.write(grid(spark, array), path, array.shape, (4, 4, 4), (1, 1, 1), encoding="raw", sharding=precomputed.sharded_by(0, 1, packed=False))
    (shard,) = (tmp_path / "v" / "1_1_1").glob("*.shard")
    content, front = bytearray(shard.read_bytes()), 16 * 2
    s = precomputed.store(json.loads((tmp_path / "v" / "info").read_text()), path)
    with open(shard, "rb") as f:
        places = {k: v for m in (0, 1) for k, v in precomputed._minishard(f, s, m).items()}
    assert len(places) == 8 and min(a for a, _ in places.values()) == front
    for number, (start, size) in places.items():
        if number != precomputed.morton((1, 0, 0), (2, 2, 2)):
            content[start : start + size] = b"\xff" * size
    shard.write_bytes(bytes(content))
    got = precomputed.scan(spark, path, box=[(0, 4), (0, 4), (4, 8)]).collect()
    assert {(r.z, r.y, r.x): r.value for r in got} == {p: array[p] for p in itertools.product(range(4), range(4), range(4, 8))}


def test_unreadable_stores():
    scale = {"key": "k", "size": [1, 1, 1], "chunk_sizes": [[1, 1, 1]], "resolution": [1, 1, 1], "encoding": "raw"}
    for change, top in (({"encoding": "jpeg"}, {}), ({}, {"num_channels": 2}), ({"encoding": "compressed_segmentation"}, {"data_type": "uint8"}), ({"sharding": precomputed.sharded_by(1, 1) | {"hash": "other"}}, {})):
        with pytest.raises(ValueError):
            precomputed.store({"num_channels": 1, "data_type": "uint64", "scales": [scale | change]} | top, "/nowhere")


# Tiles ------------------------------------------------------------------------------------------------


def test_tiles_do_not_matter(spark):
    pick = np.random.default_rng(3)
    array = pick.integers(0, 5, (6, 9, 11)).astype(float)
    array[2:5, 3:8] = 0
    voxels = grid(spark, array, kind="double")
    for reach, reduce in (((1, 1, 1), sum), ((0, 2, 1), lambda m: np.max(m, axis=0)), ((1, 0, 0), lambda m: np.median(m, axis=0))):
        run = halo.neighbourhood(reduce, reach)
        for tile in ((6, 9, 11), (1, 4, 5), (2, 9, 3)):
            out = np.zeros(array.shape)
            for r in halo.apply_tiled(voxels, array.shape, tile, reach, run).collect():
                out[r.z, r.y, r.x] = r.value
            assert (out == run(array)).all()
    dense = halo.apply_tiled(voxels.limit(0), (2, 3, 4), (2, 2, 2), (0, 0, 0), lambda b: b + 1, sparse=False)
    assert dense.count() == 24 and dense.agg(F.min("value"), F.max("value")).first() == (1, 1)
    with pytest.raises(Exception, match="outside the shape"):
        halo.apply_tiled(voxels, (2, 2, 2), (2, 2, 2), (0, 0, 0), lambda b: b).count()


# Components -------------------------------------------------------------------------------------------


def flood(array):
    out, seen = {}, set()
    for p in zip(*np.nonzero(array), strict=True):
        p = tuple(map(int, p))
        if p in seen:
            continue
        stack, found = [p], {p}
        while stack:
            q = stack.pop()
            for k, s in itertools.product(range(3), (-1, 1)):
                r = tuple(c + s * (i == k) for i, c in enumerate(q))
                if r not in found and all(0 <= c < n for c, n in zip(r, array.shape, strict=True)) and array[r] == array[p]:
                    found.add(r)
                    stack.append(r)
        seen |= found
        first = min(found)
        out |= {q: first[0] << 42 | first[1] << 21 | first[2] for q in found}
    return out


def test_voxel_components(spark):
    pick = np.random.default_rng(6)
    snake = np.zeros((3, 12, 12), np.int64)
    for row in range(0, 12, 2):
        snake[1, row] = 5
        snake[1, row + 1, 11 if row % 4 == 0 else 0] = 5
    for array, block in ((pick.integers(0, 3, (5, 9, 10)), (2, 4, 3)), (pick.integers(0, 2, (6, 6, 6)), (6, 6, 6)), (snake, (1, 3, 3))):
        got = components.voxel_components(grid(spark, array, "label"), block=block)
        assert {(r.z, r.y, r.x): r.component for r in got.collect()} == flood(array)
    assert components.voxel_components(spark.createDataFrame([], VOXEL)).count() == 0


# Contraction ------------------------------------------------------------------------------------------


def one_after_the_other(edges, beta):
    edges, names = {(a, b): (t, n) for a, b, t, n in edges}, {r: r for a, b, _, _ in edges for r in (a, b)}
    while edges:
        (a, b), (t, n) = min(edges.items(), key=lambda e: (-e[1][0] / e[1][1], e[0]))
        if t / n <= beta:
            break
        names = {r: a if i == b else i for r, i in names.items()}
        after = {}
        for (p, q), (u, m) in edges.items():
            p, q = (a if x == b else x for x in (p, q))
            if p != q:
                key = min(p, q), max(p, q)
                v, k = after.get(key, (0, 0))
                after[key] = v + u, k + m
        edges = after
    return names


def test_contraction_equals_one_edge_after_the_other(spark):
    pick = random.Random(8)
    for regions, ways in ((12, 25), (30, 60), (9, 36)):
        pairs = {tuple(sorted(pick.sample(range(1, regions + 1), 2))) for _ in range(ways)}
        edges = [(a, b, pick.randint(0, 60), pick.randint(1, 4)) for a, b in pairs]
        table = spark.createDataFrame(edges, "a long, b long, total long, n long")
        before = None
        for beta in (2.0, 9.5, 20.0):
            got = {r.region: r.instance for r in agglomerate.contract(table, beta).collect()}
            assert got == one_after_the_other(edges, beta)
            if before:  # what a higher beta joins, a lower one joins
                assert all(before[a] == before[b] for a, b in itertools.combinations(got, 2) if got[a] == got[b])
            before = got


def test_contraction_in_blocks_takes_ties_in_order(spark):
    """Few different strengths: edges of one strength touch, over the blocks' borders too."""
    pick = random.Random(3)
    for regions, ways in ((14, 30), (40, 80)):
        pairs = {tuple(sorted(pick.sample(range(1, regions + 1), 2))) for _ in range(ways)}
        edges = [(a, b, pick.randint(0, 6), pick.randint(1, 3)) for a, b in pairs]
        table, want = spark.createDataFrame(edges, "a long, b long, total long, n long"), one_after_the_other(edges, 0.5)
        assert {r.region: r.instance for r in agglomerate.contract(table, 0.5).collect()} == want
        assert {r.region: r.instance for r in agglomerate.contract(table, 0.5, block=12).collect()} == want


def test_instances_of_two_slabs(spark):
    array = np.ones((2, 4, 6), np.int64)
    array[:, :, 3:] = 2
    array[:, 2:, :3] = 3
    strong = np.full(array.shape, 200)
    strong[:, :, 3] = 10
    cells = [(z, y, x, int(array[z, y, x]), int(strong[z, y, x])) for z, y, x in np.ndindex(array.shape)]
    voxels = spark.createDataFrame([*cells, (9, 9, 9, 7, 1), (9, 9, 8, 0, 1)], "z int, y int, x int, r long, v int")
    edges = {(e.a, e.b): (e.total, e.n) for e in agglomerate.adjacency(voxels, "r", "v").collect()}
    assert edges == {(1, 2): (40, 4), (2, 3): (40, 4), (1, 3): (1200, 6)}
    for beta, want in ((100, {1: 1, 2: 2, 3: 1, 7: 7, 0: 0}), (9, {1: 1, 2: 1, 3: 1, 7: 7, 0: 0})):
        assert {r.r: r.instance for r in agglomerate.instances(voxels, "r", "v", beta).collect()} == want
    swept = agglomerate.sweep(agglomerate.adjacency(voxels, "r", "v"), [250, 9, 100]).collect()
    assert [tuple(r) for r in swept] == [(9.0, 1, 3), (100.0, 2, 3), (250.0, 3, 3)]


# Keyed state ------------------------------------------------------------------------------------------


def test_runs_of_a_stream_and_a_table(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    at = lambda m: start + datetime.timedelta(minutes=m)
    files = [
        [(1, 1, at(0), "a"), (1, 2, at(20), "b"), (2, 3, at(10), "a"), (None, 4, at(5), "x"), (1, 5, None, "x")],
        [(1, 2, at(20), "b"), (1, 6, at(12), "a"), (2, 7, at(45), None), (1, 8, at(100), "c")],  # repeated, out of order
        [(1, 9, at(2), "late"), (2, 10, at(300), "z")],
        [(3, 11, at(1000), "end")],
    ]
    schema = "key long, id long, ts timestamp, status string"
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
        out = runs.stream_runs(stream, 30, "15 minutes").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
        out.option("path", str(tmp_path / "runs")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "runs")).select("key", "start", "end", "records", "changes", "last").collect())
    want = [(1, at(0), at(20), 3, 1, "b"), (1, at(100), at(100), 1, 0, "c"), (2, at(10), at(10), 1, 0, "a"), (2, at(45), at(45), 1, 0, ""), (2, at(300), at(300), 1, 0, "z")]
    assert got == want
    whole = spark.createDataFrame([r for f in files for r in f if r[3] != "late"], schema)
    table = sorted(tuple(r) for r in runs.batch_runs(whole, 30).collect())
    assert table == sorted([*want, (3, at(1000), at(1000), 1, 0, "end")])


class Held:
    """State of one key in memory, which counts the calls."""

    def __init__(self):
        self.calls, self.timers, self.kept = 0, set(), {}

    def getListState(self, name, schema):
        return State(self, name)

    getValueState = getListState

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.remove(ms)


class State:
    def __init__(self, held, name):
        self.held, self.name = held, name

    def _of(self, value=None, clear=False):
        self.held.calls += 1
        if clear:
            self.held.kept.pop(self.name, None)
        elif value is not None:
            self.held.kept[self.name] = value
        return self.held.kept.get(self.name)

    def exists(self):
        return self._of() is not None

    def get(self):
        return self._of() or []

    def update(self, value):
        self._of(value)

    put = update

    def appendValue(self, value):
        self._of([*self.held.kept.get(self.name, []), value])

    def appendList(self, values):
        self._of([*self.held.kept.get(self.name, []), *values])

    def clear(self):
        self._of(clear=True)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_runs_of_many_keys_take_few_calls_of_the_state(spark):
    """Keys share a bucket: runs are those of the whole table, whatever the batches, and what the state
    is asked for doesn't grow with keys or records."""
    pick, keys, minute = np.random.default_rng(5), 400, 60_000_000
    n = 12_000
    whole = pd.DataFrame({"key": pick.integers(0, keys, n), "at": pick.integers(1, 3000, n) * minute + pick.integers(0, 3, n), "id": np.arange(n) % 5, "status": pick.choice(["a", "b", ""], n)})
    held, out, passed, batches = Held(), [], 0, 0
    state = runs.Runs(30 * 60_000)
    state.init(held)
    for end in [*range(250, 3001, 250), 9000]:
        now = whole[(whole["at"] > passed * 1000) & (whole["at"] < end * minute)]
        rows = pd.concat([now, now[::3]])  # what waits, and comes again
        list(state.handleInputRows((0,), iter([rows[:1000], rows[1000:]]), Clock(passed)))
        # As the engine does: the watermark moves on, then timers before it expire, with no later record yet.
        passed = end * 60_000 - 7 * 60_000
        for due in sorted(t for t in held.timers if t < passed):
            out += list(state.handleExpiredTimer((0,), Clock(passed), due))
            held.timers.discard(due)
        batches += 1
    assert held.calls < 20 * batches and not held.timers and not {k for k in held.kept if held.kept[k]}
    got = sorted(tuple(r) for r in pd.concat(out)[["key", "start", "end", "records", "changes", "last"]].itertuples(index=False))
    table = spark.createDataFrame(whole).select("key", "id", F.timestamp_micros("at").alias("ts"), "status")
    want = runs.batch_runs(table, 30).withColumns({c: F.unix_micros(c) for c in ("start", "end")})
    assert got == sorted(tuple(r) for r in want.collect())


def test_stream_of_records_without_id_in_another_zone(spark, tmp_path):
    """Instants stay what they are in any session's zone, and ids of a batch with nulls stay whole numbers."""
    big = 2**60
    rows = [(1, None, 1, "z"), (1, big + 1, 1, "b"), (1, big, 1, "a"), (1, big, 1, "a"), (2, 7, 99 * 60_000_000, "end")]
    log = spark.createDataFrame(rows, "key long, id long, us long, status string").select("key", "id", F.timestamp_micros("us").alias("ts"), "status")
    log.coalesce(1).write.parquet(str(tmp_path / "log"))
    change = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.session.timeZone": "America/New_York"}
    before = {key: spark.conf.get(key) for key in change}
    for key, value in change.items():
        spark.conf.set(key, value)
    try:
        found = runs.stream_runs(spark.readStream.schema(log.schema).parquet(str(tmp_path / "log")), 30, "15 minutes", buckets=3)
        out = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "runs"))
        out.trigger(availableNow=True).start().awaitTermination()
        got = spark.read.parquet(str(tmp_path / "runs")).select("key", F.unix_micros("start"), F.unix_micros("end"), "records", "changes", "last").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert [tuple(r) for r in got] == [(1, 1, 1, 3, 2, "b")]


# Neighbour graphs -------------------------------------------------------------------------------------


def test_bandwidths():
    pick = np.random.default_rng(9)
    d = np.sort(pick.random((50, 14)) + 0.1, axis=1)
    nearest, sigma = fuzzy.bandwidths(d)
    assert (nearest == d[:, 0]).all()
    assert np.abs(np.exp(-(d - d[:, :1]) / sigma[:, None]).sum(axis=1) - np.log2(15)).max() < 2e-5
    nearest, sigma = fuzzy.bandwidths(np.array([[0.0, 0.0, 0.0], [0.0, 2.0, 3.0]]))
    assert nearest.tolist() == [0, 2] and np.isfinite(sigma).all()


def test_fuzzy_graph(spark):
    near = [(1, 1, 1, 0.0), (1, 2, 2, 1.0), (1, 3, 3, 2.0), (2, 1, 2, 0.0), (2, 2, 1, 1.0), (2, 3, 3, 1.0), (3, 1, 3, 0.0), (3, 2, 2, 1.0), (3, 3, 1, 2.0)]
    directed = fuzzy.memberships(spark.createDataFrame(near, "id long, place int, neighbour long, distance double"))
    w = {(r.id, r.neighbour): r.weight for r in directed.collect()}
    assert w[1, 2] == w[2, 1] == w[2, 3] == w[3, 2] == 1 and 0 < w[1, 3] < 1
    graph = {(r.a, r.b): r.weight for r in fuzzy.fuzzy_union(directed).collect()}
    assert graph == {(1, 2): 1, (2, 3): 1, (1, 3): pytest.approx(w[1, 3] + w[3, 1] - w[1, 3] * w[3, 1])}


# Tours ------------------------------------------------------------------------------------------------


def test_tour_of_a_table_is_that_of_a_list(spark):
    stops = [(1.0, 2.0), (5.0, 3.0), (4.0, 9.0)]
    table = spark.createDataFrame([(i, *s) for i, s in enumerate(stops)], "position long, x double, y double")
    for entry in (None, (0.0, 1.0, 1.4, 2.5)):
        a = camera.segments(spark, stops, 10.0, entry, 3.0, 2.0, 0.35)
        b = camera.tour(table, 10.0, entry, 3.0, 2.0, 0.35)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))
    assert camera.tour(table.limit(0), 10.0, None, 3.0, 2.0, 0.35).count() == 0


# Boxes and picks --------------------------------------------------------------------------------------


def test_boxes_by_broadcast_and_by_cell(spark):
    pick = random.Random(12)
    sides = [tuple(v for _ in range(3) for a in [pick.randint(-5, 20)] for v in (a, a + pick.randint(1, 9))) for _ in range(60)]
    schema = "id int, " + ", ".join(f"{a}{e} int" for a in "zyx" for e in "01")
    table = spark.createDataFrame([(i, *s) for i, s in enumerate(sides)], schema)
    left, right = table.filter("id < 30"), table.filter("id >= 30")
    points = spark.createDataFrame([(z, y, x, z * y) for z in range(-4, 20, 3) for y in range(-4, 20, 5) for x in range(-4, 20, 4)], "z int, y int, x int, v int")
    touch = lambda a, b: all(a[2 * k] < b[2 * k + 1] and b[2 * k] < a[2 * k + 1] for k in range(3))
    want = {(i, j) for i in range(30) for j in range(30, 60) if touch(sides[i], sides[j])}
    held = {(p.z, p.y, p.x, i) for p in points.collect() for i, s in enumerate(sides) if all(s[2 * k] <= p[k] < s[2 * k + 1] for k in range(3))}
    for few in (10_000, 0):
        assert sorted(map(tuple, boxes.pairs(left, right, few).collect())) == sorted(want)
        got = boxes.within(points, table, few)
        assert got.columns == ["z", "y", "x", "v", *table.columns]
        assert sorted((r.z, r.y, r.x, r.id) for r in got.collect()) == sorted(held)


def test_picked_betas(spark):
    rows = spark.createDataFrame([(0.1, "a"), (0.1 + 5e-13, "b"), (0.1 + 3e-12, "c"), (0.3, "d"), (-0.2, "e"), (None, "f")], "beta double, name string")
    picks = spark.createDataFrame([(0.1,), (0.1,), (-0.2 - 9e-13,), (None,)], "beta double")
    assert sorted(r.name for r in workflow.chosen(rows, picks).collect()) == ["a", "b", "e"]
    with pytest.raises(ValueError):
        workflow.sweep(rows, spark.range(workflow.FEW + 1), F.lit("x"), F.lit("y"))


# Neighbours by pivots ---------------------------------------------------------------------------------


def test_pruned_neighbours(spark):
    pick = np.random.default_rng(10)
    clusters = [pick.normal(size=4) * 50 for _ in range(12)]
    x = np.concatenate([c + pick.normal(size=(25, 4)) for c in clusters])
    x[40], x[41], x[7] = x[3], x[3], x[299]  # copies, which are ties
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")
    for metric, k, pivots, block in (("euclidean", 6, 12, 10), ("euclidean", 40, 5, 1000), ("cosine", 4, 9, 7), ("euclidean", 300, 3, 50)):
        got, visits = knn.pruned(table, k, metric, pivots, block)
        want = knn.neighbours(table, k, metric)
        rows = lambda d: sorted((r.id, r.place, r.neighbour) for r in d.collect())
        assert rows(got) == rows(want)
        share = visits.agg(F.sum("visited") / F.sum("blocks"), F.max("visited"), F.count("*")).first()
        assert share[1] <= visits.first().blocks and share[2] == 300
        if (metric, k) == ("euclidean", 6):
            assert share[0] < 0.5
    with pytest.raises(ValueError):
        knn.pruned(table, 301)

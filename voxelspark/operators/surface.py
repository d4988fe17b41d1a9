"""Closed surfaces of labelled objects by marching tetrahedra.

Cells of 2 x 2 x 2 voxel centres are looked up by the mask of their corners that an object holds in a
table of triangles.  The table follows from one rule: a cell is cut into the six tetrahedra along its
diagonal, which meet those of the next cells face to face, and each is crossed by one triangle or two.
A vertex is the middle of a grid edge between a voxel in the object and one outside, and that edge is
its name.  So parts of a volume need no welding: wherever a face is made, its vertices have the names
that the next part gives them.  Voxels not in the table are outside, so surfaces are closed.

Coordinates count from the corner of the region, up to ``LIMIT`` on an axis.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Voxels of an axis: three doubled coordinates, or three coordinates and a triangle's number, are 63 bits.
LIMIT = (1 << 19) - 3
_BITS = 20
_AXES = "zyx"
#: Cells of a row of bits; it holds one voxel more, and a long has 63 bits besides its sign.
_ROW = 62


def tetrahedra() -> list[list[tuple[int, int, int]]]:
    """The corners of the six tetrahedra: a path from the first to the last corner for each order of the axes."""
    out = []
    for order in itertools.permutations(range(3)):
        path = [(0, 0, 0)]
        for axis in order:
            path.append(tuple(c + (i == axis) for i, c in enumerate(path[-1])))
        out.append(path)
    return out


def _outward(points: list[tuple], away: list[float]) -> list[tuple]:
    """The triangle's corners, turned so that its normal looks along ``away``."""
    u, v = ([p - q for p, q in zip(points[i], points[0], strict=True)] for i in (1, 2))
    normal = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    turned = sum(n * a for n, a in zip(normal, away, strict=True)) < 0
    return [points[0], points[2], points[1]] if turned else points


def triangles(mask: int) -> list[list[tuple[int, int, int]]]:
    """Triangles of a cell, their corners (z, y, x) in half cells; bit 4z + 2y + x says that corner is inside.
    Seen from outside they run against the clock in (x, y, z)."""
    out = []
    for corners in tetrahedra():
        sides = ([], [])
        for c in corners:
            sides[mask >> (4 * c[0] + 2 * c[1] + c[2]) & 1].append(c)
        outside, inside = sides
        if not outside or not inside:
            continue
        middle = [tuple(a + b for a, b in zip(i, o, strict=True)) for i in inside for o in outside]
        away = [sum(c[k] for c in outside) / len(outside) - sum(c[k] for c in inside) / len(inside) for k in range(3)]
        flats = [middle] if len(middle) == 3 else [[middle[0], middle[1], middle[3]], [middle[0], middle[3], middle[2]]]
        # The axes are z, y, x here, which turns the sense of a normal.
        out += [_outward(t, away)[::-1] for t in flats]
    return out


def case_table(spark: SparkSession) -> DataFrame:
    """(mask, triangles): a corner is 9z + 3y + x in half cells, a triangle three of them in base 27."""
    code = lambda p: 9 * p[0] + 3 * p[1] + p[2]
    rows = [(m, [code(a) * 729 + code(b) * 27 + code(c) for a, b, c in triangles(m)]) for m in range(1, 255)]
    return spark.createDataFrame(rows, "mask int, triangles array<int>")


def counts(mask: int) -> tuple[int, int, int, int]:
    """(faces, vertices, edges, open edges) that a cell adds to those of its object.  Cells share vertices
    and edges; the cell counts the vertices on grid edges from its first corner, the edges inside it and
    those on its first sides.  There the cells before it have the same four corners, so what they make on
    the side is known; an edge is open unless two faces have it, once each way round."""
    corner = list(itertools.product((0, 1), repeat=3))
    made = triangles(mask)
    ways = [(p, q) for t in made for p, q in zip(t, t[1:] + t[:1], strict=True) if not any(a == b == 2 for a, b in zip(p, q, strict=True))]
    for k in range(3):
        before = sum(1 << 4 * c[0] + 2 * c[1] + c[2] + (4 >> k) for c in corner if not c[k] and mask >> 4 * c[0] + 2 * c[1] + c[2] & 1)
        for t in triangles(before):
            moved = [tuple(v - 2 * (i == k) for i, v in enumerate(p)) for p in t]
            ways += [(p, q) for p, q in zip(moved, moved[1:] + moved[:1], strict=True) if p[k] == q[k] == 0]
    edges = {(min(w), max(w)) for w in ways}
    open_ = sum(not ways.count((p, q)) == ways.count((q, p)) == 1 for p, q in edges)
    return len(made), sum((mask ^ mask >> d) & 1 for d in range(1, 8)), len(edges), open_


def _packed(axes: Sequence[Column], bits: int) -> Column:
    out = F.lit(0).cast("long")
    for a in axes:
        out = F.shiftleft(out, bits).bitwiseOR(a.cast("long"))
    return out


def cells(voxels: DataFrame, label: str = "label") -> DataFrame:
    """(label, z, y, x, mask): the cells that an object holds some corners of, and not all; a cell has
    the coordinates of its first corner, from -1.

    Voxels are put together as bits of rows along x, the rows as the four that meet in a row of cells,
    and masks are read off them, so a table of groups holds rows and not cells.  Bit j of row k is the
    voxel at ``k * _ROW - 1 + j``; the last bit is the first one of the next row, which its last cell needs.
    """
    sound = F.lit(True)
    for a in _AXES:
        sound = sound & F.col(a).between(0, LIMIT)
    x = F.when(sound, F.col("x")).otherwise(F.raise_error(F.lit(f"a coordinate is not in 0 .. {LIMIT}")).cast("int"))
    inside = voxels.filter(F.col(label) != 0).select(F.col(label).alias("label"), *[F.col(a).cast("int").alias(a) for a in "zy"], (x.cast("int") + 1).alias("c"))
    row, last = F.floor(F.col("c") / _ROW).cast("int"), F.lit(1 << _ROW)
    held = F.array(F.struct(row.alias("k"), F.expr(f"shiftleft(1L, c % {_ROW})").alias("bits")))
    both = F.when((F.col("c") % _ROW == 0) & (F.col("c") > 0), F.concat(held, F.array(F.struct((row - 1).alias("k"), last.alias("bits"))))).otherwise(held)
    rows = inside.select("label", "z", "y", F.inline(both)).groupBy("label", "z", "y", "k").agg(F.bit_or("bits").alias("bits"))

    beside = list(itertools.product((0, 1), repeat=2))
    steps = F.explode(F.array(*[F.struct(F.lit(dz).alias("z"), F.lit(dy).alias("y"), F.lit(i).alias("i")) for i, (dz, dy) in enumerate(beside)]))
    near = rows.select("label", "z", "y", "k", "bits", steps.alias("o")).select("label", *[(F.col(a) - F.col(f"o.{a}")).alias(a) for a in "zy"], "k", "bits", F.col("o.i").alias("i"))
    four = near.groupBy("label", "z", "y", "k").agg(*[F.bit_or(F.when(F.col("i") == i, F.col("bits")).otherwise(F.lit(0).cast("long"))).alias(f"r{i}") for i in range(len(beside))])

    mask = F.expr(" | ".join(f"shiftleft(shiftright(r{i}, j) & 3L, {2 * i})" for i in range(len(beside)))).cast("int")
    each = four.select("*", F.explode(F.sequence(F.lit(0), F.lit(_ROW - 1))).alias("j"))
    return each.select("label", "z", "y", (F.col("k") * _ROW - 1 + F.col("j")).alias("x"), mask.alias("mask")).filter("mask BETWEEN 1 AND 254")


def surface(voxels: DataFrame, label: str = "label") -> DataFrame:
    """(label, fid, a, b, c): the triangles of every object's surface.  ``fid`` is the object's own; a
    vertex is named by its grid edge, alike for all objects and parts of a volume."""
    held = cells(voxels, label).join(F.broadcast(case_table(voxels.sparkSession)), "mask")
    each = held.select("label", *_AXES, F.posexplode("triangles").alias("i", "t"))

    def vertex(code: Column) -> Column:
        offset = {"z": F.floor(code / 9), "y": F.floor(code / 3) % 3, "x": code % 3}
        return _packed([2 * (F.col(a) + 1) + offset[a] for a in _AXES], _BITS)

    corner = [F.floor(F.col("t") / 729), F.floor(F.col("t") / 27) % 27, F.col("t") % 27]
    fid = F.shiftleft(_packed([F.col(a) + 1 for a in _AXES], _BITS - 1), 4).bitwiseOR(F.col("i").cast("long"))
    return each.select("label", fid.alias("fid"), *[vertex(c).alias(n) for c, n in zip(corner, "abc", strict=True)])


def merged(voxels: DataFrame, ids: Sequence[int], label: str = "label") -> DataFrame:
    """The voxels of all these labels as one object, label 1; labels that no voxel has are an error."""
    if not ids or 0 in ids:
        raise ValueError("one or more labels other than 0 are needed")
    chosen = voxels.filter(F.col(label).isin([int(i) for i in ids]))
    if not chosen.limit(1).count():
        raise ValueError("no voxel has one of these labels")
    return chosen.select(*_AXES, F.lit(1).cast("long").alias("label"))


def coordinate(vid: Column, axis: str) -> Column:
    """A vertex' place on an axis, in voxels."""
    shift = {"z": 2 * _BITS, "y": _BITS, "x": 0}[axis]
    return F.shiftright(vid, shift).bitwiseAND(F.lit((1 << _BITS) - 1)) / 2 - 1


def _placed(used: DataFrame, resolution: Sequence[float], offset: Sequence[float]) -> DataFrame:
    at = {a: ((coordinate(F.col("vid"), a) + float(o)) * float(r)).alias(a) for a, r, o in zip(_AXES, resolution, offset, strict=True)}
    return used.select("label", "vid", at["x"], at["y"], at["z"])


def vertices(faces: DataFrame, resolution: Sequence[float] = (1.0, 1.0, 1.0), offset: Sequence[float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """(label, vid, x, y, z): the vertices that an object's faces use, at (voxel + offset) * resolution,
    both in order z, y, x."""
    return _placed(faces.select("label", F.explode(F.array("a", "b", "c")).alias("vid")).distinct(), resolution, offset)


def cell_vertices(held: DataFrame, resolution: Sequence[float] = (1.0, 1.0, 1.0), offset: Sequence[float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """The same from all cells of whole objects: the cell at a grid edge's first corner gives its vertex,
    so none is given twice and no table of them is held."""
    ends = [(d, _packed([2 * (F.col(a) + 1) + o for a, o in zip(_AXES, c, strict=True)], _BITS)) for d, c in enumerate(itertools.product((0, 1), repeat=3)) if d]
    cut = F.array(*[F.when(F.col("mask").bitwiseXOR(F.shiftright("mask", d)).bitwiseAND(F.lit(1)) == 1, vid) for d, vid in ends])
    return _placed(held.select("label", F.explode(cut).alias("vid")).filter("vid IS NOT NULL"), resolution, offset)


def measures(faces: DataFrame, resolution: Sequence[float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """(label, faces, vertices, edges, open_edges, euler, area, volume).

    An edge is open unless two faces have it, once each way round.  The volume is that within the
    surface, the sum of the tetrahedra from the origin.  Names hold coordinates, so nothing is joined.
    Faces from anywhere will do, parts and open ones too; ``cell_measures`` does whole objects with less.
    """
    p = {c: {a: coordinate(F.col(c), a) * float(r) for a, r in zip(_AXES, resolution, strict=True)} for c in "abc"}
    u, v = ({a: p[c][a] - p["a"][a] for a in _AXES} for c in "bc")
    n = {"x": u["y"] * v["z"] - u["z"] * v["y"], "y": u["z"] * v["x"] - u["x"] * v["z"], "z": u["x"] * v["y"] - u["y"] * v["x"]}
    area = F.sqrt(sum(n[a] * n[a] for a in _AXES)) / 2
    solid = sum(n[a] * p["a"][a] for a in _AXES) / 6
    whole = faces.groupBy("label").agg(F.count("*").alias("faces"), F.sum(area).alias("area"), F.sum(solid).alias("volume"))
    points = vertices(faces).groupBy("label").agg(F.count("*").alias("vertices"))
    ways = F.explode(F.array(*[F.struct(F.least(s, t).alias("low"), F.greatest(s, t).alias("high"), F.when(F.col(s) < F.col(t), 1).otherwise(-1).alias("way")) for s, t in ("ab", "bc", "ca")]))
    edges = faces.select("label", ways.alias("e")).groupBy("label", "e.low", "e.high").agg(F.count("*").alias("n"), F.sum("e.way").alias("way"))
    open_ = F.when((F.col("n") != 2) | (F.col("way") != 0), 1).otherwise(0)
    edges = edges.groupBy("label").agg(F.count("*").alias("edges"), F.sum(open_).alias("open_edges"))
    both = whole.join(points, "label").join(edges, "label")
    return both.select("label", "faces", "vertices", "edges", "open_edges", (F.col("vertices") - F.col("edges") + F.col("faces")).alias("euler"), "area", "volume")


def cell_measures(held: DataFrame, resolution: Sequence[float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """The same as ``measures`` of the faces, from all cells of whole objects.

    What a cell adds depends on its mask alone, but for the volume, which also takes its place times the
    sum of its faces' normals.  So cells are counted by mask, with sums of their coordinates: a task
    holds 254 rows a label, and neither faces nor edges are made.  Half voxels keep the volume whole
    numbers to the end.
    """
    rows, size = [], [float(r) for r in resolution]
    for mask in range(1, 255):
        area, solid, normals = 0.0, 0, [0, 0, 0]
        for a, b, c in triangles(mask):
            u, v = ([q - p for p, q in zip(a, d, strict=True)] for d in (b, c))
            # The axes are z, y, x here, which turns the sense of a normal.
            n = [u[2] * v[1] - u[1] * v[2], u[0] * v[2] - u[2] * v[0], u[1] * v[0] - u[0] * v[1]]
            area += math.hypot(*[m * size[k - 1] * size[k - 2] / 4 for k, m in enumerate(n)]) / 2
            solid += sum(m * p for m, p in zip(n, a, strict=True))
            normals = [s + m for s, m in zip(normals, n, strict=True)]
        rows.append((mask, *counts(mask), area, solid, *[2 * m for m in normals]))
    names = ("faces", "vertices", "edges", "open_edges")
    table = held.sparkSession.createDataFrame(rows, f"mask int, {', '.join(f'{n} long' for n in names)}, area double, solid long, nz long, ny long, nx long")
    many = held.groupBy("label", "mask").agg(F.count("*").alias("n"), *[F.sum(F.col(a).cast("long")).alias(a) for a in _AXES]).join(F.broadcast(table), "mask")
    solid = F.col("n") * F.col("solid") + sum(F.col(a) * F.col(f"n{a}") for a in _AXES)
    out = many.groupBy("label").agg(*[F.sum(F.col("n") * F.col(c)).alias(c) for c in (*names, "area")], F.sum(solid).alias("solid"))
    volume = F.col("solid") * (math.prod(size) / 48)
    return out.select("label", *names, (F.col("vertices") - F.col("edges") + F.col("faces")).alias("euler"), "area", volume.alias("volume"))

"""Triangle meshes as tables vertex(vid, x, y, z) and face(fid, a, b, c)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelspark.operators.numbering import running_totals


def corners(face: DataFrame, vertex: DataFrame) -> DataFrame:
    """Faces with the coordinates of their corners, xa .. zc."""
    out = face
    for c in "abc":
        out = out.join(vertex.select(F.col("vid").alias(c), *[F.col(x).alias(f"{x}{c}") for x in "xyz"]), c)
    return out


def _cross() -> list[Column]:
    u = {x: F.col(f"{x}b") - F.col(f"{x}a") for x in "xyz"}
    v = {x: F.col(f"{x}c") - F.col(f"{x}a") for x in "xyz"}
    return [u["y"] * v["z"] - u["z"] * v["y"], u["z"] * v["x"] - u["x"] * v["z"], u["x"] * v["y"] - u["y"] * v["x"]]


def areas(face: DataFrame, vertex: DataFrame) -> DataFrame:
    """(fid, area)."""
    n = _cross()
    return corners(face, vertex).select("fid", (F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2]) / 2).alias("area"))


def summary(face: DataFrame, vertex: DataFrame) -> DataFrame:
    """One row: faces, vertices, orphans, area, extent of each axis, and whether it is sound."""
    used = face.select(F.explode(F.array("a", "b", "c")).alias("vid")).distinct()
    v = vertex.agg(F.count("*").alias("vertices"), *[(F.max(c) - F.min(c)).alias(f"extent_{c}") for c in "xyz"])
    o = vertex.join(used, "vid", "left_anti").agg(F.count("*").alias("orphans"))
    a = areas(face, vertex).agg(F.count("*").alias("faces"), F.sum("area").alias("area"))
    out = a.join(F.broadcast(v)).join(F.broadcast(o))
    flat = (F.col("extent_x") == 0) | (F.col("extent_y") == 0) | (F.col("extent_z") == 0)
    return out.withColumn("sound", (F.col("orphans") == 0) & ~flat)


def dangling(face: DataFrame, vertex: DataFrame) -> DataFrame:
    """Faces that name a vertex that isn't there."""
    named = face.select("fid", F.explode(F.array("a", "b", "c")).alias("vid"))
    return named.join(vertex, "vid", "left_anti").select("fid").distinct()


def normals(face: DataFrame, vertex: DataFrame) -> DataFrame:
    """(vid, nx, ny, nz): each face's area vector added at its corners, unit length."""
    n = _cross()
    vectors = corners(face, vertex).select(F.explode(F.array("a", "b", "c")).alias("vid"), *[c.alias(f"n{x}") for c, x in zip(n, "xyz", strict=True)])
    s = vectors.groupBy("vid").agg(*[F.sum(f"n{x}").alias(f"n{x}") for x in "xyz"])
    size = F.greatest(F.sqrt(F.col("nx") * F.col("nx") + F.col("ny") * F.col("ny") + F.col("nz") * F.col("nz")), F.lit(1e-12))
    return s.select("vid", *[(F.col(f"n{x}") / size).alias(f"n{x}") for x in "xyz"])


def merged(meshes: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """vertices (mesh, vid, ...), faces (mesh, fid, a, b, c), ids 0.. in each mesh -> one mesh with
    ids shifted by the vertices of the meshes before."""
    n = meshes.groupBy("mesh").agg(F.count("*").alias("n"))
    shift = running_totals(n, ["mesh"], {"end": "n"}).select("mesh", (F.col("end") - F.col("n")).alias("shift"))
    v = meshes.join(shift, "mesh").withColumn("vid", F.col("vid") + F.col("shift")).drop("shift", "mesh")
    f = faces.join(shift, "mesh")
    for c in "abc":
        f = f.withColumn(c, F.col(c) + F.col("shift"))
    return v, f.drop("shift")


def to_nm(vertex: DataFrame, resolution, offset) -> DataFrame:
    """Voxel coordinates (x, y, z) as nanometres."""
    for a, r, o in zip("xyz", resolution, offset, strict=True):
        vertex = vertex.withColumn(a, (F.col(a) + o) * r)
    return vertex


def pixels(face: DataFrame, vertex: DataFrame, width: int, height: int) -> DataFrame:
    """Orthographic view along z: (px, py, fid, depth) of the face seen at each pixel.  Faces are
    opened to the pixels of their box, tested by barycentric weights, and the nearest is kept."""
    c = corners(face, vertex)
    box = lambda f, a, n, g: g(f(*[F.col(f"{a}{k}") for k in "abc"])).cast("int")
    c = c.withColumn("x0", F.greatest(box(F.least, "x", width, F.floor), F.lit(0))).withColumn("x1", F.least(box(F.greatest, "x", width, F.ceil), F.lit(width - 1)))
    c = c.withColumn("y0", F.greatest(box(F.least, "y", height, F.floor), F.lit(0))).withColumn("y1", F.least(box(F.greatest, "y", height, F.ceil), F.lit(height - 1)))
    c = c.filter((F.col("x0") <= F.col("x1")) & (F.col("y0") <= F.col("y1")))
    p = c.withColumn("px", F.explode(F.sequence("x0", "x1"))).withColumn("py", F.explode(F.sequence("y0", "y1")))
    den = (F.col("yb") - F.col("yc")) * (F.col("xa") - F.col("xc")) + (F.col("xc") - F.col("xb")) * (F.col("ya") - F.col("yc"))
    safe = F.when(den == 0, None).otherwise(den)
    w0 = ((F.col("yb") - F.col("yc")) * (F.col("px") - F.col("xc")) + (F.col("xc") - F.col("xb")) * (F.col("py") - F.col("yc"))) / safe
    w1 = ((F.col("yc") - F.col("ya")) * (F.col("px") - F.col("xc")) + (F.col("xa") - F.col("xc")) * (F.col("py") - F.col("yc"))) / safe
    p = p.withColumn("w0", w0).withColumn("w1", w1).withColumn("w2", 1 - F.col("w0") - F.col("w1")).filter("w0 >= 0 AND w1 >= 0 AND w2 >= 0")
    p = p.withColumn("depth", F.col("w0") * F.col("za") + F.col("w1") * F.col("zb") + F.col("w2") * F.col("zc"))
    return p.groupBy("px", "py").agg(F.min(F.struct("depth", "fid")).alias("s")).select("px", "py", F.col("s.fid").alias("fid"), F.col("s.depth").alias("depth"))

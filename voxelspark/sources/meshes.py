"""Mesh files (ASCII PLY, OBJ, NPZ) and precomputed meshes as vertex and face tables, and PLY back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.functions.scalars import short_number
from voxelspark.operators.numbering import numbered
from voxelspark.sources import arrays, volumes


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their 0-based number; a mesh file is one file in order."""
    lines = spark.read.text(path).withColumn("at", F.monotonically_increasing_id())
    return numbered(lines, ["at"], "line").select("value", "line")


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vertex, face) of an ASCII PLY or an OBJ file of triangles, or an NPZ archive of vertices and faces."""
    if path.lower().endswith(".npz"):
        return _npz(spark, path)
    return _obj(spark, path) if path.lower().endswith(".obj") else _ply(spark, path)


def _ply(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    lines = _numbered(spark, path)
    last = lines.filter(F.trim("value") == "end_header").agg(F.min("line")).first()[0]
    header = [] if last is None else [r.value.strip() for r in lines.filter(F.col("line") <= last).orderBy("line").collect()]
    if header[:1] != ["ply"] or "format ascii 1.0" not in header:
        raise ValueError("not an ASCII PLY file")
    counts = {h.split()[1]: int(h.split()[2]) for h in header if h.startswith("element ")}
    body = header.index("end_header") + 1
    part = F.split(F.trim("value"), r"\s+")
    nv = counts["vertex"]
    v = lines.filter((F.col("line") >= body) & (F.col("line") < body + nv)).select((F.col("line") - body).cast("long").alias("vid"), *[part[i].cast("double").alias(a) for i, a in enumerate("xyz")])
    low = body + nv
    f = lines.filter((F.col("line") >= low) & (F.col("line") < low + counts["face"])).select((F.col("line") - low).cast("long").alias("fid"), *[part[i + 1].cast("long").alias(a) for i, a in enumerate("abc")])
    return v, f


def _obj(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    lines = _numbered(spark, path)
    part = F.split(F.trim("value"), r"\s+")
    v = numbered(lines.filter(F.col("value").startswith("v ")), ["line"], "vid").select("vid", *[part[i + 1].cast("double").alias(a) for i, a in enumerate("xyz")])
    corner = lambda i: (F.split(part[i + 1], "/")[0].cast("long") - 1)
    f = numbered(lines.filter(F.col("value").startswith("f ")), ["line"], "fid").select("fid", *[corner(i).alias(a) for i, a in enumerate("abc")])
    return v, f


def _npz(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The members ``vertices`` and ``faces``, each with three numbers a row."""

    def triples(member: str, row: str, names: str, kind: str) -> DataFrame:
        cells = arrays.read(spark, path, arrayKey=member, slab="65536")
        return cells.groupBy(F.col("y").cast("long").alias(row)).agg(*[F.max(F.when(F.col("x") == i, F.col("value"))).cast(kind).alias(a) for i, a in enumerate(names)])

    return triples("vertices", "vid", "xyz", "double"), triples("faces", "fid", "abc", "long")


def scan_precomputed(spark: SparkSession, path: str, ids: list[int]) -> tuple[DataFrame, DataFrame]:
    """vertex (segment, vid, x, y, z) and face (segment, fid, a, b, c) of the named segments of a precomputed
    source with single-resolution meshes, ids from 0 in each segment, its fragments in the manifest's order.
    Coordinates are as stored: ``operators.mesh.to_nm`` turns voxels into nanometres.  No ids and
    an id without a mesh are errors; a segment may have no fragments, and then has no rows."""
    if not ids:
        raise ValueError("name the segments")
    path = path.removeprefix("precomputed://").rstrip("/")
    folder = f"{path}/{(volumes.load_json(spark, f'{path}/info') or {}).get('mesh', 'mesh')}"
    if (volumes.load_json(spark, f"{folder}/info") or {}).get("@type", "neuroglancer_legacy_mesh") != "neuroglancer_legacy_mesh":
        raise ValueError(f"{folder}: only meshes of a single resolution can be read")
    used: dict[str, list[tuple[int, int]]] = {}
    for segment in dict.fromkeys(ids):
        manifest = volumes.load_json(spark, f"{folder}/{segment}:0")
        if manifest is None:
            raise FileNotFoundError(f"{folder}/{segment}:0")
        for part, name in enumerate(manifest["fragments"]):
            used.setdefault(name, []).append((segment, part))
    if not used:
        return spark.createDataFrame([], "segment long, vid long, x double, y double, z double"), spark.createDataFrame([], "segment long, fid long, a long, b long, c long")
    files = volumes.contents(spark, [f"{folder}/{name}" for name in used])
    v = files.mapInArrow(_fragments(used, True), "segment long, part long, i long, x double, y double, z double")
    f = files.mapInArrow(_fragments(used, False), "segment long, part long, i long, a long, b long, c long")
    return _shifted(v, v, "vid", ()), _shifted(f, v, "fid", "abc")


def _shifted(rows: DataFrame, vertex: DataFrame, name: str, corners) -> DataFrame:
    """Rows numbered through a segment's fragments; corners move by the vertices before."""
    before = W.partitionBy("segment").orderBy("part").rowsBetween(W.unboundedPreceding, -1)

    def shift(of: DataFrame, column: str) -> DataFrame:
        return of.groupBy("segment", "part").count().select("segment", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias(column))

    out = rows.join(shift(rows, "own"), ["segment", "part"])
    if corners:
        out = out.join(shift(vertex, "moved"), ["segment", "part"])
    kept = [c for c in rows.columns if c not in ("segment", "part", "i", *corners)]
    return out.select("segment", (F.col("i") + F.col("own")).alias(name), *kept, *[(F.col(c) + F.col("moved")).alias(c) for c in corners])


def _fragments(used: dict[str, list[tuple[int, int]]], vertices: bool):
    """A fragment is its number of vertices (4 bytes), their x, y, z (4 each), and corners (4 each)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                raw, name = content.as_py(), path.as_py().rsplit("/", 1)[1]
                n = int(np.frombuffer(raw, "<u4", 1)[0])
                held = np.frombuffer(raw, "<f4", 3 * n, 4).astype(np.float64) if vertices else np.frombuffer(raw, "<u4", -1, 4 + 12 * n).astype(np.int64)
                held = held.reshape(-1, 3)
                for segment, part in used[name]:
                    keys = [np.full(len(held), segment), np.full(len(held), part), np.arange(len(held))]
                    yield pa.RecordBatch.from_arrays([*(pa.array(k.astype(np.int64)) for k in keys), *(pa.array(held[:, i].copy()) for i in range(3))], ["segment", "part", "i", *("xyz" if vertices else "abc")])

    return read


def ply_lines(vertex: DataFrame, face: DataFrame) -> DataFrame:
    """The lines of an ASCII PLY file, (line, value), in order of ``line``."""
    spark = vertex.sparkSession
    nv, nf = vertex.count(), face.count()
    head = ["ply", "format ascii 1.0", f"element vertex {nv}", *[f"property float {a}" for a in "xyz"], f"element face {nf}", "property list uchar int vertex_indices", "end_header"]
    h = spark.createDataFrame(list(enumerate(head)), "line long, value string")
    n = len(head)
    v = numbered(vertex, ["vid"], "line", first=n).select("line", F.concat_ws(" ", *[short_number(F.col(a)) for a in "xyz"]).alias("value"))
    f = numbered(face, ["fid"], "line", first=n + nv).select("line", F.concat_ws(" ", F.lit("3"), "a", "b", "c").alias("value"))
    return h.unionByName(v).unionByName(f)

"""Chunked volumes (Zarr 2 and 3, N5, precomputed) and TIFF stacks as tables of indices and ``value``.

Chunks are files of Spark's own ``binaryFile`` source, so any file system that Spark reads will do, a
task holds chunks and not the volume, and a box prunes files before anything is opened.  Indices are
those of the volume; precomputed ones count from the volume's offset.  Chunks without a file hold the
fill value.  Labels beyond 2^63 - 1 are an error.
"""

from __future__ import annotations

import gzip
import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AXES = {1: "x", 2: "yx", 3: "zyx", 4: "czyx"}
#: Names of the stored types.
ZARR3_TYPES = {"bool": "?", "int8": "i1", "int16": "i2", "int32": "i4", "int64": "i8", "uint8": "u1", "uint16": "u2", "uint32": "u4", "uint64": "u8", "float16": "f2", "float32": "f4", "float64": "f8"}


@dataclass(frozen=True)
class Volume:
    """What the metadata say: axes, shape, chunk and origin in the order of the result's columns; the
    pieces of a chunk's name follow ``stored``, the axes' positions in the order of the file names."""

    kind: str
    folder: str
    shape: tuple[int, ...]
    chunk: tuple[int, ...]
    dtype: str
    stored: tuple[int, ...]
    separator: str = "."
    prefix: str = ""
    origin: tuple[int, ...] = ()
    codecs: tuple[str, ...] = ()
    fortran: bool = False
    fill: float = 0
    fixed: dict = field(default_factory=dict)

    @property
    def names(self) -> str:
        return AXES[len(self.shape)]

    @property
    def counts(self) -> list[int]:
        return [-(-n // c) for n, c in zip(self.shape, self.chunk, strict=True)]

    def piece(self, axis: int, i: int) -> str:
        """An axis' part of the name of its i-th chunk."""
        if self.kind != "precomputed":
            return str(i)
        low = self.origin[axis] + i * self.chunk[axis]
        return f"{low}-{min(low + self.chunk[axis], self.origin[axis] + self.shape[axis])}"


def _bytes(spark: SparkSession, path: str) -> bytes | None:
    """A small metadata file, or None.  Spark's sources hide names that begin with a dot."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(at):
        return None
    if store.getUri().getScheme() == "file":  # its checksum files cannot have colons in their names
        with open(at.toUri().getPath(), "rb") as f:
            return f.read()
    stream = store.open(at)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, content) of named files.  Those of a mounted folder are opened by the tasks, as their
    names may have colons, which Spark's local file system rejects."""
    if "://" in paths[0] and not paths[0].startswith("file:"):
        return spark.read.format("binaryFile").load(paths).select("path", "content")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as f:
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([f.read()])], ["path", "content"])

    names = spark.createDataFrame([(_local(p),) for p in paths], "path string")
    return names.repartition(min(len(paths), 4 * spark.sparkContext.defaultParallelism)).mapInArrow(opened, "path string, content binary")


def load_json(spark: SparkSession, path: str) -> dict | None:
    """A JSON document of the store, or None."""
    found = _bytes(spark, path)
    return None if found is None else json.loads(found)


def pyramid(spark: SparkSession, path: str) -> DataFrame:
    """A row for each resolution of a precomputed volume: (mip, key, z, y, x sizes, voxel nm, chunk)."""
    info = _info(spark, path)
    rows = []
    for mip, s in enumerate(info["scales"]):
        rows.append((mip, s["key"], *s["size"][::-1], *map(float, s["resolution"][::-1]), *s["chunk_sizes"][0][::-1], s["encoding"]))
    return spark.createDataFrame(rows, "mip int, key string, nz long, ny long, nx long, z_nm double, y_nm double, x_nm double, cz long, cy long, cx long, encoding string")


def _info(spark: SparkSession, path: str) -> dict:
    info = load_json(spark, f"{path}/info")
    if info is None:
        raise FileNotFoundError(f"{path}/info")
    return info


def describe(spark: SparkSession, path: str, kind: str, inner: str | None = None, mip: int = 0) -> Volume:
    """The metadata of an array; a group without ``inner`` is an error, as is what cannot be decoded."""
    path = path.removeprefix("precomputed://").rstrip("/")
    folder = f"{path}/{inner.strip('/')}" if inner and kind != "precomputed" else path
    if kind == "precomputed":
        return _precomputed(_info(spark, path), path, mip)
    old, new, n5 = (load_json(spark, f"{folder}/{name}") for name in (".zarray", "zarr.json", "attributes.json"))
    if kind == "n5" and n5 and "dimensions" in n5:
        return _n5(n5, folder)
    if kind == "zarr" and old:
        return _zarr2(old, folder)
    if kind == "zarr" and new and new["node_type"] == "array":
        return _zarr3(new, folder)
    raise ValueError(f"{folder} is no {kind} array; name one of a group with arrayPath")


def _codec(name: str | None) -> tuple[str, ...]:
    if name in (None, "raw"):
        return ()
    if name not in ("gzip", "zlib", "zstd"):
        raise ValueError(f"chunks are packed with {name}, which nothing here unpacks")
    return (name,)


def _zarr2(meta: dict, folder: str) -> Volume:
    if meta.get("filters"):
        raise ValueError("filters of a Zarr array cannot be undone")
    codec = _codec((meta["compressor"] or {}).get("id"))
    at = tuple(range(len(meta["shape"])))
    return Volume("zarr", folder, tuple(meta["shape"]), tuple(meta["chunks"]), meta["dtype"], at, meta.get("dimension_separator", "."), codecs=codec, fortran=meta["order"] == "F", fill=_fill(meta["fill_value"]))


def _zarr3(meta: dict, folder: str) -> Volume:
    first, *rest = meta["codecs"]
    if first["name"] != "bytes" or meta["chunk_grid"]["name"] != "regular":
        raise ValueError("only regular chunks of plain bytes can be read")
    end = "<" if first.get("configuration", {}).get("endian", "little") == "little" else ">"
    codecs = tuple(c for r in rest for c in (("crc32c",) if r["name"] == "crc32c" else _codec(r["name"])))
    keys = meta["chunk_key_encoding"]
    plain = keys["name"] == "v2"
    sep = keys.get("configuration", {}).get("separator", "." if plain else "/")
    shape = tuple(meta["shape"])
    return Volume("zarr", folder, shape, tuple(meta["chunk_grid"]["configuration"]["chunk_shape"]), end + ZARR3_TYPES[meta["data_type"]], tuple(range(len(shape))), sep, "" if plain else f"c{sep}", codecs=codecs, fill=_fill(meta["fill_value"]))


def _n5(meta: dict, folder: str) -> Volume:
    packing = meta.get("compression", {"type": meta.get("compressionType", "raw")})
    codec = ("zlib",) if packing.get("useZlib") else _codec(packing["type"])
    shape, chunk = tuple(meta["dimensions"][::-1]), tuple(meta["blockSize"][::-1])
    return Volume("n5", folder, shape, chunk, ">" + ZARR3_TYPES[meta["dataType"]], tuple(range(len(shape)))[::-1], "/", codecs=codec)


def _precomputed(info: dict, path: str, mip: int) -> Volume:
    scale = info["scales"][mip]
    if scale["encoding"] != "raw" or scale.get("sharding") or info["num_channels"] != 1:
        raise ValueError("only unsharded raw chunks of one channel can be read")
    low = tuple(scale.get("voxel_offset", [0, 0, 0])[::-1])
    return Volume("precomputed", f"{path}/{scale['key']}", tuple(scale["size"][::-1]), tuple(scale["chunk_sizes"][0][::-1]), "<" + ZARR3_TYPES[info["data_type"]], (2, 1, 0), "_", origin=low)


def _fill(value) -> float:
    return float(value.replace("Infinity", "inf")) if isinstance(value, str) else value or 0


def _unpacked(content: bytes, codecs: tuple[str, ...]) -> bytes:
    for codec in codecs[::-1]:
        if codec == "crc32c":  # the sum is not verified
            content = content[:-4]
        elif codec == "zstd":
            import zstandard

            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        else:
            content = gzip.decompress(content) if codec == "gzip" else zlib.decompress(content)
    return content


def _decoded(v: Volume, low: list[int], path: str, content: bytes) -> np.ndarray:
    """A chunk's values, without what its file holds beyond the volume's edge."""
    inside = [min(c, n - a) for c, n, a in zip(v.chunk, v.shape, low, strict=True)]
    if v.kind == "precomputed":
        raw = gzip.decompress(content) if path.endswith(".gz") else content
        return np.frombuffer(raw, v.dtype).reshape(inside)
    if v.kind == "n5":
        mode, n = struct.unpack(">HH", content[:4])
        if mode not in (0, 1):
            raise ValueError(f"{path}: a block of mode {mode} holds no array")
        held = struct.unpack(f">{n}I", content[4 : 4 + 4 * n])[::-1]
        values = np.frombuffer(_unpacked(content[4 + 4 * n + 4 * mode :], v.codecs), v.dtype).reshape(held)
    else:
        values = np.frombuffer(_unpacked(content, v.codecs), v.dtype).reshape(v.chunk, order="F" if v.fortran else "C")
    return values[tuple(slice(0, n) for n in inside)]


def _rows(values: np.ndarray, low: list[int], box, sparse: bool, names: str) -> pa.RecordBatch:
    """A block at ``low`` as rows, those within the box."""
    if box:
        cut = [slice(max(b0 - a, 0), max(b1 - a, 0)) for a, (b0, b1) in zip(low, box, strict=True)]
        low = [a + s.start for a, s in zip(low, cut, strict=True)]
        values = values[tuple(cut)]
    at = np.nonzero(values) if sparse else np.unravel_index(np.arange(values.size), values.shape)
    flat = values[at]
    if flat.dtype.kind == "u" and flat.size and int(flat.max()) >= 1 << 63:
        raise ValueError("labels beyond 2^63 - 1 do not fit a long")
    kind = np.float64 if flat.dtype.kind == "f" else np.int64
    return pa.RecordBatch.from_arrays([*(pa.array((i + a).astype(np.int32)) for i, a in zip(at, low, strict=True)), pa.array(flat.astype(kind))], [*names, "value"])


def scan(spark: SparkSession, path: str, kind: str, box: list[tuple[int, int]] | None = None, inner: str | None = None, mip: int = 0, drop_zero: bool = False) -> DataFrame:
    """The cells of a volume, or of a box of it (a start and a stop for each axis, in the order of the
    columns); ``drop_zero`` leaves zeros out.  A box beyond the volume gives what lies within."""
    v = describe(spark, path, kind, inner, mip)
    if len(v.shape) not in AXES:
        raise ValueError("arrays of one to four dimensions can be read")
    origin = v.origin or (0,) * len(v.shape)
    names, axes = v.names, range(len(v.shape))
    schema = ", ".join([*(f"{a} int" for a in names), "value " + ("double" if np.dtype(v.dtype).kind == "f" else "long")])
    spans = []
    for a in axes:
        b0, b1 = (box[a][0] - origin[a], box[a][1] - origin[a]) if box else (0, v.shape[a])
        b0, b1 = max(b0, 0), min(b1, v.shape[a])
        if b0 >= b1:
            return spark.createDataFrame([], schema)
        spans.append((b0 // v.chunk[a], -(-b1 // v.chunk[a])))
    pieces = ["*" if spans[a] == (0, v.counts[a]) else "{" + ",".join(v.piece(a, i) for i in range(*spans[a])) + "}" for a in v.stored]
    tail = v.prefix + v.separator.join(pieces)
    number = r"(-?\d+)--?\d+" if v.kind == "precomputed" else r"(\d+)"
    pattern = "/" + re.escape(v.prefix) + re.escape(v.separator).join([number] * len(v.shape)) + r"(\.gz)?$"
    ending = "{,.gz}" if v.kind == "precomputed" else ""
    files = _files(spark, f"{v.folder}/{tail}{ending}")
    cells = [files.filter(F.col("path").rlike(pattern)).select("path", "content").mapInArrow(_chunk_reader(v, pattern, origin, box, drop_zero), schema)] if files else []
    if not (drop_zero and v.fill == 0):
        sizes = [hi - lo for lo, hi in spans]
        steps = [int(np.prod(sizes[a + 1 :])) for a in axes]
        place = [(F.floor(F.col("id") / steps[a]) % sizes[a] + spans[a][0]).cast("int").alias(names[a]) for a in axes]
        absent = spark.range(int(np.prod(sizes))).select(*place)
        if files:
            listed = files.filter(F.col("path").rlike(pattern))
            index = [F.regexp_extract("path", pattern, v.stored.index(a) + 1).cast("long") for a in axes]
            seen = listed.select(*[(F.floor((index[a] - origin[a]) / v.chunk[a]) if v.kind == "precomputed" else index[a]).cast("int").alias(names[a]) for a in axes])
            absent = absent.join(seen, list(names), "left_anti")
        cells.append(absent.mapInArrow(_filler(v, origin, box), schema))
    out = cells[0] if cells else spark.createDataFrame([], schema)
    return out.union(cells[1]) if len(cells) > 1 else out


def _files(spark: SparkSession, pattern: str) -> DataFrame | None:
    """The files of a pattern, or None where it meets none."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.format("binaryFile").load(pattern)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _chunk_reader(v: Volume, pattern: str, origin, box, sparse: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = re.compile(pattern)
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                numbers = [int(n) for n in named.search(path.as_py()).groups()[: len(v.shape)]]
                given = [numbers[v.stored.index(a)] for a in range(len(v.shape))]
                low = [g - o if v.kind == "precomputed" else g * c for g, o, c in zip(given, origin, v.chunk, strict=True)]
                if all(a < n for a, n in zip(low, v.shape, strict=True)):
                    yield _rows(_decoded(v, low, path.as_py(), content.as_py()), [a + o for a, o in zip(low, origin, strict=True)], box, sparse, v.names)

    return read


def _filler(v: Volume, origin, box):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for index in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low = [i * c for i, c in zip(index, v.chunk, strict=True)]
                values = np.full([min(c, n - a) for c, n, a in zip(v.chunk, v.shape, low, strict=True)], v.fill, np.dtype(v.dtype))
                yield _rows(values, [a + o for a, o in zip(low, origin, strict=True)], box, False, v.names)

    return fill


def _local(path: str) -> str:
    """A path as Python opens it; other stores are an error, as is what executors cannot share."""
    if "://" in path and not path.startswith("file:"):
        raise ValueError(f"{path}: written and TIFF files need a mounted folder")
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def write_precomputed(voxels: DataFrame, path: str, shape, chunk, voxel_nm, dtype: str = "uint64", offset=(0, 0, 0), force: bool = False) -> None:
    """(z, y, x, value) as raw chunks of one resolution, below a folder that the executors share.  A chunk
    without rows gets no file.  An existing volume is an error, but with ``force`` and the same grid; its
    chunks are then replaced where this one has rows.  Each file appears whole or not at all, so a task
    that runs twice does no harm."""
    _local(path)
    key = "_".join(f"{v:g}" for v in voxel_nm[::-1])
    scale = {"chunk_sizes": [list(chunk[::-1])], "encoding": "raw", "key": key, "resolution": list(voxel_nm[::-1]), "size": list(shape[::-1]), "voxel_offset": list(offset[::-1])}
    info = {"data_type": dtype, "num_channels": 1, "scales": [scale], "type": "segmentation" if dtype in ("uint32", "uint64") else "image"}
    before = load_json(voxels.sparkSession, f"{path}/info")
    if before is not None and (not force or before != info):
        raise FileExistsError(f"{path} holds a volume" + (" of another grid" if force else ""))
    folder = os.path.join(_local(path), key)
    os.makedirs(folder, exist_ok=True)
    v = _precomputed(info, path, 0)

    def save(keys, table):
        index = [k.as_py() for k in keys]
        low = [i * c for i, c in zip(index, v.chunk, strict=True)]
        block = np.zeros([min(c, n - a) for c, n, a in zip(v.chunk, v.shape, low, strict=True)], v.dtype)
        block[tuple(table.column(a).to_numpy() - l - o for a, l, o in zip("zyx", low, v.origin, strict=True))] = table.column("value").to_numpy()
        name = "_".join(v.piece(a, index[a]) for a in v.stored)
        part = os.path.join(folder, f".{name}.{os.getpid()}")
        with open(part, "wb") as f:
            f.write(block.tobytes())
        os.replace(part, os.path.join(folder, name))
        return pa.table({"name": [name]})

    spot = [F.floor((F.col(a) - o) / c).alias(f"c{a}") for a, c, o in zip("zyx", chunk, offset, strict=True)]
    voxels.select("z", "y", "x", "value", *spot).groupBy("cz", "cy", "cx").applyInArrow(save, "name string").count()
    with open(os.path.join(_local(path), "info"), "w") as f:
        json.dump(info, f)


# TIFF --------------------------------------------------------------------------------------------

#: Sizes of the field types, the tags, and the sample formats of TIFF 6.
FIELD_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4, 16: 8, 17: 8, 18: 8}
FIELD_LETTERS = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 13: "I", 16: "Q", 17: "q", 18: "Q"}
WIDTH, LENGTH, BITS, PACKING, OFFSETS, SAMPLES, STRIP_ROWS, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, FORMAT = 256, 257, 258, 259, 273, 277, 278, 317, 322, 323, 324, 339
STRIP_BYTES, TILE_BYTES, DESCRIPTION = 279, 325, 270


def tiff_pages(path: str) -> list[dict]:
    """The directories of a TIFF or BigTIFF file: tag -> values, with the byte order under ``end``."""
    pages = []
    with open(path, "rb") as f:
        head = f.read(16)
        end = {b"II": "<", b"MM": ">"}.get(head[:2])
        version = struct.unpack(f"{end}H", head[2:4])[0] if end else 0
        if version not in (42, 43):
            raise ValueError(f"{path} is no TIFF file")
        wide, entry, count = ("Q", 20, "Q") if version == 43 else ("I", 12, "H")
        at = struct.unpack(end + wide, head[8:16] if version == 43 else head[4:8])[0]
        while at:
            f.seek(at)
            n = struct.unpack(end + count, f.read(struct.calcsize(count)))[0]
            block = f.read(n * entry + struct.calcsize(wide))
            page: dict = {"end": end}
            for i in range(n):
                tag, kind, many = struct.unpack_from(f"{end}HH{wide}", block, i * entry)
                if kind in FIELD_LETTERS:
                    size, room = many * FIELD_BYTES[kind], struct.calcsize(wide)
                    value = block[(i + 1) * entry - room : (i + 1) * entry]
                    if size > room:
                        f.seek(struct.unpack(end + wide, value)[0])
                        value = f.read(size)
                    page[tag] = struct.unpack(f"{end}{many}{FIELD_LETTERS[kind]}", value[:size])
            pages.append(page)
            at = struct.unpack_from(end + wide, block, n * entry)[0]
    return pages


def _dtype(page: dict) -> str:
    bits, sign = page.get(BITS, (1,))[0], page.get(FORMAT, (1,))[0]
    if page.get(SAMPLES, (1,))[0] != 1 or bits not in (8, 16, 32, 64):
        raise ValueError("only pages of one sample of whole bytes can be read")
    return page["end"] + {1: "u", 2: "i", 3: "f"}[sign] + str(bits // 8)


def _blocks(path: str, page: dict) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, column, values) of a page's strips or tiles."""
    packing, kind = page.get(PACKING, (1,))[0], np.dtype(_dtype(page))
    if packing not in (1, 8, 32946, 50000):
        raise ValueError(f"compression {packing} of {path} cannot be undone")
    (width,), (length,) = page[WIDTH], page[LENGTH]
    tiled = TILE_OFFSETS in page
    w, h = (page[TILE_WIDTH][0], page[TILE_LENGTH][0]) if tiled else (width, min(page.get(STRIP_ROWS, (length,))[0], length))
    starts, sizes = (page[TILE_OFFSETS], page[TILE_BYTES]) if tiled else (page[OFFSETS], page[STRIP_BYTES])
    places = itertools.product(range(0, length, h), range(0, width, w))
    with open(path, "rb") as f:
        for (row, column), start, size in zip(places, starts, sizes, strict=True):
            f.seek(start)
            raw = _unpacked(f.read(size), {1: (), 50000: ("zstd",)}.get(packing, ("zlib",)))
            values = np.frombuffer(raw, kind).reshape(h if tiled else min(h, length - row), w)
            if page.get(PREDICTOR, (1,))[0] == 2:
                values = np.cumsum(values, axis=1, dtype=kind.newbyteorder("="))
            elif page.get(PREDICTOR, (1,))[0] != 1:
                raise ValueError(f"a predictor of {path} cannot be undone")
            yield row, column, values[: length - row, : width - column]


def scan_tiff(spark: SparkSession, path: str, slab: int = 16, drop_zero: bool = False) -> DataFrame:
    """(z, y, x, value) of a stack of equal pages, below a folder that the executors share; ``slab``
    pages a task, a strip or a tile at a time."""
    path = _local(path)
    pages = tiff_pages(path)
    if len({(p[WIDTH], p[LENGTH], _dtype(p)) for p in pages}) != 1:
        raise ValueError(f"the pages of {path} differ: no volume")
    kind = "double" if np.dtype(_dtype(pages[0])).kind == "f" else "long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tiff_pages(path)
        for batch in batches:
            for z in batch.column(0).to_pylist():
                for row, column, values in _blocks(path, held[z]):
                    yield _rows(values[None], [z, row, column], None, drop_zero, "zyx")

    planes = spark.range(0, len(pages), numPartitions=-(-len(pages) // slab))
    return planes.mapInArrow(read, f"z int, y int, x int, value {kind}")


def write_tiff(voxels: DataFrame, path: str, shape, dtype: str = "uint16", axes: str = "ZYX") -> None:
    """(z, y, x, value) as one BigTIFF stack with its axes in the description, for one machine to read;
    a plane at a time passes through the driver.  Absent cells are 0; a path that exists is an error."""
    path = _local(path)
    if os.path.exists(path):
        raise FileExistsError(path)
    (nz, ny, nx), kind = shape, np.dtype(dtype).newbyteorder("<")

    def plane(keys, table):
        block = np.zeros((ny, nx), kind)
        block[table.column("y").to_numpy(), table.column("x").to_numpy()] = table.column("value").to_numpy()
        return pa.table({"z": pa.array([keys[0].as_py()], pa.int32()), "content": [block.tobytes()]})

    planes = voxels.select(F.col("z").cast("int").alias("z"), "y", "x", "value").groupBy("z").applyInArrow(plane, "z int, content binary").orderBy("z").toLocalIterator()
    note = json.dumps({"axes": axes, "shape": list(shape)}).encode() + b"\0"
    size, letter = ny * nx * kind.itemsize, {"u": 1, "i": 2, "f": 3}[kind.kind]
    with open(f"{path}.part", "wb") as f:
        f.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16 + len(note)) + note)
        following = next(planes, None)
        for z in range(nz):
            here = f.tell()
            tags = [(WIDTH, 4, 1, nx), (LENGTH, 4, 1, ny), (BITS, 3, 1, kind.itemsize * 8), (PACKING, 3, 1, 1), (262, 3, 1, 1), (DESCRIPTION, 2, len(note), 16), (OFFSETS, 16, 1, 0), (SAMPLES, 3, 1, 1), (STRIP_ROWS, 4, 1, ny), (STRIP_BYTES, 16, 1, size), (FORMAT, 3, 1, letter)]
            data = here + 8 + 20 * len(tags) + 8
            entries = b"".join(struct.pack("<HHQQ", t, k, n, data if t == OFFSETS else v) for t, k, n, v in tags)
            f.write(struct.pack("<Q", len(tags)) + entries + struct.pack("<Q", data + size if z + 1 < nz else 0))
            if following is not None and following.z == z:
                f.write(following.content)
                following = next(planes, None)
            else:
                f.write(bytes(size))
    os.replace(f"{path}.part", path)

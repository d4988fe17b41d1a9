"""NumPy files as a Spark data source: ``spark.read.format("npy").load(path)``.

A file of one to four dimensions becomes rows of its indices and ``value``.  It is read in slabs
along the first axis, one partition each, through a memory map, so no task holds the whole array.
Options: ``arrayKey`` (a member of an npz archive; needed if it has several), ``slab`` (planes in
a partition), ``dropZero`` (leave out zeros, as the sparse form of a label volume).
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from voxelspark.sources import volumes

AXES = {1: "x", 2: "yx", 3: "zyx", 4: "czyx"}


def open_array(path: str, key: str | None = None) -> np.ndarray:
    """The array of an npy file (memory-mapped), or of an npz archive's one or named member."""
    if not zipfile.is_zipfile(path):
        return np.load(path, mmap_mode="r", allow_pickle=False)
    with np.load(path, allow_pickle=False) as archive:
        if key is None and len(archive.files) != 1:
            raise ValueError(f"{path} holds {len(archive.files)} arrays; name one with arrayKey")
        return archive[key or archive.files[0]]


class _Slab(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.key = options["path"].removeprefix("file:"), options.get("arraykey", options.get("arrayKey"))
        self.slab, self.sparse = int(options.get("slab", "16")), options.get("dropzero", options.get("dropZero", "false")).lower() == "true"

    def partitions(self) -> list[InputPartition]:
        n = open_array(self.path, self.key).shape[0]
        return [_Slab(i, min(n, i + self.slab)) for i in range(0, n, self.slab)]

    def read(self, part: _Slab) -> Iterator[pa.RecordBatch]:
        array = open_array(self.path, self.key)
        names = AXES[array.ndim]
        for plane in range(part.low, part.high):
            values = np.asarray(array[plane : plane + 1])
            at = np.nonzero(values) if self.sparse else np.unravel_index(np.arange(values.size), values.shape)
            columns = [pa.array((a + (plane if i == 0 else 0)).astype(np.int32)) for i, a in enumerate(at)]
            kind = pa.int64() if values.dtype.kind in "iub" else pa.float64()
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values[at].ravel()).cast(kind)], [*names, "value"])


class ArraySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> StructType:
        array = open_array(self.options["path"].removeprefix("file:"), self.options.get("arrayKey"))
        if array.ndim not in AXES:
            raise ValueError("arrays of one to four dimensions can be read")
        if array.dtype.kind not in "iubf":
            raise ValueError(f"no numbers: {array.dtype}")
        if array.dtype == np.uint64 and array.size and int(array.max()) >= 1 << 63:
            raise ValueError("labels beyond 2^63 - 1 do not fit a long")
        kind = LongType() if array.dtype.kind in "iub" else DoubleType()
        return StructType([*[StructField(a, IntegerType()) for a in AXES[array.ndim]], StructField("value", kind)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArraySource)


_SUFFIXES = {".npy": "npy", ".npz": "npz", ".tif": "tiff", ".tiff": "tiff", ".zarr": "zarr", ".n5": "n5", ".ply": "ply", ".obj": "obj", ".parquet": "parquet", ".json": "json", ".csv": "csv", ".orc": "orc"}


def infer_format(path: str, stated: str | None = None) -> str:
    """The format of a path by its suffix; a stated one wins."""
    if stated:
        return stated
    lower = path.rstrip("/").lower()
    for suffix, name in _SUFFIXES.items():
        if lower.endswith(suffix):
            return name
    if lower.startswith("precomputed://"):
        return "precomputed"
    raise ValueError(f"no format is known for {path}")


def read(spark: SparkSession, path: str, stated: str | None = None, **options: str) -> DataFrame:
    """A table from any of the formats."""
    kind = infer_format(path, stated)
    if kind in ("npy", "npz"):
        register(spark)
        return spark.read.format("npy").options(**options).load(path)
    if kind in ("parquet", "json", "csv", "orc"):
        return spark.read.format(kind).options(**options).load(path)
    if kind in ("ply", "obj"):
        raise ValueError("meshes have two tables: use sources.meshes.read")
    sparse = options.get("dropZero", "false").lower() == "true"
    if kind == "tiff":
        return volumes.scan_tiff(spark, path, int(options.get("slab", "16")), sparse)
    if kind in ("zarr", "n5", "precomputed"):
        return volumes.scan(spark, path, kind, inner=options.get("arrayPath"), mip=int(options.get("mip", "0")), drop_zero=sparse)
    raise ValueError(f"nothing reads {kind}")


def write_npy(rows: DataFrame, path: str, columns: list[str], order: str) -> None:
    """A table as one NumPy file, rows in order; for results that one machine is to read.  Refuses a
    path that exists, and streams so that the driver holds a row at a time beside the mapped file."""
    import os

    if os.path.exists(path):
        raise FileExistsError(path)
    n = rows.count()
    out = np.lib.format.open_memmap(path, mode="w+", dtype=np.float64, shape=(n, len(columns)))
    for i, r in enumerate(rows.orderBy(order).select(*columns).toLocalIterator()):
        out[i] = tuple(r)
    out.flush()


def write_chunks(voxels: DataFrame, path: str, chunk: tuple[int, int, int]) -> None:
    """A chunked volume: Parquet partitioned by chunk, refusing a path that exists."""
    from voxelspark.operators.tiling import chunk_of

    keys = ["cz", "cy", "cx"]
    chunk_of(voxels, chunk).repartition(*keys).write.mode("errorifexists").partitionBy(*keys).parquet(path)

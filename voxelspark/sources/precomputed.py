"""Precomputed volumes in their usual stored forms: raw chunks and compressed segmentation, as a file for
each chunk or in shards.

The names of chunks follow from the grid and the box, so nothing is listed: a task gets grid places and
opens what it needs.  In shards it reads an entry of the shard's index, the index of a minishard and the
ranges of its chunks.  Writing groups voxels by chunk; a shard is written by one task in one pass, which
holds a chunk at a time and the index.  Folders are those that driver and executors mount.

Compressed segmentation cuts a chunk into blocks.  A block is a table of its distinct labels and an
index into it for each voxel, of 0, 1, 2, 4, 8, 16 or 32 bits, packed into 32-bit words; blocks with
equal tables share one.

Defined cases: a chunk without a file, or without an entry in its shard, holds zeros; a box beyond the
volume gives what lies within; labels beyond 2^63 - 1 are an error, as are other encodings, hashes and
more than one channel.
"""

from __future__ import annotations

import gzip
import itertools
import json
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.sources.volumes import ZARR3_TYPES, _info, _local, load_json

#: Fixed values of the format: widths of an index, names of its parts.
WIDTHS = (0, 1, 2, 4, 8, 16, 32)
SHARDED, COMPRESSED = "neuroglancer_uint64_sharded_v1", "compressed_segmentation"


def encode_labels(values: np.ndarray, block: Sequence[int]) -> bytes:
    """A chunk (z, y, x) of uint32 or uint64 labels, one channel; ``block`` is in the same order."""
    counts = [-(-n // b) for n, b in zip(values.shape, block, strict=True)]
    heads = np.zeros((*counts, 2), np.uint32)
    body, at, tables = [], heads.size, {}
    for place in itertools.product(*map(range, counts)):
        part = values[tuple(slice(p * b, (p + 1) * b) for p, b in zip(place, block, strict=True))]
        labels, index = np.unique(part, return_inverse=True)
        bits = next(w for w in WIDTHS if len(labels) <= 1 << w)
        whole = np.zeros(block, np.uint32)
        whole[tuple(slice(0, n) for n in part.shape)] = index.reshape(part.shape)
        start = at
        if bits:
            each = 32 // bits
            flat = whole.ravel()
            flat = np.pad(flat, (0, -len(flat) % each)).reshape(-1, each)
            body.append(np.bitwise_or.reduce(flat << (np.arange(each, dtype=np.uint32) * bits), axis=1).astype("<u4"))
            at += len(body[-1])
        key = labels.tobytes()
        if key not in tables:
            tables[key] = at
            body.append(np.frombuffer(labels.astype(labels.dtype.newbyteorder("<")).tobytes(), "<u4"))
            at += len(body[-1])
        if tables[key] >= 1 << 24:
            raise ValueError("a chunk is too large for compressed segmentation")
        heads[place] = tables[key] | bits << 24, start
    return np.concatenate([np.array([1], "<u4"), heads.ravel().astype("<u4"), *body]).tobytes()


def decode_labels(content: bytes, shape: Sequence[int], block: Sequence[int], dtype: str) -> np.ndarray:
    """The chunk (z, y, x) that ``encode_labels`` made, or anything else of the format."""
    words = np.frombuffer(content, "<u4")
    words = words[words[0] :]
    counts = [-(-n // b) for n, b in zip(shape, block, strict=True)]
    heads = words[: 2 * int(np.prod(counts))].reshape(*counts, 2)
    out, size, kind = np.empty(shape, dtype), int(np.prod(block)), np.dtype(dtype)
    for place in itertools.product(*map(range, counts)):
        table, bits, start = int(heads[place][0]) & 0xFFFFFF, int(heads[place][0]) >> 24, int(heads[place][1])
        if bits not in WIDTHS:
            raise ValueError(f"an index of {bits} bits")
        if bits:
            each = 32 // bits
            packed = words[start : start + -(-size // each)]
            index = (packed[:, None] >> (np.arange(each, dtype=np.uint32) * bits)) & np.uint32((1 << bits) - 1)
            index = index.ravel()[:size].reshape(block)
        else:
            index = np.zeros(block, np.uint32)
        at = tuple(slice(p * b, min((p + 1) * b, n)) for p, b, n in zip(place, block, shape, strict=True))
        index = index[tuple(slice(0, s.stop - s.start) for s in at)]
        labels = np.frombuffer(words[table : table + (int(index.max()) + 1) * kind.itemsize // 4].tobytes(), kind)
        out[at] = labels[index]
    return out


def morton(place: Sequence[int], counts: Sequence[int]) -> int:
    """The number of a chunk (x, y, z): bits of its places in turn, of each axis as many as its count needs."""
    out = used = 0
    for bit in range(max(counts).bit_length()):
        for p, n in zip(place, counts, strict=True):
            if 1 << bit < n:
                out |= (p >> bit & 1) << used
                used += 1
    return out


def murmur(key: int) -> int:
    """The low 64 bits of MurmurHash3 (x86, 128 bits, seed 0) of a number's eight bytes."""
    mask, (a, b, c) = 0xFFFFFFFF, (0x239B961B, 0xAB0E9789, 0x38B34AE5)
    turned = lambda v, n: (v << n | v >> (32 - n)) & mask

    def mixed(v: int) -> int:
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            v = (v ^ v >> shift) * factor & mask
        return v ^ v >> 16

    h = [turned((key & mask) * a & mask, 15) * b & mask, turned((key >> 32) * b & mask, 16) * c & mask, 0, 0]
    h = [v ^ 8 for v in h]
    for step in range(2):
        h[0] = sum(h) & mask
        h[1:] = [(v + h[0]) & mask for v in h[1:]]
        h = [mixed(v) for v in h] if not step else h
    return h[0] | h[1] << 32


@dataclass(frozen=True)
class Store:
    """One resolution, axes in order z, y, x but for ``sharding``'s numbers."""

    folder: str
    shape: tuple[int, ...]
    chunk: tuple[int, ...]
    origin: tuple[int, ...]
    dtype: str
    encoding: str
    block: tuple[int, ...]
    sharding: dict | None

    @property
    def counts(self) -> list[int]:
        return [-(-n // c) for n, c in zip(self.shape, self.chunk, strict=True)]

    def inside(self, place: Sequence[int]) -> list[int]:
        """The size of the chunk at a grid place."""
        return [min(c, n - p * c) for p, c, n in zip(place, self.chunk, self.shape, strict=True)]

    def name(self, place: Sequence[int]) -> str:
        low = [o + p * c for o, p, c in zip(self.origin, place, self.chunk, strict=True)]
        return "_".join(f"{a}-{a + n}" for a, n in list(zip(low, self.inside(place), strict=True))[::-1])

    def address(self, place: Sequence[int]) -> tuple[int, int, int]:
        """(shard, minishard, chunk number)."""
        number, s = morton(place[::-1], self.counts[::-1]), self.sharding
        h = number >> s["preshift_bits"]
        h = murmur(h) if s["hash"] == "murmurhash3_x86_128" else h
        return h >> s["minishard_bits"] & (1 << s["shard_bits"]) - 1, h & (1 << s["minishard_bits"]) - 1, number

    def shard(self, number: int) -> str:
        return os.path.join(self.folder, f"{number:0{-(-self.sharding['shard_bits'] // 4)}x}.shard")

    def decode(self, content: bytes, place: Sequence[int]) -> np.ndarray:
        shape = self.inside(place)
        if self.encoding == COMPRESSED:
            return decode_labels(content, shape, self.block, self.dtype)
        return np.frombuffer(content, self.dtype).reshape(shape)

    def encode(self, values: np.ndarray) -> bytes:
        return encode_labels(values, self.block) if self.encoding == COMPRESSED else values.astype(self.dtype).tobytes()


def store(info: dict, path: str, mip: int = 0) -> Store:
    """What the metadata say of a resolution."""
    s = info["scales"][mip]
    sharding = s.get("sharding")
    if s["encoding"] not in ("raw", COMPRESSED) or info["num_channels"] != 1:
        raise ValueError(f"chunks are encoded as {s['encoding']} with {info['num_channels']} channels; raw and {COMPRESSED} of one can be read")
    if s["encoding"] == COMPRESSED and info["data_type"] not in ("uint32", "uint64"):
        raise ValueError(f"{COMPRESSED} holds uint32 or uint64")
    if sharding:
        sharding = {"minishard_index_encoding": "raw", "data_encoding": "raw"} | sharding
        if sharding["@type"] != SHARDED or sharding["hash"] not in ("identity", "murmurhash3_x86_128"):
            raise ValueError(f"shards of type {sharding['@type']} with hash {sharding['hash']} cannot be read")
    turned = lambda v: tuple(v[::-1])
    return Store(
        os.path.join(_local(path), s["key"]), turned(s["size"]), turned(s["chunk_sizes"][0]), turned(s.get("voxel_offset", [0, 0, 0])), "<" + ZARR3_TYPES[info["data_type"]],
        s["encoding"], turned(s.get("compressed_segmentation_block_size", [8, 8, 8])), sharding,
    )


def _packed(content: bytes, how: str) -> bytes:
    return gzip.compress(content, mtime=0) if how == "gzip" else content


def _opened(content: bytes, how: str) -> bytes:
    return gzip.decompress(content) if how == "gzip" else content


def _minishard(f, s: Store, minishard: int) -> dict[int, tuple[int, int]]:
    """Chunk number -> (start, size) of a minishard, by two reads."""
    front = 16 << s.sharding["minishard_bits"]
    f.seek(16 * minishard)
    start, end = np.frombuffer(f.read(16), "<u8").tolist()
    if start == end:
        return {}
    f.seek(front + start)
    numbers, gaps, sizes = np.frombuffer(_opened(f.read(end - start), s.sharding["minishard_index_encoding"]), "<u8").reshape(3, -1)
    starts = front + np.cumsum(gaps) + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64)
    return dict(zip(np.cumsum(numbers).tolist(), zip(starts.tolist(), sizes.tolist(), strict=True), strict=True))


def _reader(s: Store, box, sparse: bool):
    def rows(place: list[int], values: np.ndarray | None) -> pa.RecordBatch | None:
        low = [o + p * c for o, p, c in zip(s.origin, place, s.chunk, strict=True)]
        cut = [slice(max(b0 - a, 0), max(min(b1 - a, n), 0)) for a, n, (b0, b1) in zip(low, s.inside(place), box, strict=True)]
        if values is None:
            if sparse:
                return None
            values = np.zeros(s.inside(place), s.dtype)
        values = values[tuple(cut)]
        at = np.nonzero(values) if sparse else np.unravel_index(np.arange(values.size), values.shape)
        flat = values[at]
        if flat.dtype.kind == "u" and flat.size and int(flat.max()) >= 1 << 63:
            raise ValueError("labels beyond 2^63 - 1 do not fit a long")
        kind = np.float64 if flat.dtype.kind == "f" else np.int64
        return pa.RecordBatch.from_arrays([*(pa.array((i + a + c.start).astype(np.int32)) for i, a, c in zip(at, low, cut, strict=True)), pa.array(flat.astype(kind))], [*"zyx", "value"])

    def unsharded(places) -> Iterator[tuple[list[int], bytes | None]]:
        for place in places:
            path = os.path.join(s.folder, s.name(place))
            for name in (path, path + ".gz"):
                if os.path.exists(name):
                    with open(name, "rb") as f:
                        yield place, _opened(f.read(), "gzip" if name != path else "raw")
                    break
            else:
                yield place, None

    def sharded(places) -> Iterator[tuple[list[int], bytes | None]]:
        now, f, index = None, None, {}
        try:
            for place in places:
                shard, minishard, number = s.address(place)
                if now is None or now[0] != shard:
                    if f:
                        f.close()
                    f = open(s.shard(shard), "rb") if os.path.exists(s.shard(shard)) else None  # noqa: SIM115
                if now != (shard, minishard):
                    now, index = (shard, minishard), _minishard(f, s, minishard) if f else {}
                if number not in index:
                    yield place, None
                    continue
                start, size = index[number]
                f.seek(start)
                yield place, _opened(f.read(size), s.sharding["data_encoding"])
        finally:
            if f:
                f.close()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = (list(p) for batch in batches for p in zip(*(batch.column(a).to_pylist() for a in ("cz", "cy", "cx")), strict=True))
        for place, content in (sharded if s.sharding else unsharded)(places):
            batch = rows(place, None if content is None else s.decode(content, place))
            if batch is not None:
                yield batch

    return read


def _addresses(s: Store):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = list(zip(*(batch.column(a).to_pylist() for a in ("cz", "cy", "cx")), strict=True))
            at = list(zip(*(s.address(p) for p in places), strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names), *(pa.array(list(c), pa.int64()) for c in at)], [*batch.schema.names, "shard", "minishard", "number"])

    return add


def scan(spark: SparkSession, path: str, mip: int = 0, box: Sequence[tuple[int, int]] | None = None, drop_zero: bool = False) -> DataFrame:
    """(z, y, x, value) of a volume, or of a box of it (a start and a stop for z, y and x); ``drop_zero``
    leaves zeros out."""
    s = store(_info(spark, path), path, mip)
    whole = [(o, o + n) for o, n in zip(s.origin, s.shape, strict=True)]
    box = [(max(a, c), min(b, d)) for (a, b), (c, d) in zip(box or whole, whole, strict=True)]
    schema = "z int, y int, x int, value " + ("double" if np.dtype(s.dtype).kind == "f" else "long")
    if any(a >= b for a, b in box):
        return spark.createDataFrame([], schema)
    first = [(a - o) // c for (a, _), o, c in zip(box, s.origin, s.chunk, strict=True)]
    sizes = [-(-(b - o) // c) - f for (_, b), o, c, f in zip(box, s.origin, s.chunk, first, strict=True)]
    steps = [int(np.prod(sizes[i + 1 :])) for i in range(3)]
    place = [(F.floor(F.col("id") / steps[i]) % sizes[i] + first[i]).cast("long").alias(f"c{a}") for i, a in enumerate("zyx")]
    places = spark.range(int(np.prod(sizes))).select(*place)
    if s.sharding:
        places = places.mapInArrow(_addresses(s), "cz long, cy long, cx long, shard long, minishard long, number long")
        places = places.repartition("shard", "minishard").sortWithinPartitions("shard", "minishard", "number")
    return places.mapInArrow(_reader(s, box, drop_zero), schema)


def _whole_file(path: str, parts: Iterator[bytes]) -> None:
    """A file that appears whole or not at all."""
    part = f"{os.path.dirname(path)}/.{os.path.basename(path)}.{os.getpid()}"
    with open(part, "wb") as f:
        for p in parts:
            f.write(p)
    os.replace(part, path)


def _shard_writer(s: Store):
    """Chunks in order of (shard, minishard, number) -> shards.  Data go first to a file of their own, the
    index before them when all is known; a task holds the index and one batch."""
    many = 1 << s.sharding["minishard_bits"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, body, at, entries = None, None, 0, {}

        def finish() -> str:
            nonlocal body
            heads, at_, tables = [], at, []
            for m in range(many):
                found = entries.get(m, [])
                numbers, starts, sizes = (np.array(c, np.uint64) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64),) * 3
                gaps = starts - np.concatenate([[0], (starts + sizes)[:-1]]).astype(np.uint64) if found else starts
                table = _packed(np.stack([np.diff(numbers, prepend=np.uint64(0)), gaps, sizes]).astype("<u8").tobytes(), s.sharding["minishard_index_encoding"]) if found else b""
                heads += [at_, at_ + len(table)] if found else [0, 0]
                at_ += len(table)
                tables.append(table)
            body.seek(0)
            _whole_file(s.shard(now), itertools.chain([np.array(heads, "<u8").tobytes()], iter(lambda: body.read(1 << 20), b""), tables))
            body.close()
            os.remove(body.name)
            body = None
            return os.path.basename(s.shard(now))

        for batch in batches:
            done = []
            for shard, minishard, number, content in zip(*(batch.column(c).to_pylist() for c in ("shard", "minishard", "number", "content")), strict=True):
                if shard != now:
                    if body:
                        done.append(finish())
                    now, at, entries = shard, 0, {}
                    body = open(f"{s.folder}/.data.{shard}.{os.getpid()}", "w+b")  # noqa: SIM115
                data = _packed(content, s.sharding["data_encoding"])
                entries.setdefault(minishard, []).append((number, at, len(data)))
                body.write(data)
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["name"])
        if body:
            yield pa.RecordBatch.from_arrays([pa.array([finish()])], ["name"])

    return write


def sharded_by(shards: int, minishards: int, packed: bool = True, preshift: int = 0, scrambled: bool = False) -> dict:
    """The metadata of shards: bits of both levels, whether indices and data are packed, how many chunks
    in a row stay together (as bits), and whether numbers are hashed."""
    how = "gzip" if packed else "raw"
    return {"@type": SHARDED, "preshift_bits": preshift, "hash": "murmurhash3_x86_128" if scrambled else "identity", "minishard_bits": minishards, "shard_bits": shards, "minishard_index_encoding": how, "data_encoding": how}


def write(
    voxels: DataFrame, path: str, shape: Sequence[int], chunk: Sequence[int], voxel_nm: Sequence[float], dtype: str = "uint64", offset: Sequence[int] = (0, 0, 0),
    encoding: str = COMPRESSED, block: Sequence[int] = (8, 8, 8), sharding: dict | None = None,
) -> int:
    """(z, y, x, value) as a volume of one resolution; gives the number of files.  A chunk without rows is
    not stored.  An existing volume is an error.  The metadata come last, so a volume that has them is whole."""
    spark = voxels.sparkSession
    if load_json(spark, f"{path}/info") is not None:
        raise FileExistsError(f"{path} holds a volume")
    scale = {"chunk_sizes": [list(chunk)[::-1]], "encoding": encoding, "key": "_".join(f"{v:g}" for v in voxel_nm[::-1]), "resolution": list(voxel_nm)[::-1], "size": list(shape)[::-1], "voxel_offset": list(offset)[::-1]}
    scale |= {"compressed_segmentation_block_size": list(block)[::-1]} if encoding == COMPRESSED else {}
    scale |= {"sharding": sharding} if sharding else {}
    info = {"@type": "neuroglancer_multiscale_volume", "data_type": dtype, "num_channels": 1, "scales": [scale], "type": "segmentation" if dtype in ("uint32", "uint64") else "image"}
    s = store(info, path)
    os.makedirs(s.folder, exist_ok=True)

    def encode(keys, t):
        place = [k.as_py() for k in keys]
        values = np.zeros(s.inside(place), s.dtype)
        values[tuple(t.column(a).to_numpy() - o - p * c for a, o, p, c in zip("zyx", s.origin, place, s.chunk, strict=True))] = t.column("value").to_numpy()
        return pa.table({"cz": [place[0]], "cy": [place[1]], "cx": [place[2]], "content": pa.array([s.encode(values)], pa.binary())})

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [s.name(p) for p in zip(*(batch.column(a).to_pylist() for a in ("cz", "cy", "cx")), strict=True)]
            for name, content in zip(names, batch.column("content").to_pylist(), strict=True):
                _whole_file(os.path.join(s.folder, name), iter([content]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    spot = [F.floor((F.col(a) - o) / c).cast("long").alias(f"c{a}") for a, o, c in zip("zyx", offset, chunk, strict=True)]
    chunks = voxels.select("z", "y", "x", "value", *spot).groupBy("cz", "cy", "cx").applyInArrow(encode, "cz long, cy long, cx long, content binary")
    if sharding:
        dealt = chunks.mapInArrow(_addresses(s), "cz long, cy long, cx long, content binary, shard long, minishard long, number long")
        names = dealt.repartition("shard").sortWithinPartitions("shard", "minishard", "number").mapInArrow(_shard_writer(s), "name string")
    else:
        names = chunks.mapInArrow(save, "name string")
    files = names.count()
    _whole_file(os.path.join(_local(path), "info"), iter([json.dumps(info).encode()]))
    return files

import gzip
import json
import struct
import zlib

import numpy as np
import pytest
import zstandard

from voxelspark.sources import arrays, meshes, volumes

A = np.arange(4 * 5 * 7, dtype=np.uint16).reshape(4, 5, 7) + 1
CHUNK = (2, 3, 4)


def blocks(a, chunk):
    for z in range(0, a.shape[0], chunk[0]):
        for y in range(0, a.shape[1], chunk[1]):
            for x in range(0, a.shape[2], chunk[2]):
                part = a[z : z + chunk[0], y : y + chunk[1], x : x + chunk[2]]
                yield (z // chunk[0], y // chunk[1], x // chunk[2]), (z, y, x), part


def cells(a, low=(0, 0, 0)):
    return sorted((*(int(i) + o for i, o in zip(at, low, strict=True)), v.item()) for at, v in np.ndenumerate(a) for at in [at])


def got(df):
    return sorted(tuple(r) for r in df.collect())


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)


@pytest.fixture(params=["zarr2", "zarr2_f_nested", "zarr3", "n5", "n5_gzip"])
def stored(request, tmp_path):
    """The array A in a format, but for its last chunk in x at the origin: (path, kind, fill)."""
    name, root, fill = request.param, tmp_path / "v", 0
    for index, low, part in blocks(A, CHUNK):
        if index == (0, 0, 1):
            continue
        if name.startswith("n5"):
            head = struct.pack(">HH3I", 0, 3, *part.shape[::-1])
            raw = part.astype(">u2").tobytes()
            put(root / "/".join(map(str, index[::-1])), head + (gzip.compress(raw) if "gzip" in name else raw))
            continue
        full = np.zeros(CHUNK, np.uint16)
        full[tuple(slice(0, n) for n in part.shape)] = part
        if name == "zarr2":
            put(root / ".".join(map(str, index)), zlib.compress(full.tobytes()))
        elif name == "zarr2_f_nested":
            put(root / "/".join(map(str, index)), full.astype(">u2").tobytes(order="F"))
        else:
            put(root / "c" / "/".join(map(str, index)), zstandard.compress(full.tobytes()))
    if name.startswith("zarr2"):
        fill, f = 9, name == "zarr2_f_nested"
        meta = {"zarr_format": 2, "shape": A.shape, "chunks": CHUNK, "dtype": ">u2" if f else "<u2", "order": "F" if f else "C", "fill_value": fill, "filters": None, "compressor": None if f else {"id": "zlib"}}
        put(root / ".zarray", json.dumps(meta | ({"dimension_separator": "/"} if f else {})).encode())
    elif name == "zarr3":
        meta = {"node_type": "array", "shape": A.shape, "data_type": "uint16", "fill_value": 0, "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": CHUNK}}, "chunk_key_encoding": {"name": "default"}}
        put(root / "zarr.json", json.dumps(meta | {"codecs": [{"name": "bytes", "configuration": {"endian": "little"}}, {"name": "zstd"}]}).encode())
    else:
        put(root / "attributes.json", json.dumps({"dimensions": A.shape[::-1], "blockSize": CHUNK[::-1], "dataType": "uint16", "compression": {"type": "gzip" if "gzip" in name else "raw"}}).encode())
    return str(root), name[:4] if name.startswith("zarr") else "n5", fill


def test_chunked(spark, stored):
    path, kind, fill = stored
    whole = A.copy()
    whole[:2, :3, 4:] = fill
    assert got(arrays.read(spark, path, kind)) == cells(whole)
    box = [(1, 4), (2, 4), (3, 5)]
    assert got(volumes.scan(spark, path, kind, box)) == cells(whole[1:4, 2:4, 3:5], (1, 2, 3))
    files = volumes.scan(spark, path, kind, [(0, 1), (0, 1), (0, 1)], drop_zero=True).inputFiles()
    assert len(files) == 1
    assert volumes.scan(spark, path, kind, [(9, 12), (0, 1), (0, 1)]).count() == 0
    if fill == 0:
        assert volumes.scan(spark, path, kind, [(0, 1), (0, 1), (4, 7)], drop_zero=True).count() == 0


def test_groups_and_packings(spark, tmp_path):
    put(tmp_path / "g" / ".zgroup", b"{}")
    with pytest.raises(ValueError, match="arrayPath"):
        volumes.scan(spark, str(tmp_path / "g"), "zarr")
    meta = {"shape": [2], "chunks": [2], "dtype": "<f4", "order": "C", "fill_value": "NaN", "compressor": None}
    put(tmp_path / "g" / "a" / ".zarray", json.dumps(meta).encode())
    put(tmp_path / "g" / "a" / "0", np.array([1.5, -2], "<f4").tobytes())
    assert got(arrays.read(spark, str(tmp_path / "g"), "zarr", arrayPath="a")) == [(0, 1.5), (1, -2.0)]
    put(tmp_path / "g" / "a" / ".zarray", json.dumps(meta | {"compressor": {"id": "blosc"}}).encode())
    with pytest.raises(ValueError, match="blosc"):
        volumes.scan(spark, str(tmp_path / "g" / "a"), "zarr")


def test_precomputed(spark, tmp_path):
    path, low = str(tmp_path / "p"), (-3, 20, 10)
    some = [c for c in cells(A, low) if not (c[0] < -1 and c[1] < 23 and c[2] >= 14)]
    df = spark.createDataFrame(some, "z int, y int, x int, value long")
    volumes.write_precomputed(df, path, A.shape, CHUNK, (40.0, 8.0, 8.0), "uint16", low)
    kept = {c[:3]: c[3] for c in some}
    want = sorted((*c[:3], kept.get(c[:3], 0)) for c in cells(A, low))
    assert got(arrays.read(spark, f"precomputed://{path}")) == want
    inside = [c for c in want if -2 <= c[0] < 0 and c[1] < 22 and c[2] >= 13]
    assert got(volumes.scan(spark, path, "precomputed", [(-2, 0), (0, 22), (13, 99)])) == inside
    one = tmp_path / "p" / "8_8_40" / "10-14_20-23_-3--1"
    put(one.with_name(one.name + ".gz"), gzip.compress(one.read_bytes()))
    one.unlink()
    assert got(volumes.scan(spark, path, "precomputed")) == want
    first = volumes.pyramid(spark, path).first()
    assert (first.mip, first.nz, first.nx, first.z_nm, first.cx) == (0, 4, 7, 40.0, 4)
    with pytest.raises(FileExistsError):
        volumes.write_precomputed(df, path, A.shape, CHUNK, (40.0, 8.0, 8.0), "uint16", low)
    with pytest.raises(FileExistsError):
        volumes.write_precomputed(df, path, A.shape, (4, 4, 4), (40.0, 8.0, 8.0), "uint16", low, force=True)
    volumes.write_precomputed(df, path, A.shape, CHUNK, (40.0, 8.0, 8.0), "uint16", low, force=True)


def test_precomputed_labels_beyond_long(spark, tmp_path):
    path = tmp_path / "p"
    volumes.write_precomputed(spark.createDataFrame([(0, 0, 0, 1)], "z int, y int, x int, value long"), str(path), (1, 1, 1), (1, 1, 1), (1.0, 1.0, 1.0))
    put(path / "1_1_1" / "0-1_0-1_0-1", np.array([1 << 63], np.uint64).tobytes())
    with pytest.raises(Exception, match="do not fit"):
        volumes.scan(spark, str(path), "precomputed").collect()


@pytest.mark.parametrize("kind", ["uint16", "float32", "int32"])
def test_tiff(spark, tmp_path, kind):
    a = A.astype(kind)
    a[2] = 0
    rows = [c for c in cells(a) if c[3]]
    df = spark.createDataFrame(rows, f"z int, y int, x int, value {'double' if kind == 'float32' else 'long'}")
    path = str(tmp_path / "s.tif")
    volumes.write_tiff(df, path, A.shape, kind)
    assert got(arrays.read(spark, path, slab="2")) == cells(a)
    assert got(volumes.scan_tiff(spark, path, drop_zero=True)) == rows
    with pytest.raises(FileExistsError):
        volumes.write_tiff(df, path, A.shape, kind)


def page(a, end, packing, predictor, tile, at):
    """One directory of a classic file at byte ``at``, its blocks after it."""
    h, w = tile or (2, a.shape[1])
    parts = []
    for y in range(0, a.shape[0], h):
        for x in range(0, a.shape[1], w):
            part = a[y : y + h, x : x + w]
            if tile:
                part = np.pad(part, ((0, h - part.shape[0]), (0, w - part.shape[1])))
            if predictor == 2:
                part = np.concatenate([part[:, :1], np.diff(part, axis=1)], axis=1)
            raw = part.astype(f"{end}u2").tobytes()
            parts.append(zlib.compress(raw) if packing == 8 else raw)
    n = len(parts)
    tags = [(256, a.shape[1]), (257, a.shape[0]), (258, 16), (259, packing), (317, predictor)]
    tags += [(322, w), (323, h), (324, None), (325, None)] if tile else [(273, None), (278, h), (279, None)]
    tags.sort()
    lists = at + 2 + 12 * len(tags) + 4
    data = lists + 8 * n
    starts = [data + sum(map(len, parts[:i])) for i in range(n)]
    out = struct.pack(f"{end}H", len(tags))
    for tag, value in tags:
        many = n if value is None else 1
        if value is None:
            value = lists + (0 if tag in (273, 324) else 4 * n)
        out += struct.pack(f"{end}HHII", tag, 4, many, value)
    body = struct.pack(f"{end}{2 * n}I", *starts, *map(len, parts)) + b"".join(parts)
    return out, body


@pytest.mark.parametrize(("end", "packing", "predictor", "tile"), [("<", 1, 1, None), (">", 8, 2, None), ("<", 8, 2, (3, 4)), (">", 1, 1, (3, 4))])
def test_classic_tiff(spark, tmp_path, end, packing, predictor, tile):
    content = struct.pack(f"{end}2sHI", b"II" if end == "<" else b"MM", 42, 8)
    for i, plane in enumerate(A[:2]):
        out, body = page(plane, end, packing, predictor, tile, len(content))
        content += out + struct.pack(f"{end}I", 0 if i else len(content) + len(out) + 4 + len(body)) + body
    put(tmp_path / "c.tif", content)
    assert got(volumes.scan_tiff(spark, str(tmp_path / "c.tif"))) == cells(A[:2])


def test_no_tiff(spark, tmp_path):
    put(tmp_path / "x.tif", b"plain text, sixteen")
    with pytest.raises(ValueError, match="no TIFF"):
        volumes.scan_tiff(spark, str(tmp_path / "x.tif"))


def fragment(vertices, corners):
    return struct.pack("<I", len(vertices)) + np.array(vertices, "<f4").tobytes() + np.array(corners, "<u4").tobytes()


def test_precomputed_meshes(spark, tmp_path):
    p = tmp_path / "p"
    put(p / "info", json.dumps({"mesh": "m"}).encode())
    put(p / "m" / "5:0", json.dumps({"fragments": ["5:0:a", "5:0:b"]}).encode())
    put(p / "m" / "6:0", json.dumps({"fragments": ["6:0:a"]}).encode())
    put(p / "m" / "7:0", json.dumps({"fragments": []}).encode())
    put(p / "m" / "5:0:a", fragment([(0, 0, 0), (1, 0, 0), (0, 1, 0)], [(0, 1, 2)]))
    put(p / "m" / "5:0:b", fragment([(0, 0, 1), (1, 0, 1), (0, 1, 1), (1, 1, 1)], [(0, 1, 2), (1, 3, 2)]))
    put(p / "m" / "6:0:a", fragment([(9, 9, 9), (8, 9, 9), (9, 8, 9)], [(2, 1, 0)]))
    v, f = meshes.scan_precomputed(spark, f"precomputed://{p}", [5, 6, 7, 5])
    assert v.filter("segment = 5").count() == 7 and v.filter("segment = 6 AND vid = 1").first().x == 8
    assert got(f) == [(5, 0, 0, 1, 2), (5, 1, 3, 4, 5), (5, 2, 4, 6, 5), (6, 0, 2, 1, 0)]
    assert [d.count() for d in meshes.scan_precomputed(spark, str(p), [7])] == [0, 0]
    with pytest.raises(FileNotFoundError):
        meshes.scan_precomputed(spark, str(p), [8])
    with pytest.raises(ValueError):
        meshes.scan_precomputed(spark, str(p), [])
    put(p / "m" / "info", json.dumps({"@type": "neuroglancer_multilod_draco"}).encode())
    with pytest.raises(ValueError, match="single resolution"):
        meshes.scan_precomputed(spark, str(p), [5])


def test_npz_mesh(spark, tmp_path):
    np.savez(tmp_path / "m.npz", vertices=np.array([[0, 1, 2], [3, 4, 5.5]]), faces=np.array([[0, 1, 0]]))
    v, f = meshes.read(spark, str(tmp_path / "m.npz"))
    assert got(v) == [(0, 0.0, 1.0, 2.0), (1, 3.0, 4.0, 5.5)] and got(f) == [(0, 0, 1, 0)]

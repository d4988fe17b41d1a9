"""Language-model scores from a log-frequency Bloom filter.

Documents are taken in blocks of some megabytes.  A block asks once for its distinct tokens and
its distinct pairs, with what its own training documents add; the requests meet by a hash, so a
segment sees all counts of its tokens or pairs and answers every block.  A frequent token thus costs
one entry a block and not one a document, and no segment or block is held beyond its size.

Exact part.  Tokens are answered with their counts, for the base score.

The model.  Counts are read as levels, 1 + floor(2 log2 c).  Tokens and pairs of training documents are
entered into one log-frequency Bloom filter, cut into pieces by ranges of the hash: an n-gram of count c
is entered once for each level up to its own.  The pieces, each as large as its entries need at
``ENTRY_BITS`` bits, are written down; so every n-gram is in the model at any size of the input.  A pass
of its own then reads all levels by probing level after level until one is absent.  While the filter is
within the bound of a broadcast it goes to all workers, and each block is probed where it lies; beyond it
the pieces stay and the blocks' requests go to them.  Either way the answers are the same.  Errors are
one-sided: an absent level is read as present once in ``(1 - exp(-PROBES / ENTRY_BITS)) ** -PROBES``
times, some thousand, so the probabilities of a context sum to one within about a thousandth.

P(w | v) = l c(v, w) / c(v) + (1 - l) (c(w) + 1) / (N + V + 1), all c by level; l depends on
the level of c(v) and is fitted by expectation maximisation on all training documents, whose
own occurrence is taken off the counts; only this fit uses the pairs' exact levels.  Ends of documents are tokens
and the context of the first one.

Defined cases: a null text is empty and is its end alone; null ids are training rows (their
checksum is null); repeated rows are scored alike and counted each; without training tokens every
token has probability 1 / (0 + 0 + 1); extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.llm import textscan as ts
from voxelspark.llm.common import BROADCAST_BYTES, cut, remove, table, written

ENTRY_BITS = 16
PROBES = 6
BLOCK_BYTES = 4 << 20  # of text in a block
SEGMENT_BYTES = 24 << 20  # of text whose requests meet in one segment
_END = ts.mix(np.array([0xE0D], dtype=np.uint64))[0]
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LEVELS = 80


def tokens(words: ts.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row) of all tokens in order, each row's end included, and where rows begin."""
    n = len(words.counts)
    start = words.first + np.arange(n + 1)
    h = np.empty(len(words.hash) + n, dtype=np.uint64)
    h[np.arange(len(words.hash)) + words.row] = words.hash
    h[start[1:] - 1] = _END
    return h, np.repeat(np.arange(n), np.diff(start)), start


def level(count: np.ndarray) -> np.ndarray:
    """1 + floor(2 log2 c), exactly: whether c^2 reaches a power of two."""
    c = count.astype(np.float64)
    return 1 + (np.frexp(c * c)[1] - 1)


_MEAN = np.zeros(_LEVELS + 2)
for _q in range(1, _LEVELS + 2):  # the middle of the counts of a level, or the one count that it has
    _low, _high = math.ceil(2 ** ((_q - 1) / 2)), math.ceil(2 ** (_q / 2)) - 1
    _MEAN[_q] = math.sqrt(_low * max(_low, _high))


class Filter:
    """The pieces of all segments in one bit array, and the training rows' tokens and types."""

    def __init__(self, bits: np.ndarray, segments: int, tokens: int, types: int):
        self.bits, self.segments, self.piece = bits, segments, len(bits) // segments * 8
        self.tokens, self.types = tokens, types

    @staticmethod
    def places(h: np.ndarray, q: int, piece: int) -> Iterator[np.ndarray]:
        """Bit numbers, within its piece, of each n-gram at level q, probe by probe."""
        x = ts.mix(h + np.uint64(q * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        a, b = x >> np.uint64(32), (x & np.uint64(0xFFFFFFFF)) | np.uint64(1)
        for i in range(PROBES):
            yield ((a + np.uint64(i) * b) & np.uint64(0xFFFFFFFF)) * np.uint64(piece) >> np.uint64(32)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """The level of each n-gram, 0 if absent."""
        out = np.zeros(len(grams), dtype=np.int64)
        h, alive = short(grams), np.arange(len(grams))
        base = segment_of(grams, self.segments).astype(np.uint64) * np.uint64(self.piece)
        for q in range(1, _LEVELS + 1):
            ok = np.ones(len(alive), dtype=bool)
            for at in self.places(h[alive], q, self.piece):
                at = at + base[alive]
                ok &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
            alive = alive[ok]
            if not len(alive):
                return out
            out[alive] = q
        return out


def segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    """Segments are ranges of the hash, so hashes in order are in order of segment."""
    return (((h >> np.uint64(40)) * np.uint64(segments)) >> np.uint64(24)).astype(np.int64)


def short(h: np.ndarray) -> np.ndarray:
    """What a segment keeps of an n-gram's hash: its low 32 bits.  In a segment of some millions of
    n-grams one in a thousand meets another, far less often than the filter errs."""
    return h & np.uint64((1 << 32) - 1)


def _packed(h: np.ndarray, size: int = 4) -> bytes:
    """Ascending numbers of ``size`` bytes as compressed differences, byte by byte of the same place."""
    steps = np.diff(h, prepend=np.uint64(0)).astype(f"<u{size}")
    return len(h).to_bytes(4, "little") + pa.compress(steps.view(np.uint8).reshape(-1, size).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, size: int = 4) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    planes = np.frombuffer(pa.decompress(raw[4:], decompressed_size=size * n, codec="zstd", asbytes=True), dtype=np.uint8).reshape(size, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(f"<u{size}").ravel(), dtype=np.uint64)


def _narrow(x: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes each, compressed; the head says how many."""
    size = next(s for s in (1, 2, 4, 8) if s == 8 or x.max(initial=0) < 1 << 8 * s)
    planes = x.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()
    return bytes([size]) + len(x).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _wide(raw: bytes) -> np.ndarray:
    size, n = raw[0], int.from_bytes(raw[1:5], "little")
    planes = np.frombuffer(pa.decompress(raw[5:], decompressed_size=size * n, codec="zstd", asbytes=True), dtype=np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(f"<u{size}").ravel().astype(np.int64)


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one, as a row is a whole block."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _counted(docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return docs.select("doc_id", "text", held.alias("held"))


def block_table(docs: DataFrame, segments: int) -> DataFrame:
    """One row a block: its documents, distinct tokens by segment, distinct pairs by context and
    token, and where the pairs stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for turn, part in enumerate(ts.blocks(batches, "text", BLOCK_BYTES)):
            h, row, start = tokens(ts.scan(part.column("text")))
            train = ~np.asarray(part.column("held").to_numpy(zero_copy_only=False), dtype=bool)
            one, w = np.unique(h, return_inverse=True)  # in order of segment
            v = np.empty_like(w)
            v[1:] = w[:-1]
            v[start[:-1]] = np.searchsorted(one, _END)
            key = v * len(one) + w
            order = np.argsort(key, kind="stable")  # rows were in order
            key, row, w = key[order], row[order], w[order]
            new = np.append(True, key[1:] != key[:-1])
            first, posted = np.flatnonzero(new), np.flatnonzero(new | np.append(True, row[1:] != row[:-1]))
            learnt = train[row].astype(np.int64)
            follow = np.bincount(key[first] // len(one), minlength=len(one))
            second = w[first].copy()  # steps among those that follow the same token
            second[1:] -= np.where(np.diff(key[first] // len(one)) > 0, 0, w[first][:-1])
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([task << 32 | turn], pa.int64()),
                    "ids": pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    "held": pa.array([part.column("held").to_pylist()], pa.list_(pa.bool_())),
                    "n_tokens": pa.array([np.diff(start)], pa.list_(pa.int64())),
                    "hashes": pa.array([_packed(one, 8)], pa.binary()),
                    "own": pa.array([_narrow(np.bincount(w, weights=learnt, minlength=len(one)).astype(np.int64))], pa.binary()),
                    "follow": pa.array([_narrow(follow)], pa.binary()),
                    "second": pa.array([_narrow(second)], pa.binary()),
                    "both": pa.array([_narrow(np.add.reduceat(learnt, first))], pa.binary()),
                    "widths": pa.array([_narrow(np.diff(np.append(np.searchsorted(posted, first), len(posted))))], pa.binary()),
                    "rows": pa.array([_narrow(row[posted])], pa.binary()),
                    "often": pa.array([_narrow(np.diff(np.append(posted, len(h))))], pa.binary()),
                }
            )

    schema = "block long, ids array<long>, held array<boolean>, n_tokens array<long>, hashes binary, own binary, follow binary, second binary, both binary, widths binary, rows binary, often binary"
    return _counted(docs).mapInArrow(run, schema)


def _pairs_of(r: dict, segments: int) -> tuple[np.ndarray, ...]:
    """First and second token of a block's pairs, and the pairs' hashes, segments and the order in
    which they are asked for."""
    one, second, follow = _unpacked(r["hashes"], 8), np.append(0, np.cumsum(_wide(r["second"]))), _wide(r["follow"])
    v = np.repeat(np.arange(len(one)), follow)
    second = second[1:] - np.repeat(second[np.cumsum(follow) - follow], follow)
    h = ts.mix(one[v] * _PAIR + one[second])
    seg, h = segment_of(h, 2 * segments), short(h)
    return v, second, h, seg, np.lexsort((h, seg))


def _requests(blocks: DataFrame, segments: int) -> DataFrame:
    """Segments of tokens come before those of pairs, which are twice as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _each(batch):
                h, own = _unpacked(r["hashes"], 8), _wide(r["own"])
                cuts = np.searchsorted(segment_of(h, segments), np.arange(segments + 1))
                some = np.flatnonzero(np.diff(cuts))
                _, _, pair, seg, order = _pairs_of(r, segments)
                pair, both = pair[order], _wide(r["both"])[order]
                at = np.searchsorted(seg[order], np.arange(2 * segments + 1))
                more = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_pydict(
                    {
                        "seg": pa.array(np.append(some, more + segments), pa.int64()),
                        "block": pa.array([r["block"]] * (len(some) + len(more)), pa.int64()),
                        "hashes": pa.array([*(_packed(h[cuts[s] : cuts[s + 1]], 8) for s in some), *(_packed(pair[at[s] : at[s + 1]]) for s in more)], pa.binary()),
                        "own": pa.array([*(_narrow(own[cuts[s] : cuts[s + 1]]) for s in some), *(_narrow(both[at[s] : at[s + 1]]) for s in more)], pa.binary()),
                    }
                )

    return blocks.select("block", "hashes", "own", "follow", "second", "both").mapInArrow(run, "seg long, block long, hashes binary, own binary")


def filled(grams: np.ndarray, counts: np.ndarray, entry_bits: int = ENTRY_BITS) -> Filter:
    """The piece of one segment: all its n-grams of count 1 or more, with room for all of them."""
    grams, q = short(grams[counts > 0]), level(counts[counts > 0])
    bits = np.zeros(8 * max(8, math.ceil(int(q.sum()) * entry_bits / 8)), dtype=bool)
    for k in range(1, int(q.max(initial=0)) + 1):
        for at in Filter.places(grams[q >= k], k, len(bits)):
            bits[at] = True
    return Filter(np.packbits(bits, bitorder="little"), 1, 0, 0)


def _read(bits: bytes, grams: np.ndarray) -> np.ndarray:
    """Levels of n-grams by probing the piece that would hold them."""
    return Filter(np.frombuffer(bits, dtype=np.uint8), 1, 0, 0).levels(grams)


def _stored(requests: DataFrame, segments: int, entry_bits: int) -> str:
    """Writes (seg, block, counts, bits, types, total), pieces and counts apart, and gives the path: the filter's piece of each segment, with its distinct
    training tokens and their sum, and for each request the exact counts of tokens or levels of pairs."""

    def run(t: pa.Table) -> pa.Table:
        seg = t["seg"][0].as_py()
        words = seg < segments
        hashes = [_unpacked(x, 8 if words else 4) for x in t["hashes"].to_pylist()]
        own = np.concatenate([_wide(x) for x in t["own"].to_pylist()])
        grams, code = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(code, weights=own).astype(np.int64)
        at = np.cumsum([0, *map(len, hashes)])
        told, exact = list(zip(t["block"].to_pylist(), at, at[1:], strict=False)), total if words else np.where(total > 0, level(np.maximum(total, 1)), 0)
        return pa.table(
            {
                "seg": pa.array([seg] * (len(told) + 1), pa.int64()),
                "block": pa.array([None, *(b for b, _, _ in told)], pa.int64()),
                "counts": pa.array([None, *(_narrow(exact[code[a:b]]) for _, a, b in told)], pa.binary()),
                "bits": pa.array([filled(grams, total, entry_bits).bits.tobytes(), *[None] * len(told)], pa.binary()),
                "types": pa.array([int((total > 0).sum()) if words else 0, *[0] * len(told)], pa.int64()),
                "total": pa.array([int(total.sum()) if words else 0, *[0] * len(told)], pa.int64()),
            }
        )

    told = requests.groupBy("seg").applyInArrow(run, "seg long, block long, counts binary, bits binary, types long, total long")
    return written(told.withColumn("kind", F.when(F.col("block").isNull(), "pieces").otherwise("counts")), "filter", "kind")


def _probed(requests: DataFrame, pieces: DataFrame, segments: int) -> DataFrame:
    """(seg, block, levels) for each request, where the pieces are."""

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        size, bits = (8 if a["seg"][0].as_py() < segments else 4) if a.num_rows else 8, b["bits"][0].as_py()
        told = [_narrow(_read(bits, _unpacked(x, size))) for x in a["hashes"].to_pylist()]
        return pa.table({"seg": a["seg"].combine_chunks(), "block": a["block"].combine_chunks(), "levels": pa.array(told, pa.binary())})

    return requests.groupBy("seg").cogroup(pieces.groupBy("seg")).applyInArrow(run, "seg long, block long, levels binary")


def _looked_up(docs: DataFrame, segments: int, entry_bits: int, most: int) -> tuple[DataFrame, int, int]:
    """One row a block: its documents with their exact sums, and how often each document has each
    combination of levels of context, token and pair, and of the pair's exact level (seven bits each).
    And the training tokens and types.  What is stored goes as soon as it has been read."""
    blocks = cut(block_table(docs, segments))
    spark, path = docs.sparkSession, _stored(_requests(blocks, segments), segments, entry_bits)
    kinds = "seg long, block long, counts binary, bits binary, types long, total long"
    stored = spark.read.schema(f"{kinds}, kind string").parquet(path)
    size, n, v = stored.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (F.octet_length("bits"), "total", "types")]).first()
    pieces, counts = stored.filter("kind = 'pieces'").select("seg", "bits"), stored.filter("kind = 'counts'").select("seg", "block", "counts")
    sent = None
    if size <= most:
        sent = spark.sparkContext.broadcast({r.seg: r.bits for r in pieces.collect()})
        answers = counts.withColumn("levels", F.lit(None).cast("binary"))
    else:
        probed = cut(_probed(_requests(blocks, segments).drop("own"), pieces, segments))
        remove(spark, f"{path}/kind=pieces")
        counts = spark.read.schema(kinds).parquet(f"{path}/kind=counts").select("seg", "block", "counts")
        answers = counts.unionByName(probed, allowMissingColumns=True)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        seg = np.asarray(b["seg"])
        order = np.argsort(seg, kind="stable")
        exact, probed = b["counts"].to_pylist(), b["levels"].to_pylist()
        r = a.to_pylist()[0]
        v, w, pair, pair_seg, asked = _pairs_of(r, segments)
        counts = np.concatenate([_wide(exact[i]) for i in order if exact[i] is not None and seg[i] < segments])
        q2, true = np.empty(len(asked), dtype=np.int64), np.empty(len(asked), dtype=np.int64)
        true[asked] = np.concatenate([_wide(exact[i]) for i in order if exact[i] is not None and seg[i] >= segments])
        if sent is None:
            q1 = np.concatenate([_wide(probed[i]) for i in order if probed[i] is not None and seg[i] < segments])
            q2[asked] = np.concatenate([_wide(probed[i]) for i in order if probed[i] is not None and seg[i] >= segments])
        else:
            one = _unpacked(r["hashes"], 8)
            q1 = np.empty(len(one), dtype=np.int64)
            for grams, at, first, out in ((one, segment_of(one, segments), 0, q1), (pair[asked], pair_seg[asked], segments, q2)):
                cuts = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at))
                levels = [_read(sent.value[first + int(at[low])], grams[low:high]) for low, high in zip(cuts, cuts[1:], strict=False)]
                out[slice(None) if out is q1 else asked] = np.concatenate(levels)
        rows, often, widths = _wide(r["rows"]), _wide(r["often"]), _wide(r["widths"])
        m = len(r["ids"])
        base = np.bincount(rows, weights=np.repeat(np.log10(counts + 1.0)[w], widths) * often, minlength=m)
        known = np.bincount(rows, weights=np.repeat(counts[w] > 0, widths) * often, minlength=m).astype(np.int64)
        key, inverse = np.unique(rows << 28 | np.repeat(q1[v] << 21 | q1[w] << 14 | q2 << 7 | true, widths), return_inverse=True)
        columns = {
            "ids": pa.array([r["ids"]], pa.list_(pa.int64())),
            "held": pa.array([r["held"]], pa.list_(pa.bool_())),
            "n_tokens": pa.array([r["n_tokens"]], pa.list_(pa.int64())),
            "known": pa.array([known], pa.list_(pa.int64())),
            "base": pa.array([base], pa.list_(pa.float64())),
            "widths": pa.array([_narrow(np.bincount(key >> 28, minlength=m))], pa.binary()),
            "levels": pa.array([_narrow(key & (1 << 28) - 1)], pa.binary()),
            "often": pa.array([_narrow(np.bincount(inverse, weights=often).astype(np.int64))], pa.binary()),
        }
        return pa.table(columns)

    schema = "ids array<long>, held array<boolean>, n_tokens array<long>, known array<long>, base array<double>, widths binary, levels binary, often binary"
    asked = blocks.drop("own", "both")
    looked = cut(asked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema))
    remove(spark, path)
    return looked, n, v


def _levels(r: dict) -> tuple[np.ndarray, ...]:
    """Row, levels of context, token and pair, the pair's exact level, and how often."""
    x, widths = _wide(r["levels"]), _wide(r["widths"])
    return np.repeat(np.arange(len(widths)), widths), x >> 21, x >> 14 & 127, x >> 7 & 127, x & 127, _wide(r["often"])


def _tuned(looked: DataFrame, n: int, v: int) -> np.ndarray:
    """The weight of the pair model for each level of the context's count, fitted on exact levels: what
    follows a token that was seen once was never seen with it before, so any error would be its weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = np.zeros((_LEVELS + 1, 64))
        for batch in batches:
            for r in _each(batch):
                row, q, one, _, both, often = _levels(r)
                learnt = ~np.array(r["held"], dtype=bool)[row]
                q, one, both, often = q[learnt], _MEAN[one[learnt]], _MEAN[both[learnt]], often[learnt]
                pair = np.maximum(both - 1, 0) / np.maximum(_MEAN[q] - 1, 1)
                odds = np.clip(np.rint(2 * np.log2(np.maximum(pair, 1e-12) / (np.maximum(one, 1) / (n + v)))) + 32, 1, 63)
                odds[pair <= 0] = 0
                np.add.at(grid, (q, odds.astype(np.int64)), often)
        at = np.argwhere(grid > 0)
        yield pa.RecordBatch.from_pydict({"q": pa.array(at[:, 0]), "odds": pa.array(at[:, 1]), "n": pa.array(grid[grid > 0])})

    grid = np.zeros((_LEVELS + 1, 64))
    for r in looked.select("held", "widths", "levels", "often").mapInArrow(run, "q long, odds long, n double").groupBy("q", "odds").agg(F.sum("n").alias("n")).collect():
        grid[r.q, r.odds] = r.n
    ratio = np.append(0, 2 ** ((np.arange(1, 64) - 32) / 2))
    weight = np.full(_LEVELS + 1, 0.1)
    for _ in range(30):
        share = weight[:, None] * ratio / (weight[:, None] * ratio + 1 - weight[:, None])
        weight = ((grid * share).sum(axis=1) + 0.1) / (grid.sum(axis=1) + 10)
    weight[0] = 0
    return weight


def scored(docs: DataFrame, entry_bits: int = ENTRY_BITS, most: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text) -> (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); a filter
    of up to ``most`` bytes is broadcast."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = max(16, math.ceil(size / SEGMENT_BYTES))
    looked, n, v = _looked_up(docs, segments, entry_bits, most)
    weight, norm = _tuned(looked, n, v), math.log10(n + v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _each(batch):
                row, q, one, both, _, often = _levels(r)
                pair = np.minimum(_MEAN[both] / np.maximum(_MEAN[q], 1), 1)
                p = weight[q] * pair + (1 - weight[q]) * (_MEAN[one] + 1) / (n + v + 1)
                m = len(r["ids"])
                score = np.bincount(row, weights=np.log10(np.minimum(p, 1)) * often, minlength=m)
                size = np.asarray(r["n_tokens"], dtype=np.int64)
                columns = [r["ids"], r["held"], size, r["known"], np.full(m, n), np.asarray(r["base"]) - size * norm, score]
                kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return looked.mapInArrow(run, schema)


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"))

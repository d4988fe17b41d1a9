"""Vectorised scanning of Arrow text columns with NumPy: words, word hashes and shingle sets.

The kernels work on the UTF-8 bytes of many documents at once.  Separators are ASCII, so
cutting at bytes equals cutting at characters.  Callers walk a batch in blocks of about
``BLOCK_BYTES`` so that memory follows the block (or one longest text), never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACES = frozenset((0x20, 9, 10, 11, 12, 13))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply); returns a new array."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32  # A-Z only
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))[_FOLD]  # folded byte -> 64 bits
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
NOT_LETTERS = np.ones(256, dtype=bool)  # letters: A-Z, a-z and all bytes beyond ASCII
NOT_LETTERS[65:91] = NOT_LETTERS[97:123] = NOT_LETTERS[128:] = False
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + (BLOCK_BYTES >> 2))
        for i, base in enumerate((_BASE, _INVERSE)):
            run = np.full(size, base, dtype=_U)
            run[0] = 1
            _powers[i] = np.cumprod(run, dtype=_U)
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the n + 1 offsets of its rows; null reads as empty."""
    if column.type not in (pa.string(), pa.large_string()):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int32 if column.type == pa.string() else np.int64
    _, places, data = column.buffers()
    at = np.frombuffer(places, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cuts batches into slices whose texts have at most ``limit`` bytes together (or one row), and
    of at most ``rows`` rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(at, at[low] + limit, side="right")) - 1)
            high = min(high, low + rows) if rows else high
            yield batch.slice(low, high - low)
            low = high


def _segments(raw: np.ndarray, keep: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts a block into stretches of about ``BLOCK_BYTES`` between words, so that the arrays of
    eight bytes a byte never cover a whole long text (but for one word that is longer)."""
    low = 0
    while low < len(raw):
        high = min(len(raw), low + BLOCK_BYTES)
        if high < len(raw):
            gaps = np.flatnonzero(~keep[low:high])
            if len(gaps):
                high = low + int(gaps[-1]) + 1
            else:
                rest = np.flatnonzero(~keep[high:])
                high = high + int(rest[0]) + 1 if len(rest) else len(raw)
        yield low, high
        low = high


class Words:
    """Words of a block: starts and ends in bytes, row of each, first word of each row, hashes."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, apart: np.ndarray = _SPACE):
        keep = ~apart[raw]
        before = np.zeros(len(raw), dtype=bool)
        before[1:] = keep[:-1]
        edge = at[:-1][at[:-1] < len(raw)]
        before[edge] = False
        after = np.zeros(len(raw), dtype=bool)
        after[:-1] = keep[1:]
        after[at[1:][at[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(keep & ~before)
        self.ends = np.flatnonzero(keep & ~after) + 1
        self.first = np.searchsorted(self.starts, at)  # n + 1
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(at) - 1), self.counts)
        self._raw = raw
        h = np.empty(len(self.starts), dtype=_U)
        for low, high in _segments(raw, keep):
            i, j = np.searchsorted(self.starts, (low, high))
            if i == j:
                continue
            starts, ends = self.starts[i:j] - low, self.ends[i:j] - low
            power, inverse = _grow(high - low + 1)
            total = np.zeros(high - low + 1, dtype=_U)
            np.cumsum(_BYTE[raw[low:high]] * power[: high - low], out=total[1:])
            h[i:j] = (total[ends] - total[starts]) * inverse[starts]
        self.hash = mix(h + (self.ends - self.starts).astype(_U) * _U(0xA0761D6478BD642F))

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and hashes of the first ``size`` bytes of the words that have as many."""
        long = np.flatnonzero(self.ends - self.starts >= size)
        s, h, power = self.starts[long], np.zeros(len(long), dtype=_U), _grow(size)[0]
        for i in range(size):
            h += _BYTE[self._raw[s + i]] * power[i]
        return self.row[long], mix(h ^ mix(np.array([size + 1000], dtype=_U)))


def scan(column: pa.Array, apart: np.ndarray = _SPACE) -> Words:
    return Words(*text_bytes(column), apart)


_STEP = mix(np.arange(101, 133, dtype=_U)) | _U(1)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, as (row, hash) sorted by both, and counts by row.

    A row with fewer words than ``size`` has its whole sequence as its one shingle; a row
    without words has none.
    """
    h, counts, n = words.hash, words.counts, len(words.counts)
    rows, sets = [], []
    if len(h) >= size:
        here = words.row[: len(h) - size + 1]
        whole = here == words.row[size - 1 :]
        value = h[: len(h) - size + 1] * _STEP[0]
        for k in range(1, size):
            value = value + h[k : len(h) - size + 1 + k] * _STEP[k]
        rows.append(here[whole])
        sets.append(mix(value[whole]))
    for m in range(1, size):
        short = np.flatnonzero(counts == m)
        if len(short):
            value = np.full(len(short), (m * 0xE7037ED1A0B428DB) & 0xFFFFFFFFFFFFFFFF, dtype=_U)
            for k in range(m):
                value += h[words.first[short] + k] * _STEP[k]
            rows.append(short)
            sets.append(mix(value))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(n, np.int64)
    row, value = np.concatenate(rows), np.concatenate(sets)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    return row, value, np.bincount(row, minlength=n)

"""Benchmark decontamination: passages of a benchmark in documents, up to a share of edits.

Texts are lower-cased and every run of ASCII characters other than letters and digits becomes one
space.  An item of m characters may differ from a passage by k = floor(rate * m) edits.  Items and
texts have a space on either side, and those of an item count: a passage that begins or ends inside a
word of the text is an edit away for each such end, so a short item (k = 0) is found as whole words
only.  The item is cut into k + 1 pieces; by the pigeonhole principle an occurrence within k edits holds a piece unchanged.
One Aho-Corasick automaton finds the pieces of all items in one pass over a document; around each
hit a count of shared 4-grams (k edits spoil at most 4k of them) turns most chance hits away, and
Myers' bit-parallel algorithm gives the least edit distance of the item to any passage there.
Hits on diagonals that a checked window covers are not checked again.

The benchmark is measured first and taken in blocks of at most ``BLOCK_BYTES`` of text, each of
which goes to the workers and over the documents once, so what is sent is bounded for any size.

Defined cases: a null text holds nothing, an item without letters or digits (or null) matches
nothing, null ids are returned as null; repeated items and documents give a row each;
documents' other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from voxelspark.llm import textscan as ts
from voxelspark.llm.common import table

RATE = 0.1
#: Memory of a block of items in a task: its patterns and automaton, counted per item and per byte of text.
BLOCK_BYTES, ITEM_BYTES, TEXT_BYTES = 192 << 20, 2500, 100
_SLOTS = 1 << 14
_FOLD = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def normal(text: str | None) -> str:
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()).decode("utf-8", "surrogatepass")


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece) of the budget + 1 pieces of nearly equal length."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def gram_slots(text: str) -> np.ndarray:
    """A slot of ``_SLOTS`` for each 4-gram of the text, equal for equal ones."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(c) < 4:
        return np.zeros(0, dtype=np.uint16)
    code = ((c[:-3] * np.uint64(0x9E3779B1) + c[1:-2]) * np.uint64(0x85EBCA77) + c[2:-1]) * np.uint64(0xC2B2AE3D) + c[3:]
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(50)).astype(np.uint16)


class Pattern:
    """An item with its bit masks."""

    def __init__(self, ident, text: str, rate: float, chars: int | None = None):
        self.ident, self.text, self.size = ident, text, len(text)
        self.chars = self.size if chars is None else chars  # what the budget is a share of
        self.budget = min(math.floor(rate * self.chars), self.chars - 1)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i
        self.shared = self.size - 3 - 4 * self.budget
        self.grams = np.unique(gram_slots(text)).astype(np.uint16) if self.shared > 0 else None

    def may_hold(self, slots: np.ndarray) -> bool:
        """False only if no passage of the text with these 4-grams is within budget."""
        if self.shared <= 0:
            return True
        at = np.minimum(np.searchsorted(self.grams, slots), len(self.grams) - 1)
        return np.count_nonzero(self.grams[at] == slots) >= self.shared

    def best(self, text: str) -> tuple[int, int] | None:
        """(distance, end) of the nearest passage in ``text`` if within budget; first end on ties."""
        m, masks, limit = self.size, self.masks, self.budget
        full, high = (1 << m) - 1, 1 << (m - 1)
        pv, mv, score, found, left = full, 0, m, None, len(text)
        for j, c in enumerate(text):
            eq = masks.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (full & ~(xh | pv))
            mh = pv & xh
            if ph & high:
                score += 1
            elif mh & high:
                score -= 1
            if score <= limit:
                found, limit = (score, j + 1), score - 1
                if limit < 0:
                    break
            elif score - (left - j - 1) > limit:
                break
            ph = (ph << 1) & full
            mh = (mh << 1) & full
            pv = mh | (full & ~(xv | ph))
            mv = ph & xv
        return found


def automaton(patterns: list[Pattern]):
    import ahocorasick

    places: dict[str, list[tuple[int, int]]] = {}
    for i, p in enumerate(patterns):
        for offset, piece in pieces(p.text, p.budget):
            places.setdefault(piece, []).append((i, offset))
    out = ahocorasick.Automaton()
    for piece, where in places.items():
        out.add_word(piece, (len(piece), where))
    out.make_automaton()
    return out


def matches(text: str, patterns: list[Pattern], machine) -> dict[int, tuple[int, int]]:
    """Pattern number -> (distance, end) of its nearest passage in the normalised text."""
    best: dict[int, tuple[int, int]] = {}
    checked: dict[int, list[int]] = {}
    slots = None
    for last, (size, where) in machine.iter(text):
        for i, offset in where:
            p = patterns[i]
            if best.get(i, (1,))[0] == 0:
                continue
            start = last + 1 - size - offset
            seen = checked.setdefault(i, [])
            k = p.budget
            if seen and any(abs(start - s) <= k for s in seen[-4:]):
                continue
            seen.append(start)
            low = max(0, start - 2 * k)
            high = start + p.size + 2 * k
            slots = gram_slots(text) if slots is None else slots
            found = p.best(text[low:high]) if p.may_hold(slots[low:high]) else None
            if found and (i not in best or (found[0], found[1] + low) < best[i]):
                best[i] = (found[0], found[1] + low)
    return best


def _patterns(listed: list[tuple], rate: float) -> list[Pattern]:
    return [Pattern(i, f" {t} ", rate, len(t)) for i, t in listed]


def _blocks(items: DataFrame) -> Iterator[list]:
    size = items.agg(F.sum(F.octet_length("text").cast("long") * TEXT_BYTES + ITEM_BYTES)).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    for b in range(n):
        yield items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).select("item_id", "text").collect()


def contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """docs (doc_id, text), items (item_id, text) -> (doc_id, item_id, distance, end_at, chars):
    each item found in a document, its least distance, where the first such passage ends in the
    normalised text, and the item's normalised length."""
    ident, item_kind = dict(docs.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    item_arrow = to_arrow_type(items.schema["item_id"].dataType)
    schema = f"doc_id {ident}, item_id {item_kind}, distance int, end_at long, chars int"
    parts = []
    for rows in _blocks(items.filter(F.col("text").isNotNull())):
        listed = [(r.item_id, t) for r in rows if (t := normal(r.text))]

        def run(batches: Iterator[pa.RecordBatch], listed=listed) -> Iterator[pa.RecordBatch]:
            patterns = _patterns(listed, rate)
            machine = automaton(patterns) if patterns else None
            for part in ts.blocks(batches, "text"):
                out = []
                if machine:
                    for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                        for i, (distance, end) in matches(f" {normal(text)} ", patterns, machine).items():
                            out.append((doc, patterns[i].ident, distance, max(0, end - 2), patterns[i].chars))
                columns = list(zip(*out, strict=True)) if out else [()] * 5
                kinds = [part.schema.field("doc_id").type, item_arrow, pa.int32(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "distance", "end_at", "chars"])

        parts.append(docs.select("doc_id", "text").mapInArrow(run, schema))
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return out


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item."""
    for rows in _blocks(items.filter(F.col("text").isNotNull())):
        listed = [(r.item_id, t) for r in rows if (t := normal(r.text))]

        def run(batches: Iterator[pa.RecordBatch], listed=listed) -> Iterator[pa.RecordBatch]:
            patterns = _patterns(listed, rate)
            machine = automaton(patterns)
            for part in ts.blocks(batches, "text"):
                yield part.filter(pa.array([not matches(f" {normal(text)} ", patterns, machine) for text in part.column("text").to_pylist()], pa.bool_()))

        if listed:
            docs = docs.mapInArrow(run, docs.schema)
    return docs


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Divergence of sources: how far the word use of each source is from every other one of its language.

One pass counts the terms of each task's documents in a table that is given out when it is full, so
few rows are shuffled.  Terms held by enough documents of their language are kept and numbered.  A
group (lang, source) gives each kept term a share in billionths, smoothed, in whole numbers.

Groups are compared by two-dimensional tiles.  The groups of a language are dealt into blocks and
its terms into chunks; a group's counts in a chunk are packed into one row of shares.  Each row is
replicated to the tiles of its block, a tile being a pair of blocks.  A tile goes over its chunks one
after the other, lays each out as two small matrices and adds up the differences of all pairs of
rows; chunks that no row of the tile has need no matrix.  A tile of a large vocabulary is cut into
spans of chunks, whose sums are added afterwards.  So a task holds a chunk of two blocks, whatever
the number of sources, terms and documents.

Defined cases: null text, lang and source are empty; rows are documents of their own, repeated or
not, and ids don't matter; a language without kept terms has distance 0 between its groups; a
language of one group has no pairs; ties go by the item's UTF-8 bytes; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.llm.common import _LOWER, _UPPER, cut, ranked, small, table

#: Documents of its language that a kept term is in, and what is added to each count.
LEAST = 30
ADDED = 5
#: Shares are in this unit.
WHOLE = 1_000_000_000
#: Most terms reported for a group.
TOP = 50
#: Groups in a block, terms in a chunk, chunks in a span.
BLOCK, CHUNK, SPAN = 256, 1024, 128
#: Bytes of counts that a task holds before it gives them out, and of a text that is gone through piecemeal.
HELD = 64 << 20
LONG = 8 << 20
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])
_PAIRS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def terms(text: bytes) -> Counter:
    """Occurrences of each term; only A-Z change case, as the text is bytes."""
    text = text.lower()
    return Counter(_TERM.findall(text) if len(text) < LONG else (m.group() for m in _TERM.finditer(text)))


def _given(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in held.items():
        keys = list(counts)
        for i in range(0, len(keys), 20_000):
            part = keys[i : i + 20_000]
            columns = [[lang] * len(part), [source] * len(part), part, [counts[t] for t in part], [docs[t] for t in part]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNTS, strict=True)], schema=_COUNTS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, weight = {}, 0
    for batch in batches:
        names = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for i, group in enumerate(names):
            found = terms(batch.column("text")[i].as_py())
            if group not in held:
                held[group] = (Counter(), Counter())
            counts, docs = held[group]
            for t, n in found.items():
                counts[t] += n
            docs.update(found.keys())
            weight += sum(map(len, found)) + 200 * len(found)
            if weight > HELD:  # an upper bound, as terms repeat
                weight = sum(sum(map(len, c)) + 200 * len(c) for c, _ in held.values())
                if 2 * weight > HELD:
                    yield from _given(held)
                    held, weight = {}, 0
    yield from _given(held)


def term_counts(docs: DataFrame) -> DataFrame:
    """(text, lang, source) -> (lang, source, term, n, docs): occurrences, and documents with the term."""
    empty = F.lit("")
    rows = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source"), F.coalesce("text", empty).cast("binary").alias("text"))
    return rows.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(WHOLE * (n + ADDED) / (total + ADDED * vocabulary)), exactly; null without vocabulary."""
    exact = [x.cast("decimal(19,0)") for x in (n, total, vocabulary)]
    over = F.call_function("div", (exact[0] + ADDED) * F.lit(WHOLE).cast("decimal(10,0)"), F.nullif(exact[1] + exact[2] * ADDED, F.lit(0).cast("decimal(1,0)")))
    return (over + 1).cast("int")


class Tile:
    """The distances between the rows of two blocks, added up chunk by chunk."""

    def __init__(self, diagonal: bool, terms: int, chunk: int, last: int, width: int):
        self.diagonal, self.rest, self.chunk, self.last, self.width = diagonal, terms, chunk, last, width
        self.names, self.places, self.empty, self.sums = ([], []), ({}, {}), ([], []), None

    def group(self, side: int, slot: int, name: str, empty: int) -> None:
        self.places[side][slot] = len(self.names[side])
        self.names[side].append(name)
        self.empty[side].append(empty)

    def add(self, chunk: int, rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> None:
        """Rows (side, slot, places, shares) of one chunk."""
        width = self.last if chunk == self.chunk else self.width
        sides = [np.repeat(np.array(e, dtype=np.int32)[:, None], width, axis=1) for e in self.empty]
        for side, slot, at, shares in rows:
            sides[side][self.places[side][slot], at] = shares
        self.rest -= width
        self._sum(sides[0], sides[0] if self.diagonal else sides[1])

    def _sum(self, left: np.ndarray, right: np.ndarray, times: int = 1) -> None:
        if self.sums is None:
            self.sums = np.zeros((len(left), len(right)), dtype=np.int64)
        for i, row in enumerate(left):
            first = i + 1 if self.diagonal else 0
            self.sums[i, first:] += np.abs(right[first:] - row).sum(axis=1, dtype=np.int64) * times

    def pairs(self) -> Iterator[tuple[list[str], list[str], np.ndarray]]:
        """For each row of the first block: its name, the names of the others and the distances."""
        empty = [np.array(e, dtype=np.int32)[:, None] for e in self.empty]
        names = self.names[0] if self.diagonal else self.names[1]
        self._sum(empty[0], empty[0] if self.diagonal else empty[1], self.rest)
        for i, name in enumerate(self.names[0]):
            first = i + 1 if self.diagonal else 0
            yield name, names[first:], self.sums[i, first:]


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, tile, chunk, rows = None, None, None, []

    def ended():
        for name, others, values in tile.pairs():
            if others:
                columns = [[key[0]] * 2 * len(others), [name] * len(others) + others, others + [name] * len(others), np.concatenate([values, values])]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PAIRS, strict=True)], schema=_PAIRS)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "low", "high", "span", "chunk", "side", "slot", "name", "empty", "terms", "last_chunk", "last_width", "width")]
        at, shares = batch.column("at"), batch.column("shares")
        for i, (lang, low, high, span, now, side, slot, name, empty, terms, last, last_width, width) in enumerate(zip(*columns, strict=True)):
            if (lang, low, high, span) != key or now != chunk:
                if rows:
                    tile.add(chunk, rows)
                chunk, rows = now, []
            if (lang, low, high, span) != key:
                if tile:
                    yield from ended()
                key, tile = (lang, low, high, span), Tile(low == high, terms, last, last_width, width)
            if now < 0:
                tile.group(side, slot, name, empty)
            else:
                rows.append((side, slot, at[i].values.to_numpy(), shares[i].values.to_numpy()))
    if rows:
        tile.add(chunk, rows)
    if tile:
        yield from ended()


def distances(groups: DataFrame, shares: DataFrame, block: int = BLOCK, chunk: int = CHUNK, span: int = SPAN) -> DataFrame:
    """Distances of all pairs of groups of a language, both ways round.

    ``groups``: (lang, source, slot, slots, vocabulary, empty): a number from 0 in its language, how
    many there are, the language's kept terms and the share of a term that the group lacks.
    ``shares``: (lang, slot, at, share) of the terms it has, by their numbers.
    """
    packed = shares.withColumn("chunk", F.floor(F.col("at") / chunk).cast("long")).groupBy("lang", "slot", "slots", "chunk")
    packed = packed.agg(F.collect_list(F.struct((F.col("at") - F.col("chunk") * chunk).cast("int").alias("at"), "share")).alias("held"))
    own, blocks = F.floor(F.col("slot") / block), F.ceil(F.col("slots") / block)
    tiles = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda o: F.struct(F.least(o, own).alias("low"), F.greatest(o, own).alias("high"))))
    side = (F.col("tile.low") != own).cast("int")
    none = F.lit(None)
    rows = packed.withColumn("tile", tiles).select(
        "lang", "tile.low", "tile.high", F.floor(F.col("chunk") / span).alias("span"), "chunk", side.alias("side"), "slot", none.cast("string").alias("name"), none.cast("int").alias("empty"),
        *[none.cast("long").alias(c) for c in ("terms", "last_chunk", "last_width", "width")], F.col("held.at").alias("at"), F.col("held.share").alias("shares"),
    )
    vocabulary = F.col("vocabulary")
    last, reached = F.greatest(F.ceil(vocabulary / chunk) - 1, F.lit(0)), chunk * span
    spans = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(vocabulary / reached) - 1, F.lit(0))))
    heads = groups.withColumn("tile", tiles).withColumn("span", spans).select(
        "lang", "tile.low", "tile.high", "span", F.lit(-1).cast("long").alias("chunk"), side.alias("side"), "slot", F.col("source").alias("name"), F.coalesce("empty", F.lit(0)).alias("empty"),
        F.least(vocabulary - F.col("span") * reached, F.lit(reached)).cast("long").alias("terms"), last.alias("last_chunk"), (vocabulary - last * chunk).cast("long").alias("last_width"),
        F.lit(chunk).cast("long").alias("width"), F.array().cast("array<int>").alias("at"), F.array().cast("array<int>").alias("shares"),
    )
    order = ["lang", "low", "high", "span", "chunk", "side", "slot"]
    dealt = heads.unionByName(rows).repartition(*order[:4]).sortWithinPartitions(*order)
    made = dealt.mapInArrow(_tiled, "lang string, source string, item string, value long")
    return made.repartition("lang", "source").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, **tiling: int) -> DataFrame:
    """(text, lang, source) -> (lang, source, part, item, value, rank): for each group, its distance to
    every other source of its language (``pair``) and the terms it has most too much of (``term``)."""
    counts = cut(term_counts(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("held"), F.sum("n").alias("lang_n")).filter(F.col("held") >= least)
    kept = ranked(kept.select("lang", "term", "lang_n"), ["term"], "at", ["lang"])
    used = cut(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "at", "lang_n"))
    langs = small(kept.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("lang_n").alias("lang_total")))
    empty = F.lit("")
    every = docs.select(F.coalesce("lang", empty).alias("lang"), F.coalesce("source", empty).alias("source")).distinct()
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = ranked(every.join(totals, ["lang", "source"], "left"), ["source"], "slot", ["lang"])
    slots = small(groups.groupBy("lang").agg(F.count("*").alias("slots")))
    zero = F.lit(0).cast("long")
    groups = groups.join(slots, "lang").join(langs, "lang", "left").select("lang", "source", "slot", "slots", *[F.coalesce(c, zero).alias(c) for c in ("total", "vocabulary", "lang_total")])
    groups = small(groups.withColumn("empty", share(zero, F.col("total"), F.col("vocabulary"))))
    shares = used.join(groups, ["lang", "source"]).withColumn("share", share(F.col("n"), F.col("total"), F.col("vocabulary")))

    pair = distances(groups, shares.select("lang", "slot", "slots", "at", "share"), **tiling)
    by = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by).alias("rank"))
    more = (F.col("share") - share(F.col("lang_n"), F.col("lang_total"), F.col("vocabulary"))).cast("long")
    term = shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), more.alias("value")).filter(F.col("value") > 0)
    term = term.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
    return pair.unionByName(term)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
x AS MATERIALIZED (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM x GROUP BY 1, 2 HAVING count(DISTINCT k) >= {LEAST}),
c AS (SELECT x.lang, x.source, x.term, count(*) AS n FROM x JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY 1),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY 1, 2) USING (lang, source)),
p AS MATERIALIZED (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + {WHOLE}::HUGEINT * (coalesce(c.n, 0) + {ADDED}) // (g.total + {ADDED} * v.v) AS p,
    1 + {WHOLE}::HUGEINT * (kept.n + {ADDED}) // (v.total + {ADDED} * v.v) AS q
  FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r)
SELECT * FROM n WHERE part = 'pair' OR rank <= {TOP}
"""

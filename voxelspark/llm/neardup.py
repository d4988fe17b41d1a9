"""Near-duplicate documents: b-bit MinHash signatures and a multi-index Hamming join.

1. Each text becomes its set of distinct word shingles; texts with equal sets are one class, whose
   node is a hash of the set.  Only classes go on, so copies cost one row each.
2. A class gets a signature of ``CHUNKS * WIDTH`` min-hashes of 16 bits.  By the pigeonhole
   principle two signatures that differ in at most ``2 * CHUNKS - 1`` places have a chunk with at
   most one difference; so for each chunk one key is made for each place left out.  Every pair
   under that distance shares a key, and pairs of similarity 0.8 that lie above it nearly always
   do too: a chunk misses with probability 0.18, all ten with 4e-8.
3. In each bucket the members are compared with one pivot (not with each other), the pivots being
   drawn so that the chunks of a class have different ones.  Pairs farther apart than
   ``NEAR`` places are left out.  Each class is verified on its whole set against its nearest
   pivot first; after joining what is linked, only pairs across components are verified.
4. A bucket that still holds several components is gone through pair by pair if it has at most
   ``SMALL`` members.  Members of larger such buckets go through an exact prefix-filter join: two
   sets of similarity t share one of their n - ceil(t n) + 1 rarest shingles, whatever the order,
   and what stands before the first shared one can't be common, so its place bounds the overlap.
   Common passages are never among a set's rarest.  Where more than ``LISTED`` sets share a rare
   shingle (a dense group, with many pairs just under the threshold) no pairs are listed: blocks of
   the group are compared whole, and a pair of blocks returns one row for each component that it
   joins to another, never its links one by one.
5. Components of the confirmed links, and the smallest doc_id of each.

Texts are read twice: once for signatures, and those of classes with a near one again for their
sets.  Everything between is built-in expressions over hashes; no text is shuffled or written down.

Defined cases: null and empty texts have no shingles and are linked with nothing; with fewer words
than a shingle the whole sequence is one; rows that share a doc_id are documents of their own, each
with the component of its own text; a null doc_id names no component: such a row has the smallest
id of its component's other rows, or null where none has one, and is then kept; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.llm import textscan as ts
from voxelspark.llm.common import SPACE_WORD, cut, numbered, small, table
from voxelspark.llm.components import components, local_components

CHUNKS, WIDTH = 10, 4
NEAR = 22  # of 40 places; a pair of similarity 0.8 is farther apart twice in 10^6
SMALL = 24
LISTED = 48  # nodes that share a rare shingle, up to which they are listed in pairs
GROUP_NODES, GROUP_BYTES = 1024, 8 << 20  # of a block of a dense group
_COLUMNS = 2048
_PLACES = CHUNKS * WIDTH
_LAST = (1 << 63) - 1
_MASKS = ts.mix(np.arange(1, CHUNKS + 1, dtype=np.uint64)).view(np.int64)
_FACTORS = ts.mix(np.arange(1, _PLACES + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)) | np.uint64(1)
_SIGNATURE = [f"g{c}" for c in range(CHUNKS)]  # a chunk of four 16-bit places each


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """16-bit min-hashes, one row for each non-empty set; ``hashes`` are grouped by set."""
    sizes = counts[counts > 0]
    start = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    out = np.empty((len(sizes), _PLACES), dtype=np.uint16)
    for k, factor in enumerate(_FACTORS):
        least = np.minimum.reduceat((hashes * factor) >> np.uint64(24), start) if len(sizes) else np.zeros(0, np.uint64)
        out[:, k] = (ts.mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _set_sums(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over the mixed members of each set: equal for equal sets."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x6A09E667F3BCC909):
        total = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(ts.mix(h ^ np.uint64(salt)), out=total[1:])
        at = np.searchsorted(row, np.arange(n + 1))
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def sketch(docs: DataFrame, size: int) -> DataFrame:
    """Adds to (text, ...) the set's size and its two sums, and the signature, and drops the text."""
    rest = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in ts.blocks(batches, "text"):
            row, h, counts = ts.shingles(ts.scan(part.column("text")), size)
            s1, s2 = _set_sums(row, h, part.num_rows)
            sig = np.zeros((part.num_rows, _PLACES), dtype=np.uint16)
            sig[counts > 0] = signatures(h, counts)
            chunks = sig.view(np.int64)
            columns = [*(part.column(c) for c in rest), pa.array(counts, pa.int64()), pa.array(s1), pa.array(s2), *(pa.array(np.ascontiguousarray(chunks[:, c])) for c in range(CHUNKS))]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "n_shingles", "s1", "s2", *_SIGNATURE])

    kinds = dict(docs.dtypes)
    added = ["n_shingles", "s1", "s2", *_SIGNATURE]
    return docs.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in rest), *(f"{c} long" for c in added)]))


def classes(sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``node`` (null without shingles), and one row for each node.  Two sets
    with one hash would be one node; then another salt is taken."""
    for salt in itertools.count():
        node = F.when(F.col("n_shingles") > 0, F.xxhash64(F.lit(salt), "s1", "s2"))
        rows = sketched.select("doc_id", "row", "whole", "n_shingles", "s1", "s2", *_SIGNATURE, node.alias("node"))
        first = F.coalesce("doc_id", F.lit(_LAST))
        nodes = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
            F.min("n_shingles").alias("n"), F.min("doc_id").alias("least"), F.min_by("whole", first).alias("pick"), F.min("row").alias("row"),
            *[F.min(c).alias(c) for c in _SIGNATURE], *[f(c).alias(f"{c}{e}") for c in ("s1", "s2") for f, e in ((F.min, "low"), (F.max, "high"))],
        )
        nodes = cut(nodes)
        if not nodes.filter("s1low <> s1high OR s2low <> s2high").limit(1).count():
            return rows.drop("s1", "s2", *_SIGNATURE), nodes.drop("s1low", "s1high", "s2low", "s2high")


def bucket_keys(nodes: DataFrame) -> DataFrame:
    """(node, key): one key for each chunk and place left out; the low four bits are the chunk."""
    keys = []
    for c in range(CHUNKS):
        for gone in range(WIDTH):
            rest = int(np.uint64(~(0xFFFF << 16 * gone) & 0xFFFFFFFFFFFFFFFF).view(np.int64))
            key = F.xxhash64(F.lit(c * WIDTH + gone), F.col(f"g{c}").bitwiseAND(F.lit(rest)))
            keys.append(key.bitwiseAND(F.lit(~15)).bitwiseOR(F.lit(c)))
    return nodes.select("node", F.explode(F.array(*keys)).alias("key"))


def _distance(a: str, b: str) -> Column:
    """Places in which two signatures differ."""
    out = F.lit(0)
    for c in _SIGNATURE:
        apart = F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))
        for place in range(WIDTH):
            lane = int(np.uint64(0xFFFF << 16 * place).view(np.int64))
            out = out + (apart.bitwiseAND(F.lit(lane)) != 0).cast("int")
    return out


def _near(pairs: DataFrame, nodes: DataFrame, percent: int, most: int = NEAR) -> DataFrame:
    """(a, b) -> (a, b, dist) for those at most ``most`` places apart whose sizes allow a link."""
    side = nodes.select("node", "n", *_SIGNATURE)
    both = pairs.alias("p").join(side.alias("l"), F.col("p.a") == F.col("l.node")).join(side.alias("r"), F.col("p.b") == F.col("r.node"))
    both = both.filter(F.least("l.n", "r.n") * 100 >= F.greatest("l.n", "r.n") * percent)
    return both.select("p.a", "p.b", _distance("l", "r").alias("dist")).filter(F.col("dist") <= most)


def shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, text) -> (node, set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in ts.blocks(batches, "text"):
            _, h, counts = ts.shingles(ts.scan(part.column("text")), size)
            at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(pa.array(at), pa.array(h.view(np.int64)))], ["node", "set"])

    return texts.select("node", "text").mapInArrow(run, "node long, set array<long>")


def _sets(keyed: DataFrame, wanted: DataFrame, nodes: DataFrame, twice: DataFrame, size: int) -> DataFrame:
    """(node, set) of the wanted nodes, from one row of each class.  Those rows' names are broadcast
    if they are few enough, else joined."""
    names = small(wanted.distinct().join(nodes.select("node", "row"), "node"))
    texts = keyed.select("row", "text").join(names, "row").select("row", "node", "text")
    if twice.join(names, "row", "left_semi").limit(1).count():
        texts = texts.dropDuplicates(["row"])
    return cut(shingle_sets(texts, size))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose whole sets have 100 * intersection >= percent * union."""
    both = pairs.alias("p").join(sets.alias("l"), F.col("p.a") == F.col("l.node")).join(sets.alias("r"), F.col("p.b") == F.col("r.node"))
    held = F.size(F.array_intersect("l.set", "r.set")).alias("held")
    both = both.select("p.a", "p.b", held, (F.size("l.set") + F.size("r.set")).alias("total"))
    return both.filter((F.col("held") > 0) & (F.col("held") * 100 >= (F.col("total") - F.col("held")) * percent)).select("a", "b")


def _prefixes(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(node, n, at, h, component): the rarest shingles of each node, of which a pair of similarity
    ``percent`` shares one, with their place in the order: those in few sets first."""
    rows = sets.select("node", F.explode("set").alias("h"))
    often = small(rows.groupBy("h").agg(F.count("*").alias("df")).filter(F.col("df") > SMALL))
    placed = rows.join(often, "h", "left").groupBy("node").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h"))).alias("all"))
    n = F.size("all")
    keep = n - F.ceil(n * percent / 100) + 1
    prefix = placed.select("node", n.alias("n"), F.posexplode(F.slice("all", F.lit(1), keep.cast("int"))).alias("at", "x"))
    return prefix.select("node", "n", "at", F.col("x.h").alias("h")).join(labels, "node")


def _few_pairs(prefix: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a listed shingle and can still reach ``percent``."""
    some = prefix.join(lists, "h", "left_semi")
    l, r = some.alias("l"), some.alias("r")
    # If this is the first shingle that both have, no more than what follows it can be common.
    most = F.least(F.col("l.n") - F.col("l.at"), F.col("r.n") - F.col("r.at"))
    enough = most * (100 + percent) >= (F.col("l.n") + F.col("r.n")) * percent
    both = l.join(r, (F.col("l.h") == F.col("r.h")) & (F.col("l.component") < F.col("r.component")) & enough)
    return both.select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct()


def _common(h: np.ndarray, side: np.ndarray, m: int) -> np.ndarray:
    """Sizes of the intersections of m sets, given as (shingle, set) rows: an m x m table."""
    order = np.argsort(h, kind="stable")
    h, side = h[order], side[order]
    new = np.append(True, h[1:] != h[:-1])
    code = np.cumsum(new) - 1
    shared = np.bincount(code)[code] > 1  # those of one set are in no intersection
    _, code = np.unique(code[shared], return_inverse=True)
    side, out = side[shared], np.zeros((m, m), dtype=np.float32)
    at = np.searchsorted(code, np.arange(0, (code.max() + 1 if len(code) else 0) + _COLUMNS, _COLUMNS))
    for i, (low, high) in enumerate(zip(at, at[1:], strict=False)):
        part = np.zeros((m, _COLUMNS), dtype=np.float32)
        part[side[low:high], code[low:high] - i * _COLUMNS] = 1
        out += part @ part.T
    return out


def _dense_links(sets: DataFrame, groups: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Components to join (a, b) within dense groups, whose nodes share rare shingles so widely that
    lists of pairs would be quadratic.  A group is cut into blocks of nodes; two blocks meet in one
    task, which compares their whole sets by a product of membership tables."""
    held = cut(sets.join(groups, "node").join(labels, "node").select("g", "node", "component", "set"))
    weight = held.groupBy("g").agg(F.count("*").alias("n"), F.sum(F.size("set").cast("long") * 8).alias("bytes"))
    subs = F.ceil(F.greatest(F.col("n") / GROUP_NODES, F.col("bytes") / GROUP_BYTES)).cast("int").alias("subs")
    split = held.join(weight.select("g", subs), "g").withColumn("sub", F.pmod(F.xxhash64("node"), F.col("subs")).cast("int"))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
    split = split.select("g", F.least("sub", "other").alias("lo"), F.greatest("sub", "other").alias("hi"), "component", "set")

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        listed = t["set"].combine_chunks() if t["set"].num_chunks != 1 else t["set"].chunk(0)
        component, counts = np.asarray(t["component"]), np.diff(np.asarray(listed.offsets)).astype(np.int64)
        both = _common(np.asarray(listed.flatten()), np.repeat(np.arange(t.num_rows), counts), t.num_rows)
        near = [np.zeros((0, 2), np.int64)]
        for low in range(0, t.num_rows, 256):
            held = both[low : low + 256].astype(np.int64)
            linked = 100 * held >= percent * (counts[low : low + 256, None] + counts[None] - held)
            linked &= (component[low : low + 256, None] < component[None]) & (held > 0)
            near.append(np.argwhere(linked) + (low, 0))
        a, b = np.concatenate(near).T
        nodes, least = local_components(component[a], component[b])
        return pa.table({"a": pa.array(nodes[nodes != least], pa.int64()), "b": pa.array(least[nodes != least], pa.int64())})

    return split.groupBy("g", "lo", "hi").applyInArrow(compare, "a long, b long")


def _labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) for all nodes."""
    found = components(links)
    return cut(nodes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")))


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    side = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(F.col("c_a") != F.col("c_b")).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))


def _linked(keyed: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row, whole, text) -> the rows without text but with n_shingles and node, and
    (node, component, least, pick): the component's smallest doc_id and the name of one of its rows."""
    rows, nodes = classes(cut(sketch(keyed, size)))
    twice = rows.groupBy("row").count().filter("count > 1").select("row")
    keys = bucket_keys(nodes)
    # The least of node XOR the chunk's mask: another order of the nodes for each chunk.
    mask = F.element_at(F.array(*[F.lit(int(m)) for m in _MASKS]), (F.col("key").bitwiseAND(F.lit(15)) + 1).cast("int"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("members"), F.min(F.col("node").bitwiseXOR(mask)).alias("b")).filter("members > 1")
    buckets = buckets.select("key", "members", F.col("b").bitwiseXOR(mask).alias("b"))
    shared = cut(keys.join(buckets, "key").select("key", "node", "b", "members"))
    stars = shared.filter(F.col("node") != F.col("b")).select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()
    stars = cut(_near(stars, nodes, percent))

    sets = _sets(keyed, _ends(stars), nodes, twice, size)
    best = cut(stars.groupBy("a").agg(F.min(F.struct("dist", "b"))["b"].alias("b")))
    links = cut(verified(best, sets, percent))
    labels = _labels(nodes, links)
    rest = _across(stars.join(best, ["a", "b"], "left_anti"), labels)
    links = links.union(cut(verified(rest, sets, percent)))
    labels = _labels(nodes, links)

    # Buckets that still hold several components.
    member = shared.join(labels, "node")
    mixed = member.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    member = cut(member.join(mixed, "key"))
    few = member.filter(F.col("members") <= SMALL)
    l, r = few.alias("l"), few.alias("r")
    apart = l.join(r, (F.col("l.key") == F.col("r.key")) & (F.col("l.component") < F.col("r.component")))
    apart = apart.select(F.greatest("l.node", "r.node").alias("a"), F.least("l.node", "r.node").alias("b")).distinct()
    found = _near(apart.join(stars.select("a", "b"), ["a", "b"], "left_anti"), nodes, percent).select("a", "b")
    many = cut(member.filter(F.col("members") > SMALL).select("node").distinct())
    if many.limit(1).count():
        more = _sets(keyed, many, nodes, twice, size)
        prefix = cut(_prefixes(more, labels, percent))
        lists = prefix.groupBy("h").agg(F.count("*").alias("held"), F.min("node").alias("b"), F.min("component").alias("low"), F.max("component").alias("high"))
        lists = cut(lists.filter("low < high").select("h", "held", "b"))
        found = found.union(_few_pairs(prefix, small(lists.filter(F.col("held") <= LISTED).select("h")), percent))
        wide = prefix.join(small(lists.filter(F.col("held") > LISTED)), "h").select(F.col("node").alias("a"), "b").distinct()
        groups = components(wide).withColumnRenamed("component", "g")
        links = links.union(cut(_dense_links(more, groups, labels, percent)))
        labels = _labels(nodes, links)
    found = cut(_across(found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), labels))
    if found.limit(1).count():
        links = links.union(cut(verified(found, _sets(keyed, _ends(found), nodes, twice, size), percent)))
        labels = _labels(nodes, links)

    named = labels.join(nodes.select("node", "least", "pick"), "node")
    first = named.groupBy("component").agg(F.min("least").alias("least"), F.min_by("pick", F.coalesce("least", F.lit(_LAST))).alias("pick"))
    return rows, cut(labels.join(first, "component").select("node", "component", "least", "pick"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_shingles, component_id, kept), one row a row."""
    row = F.xxhash64("doc_id", "text")
    rows, groups = _linked(docs.select(F.col("doc_id").cast("long"), row.alias("row"), row.alias("whole"), "text"), size, percent)
    out = rows.select("doc_id", "n_shingles", "node").join(groups.select("node", "least"), "node", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, but one row for each near-duplicate group: one
    with its smallest doc_id, or any where no row has an id.  Rows that share an id and not a text
    are no copies of each other; rows without shingles all stay."""
    whole = numbered(docs)
    keyed = whole.select(F.col("row.doc_id").cast("long").alias("doc_id"), F.col("at").alias("row"), F.col("at").alias("whole"), F.col("row.text").alias("text"))
    rows, groups = _linked(keyed, size, percent)
    rows = rows.filter(F.col("node").isNotNull()).select("node", "whole").join(groups.select("node", "pick"), "node")
    gone = small(rows.filter(F.col("whole") != F.col("pick")).select(F.col("whole").alias("at")))
    return whole.join(gone, "at", "left_anti").select("row.*")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)


#: All pairs that share a shingle, counted; for small tables.
ORACLE = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE_WORD}') AS w FROM documents),
s AS MATERIALIZED (
  SELECT k, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM d),
x AS MATERIALIZED (SELECT k, unnest(s) AS h FROM s),
c AS (SELECT a.k AS a, b.k AS b, count(*) AS held FROM x a JOIN x b ON a.h = b.h AND a.k < b.k GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM c JOIN s p ON p.k = a JOIN s q ON q.k = b WHERE 100 * held >= 80 * (len(p.s) + len(q.s) - held)),
links AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(k, other) AS (SELECT k, k FROM s UNION SELECT r.k, links.b FROM r JOIN links ON links.a = r.other),
g AS (SELECT r.k, min(o.doc_id) AS component_id FROM r JOIN s o ON o.k = r.other GROUP BY r.k)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, CASE WHEN len(s.s) = 0 THEN s.doc_id ELSE g.component_id END AS component_id,
  CASE WHEN len(s.s) = 0 THEN true ELSE coalesce(s.doc_id = g.component_id, g.component_id IS NULL) END AS kept FROM s JOIN g USING (k)
"""

"""Prefix trie of conversations by Patricia construction.

A conversation is the sequence of its turns, and a node of the trie is a distinct prefix of one.  A
turn is known by 128 bits of the SHA-256 of its role and text, so texts are read once and never
shuffled.  Conversations are range-partitioned and sorted by their turns.  One scan over a sorted
part keeps the points of the current path on a stack and makes only branch, end and leaf points:
edges between points are compressed, and sums over subtrees are taken from point to point.  Only
the result is expanded: the nodes along an edge have the members and leaves of its lower point, and
what they save is that point's sum and a suffix sum over the edge.

A point whose members all stand within one part is finished there.  The others are prefixes of the
part's first or last conversation; their partial sums go, with those two conversations, to a second
scan of the same kind.  It has two rows a part, whatever the number of conversations, and a group of
equal conversations may lie over many parts: its ids go on in packed pieces, hashed in order.

Defined cases: rows without a conv_id belong to no conversation; a null role or text is empty; null
turns come first and turns of equal number are ordered by their digest; repeated rows are turns of
their own; an empty table has no node, not even a root; further columns are ignored.  A remainder has
the sign of the id, as in SQL.  The digests and lengths of one conversation's turns, 20 bytes each,
are a row, and with the points on its path must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.llm.common import cut, partitions, small, table

#: Conversations share the first turns of the one whose id is the last multiple of this.
FAMILY = 100
#: The most turns that are shared, and one more.
SHARED = 6
WIDTH = 16
#: Ids in a packed piece.
PACKED = 1000
_NONE = hashlib.sha256(b"").hexdigest()
_LONGS = pa.list_(pa.int64())
_SPINE = pa.struct([("key", pa.binary()), ("lengths", _LONGS), ("points", pa.list_(_LONGS))])
_OUT = pa.schema(
    [("kind", pa.string()), ("id", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64())]
    + [("n_leaves", pa.int64()), ("saved", _LONGS), ("ends", pa.string()), ("spine", _SPINE)]
)
_SCHEMA = (
    "kind string, id binary, parent binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved array<long>, ends string,"
    " spine struct<key: binary, lengths: array<long>, points: array<array<long>>>"
)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> (conv_id, turns): the turns in order, each with its digest (hex)
    and its length in code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    each = turns.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), F.struct(F.col("turn").alias("t"), digest.alias("d"), F.length(text).cast("long").alias("n")).alias("s"))
    ordered = F.sort_array(F.collect_list("s"))  # nulls first
    return each.groupBy("conv_id").agg(F.transform(ordered, lambda s: F.struct(s["d"].alias("d"), s["n"].alias("n"))).alias("turns"))


def shared_heads(own: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """Each conversation c with the first h turns of conversation c - c % family in place of its own
    first h; h = crc32(c) % shared."""
    c = F.col("conv_id")
    heads = own.filter(c % family == 0).select(c.alias("first"), F.slice("turns", 1, shared).alias("head"))
    both = own.withColumn("first", c - c % family).join(heads, "first", "left")
    h = (F.crc32(c.cast("string").cast("binary")) % shared).cast("int")
    head = F.when(h > 0, F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return both.select("conv_id", F.concat(head, rest).alias("turns"))


def common(a: bytes, b: bytes) -> int:
    """How many leading turns two keys share."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low * WIDTH : middle * WIDTH] == b[low * WIDTH : middle * WIDTH] else (low, middle - 1)
    return low


class _Point:
    """A point on the current path: its depth, what is known of its subtree, and the ids that end at it."""

    __slots__ = ("below", "children", "convs", "depth", "ids", "least", "leaves")

    def __init__(self, depth: int):
        self.depth, self.convs, self.least, self.children, self.leaves, self.below, self.ids = depth, 0, None, 0, 0, 0, None

    def add(self, convs: int, least: int | None, children: int, leaves: int, below: int) -> None:
        self.convs += convs
        self.children += children
        self.leaves += leaves
        self.below += below
        if least is not None and (self.least is None or least < self.least):
            self.least = least


class Scan:
    """The points of sorted sequences.  ``inner``: other parts may hold more members of the points on
    the first and the last path, so these are given out as sums and not as points."""

    def __init__(self, inner: bool):
        self.inner, self.first, self.last, self.out = inner, None, b"", []
        self.shared = 0  # turns that the first sequence has in common with the current one
        self.lengths, self.total, self.chain, self.spine = [0], [0], [hashlib.sha256(b"root").digest()[:WIDTH]], []
        self.stack = [_Point(0)]

    def put(self, kind: str, **values) -> None:
        self.out.append({"kind": kind, **values})

    def _sums(self, p: _Point) -> list:
        return [p.depth, p.convs, p.least, p.children, p.leaves, p.below]

    def _pieces(self, p: _Point) -> None:
        for i in range(0, len(p.ids or ()), PACKED):
            self.put("ids", id=self.chain[p.depth], conv_id=p.ids[i], ends=",".join(map(str, p.ids[i : i + PACKED])))

    def _close(self, p: _Point, up: _Point | None) -> None:
        if self.inner and p.depth <= self.shared:
            self._pieces(p)
            self.spine.append(self._sums(p))
            return
        leaves, depth = p.leaves if p.children else 1, up.depth if up else -1
        # total[d]: code points of the turns 1 .. d; the root has no turn.
        saved = [p.below + (p.convs - 1) * (self.total[p.depth] - self.total[d - 1 if d else 0]) for d in range(depth + 1, p.depth + 1)]
        ends = hashlib.sha256(",".join(map(str, p.ids)).encode()).hexdigest() if p.ids else _NONE
        self.put("point", id=self.chain[p.depth], parent=self.chain[depth] if up else None, conv_id=p.least, depth=p.depth, n_convs=p.convs, n_children=p.children, n_leaves=leaves, saved=saved, ends=ends)
        if up:
            up.add(p.convs, p.least, 1, leaves, saved[0])

    def _pop(self, depth: int) -> None:
        """Closes what is deeper than ``depth``, where a branch point stands then."""
        while self.stack[-1].depth > depth:
            p = self.stack.pop()
            if self.stack[-1].depth < depth:
                self.stack.append(_Point(depth))
            self._close(p, self.stack[-1])

    def _at(self, depth: int) -> _Point:
        """The point of the current path at ``depth``, made if there is none."""
        i = len(self.stack)
        while self.stack[i - 1].depth > depth:
            i -= 1
        if self.stack[i - 1].depth < depth:
            self.stack.insert(i, _Point(depth))
            i += 1
        return self.stack[i - 1]

    def path(self, key: bytes, lengths: list[int]) -> None:
        """The next sequence: closes what it leaves and takes up its turns."""
        same = common(self.last, key)
        self._pop(same)
        del self.lengths[same + 1 :], self.total[same + 1 :], self.chain[same + 1 :]
        for i in range(same, len(lengths)):
            self.lengths.append(lengths[i])
            self.total.append(self.total[-1] + lengths[i])
            self.chain.append(hashlib.sha256(self.chain[-1] + key[i * WIDTH : (i + 1) * WIDTH]).digest()[:WIDTH])
        self.shared = len(lengths) if self.first is None else min(self.shared, same)
        self.first = (key, list(lengths)) if self.first is None else self.first
        self.last = key

    def member(self, key: bytes, lengths: list[int], conv_id: int) -> None:
        if self.first is None or key != self.last:
            self.path(key, lengths)
        p = self._at(len(lengths))
        p.add(1, conv_id, 0, 0, 0)
        p.ids = p.ids or []
        p.ids.append(conv_id)

    def partial(self, key: bytes, lengths: list[int], points: list[list[int]]) -> None:
        self.path(key, lengths)
        for depth, *sums in points:
            self._at(depth).add(*sums)

    def finish(self) -> None:
        if self.first is None:
            return
        if not self.inner:
            self._pop(0)
            self._close(self.stack.pop(), None)
            return
        if self.spine:
            self.put("spine", spine={"key": self.first[0], "lengths": self.first[1], "points": self.spine})
        for p in self.stack:
            self._pieces(p)
        self.put("spine", spine={"key": self.last, "lengths": self.lengths[1:], "points": [self._sums(p) for p in self.stack]})

    def taken(self, least: int) -> Iterator[pa.RecordBatch]:
        """What has been made, once it is so many rows."""
        if len(self.out) >= max(least, 1):
            names = _OUT.names
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in self.out], _OUT.field(c).type) for c in names], schema=_OUT)
            self.out = []


def _inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan = Scan(inner=True)
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "lengths", "conv_id")), strict=True):
            scan.member(*row)
        yield from scan.taken(5000)
    scan.finish()
    yield from scan.taken(1)


def _outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scan = Scan(inner=False)
    for batch in batches:
        for row in batch.column("spine").to_pylist():
            scan.partial(row["key"], row["lengths"], row["points"])
        yield from scan.taken(5000)
    scan.finish()
    yield from scan.taken(1)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (id, first id) -> (id, ends): the hash of all pieces of an id."""
    now, sha = None, None
    for batch in batches:
        done = []
        for key, text in zip(batch.column("id").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if key != now:
                if now is not None:
                    done.append((now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(text.encode())
            else:
                sha.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], ["id", "ends"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([sha.hexdigest()])], ["id", "ends"])


def points(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) -> the compressed tree: a row for each branch, end and leaf point and the root,
    with what the nodes of the edge above it save, from its upper to its lower end."""
    keyed = conversations.select("conv_id", F.unhex(F.array_join(F.col("turns.d"), "")).alias("key"), F.col("turns.n").alias("lengths"))
    order = [F.col("key"), F.col("conv_id")]
    parts = keyed.repartitionByRange(partitions(conversations.sparkSession), *order).sortWithinPartitions(*order)
    made = cut(parts.mapInArrow(_inner, _SCHEMA))
    spines = made.filter("kind = 'spine'").select("spine").repartition(1).sortWithinPartitions("spine.key")
    ends = made.filter("kind = 'ids'").select("id", "conv_id", "ends").repartition("id").sortWithinPartitions("id", "conv_id")
    ends = small(ends.select("id", "ends").mapInArrow(_hashed, "id binary, ends string"))
    top = spines.mapInArrow(_outer, _SCHEMA).drop("ends").join(ends, "id", "left").withColumn("ends", F.coalesce("ends", F.lit(_NONE)))
    return cut(made.filter("kind = 'point'").unionByName(top).drop("kind", "spine"))


def nodes(tree: DataFrame) -> DataFrame:
    """The compressed tree -> a row for each node; a node within an edge has one child and no end."""
    up = tree.select(F.col("id").alias("parent"), F.col("conv_id").alias("up"))
    each = tree.join(up, "parent", "left").select("*", F.posexplode("saved").alias("i", "saved_tokens"))
    size, last = F.size("saved"), F.col("i") == F.size("saved") - 1
    return each.select(
        "conv_id",
        (F.col("depth") - size + 1 + F.col("i")).cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("up")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.when(last, F.col("ends")).otherwise(F.lit(_NONE)).alias("ends_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = cut(sequences(table(spark, sf_dir, "conversations")))
    return nodes(points(shared_heads(own)))


def oracle(crc_table: list[int]) -> str:
    crc = f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(CAST(conv_id AS VARCHAR))), '..'),
      lambda i: ('0x' || i)::BIGINT)), lambda c, b: xor(c >> 8, CAST({crc_table} AS BIGINT[])[xor(c & 255, b) + 1])))"""
    return f"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, length(coalesce(text, '')) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, d, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS pos FROM t),
c AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS first, {crc} % {SHARED} AS h FROM (SELECT DISTINCT conv_id FROM o)),
s AS (
  SELECT c.conv_id, o.pos AS depth, o.d, o.n FROM c JOIN o ON o.conv_id = c.first AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, least(c.h, coalesce(f.turns, 0)) + o.pos - c.h, o.d, o.n
  FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h LEFT JOIN (SELECT conv_id, count(*) AS turns FROM o GROUP BY 1) f ON f.conv_id = c.first
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM c),
p AS MATERIALIZED (
  SELECT conv_id, depth, n, sha256(string_agg(d, '') OVER w) AS id,
    max(depth) OVER (PARTITION BY conv_id) AS turns
  FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
q AS (SELECT *, lag(id) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM p),
g AS MATERIALIZED (
  SELECT id, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(up) AS up, min(n) AS n,
    string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE depth = turns) AS ends
  FROM q GROUP BY id, depth),
k AS (SELECT up AS id, depth - 1 AS depth, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1, 2),
w AS MATERIALIZED (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k USING (id, depth)),
a AS (
  SELECT p.id, p.depth, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((w.n_convs - 1) * w.n) AS saved_tokens
  FROM w JOIN p ON p.conv_id = w.conv_id AND p.depth <= w.depth GROUP BY 1, 2)
SELECT w.conv_id, CAST(w.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, CAST(a.n_leaves AS BIGINT) AS n_leaves,
  CAST(a.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN a USING (id, depth) LEFT JOIN w u ON u.id = w.up AND u.depth = w.depth - 1
"""

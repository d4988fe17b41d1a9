"""Line dedup by a log-template tree; built-in functions only.

A line's leaf in the tree is its token count and its first ``DEPTH`` tokens, tokens with a digit
being a field already.  In a leaf that enough documents reach, a token at a position is constant if
enough documents have it there and the position has few such tokens (the tree's fan-out); all else
is a field.  The line's template is its tokens with fields as wildcards.  Where positions fan out, a
line has a second template, in which every token that enough documents have there is constant.
Templates of mostly constant tokens that recur in ``MIN_DOCS`` documents or more are dropped, all
their lines; so a line of mostly digit-free tokens that stands in that many documents always goes.

Only hashes are shuffled: those of leaves, and in leaves that recur those of (leaf, position, token),
which stand for a constant; documents are counted after a first aggregation by (key, document), so a
line that a third of all documents hold is no hot key there, and where it is one in a join the other
side has one row for it and adaptive execution splits it.  Lines of leaves that do not recur are left
out by a broadcast of the recurring leaves' hashes while they fit, then of a bit table of fixed size.
Nothing is gathered: a template is the exclusive or of the hashes of the constants that a line has.

Defined cases: a null text has no lines, an empty text one empty line; lines without
tokens stay, and lines of fewer than ``SHORT`` go only if all their tokens are constant; rows equal in id and text count as one document and get one answer
each; null ids are ids; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.llm.common import SPACE_WORD, cut, fits, table

DEPTH = 3
SHORT = 5  # lines with fewer tokens are dropped only if all of them are constant
MIN_DOCS = 3
FAN_OUT = 16
CONSTANT = 0.6  # least share of constant tokens in a template that is dropped
SIEVE_BITS = 27
_FIELD = "<*>"
_WITH_DIGIT = r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+"  # no more than one look at each character


def _lines(docs: DataFrame) -> DataFrame:
    """(k, line_no, tokens) of all lines with a token; k names the document, and tokens with a
    digit are fields.  White space and digits are dealt with in the text, before lines are cut."""
    text = F.when(F.col("text").rlike(r"[\x09\x0B-\x0D]"), F.translate("text", "\t\x0b\f\r", "    ")).otherwise(F.col("text"))
    docs = docs.select(F.xxhash64("doc_id", "text").alias("k"), text.alias("text"))
    text = F.when(F.col("text").rlike("[0-9]"), F.regexp_replace("text", _WITH_DIGIT, _FIELD)).otherwise(F.col("text"))
    lines = docs.select("k", F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return lines.select("k", "line_no", F.array_remove(F.split("line", " "), "").alias("tokens")).filter(F.size("tokens") > 0)


def _documents(df: DataFrame, key: str, *rest: str) -> DataFrame:
    """Keys that ``MIN_DOCS`` documents or more have, with what else depends on the key."""
    once = df.groupBy(key, "k").agg(F.lit(1).alias("one"), *[F.min(c).alias(c) for c in rest])
    return once.groupBy(key).agg(F.count("*").alias("docs"), *[F.min(c).alias(c) for c in rest]).filter(F.col("docs") >= MIN_DOCS).select(key, *rest)


def _sieved(lines: DataFrame, leaves: DataFrame) -> DataFrame:
    """Lines whose leaf may recur, by a bit table of 2^``SIEVE_BITS`` bits (16 MB at any size).  Some
    that do not recur pass, and no constant is found for them later; none that does is lost."""
    slot = F.col("leaf").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    words = leaves.select(F.shiftright(slot, 6).alias("word"), F.expr("shiftleft(1L, CAST(leaf & 63 AS INT))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = leaves.sparkSession.range(1 << (SIEVE_BITS - 6)).withColumnRenamed("id", "word").join(words, "word", "left")
    row = F.sort_array(F.collect_list(F.struct((F.col("word") % 512).alias("at"), F.coalesce("bits", F.lit(0)).alias("bits"))))
    table = cut(every.groupBy(F.shiftright("word", 9).alias("part")).agg(F.transform(row, lambda x: x["bits"]).alias("bits")))
    both = lines.join(F.broadcast(table), F.shiftright(slot, 15) == F.col("part"))
    hit = F.getbit(F.element_at("bits", (F.shiftright(slot, 6) % 512 + 1).cast("int")), F.col("leaf").bitwiseAND(F.lit(63)).cast("int"))
    return both.filter(hit == 1).select(lines.columns)


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (k, line_no) of the lines to drop."""
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH)).alias("leaf")
    lines = _lines(docs).select("k", "line_no", "tokens", leaf)
    leaves = cut(_documents(lines.select("leaf", "k"), "leaf"))
    hashed = F.transform("tokens", lambda t, i: F.when(t != _FIELD, F.xxhash64("leaf", i, t)))
    hashed = lines.select("leaf", "k", "line_no", F.size("tokens").alias("n"), hashed.alias("tokens"))
    held = cut(hashed.join(F.broadcast(leaves), "leaf") if fits(leaves) else _sieved(hashed, leaves))
    placed = held.select("leaf", "k", F.posexplode("tokens").alias("pos", "token")).filter("token IS NOT NULL")
    often = cut(_documents(placed.select("token", "k", F.xxhash64("leaf", "pos").alias("place")), "token", "place"))
    fan = often.groupBy("place").agg(F.count("*").alias("fan"))
    constants = often.join(fan, "place").select("token", (F.col("fan") <= FAN_OUT).alias("narrow"))
    # A line's templates: which constants it has where, whatever the order they come in.
    narrow, token = F.col("narrow"), F.col("token")
    whole = F.count_if(narrow).alias("fixed"), F.bit_xor(F.when(narrow, token)).alias("shape"), F.count("*").alias("often"), F.bit_xor(token).alias("full")
    # Rows that are equal in id and text have lines of their own, told apart by ``r``.
    tokens = held.select(F.monotonically_increasing_id().alias("r"), "k", "line_no", "n", "tokens")
    tokens = tokens.select("r", "k", "line_no", "n", F.explode("tokens").alias("token")).filter("token IS NOT NULL")
    lines = tokens.join(constants, "token").groupBy("r", "k", "line_no", "n").agg(*whole)
    enough = F.when(F.col("n") < SHORT, F.col("n")).otherwise(F.ceil(F.col("n") * CONSTANT))
    mostly = lambda c: (F.col(c) > 0) & (F.col(c) >= enough)
    first = F.when(mostly("fixed"), F.xxhash64("n", "shape", "fixed"))
    second = F.when(mostly("often") & (F.col("often") > F.col("fixed")), F.xxhash64("n", "full", "often"))
    shaped = cut(lines.filter(mostly("often")).select("k", "line_no", F.explode(F.array_compact(F.array(first, second))).alias("template")))
    recurring = _documents(shaped.select("template", "k"), "template")
    return shaped.join(recurring, "template", "left_semi").select("k", "line_no").distinct()


def _grouped(docs: DataFrame) -> DataFrame:
    return dropped_lines(docs).groupBy("k").agg(F.sort_array(F.collect_list("line_no")).alias("gone"))


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their columns, dropped lines taken out of ``text``."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("doc_id", "text").alias("k"))
    both = keyed.join(_grouped(docs), "k", "left")
    both = both.withColumn("lines", F.when(F.col("gone").isNotNull(), F.split("row.text", "\n")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    left = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(left)
    return both.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), F.when(F.col("text").isNull(), 0).otherwise(lines).cast("long").alias("n_lines"))
    both = rows.join(_grouped(docs), "k", "left")
    return both.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("dropped_lines"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, text, row_number() OVER () AS r, dense_rank() OVER (ORDER BY doc_id, text) AS k FROM documents),
u AS (SELECT DISTINCT k, text FROM d WHERE text IS NOT NULL),
l AS (SELECT k, unnest(list_zip(string_split(text, chr(10)), range(0, len(string_split(text, chr(10)))))) AS z FROM u),
t AS MATERIALIZED (
  SELECT k, line_no, list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{_FIELD}' ELSE x END) AS w
  FROM (SELECT k, z[2] AS line_no, regexp_extract_all(z[1], '{SPACE_WORD}') AS w FROM l) WHERE len(w) > 0),
v AS (SELECT *, len(w)::VARCHAR || chr(1) || array_to_string(list_slice(w, 1, {DEPTH}), chr(1)) AS leaf FROM t),
ok AS (SELECT leaf FROM v GROUP BY leaf HAVING count(DISTINCT k) >= {MIN_DOCS}),
h AS MATERIALIZED (SELECT * FROM v WHERE leaf IN (SELECT leaf FROM ok)),
p AS MATERIALIZED (SELECT leaf, k, line_no, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS pos FROM h),
o AS (SELECT leaf, pos, token FROM p WHERE token <> '{_FIELD}' GROUP BY ALL HAVING count(DISTINCT k) >= {MIN_DOCS}),
c AS (SELECT * FROM o QUALIFY count(*) OVER (PARTITION BY leaf, pos) <= {FAN_OUT}),
s AS (
  SELECT p.leaf, p.k, p.line_no, count(*) AS n, count(c.token) AS fixed, string_agg(coalesce(c.token, chr(2)), chr(1) ORDER BY p.pos) AS shape,
    count(o.token) AS often, string_agg(coalesce(o.token, chr(2)), chr(1) ORDER BY p.pos) AS whole
  FROM p LEFT JOIN o ON o.leaf = p.leaf AND o.pos = p.pos AND o.token = p.token
  LEFT JOIN c ON c.leaf = p.leaf AND c.pos = p.pos AND c.token = p.token GROUP BY p.leaf, p.k, p.line_no),
e AS (
  SELECT leaf, k, line_no, shape FROM s WHERE fixed > 0 AND fixed >= CASE WHEN n < {SHORT} THEN n ELSE ceil(n * {CONSTANT}) END
  UNION ALL SELECT leaf, k, line_no, whole FROM s WHERE often > fixed AND often >= CASE WHEN n < {SHORT} THEN n ELSE ceil(n * {CONSTANT}) END),
g AS (SELECT DISTINCT k, line_no FROM e WHERE (leaf, shape) IN (SELECT (leaf, shape) FROM e GROUP BY leaf, shape HAVING count(DISTINCT k) >= {MIN_DOCS})),
a AS (SELECT k, count(*) AS n, string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS gone FROM g GROUP BY k)
SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS BIGINT) AS n_lines,
  CAST(coalesce(a.n, 0) AS BIGINT) AS n_dropped, coalesce(a.gone, '') AS dropped_lines
FROM d LEFT JOIN a USING (k)
"""

"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in order of (id, text checksum, size).  A balanced Feistel network over
the smallest domain 4^h >= n, walked on while it leaves [0, n), permutes the numbers; row with
permuted number p goes to shard p mod k, slot p div k.  So shard sizes differ by one at most (law
``rows``), slots have no gaps, any row's place can be computed from its number alone, and
``unplace`` finds the number that stands in a given slot.

Defined cases: null ids sort first; a null text has no bytes (size 1, checksum 0); rows equal in
id, checksum and size are interchangeable; an empty table gives an empty result.  Texts are not
shuffled by ``numbers``; ``shards`` keeps all columns of the input in struct ``row``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.llm.common import ranked, table

SHARDS = 8
SEED = 20_240_607
ROUNDS = 6
_PRIME = (1 << 31) - 1


def keys(seed: int = SEED, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Multiplier and addend of each round, from the seed by a multiplicative generator."""
    out, x = [], seed % (_PRIME - 1) + 1
    for _ in range(rounds):
        pair = []
        for _ in range(2):
            x = x * 48271 % _PRIME
            pair.append(x)
        out.append(tuple(pair))
    return out


def half_bits(n: int) -> int:
    """Bits of one half: the smallest h with 4^h >= n, one at least."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(x: np.ndarray, key: tuple[int, int], mask: int) -> np.ndarray:
    t = (x * key[0] + key[1]) % _PRIME
    return (t * t % _PRIME) & mask


def _once(p: np.ndarray, h: int, rounds: list[tuple[int, int]], back: bool = False) -> np.ndarray:
    mask = (1 << h) - 1
    left, right = p >> h, p & mask
    for key in reversed(rounds) if back else rounds:
        if back:
            left, right = right ^ _round(left, key, mask), left
        else:
            left, right = right, left ^ _round(right, key, mask)
    return (left << h) | right


def permute(numbers: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """The permutation of [0, n) (or its inverse), by cycle walking."""
    if not 0 <= n <= 1 << 62:
        raise ValueError("n must be in 0 .. 2^62")
    h, rounds = half_bits(n), keys(seed)
    p = _once(np.asarray(numbers, dtype=np.int64), h, rounds, back)
    while (out := p >= n).any():
        p[out] = _once(p[out], h, rounds, back)
    return p


def unplace(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The row number that stands in a slot."""
    return int(permute(np.array([slot * shards + shard]), n, seed, back=True)[0])


def shards(df: DataFrame, count: int = SHARDS, seed: int = SEED, whole: bool = True) -> DataFrame:
    """(doc_id, size, text_crc32, number, shard, slot) and, if ``whole``, each row as ``row``."""
    row = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if whole else []
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), *row)
    numbered = ranked(rows, ["doc_id", "text_crc32", "size"], "number")
    n = numbered.count()

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(dtype=np.int64), n, seed))

    placed = numbered.withColumn("__p", place("number"))
    return placed.withColumns({"shard": (F.col("__p") % count).cast("int"), "slot": F.floor(F.col("__p") / count).cast("long")}).drop("__p")


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards(table(spark, sf_dir, "documents"), whole=False)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _oracle() -> str:
    body = "p >> h AS l, p & ((1::BIGINT << h) - 1) AS r"
    inner = f"SELECT *, {body} FROM walk WHERE fresh OR p >= n"
    for a, b in keys():
        inner = f"SELECT * EXCLUDE (l, r), r AS l, xor(l, (((r * {a} + {b}) % {_PRIME}) * ((r * {a} + {b}) % {_PRIME}) % {_PRIME}) & ((1::BIGINT << h) - 1)) AS r FROM ({inner})"
    return inner


def _crc_table() -> list[int]:
    """The table of CRC-32 (reflected polynomial 0xEDB88320), for the SQL counterpart."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ 0xEDB88320 * (c & 1)
        out.append(c)
    return out


ORACLE = f"""
WITH RECURSIVE bytes AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 1 AS size, hex(encode(coalesce(text, ''))) AS x FROM documents),
sums AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(regexp_extract_all(x, '..'), lambda i: ('0x' || i)::BIGINT)),
    lambda c, b: xor(c >> 8, CAST({_crc_table()} AS BIGINT[])[xor(c & 255, b) + 1]))) AS crc
  FROM bytes),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, crc, size) - 1 AS number, count(*) OVER () AS n FROM sums),
sized AS (
  SELECT *, greatest(1, (SELECT min(b) FROM range(1, 32) t(b) WHERE (1::BIGINT << (2 * b)) >= n)) AS h FROM numbered),
walk AS (
  SELECT doc_id, size, crc, n, h, CAST(number AS BIGINT) AS p, true AS fresh FROM sized
  UNION ALL
  SELECT doc_id, size, crc, n, h, (l << h) | r AS p, false AS fresh FROM ({_oracle()}))
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(p % {SHARDS} AS INTEGER) AS shard, p // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM walk WHERE NOT fresh AND p < n
"""

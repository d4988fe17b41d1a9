"""Order over whole tables without one task that holds them: row numbers and exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.operators.components import checkpointed


def _ordered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partitioned and sorted, with the part and the place of each row; written down, so that
    parts stay what they were."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc() for c in order]
    out = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return checkpointed(out.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))


def _starts(totals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out, before = [], 0
    for part, n in sorted(totals):
        out.append((part, before))
        before += n
    return out


def numbered(df: DataFrame, order: Sequence[str], name: str, first: int = 0) -> DataFrame:
    """Adds the place of each row in the order, from ``first``.  One number for each part meets on
    the driver."""
    parts = _ordered(df, order)
    totals = [(r["__part"], r["count"]) for r in parts.groupBy("__part").count().collect()]
    starts = df.sparkSession.createDataFrame(_starts(totals) or [(0, 0)], "__part int, __start long")
    out = parts.join(F.broadcast(starts), "__part").withColumn(name, F.col("__at") + F.col("__start") + first)
    return out.select(*df.columns, name)


def running_totals(df: DataFrame, order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Adds, for each name: column, the sum of the column over all rows up to this one in the order.
    One row of sums for each part meets on the driver."""
    parts = _ordered(df, order)
    whole = parts.groupBy("__part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    rows, before = [], [0] * len(sums)
    for r in sorted(whole.collect(), key=lambda r: r["__part"]):
        rows.append((r["__part"], *before))
        before = [b + (r[n] or 0) for b, n in zip(before, sums, strict=True)]
    starts = df.sparkSession.createDataFrame(rows, whole.schema)
    here = W.partitionBy("__part").orderBy("__at").rowsBetween(W.unboundedPreceding, 0)
    inside = parts.withColumns({f"__{n}": F.sum(c).over(here) for n, c in sums.items()})
    out = inside.join(F.broadcast(starts), "__part")
    return out.select(*df.columns, *[(F.col(f"__{n}") + F.col(n)).alias(n) for n in sums])


def quantiles(values: DataFrame, column: str, at: Sequence[float]) -> list[float | None]:
    """Exact quantiles, linear between neighbours, of the finite values: counts of distinct values
    are ordered in parts, and the few rows that the quantiles fall on come to the driver."""
    v = F.col(column).cast("double")
    finite = values.select(v.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    parts = _ordered(finite.groupBy("v").agg(F.count("*").alias("n")), ["v"])
    totals = [(r["__part"], r["n"]) for r in parts.groupBy("__part").agg(F.sum("n").alias("n")).collect()]
    total = sum(n for _, n in totals)
    if not total:
        return [None] * len(at)
    places = [q * (total - 1) for q in at]
    wanted = sorted({k for p in places for k in (math.floor(p), math.ceil(p))})
    starts = values.sparkSession.createDataFrame(_starts(totals), "__part int, __start long")
    end = F.sum("n").over(W.partitionBy("__part").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    rows = parts.withColumn("end", end).join(F.broadcast(starts), "__part").withColumn("end", F.col("end") + F.col("__start"))
    inside = F.lit(False)
    for k in wanted:
        inside = inside | ((F.col("end") > k) & (F.col("end") - F.col("n") <= k))
    found = {k: r.v for r in rows.filter(inside).collect() for k in wanted if r.end - r.n <= k < r.end}
    out = []
    for p in places:
        low, high = found[math.floor(p)], found[math.ceil(p)]
        out.append(low + (high - low) * (p - math.floor(p)))
    return out

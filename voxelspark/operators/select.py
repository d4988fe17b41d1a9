"""Choosing regions: greedy coverage under a budget, spread-out stops, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelspark.operators.components import checkpointed


def coverage(members: DataFrame, near: DataFrame) -> DataFrame:
    """members (ord, patch_id), near (id, neighbour) -> (ord, covered): the distinct neighbours of
    a candidate's patches."""
    return members.join(near, members["patch_id"] == near["id"]).select("ord", F.col("neighbour").alias("covered")).distinct()


def gains(candidates: DataFrame, cover: DataFrame, budget: float, alpha: float) -> DataFrame:
    """Affordable candidates with what they cover: (ord, gain, cost, score)."""
    g = cover.groupBy("ord").agg(F.count("*").alias("gain"))
    both = g.join(candidates.select("ord", "cost"), "ord").filter(F.col("cost") <= budget)
    return both.withColumn("score", F.col("gain") / F.pow(F.col("cost").cast("double"), F.lit(alpha)))


ORDER = (F.desc, "score"), (F.desc, "gain"), (F.asc, "cost"), (F.asc, "ord")


def _first(scored: DataFrame) -> DataFrame:
    return scored.orderBy(*[way(c) for way, c in ORDER]).limit(1)


def greedy(candidates: DataFrame, members: DataFrame, near: DataFrame, budget: int, most: int, alpha: float = 1.0, overlap: bool = False) -> DataFrame:
    """Up to ``most`` candidates, each the best of (gain / cost^alpha, gain, -cost, -ord) among
    those that fit the rest of the budget and share no patch with the chosen ones (unless
    ``overlap``): (rank, ord, gain, score, cost, spent, left, covered).

    A driver loop over the picks, of which there are few; each step is one distributed anti-join,
    aggregation and top-1, and only the pick comes back.
    """
    if not 0 <= alpha <= 1:
        raise ValueError("alpha must be in 0 .. 1")
    spark = candidates.sparkSession
    candidates, members = checkpointed(candidates.select("ord", "cost")), checkpointed(members.select("ord", "patch_id"))
    cover = checkpointed(coverage(members, near))
    chosen, spent, done, picks = [], 0, 0, []
    for rank in range(1, most + 1):
        open_, free = candidates, cover
        if chosen:
            # What is chosen is a list in the plan, so each step's plan is as small as the first one's.
            taken = cover.filter(F.col("ord").isin(chosen)).select("covered").distinct()
            free = cover.join(taken, "covered", "left_anti")
            gone = members.filter(F.col("ord").isin(chosen)).select("patch_id").distinct()
            gone = members.join(gone, "patch_id", "left_semi").select("ord").distinct()
            open_ = open_.filter(~F.col("ord").isin(chosen)) if overlap else open_.join(gone, "ord", "left_anti")
        best = _first(gains(open_, free, budget - spent, alpha)).first()
        if best is None:
            break
        spent, done = spent + best.cost, done + best.gain
        chosen.append(best.ord)
        picks.append((rank, best.ord, best.gain, best.score, best.cost, spent, budget - spent, done))
    if not picks:
        raise ValueError("no candidate fits the budget")
    return spark.createDataFrame(picks, "rank int, ord long, gain long, score double, cost long, spent long, left long, covered long")


def running(picks: DataFrame, budget: int, patches: int) -> DataFrame:
    """Cumulative cost, rest of the budget and coverage rate by rank."""
    from voxelspark.operators.numbering import running_totals

    out = running_totals(picks, ["rank"], {"total_cost": "cost", "total_gain": "gain"})
    return out.withColumn("rest", F.lit(budget) - F.col("total_cost")).withColumn("rate", F.col("total_gain") / patches)


def spaced(points: DataFrame, seed: str, count: int, distance: float, limit: int = 100_000) -> DataFrame:
    """The first ``count`` points, in an order by hash, that keep ``distance`` from all before.

    Points (id, x, y) come in hash order in bounded slices; acceptance is sequential by nature, so
    it is done on the driver over at most ``count`` accepted points.  Too few is an error.
    """
    turn = F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")))
    return first_apart(points.withColumn("turn", turn), count, distance, limit)


def first_apart(points: DataFrame, count: int, distance: float, limit: int = 100_000) -> DataFrame:
    """The same over points (id, x, y, turn) in the order of ``turn``, text without repeats."""
    spark = points.sparkSession
    ordered = points.select("id", F.col("x").cast("double"), F.col("y").cast("double"), "turn")
    kept, after = [], ""
    while len(kept) < count:
        rows = ordered.filter(F.col("turn") > after).orderBy("turn").limit(limit).collect()
        for r in rows:
            if all((r.x - k.x) ** 2 + (r.y - k.y) ** 2 >= distance * distance for k in kept):
                kept.append(r)
                if len(kept) == count:
                    break
        if len(rows) < limit:
            break
        after = rows[-1].turn
    if len(kept) < count:
        raise ValueError(f"only {len(kept)} of {count} points keep the distance")
    return spark.createDataFrame([(i + 1, r.id, r.x, r.y) for i, r in enumerate(kept)], "rank int, id long, x double, y double")


def evenly(df: DataFrame, order: str, count: int, total: int) -> DataFrame:
    """``count`` rows evenly spaced in the 0-based column ``order`` of ``total`` rows."""
    places: Sequence[int] = sorted({i * (total - 1) // max(1, count - 1) for i in range(min(count, total))})
    return df.filter(F.col(order).isin(*places))


def eligible(points: DataFrame, share: str, least: float, width: int, height: int, margin: int) -> DataFrame:
    """Points (x, y, share of tissue) with enough tissue around them, outside the margins."""
    inside = (F.col("x") >= margin) & (F.col("x") < width - margin) & (F.col("y") >= margin) & (F.col("y") < height - margin)
    return points.filter(inside & (F.col(share) >= least))


def draws(spark, seed: str, box: tuple[float, float, float, float], count: int = 2000) -> DataFrame:
    """(id, x, y, turn): so many points drawn by hash in a box (x0, x1, y0, y1), in their order."""
    unit = lambda part: F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{part}:"), F.col("id").cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    d = spark.range(1, count + 1)
    x, y = F.lit(box[0]) + unit("x") * (box[1] - box[0]), F.lit(box[2]) + unit("y") * (box[3] - box[2])
    return d.select("id", x.alias("x"), y.alias("y"), F.lpad(F.col("id").cast("string"), 10, "0").alias("turn"))


def equispaced(candidates: DataFrame, order: str, count: int) -> DataFrame:
    """``count`` candidates evenly spaced in their order."""
    from voxelspark.operators.numbering import numbered

    total = candidates.count()
    return evenly(numbered(candidates, [order], "place"), "place", count, total)


def split_by_cell(boxes: DataFrame, edge: int, share: float, seed: str) -> DataFrame:
    """Boxes with ``part``: cells of ``edge`` planes along z go to validation with probability
    ``share``, by hash; a box in cells of both kinds is left out, so that no two boxes of different
    parts share a voxel."""
    cell = lambda z: F.floor(z / edge)
    drawn = lambda c: F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) < share
    kinds = F.transform(F.sequence(cell(F.col("z0")), cell(F.col("z1") - 1)), drawn)
    tagged = boxes.withColumn("__all", F.forall(kinds, lambda k: k)).withColumn("__any", F.exists(kinds, lambda k: k))
    part = F.when(F.col("__all"), "validation").when(~F.col("__any"), "training")
    return tagged.withColumn("part", part).filter("part IS NOT NULL").drop("__all", "__any")

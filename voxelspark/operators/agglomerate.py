"""Instances from affinities: a region adjacency table, contracted from its strongest edges on.

An edge's strength is the mean affinity of the contacts between two regions, kept as a whole total and a
count, so sums are exact.  Contracting two regions adds totals and counts of parallel edges.  A mean is
never above the larger of two means, so an edge that is the best of both its ends stays so until it is
contracted, whatever happens elsewhere: regions whose best edges stay within a block are contracted there
as contracting one edge after the other, the strongest first, does.  Edges of equal strength that touch are
taken in the order of their ends, so a block contracts them only if it holds them all.  Strength minus
``beta`` is the signed weight; edges at or below ``beta`` are never contracted, so a lower beta only joins
what a higher one leaves apart.
"""

from __future__ import annotations

import heapq
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelspark.operators.components import checkpointed


def adjacency(voxels: DataFrame, region: str, affinity: str) -> DataFrame:
    """Voxels (z, y, x, region, affinity) -> (a, b, total, n), a < b: the contacts of two regions across
    faces, and the sum of their affinities, the smaller one of the two voxels.  Region 0 is none."""
    cells = voxels.filter(F.col(region) != 0).select("z", "y", "x", F.col(region).cast("long").alias("r"), F.col(affinity).cast("long").alias("v"))
    # Each voxel goes to its own place and to the three before it, where pairs meet in one shuffle.
    steps = [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
    ways = [F.struct(F.lit(i).alias("axis"), F.lit(m).alias("m"), *[F.lit(s * m).alias(f"d{a}") for a, s in zip("zyx", step, strict=True)]) for i, step in enumerate(steps) for m in (0, 1)]
    placed = cells.withColumn("w", F.explode(F.array(*ways))).select(*[(F.col(a) - F.col(f"w.d{a}")).alias(a) for a in "zyx"], "w.axis", "w.m", "r", "v")
    side = lambda m: F.max(F.when(F.col("m") == m, F.struct("r", "v")))
    pairs = placed.groupBy("z", "y", "x", "axis").agg(side(0).alias("p"), side(1).alias("q")).filter("p.r <> q.r")
    both = pairs.select(F.least("p.r", "q.r").alias("a"), F.greatest("p.r", "q.r").alias("b"), F.least("p.v", "q.v").alias("v"))
    return both.groupBy("a", "b").agg(F.sum("v").alias("total"), F.count("*").alias("n"))


def strength() -> Column:
    return F.col("total") / F.col("n")


#: Edges of a block at first, and the most that blocks grow to while rounds get on.
BLOCK, MOST = 200_000, 800_000


def _contracted(edges: list[tuple], outside: set, beta: float) -> dict:
    """Edges (a, b, total, n), all those of every region but of ``outside`` -> {region: what it is joined to}.

    Strengths are taken from the highest down.  A region that has an edge of the strength at hand to one
    outside, or to one that waits, waits too, as do all that are tied to it: what they are joined to is
    decided elsewhere.  Other edges of that strength have both ends here, and stronger ones are gone."""
    near: dict = {}
    for a, b, total, n in edges:
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = (total, n)
    heap = [(-t / n, a, b) for a, b, t, n in edges if -t / n < -beta]
    heapq.heapify(heap)
    waits, name, into = set(outside), {}, {}
    while heap:
        weak, tied = heap[0][0], {}
        while heap and heap[0][0] == weak:
            _, a, b = heapq.heappop(heap)
            e = near.get(a, {}).get(b)
            if e and -e[0] / e[1] == weak:
                tied.setdefault(a, set()).add(b)
                tied.setdefault(b, set()).add(a)
        reached = [r for r in tied if r in waits]
        waiting = set(reached)
        while reached:
            for other in tied[reached.pop()]:
                if other not in waiting:
                    waiting.add(other)
                    reached.append(other)
        waits |= waiting
        ends = lambda a, b: (*sorted((name.get(a, a), name.get(b, b))), a, b)
        turn = [ends(a, b) for a, others in tied.items() if a not in waiting for b in others if a < b]
        heapq.heapify(turn)
        while turn:
            p, q, a, b = heapq.heappop(turn)
            if b not in tied.get(a, ()) or ends(a, b)[:2] != (p, q):
                continue
            keep, gone = (a, b) if len(near[a]) >= len(near[b]) else (b, a)
            name[keep], into[gone] = p, keep
            for other in tied.pop(gone):
                tied[other].discard(gone)
            del near[keep][gone]
            for other, (total, n) in near.pop(gone).items():
                if other == keep:
                    continue
                del near[other][gone]
                t, m = near[keep].get(other, (0, 0))
                e = near[keep][other] = near[other][keep] = (total + t, n + m)
                w = -e[0] / e[1]
                if w == weak:
                    tied[keep].add(other)
                    tied[other].add(keep)
                else:
                    if m and other in tied[keep]:
                        tied[keep].discard(other)
                        tied[other].discard(keep)
                    if w < -beta:
                        heapq.heappush(heap, (w, keep, other))
            for other in tied[keep]:
                heapq.heappush(turn, ends(keep, other))
    out = {}
    for region in near.keys() | into.keys():
        root = region
        while root in into:
            root = into[root]
        while into.get(region, root) != root:  # so that no path is walked twice
            into[region], region = root, into[region]
    for region in near.keys() | into.keys():
        root = into.get(region, region)
        if name.get(root, region) != region:
            out[region] = name[root]
    return out


def _in_block(beta: float):
    def run(t: pa.Table) -> pa.Table:
        a, b, total, n, far_a, far_b = (t.column(c).to_pylist() for c in ("a", "b", "total", "n", "far_a", "far_b"))
        outside = {r for r, f in zip(a, far_a, strict=True) if f} | {r for r, f in zip(b, far_b, strict=True) if f}
        into = _contracted(list(zip(a, b, total, n, strict=True)), outside, beta)
        return pa.table({"gone": pa.array(into.keys(), pa.int64()), "into": pa.array(into.values(), pa.int64())})

    return run


def _block(region: str, cuts: list[float]) -> Column:
    """The number of the cuts at or below a region."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(region))) if cuts else F.lit(0)


def contract(edges: DataFrame, beta: float, block: int = BLOCK) -> DataFrame:
    """(a, b, total, n) -> (region, instance) for all regions with an edge: the least region of its instance.
    Ties go to the edge with the smaller ends, by the least regions of what they are joined to so far.

    Regions are dealt to blocks by their numbers, at about so many edges a block.  A task gets all edges of
    a block's regions and contracts what other blocks can't change; the table is joined to what was
    contracted, and a round with wider blocks, cut elsewhere, follows until one block holds what is left.
    Edges at or below beta are kept, as their contacts weigh in when their ends are contracted.
    """
    now = checkpointed(edges.select("a", "b", F.col("total").cast("long").alias("total"), F.col("n").cast("long").alias("n")))
    ends = now.select(F.col("a").alias("region")).union(now.select(F.col("b").alias("region"))).distinct()
    names = checkpointed(ends.select("region", F.col("region").alias("instance")))
    held, shift = now.count(), False
    while now.filter(strength() > beta).limit(1).count():
        parts = math.ceil(held / block)
        cuts = sorted(set(now.approxQuantile("a", [(i + (0.5 if shift else 0)) / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
        dealt = now.withColumn("ba", _block("a", cuts)).withColumn("bb", _block("b", cuts))
        dealt = dealt.withColumn("block", F.explode(F.array_distinct(F.array("ba", "bb")))).withColumn("far_a", F.col("ba") != F.col("block")).withColumn("far_b", F.col("bb") != F.col("block"))
        chosen = checkpointed(dealt.groupBy("block").applyInArrow(_in_block(beta), "gone long, into long"))
        names = checkpointed(names.join(chosen, names["instance"] == chosen["gone"], "left").select("region", F.coalesce("into", "instance").alias("instance")))
        if not cuts:
            return names
        for c in "ab":
            now = now.join(chosen, now[c] == chosen["gone"], "left").withColumn(c, F.coalesce("into", c)).drop("gone", "into")
        now = now.filter("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        now = checkpointed(now)
        before, held, shift = held, now.count(), not shift
        if block < MOST or held > 0.9 * before:
            block *= 2
    return names


def instances(voxels: DataFrame, region: str, affinity: str, beta: float) -> DataFrame:
    """Voxels with ``instance``: the least region that theirs is joined to; region 0 stays 0."""
    names = contract(adjacency(voxels, region, affinity), beta).withColumnRenamed("region", region)
    return voxels.join(names, region, "left").withColumn("instance", F.coalesce("instance", region))


def sweep(edges: DataFrame, betas: list[float]) -> DataFrame:
    """(beta, instances, regions): how many instances each beta makes of the regions that have edges, and of how many regions."""
    out = None
    for beta in sorted(betas):
        part = contract(edges, beta).groupBy().agg(F.countDistinct("instance").alias("instances"), F.count("*").alias("regions")).select(F.lit(float(beta)).alias("beta"), "instances", "regions")
        out = part if out is None else out.union(part)
    return out

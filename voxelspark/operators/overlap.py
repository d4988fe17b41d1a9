"""Comparing labelings voxel by voxel: foreground scores, overlapping pairs, instance matching."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelspark.operators.components import checkpointed, connected


def ratio(num: Column, den: Column, empty: Column | float) -> Column:
    return F.when(den == 0, F.lit(empty) if isinstance(empty, (int, float)) else empty).otherwise(num.cast("double") / F.when(den == 0, F.lit(1)).otherwise(den))


def foreground_metrics(voxels: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """One row: tp, fp, fn, dice, iou, precision, recall.  Two empty masks agree (1); precision
    without prediction is 1 if there is no truth, recall without truth is 1."""
    p, t = F.col(pred) > 0, F.col(truth) > 0
    c = voxels.agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        "tp", "fp", "fn", ratio(2 * tp, 2 * tp + fp + fn, 1.0).alias("dice"), ratio(tp, tp + fp + fn, 1.0).alias("iou"),
        ratio(tp, tp + fp, F.when(tp + fn == 0, 1.0).otherwise(0.0)).alias("precision"), ratio(tp, tp + fn, 1.0).alias("recall"),
    )


def pair_overlap(voxels: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """(pred, truth, n, size_pred, size_truth, iou) of each pair of objects that share a voxel.

    One aggregation to pairs, with partial sums; sizes come from the pairs' table, not from a
    second pass over the voxels.
    """
    pairs = voxels.filter((F.col(pred) > 0) | (F.col(truth) > 0)).groupBy(F.col(pred).alias("pred"), F.col(truth).alias("truth")).agg(F.count("*").alias("n"))
    sized = pairs.withColumn("size_pred", F.sum("n").over(W.partitionBy("pred"))).withColumn("size_truth", F.sum("n").over(W.partitionBy("truth")))
    both = sized.filter((F.col("pred") > 0) & (F.col("truth") > 0))
    return both.withColumn("iou", F.col("n").cast("double") / (F.col("size_pred") + F.col("size_truth") - F.col("n")))


def match_strict(pairs: DataFrame, threshold: float) -> DataFrame:
    """Matches above one half: at most one partner each, so a filter is the whole matching."""
    if threshold <= 0.5:
        raise ValueError("a threshold of one half or less needs match_greedy")
    return pairs.filter(F.col("iou") >= threshold)


GROUP_PAIRS = 1_000_000  # of a component that one task matches in order


def _in_order(t: pa.Table) -> pa.Table:
    """The pairs of a component that the order takes, one after another."""
    iou, pred, truth = (np.asarray(t[c]) for c in ("iou", "pred", "truth"))
    order = np.lexsort((-truth, -pred, -iou))
    left, right, taken = set(), set(), []
    for i, p, q in zip(order.tolist(), pred[order].tolist(), truth[order].tolist(), strict=True):
        if p not in left and q not in right:
            left.add(p)
            right.add(q)
            taken.append(i)
    return t.select(["pred", "truth", "n", "iou"]).take(pa.array(taken, pa.int64()))


def _in_block(t: pa.Table) -> pa.Table:
    """Pairs with their places among those of each of their objects, some of them elsewhere -> the pairs
    that the order takes (1) or that lose an object to these (0), as far as the block tells: a pair waits
    (no row) where a better one of its objects waits or is not here."""
    pred, truth, a, b = (np.asarray(t[c]) for c in ("pred", "truth", "a", "b"))
    order = np.lexsort((-truth, -pred, -np.asarray(t["iou"])))
    taken, seen, waits, settled, kinds = (set(), set()), ({}, {}), (set(), set()), [], []
    for i, *ends in zip(order.tolist(), pred[order].tolist(), truth[order].tolist(), a[order].tolist(), b[order].tolist(), strict=True):
        objects, places = ends[:2], ends[2:]
        for side in (0, 1):
            here = seen[side][objects[side]] = seen[side].get(objects[side], 0) + 1
            if here != places[side]:
                waits[side].add(objects[side])
        if objects[0] in taken[0] or objects[1] in taken[1]:
            settled.append(i)
            kinds.append(0)
        elif objects[0] in waits[0] or objects[1] in waits[1]:
            waits[0].add(objects[0])
            waits[1].add(objects[1])
        else:
            taken[0].add(objects[0])
            taken[1].add(objects[1])
            settled.append(i)
            kinds.append(1)
    return t.select(["pred", "truth", "n", "iou"]).take(pa.array(settled, pa.int64())).append_column("kind", pa.array(kinds, pa.int32()))


def _round(left: DataFrame, side: str, shift: bool, most: int) -> tuple[DataFrame, DataFrame]:
    """(taken, left): what blocks of about ``most`` pairs, near in the numbers of one side, settle; the best
    pair of both its objects is always among it.  Pairs of taken objects leave."""
    order = [F.col("iou").desc(), F.col("pred").desc(), F.col("truth").desc()]
    parts = math.ceil(left.count() / most)
    cuts = sorted(set(left.approxQuantile(side, [(i + (0.5 if shift else 0)) / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    block = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(side))) if cuts else F.lit(0)
    best = left.withColumn("a", F.row_number().over(W.partitionBy("pred").orderBy(*order))).withColumn("b", F.row_number().over(W.partitionBy("truth").orderBy(*order)))
    kinds = "pred long, truth long, n long, iou double, kind int"
    typed = best.select(F.col("pred").cast("long"), F.col("truth").cast("long"), F.col("n").cast("long"), "iou", "a", "b", block.alias("block"))
    settled = checkpointed(typed.groupBy("block").applyInArrow(_in_block, kinds))
    now = settled.filter("kind = 1").select(*[F.col(f.name).cast(f.dataType) for f in left.schema.fields])
    rest = left.join(now.select("pred"), "pred", "left_anti").join(now.select("truth"), "truth", "left_anti")
    return now, checkpointed(rest.select("pred", "truth", "n", "iou"))


def _in_rounds(pairs: DataFrame, most: int) -> DataFrame:
    """The same by rounds, until one task can hold what is left: each settles what blocks tell, by the
    numbers of one side and the other, cut elsewhere each time.  Each round is written down, and what is
    taken is put together now and then, so plans do not grow."""
    left, taken, turn = checkpointed(pairs.select("pred", "truth", "n", "iou")), [], 0
    while left.limit(most + 1).count() > most:
        now, left = _round(left, ("pred", "truth")[turn % 2], turn % 4 > 1, most)
        taken, turn = [*taken, now], turn + 1
        if len(taken) == 10:
            taken = [checkpointed(functools.reduce(DataFrame.unionByName, taken))]
    last = left.withColumn("component", F.lit(0)).groupBy("component").applyInArrow(_in_order, left.schema)
    return functools.reduce(DataFrame.unionByName, [*taken, last])


def match_greedy(pairs: DataFrame, threshold: float, most: int = GROUP_PAIRS) -> DataFrame:
    """One-to-one matches in order of (iou, pred, truth), all descending.

    One task matches ``most`` pairs in order.  Of more, a round of blocks settles what can't be changed from
    outside them, and goes on while it leaves less than half; else pairs of different connected components,
    which never compete, are told apart, and only components of more than ``most`` pairs take more rounds.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be in (0, 1]")
    left, taken = checkpointed(pairs.filter(F.col("iou") >= threshold).select("pred", "truth", "n", "iou")), []
    held, turn = left.count(), 0
    while held > most:
        now, left = _round(left, ("pred", "truth")[turn % 2], turn % 4 > 1, most)
        before, held, turn = held, left.count(), turn + 1
        taken.append(now)
        if held > before / 2:
            break
    if held <= most:
        last = left.withColumn("component", F.lit(0)).groupBy("component").applyInArrow(_in_order, left.schema)
        return functools.reduce(DataFrame.unionByName, [*taken, last])
    ends = left.select((F.col("pred") * 2).alias("a"), (F.col("truth") * 2 + 1).alias("b"))
    nodes = ends.select(F.col("a").alias("node")).union(ends.select(F.col("b").alias("node"))).distinct()
    found = connected(nodes, ends)
    named = checkpointed(left.join(found.withColumnRenamed("node", "a"), F.col("pred") * 2 == F.col("a")).drop("a"))
    large = named.groupBy("component").count().filter(F.col("count") > most).select("component")
    out = named.join(large, "component", "left_anti").groupBy("component").applyInArrow(_in_order, left.schema)
    rest = _in_rounds(named.join(large, "component", "left_semi").drop("component"), most)
    return functools.reduce(DataFrame.unionByName, [*taken, out, rest])


def match_scores(matches: DataFrame, objects: DataFrame) -> DataFrame:
    """``objects`` (n_pred, n_truth) -> tp, fp, fn, precision, recall, f1, mean_iou."""
    m = matches.agg(F.count("*").alias("tp"), F.avg("iou").alias("mean_iou"))
    both = m.join(F.broadcast(objects))
    tp, p, t = F.col("tp"), F.col("n_pred"), F.col("n_truth")
    both = both.withColumn("precision", ratio(tp, p, F.when(t == 0, 1.0).otherwise(0.0))).withColumn("recall", ratio(tp, t, 1.0))
    total = F.col("precision") + F.col("recall")
    f1 = F.when(total == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / F.when(total == 0, 1.0).otherwise(total))
    return both.select("tp", (p - tp).alias("fp"), (t - tp).alias("fn"), "precision", "recall", f1.alias("f1"), "mean_iou")


def object_counts(voxels: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    some = lambda c: F.count_distinct(F.when(F.col(c) > 0, F.col(c)))
    return voxels.agg(some(pred).alias("n_pred"), some(truth).alias("n_truth"))


def rank_candidates(scores: DataFrame) -> DataFrame:
    """(name, score) -> with ``rank`` by descending score, then name."""
    return scores.withColumn("rank", F.row_number().over(W.orderBy(F.col("score").desc(), "name")))


def information(voxels: DataFrame, pred: str = "pred", truth: str = "truth") -> DataFrame:
    """One row over truth foreground: variation of information (split, merge) and adapted Rand
    error, from the table of pairs."""
    pairs = voxels.filter(F.col(truth) > 0).groupBy(F.col(pred).alias("p"), F.col(truth).alias("t")).agg(F.count("*").cast("double").alias("n"))
    s = pairs.withColumn("np", F.sum("n").over(W.partitionBy("p"))).withColumn("nt", F.sum("n").over(W.partitionBy("t")))
    pair, total = F.sum(F.col("n") * F.col("n")), F.sum("n")
    rows = s.agg(
        (F.sum(-F.col("n") * F.log2(F.col("n") / F.col("nt"))) / total).alias("vi_split"),
        (F.sum(-F.col("n") * F.log2(F.col("n") / F.col("np"))) / total).alias("vi_merge"),
        pair.alias("both"), F.sum(F.col("n") * F.col("np")).alias("same_p"), F.sum(F.col("n") * F.col("nt")).alias("same_t"),
    )
    return rows.select("vi_split", "vi_merge", (1 - 2 * F.col("both") / (F.col("same_p") + F.col("same_t"))).alias("arand_error"))


def slice_edges(voxels: DataFrame, label: str = "pred") -> DataFrame:
    """Objects of adjacent planes that overlap: (z, a, b, n, iou, ioa), a on z and b on z + 1."""
    here = voxels.filter(F.col(label) > 0).select("z", "y", "x", F.col(label).alias("a"))
    above = here.select((F.col("z") - 1).alias("z"), "y", "x", F.col("a").alias("b"))
    n = here.join(above, ["z", "y", "x"]).groupBy("z", "a", "b").agg(F.count("*").alias("n"))
    size = here.groupBy("z", F.col("a").alias("o")).agg(F.count("*").alias("size"))
    out = n.join(size.select("z", F.col("o").alias("a"), F.col("size").alias("size_a")), ["z", "a"])
    out = out.join(size.select((F.col("z") - 1).alias("z"), F.col("o").alias("b"), F.col("size").alias("size_b")), ["z", "b"])
    iou = F.col("n").cast("double") / (F.col("size_a") + F.col("size_b") - F.col("n"))
    return out.select("z", "a", "b", "n", iou.alias("iou"), (F.col("n").cast("double") / F.least("size_a", "size_b")).alias("ioa"))


def ambiguities(pairs: DataFrame, close: float = 0.05) -> DataFrame:
    """Objects whose second-best partner is within ``close`` of the best."""
    w = W.partitionBy("pred").orderBy(F.col("iou").desc(), F.col("truth").desc())
    top = pairs.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= 2)
    pick = lambda i, c: F.max(F.when(F.col("place") == i, F.col(c)))
    out = top.groupBy("pred").agg(pick(1, "truth").alias("best"), pick(2, "truth").alias("second"), pick(1, "iou").alias("best_iou"), pick(2, "iou").alias("second_iou"))
    return out.withColumn("ambiguous", F.coalesce(F.col("best_iou") - F.col("second_iou") < close, F.lit(False)))


def doubtful(pairs: DataFrame, strong: float = 0.3, close: float = 0.05, largest: int = 1 << 40) -> DataFrame:
    """(pred, kind) for each reason to look again: several strong partners (by share of the object),
    a close second, or an object that joined with its best partner would be too large."""
    w = W.partitionBy("pred").orderBy(F.col("iou").desc(), F.col("truth").desc())
    top = pairs.withColumn("place", F.row_number().over(w))
    pick = lambda i, c: F.max(F.when(F.col("place") == i, F.col(c)))
    share = F.col("n").cast("double") / F.col("size_pred")
    per = top.groupBy("pred").agg(
        F.count_if(share >= strong).alias("partners"), (pick(1, "iou") - pick(2, "iou")).alias("gap"), (F.max("size_pred") + pick(1, "size_truth") - pick(1, "n")).alias("joined")
    )
    kinds = F.array(F.when(F.col("partners") > 1, "several"), F.when(F.col("gap") < close, "close"), F.when(F.col("joined") > largest, "large"))
    return per.select("pred", F.explode(F.array_compact(kinds)).alias("kind"))


def chained(edges: DataFrame, objects: DataFrame, ioa: float) -> DataFrame:
    """Objects (z, label) of planes and edges (z, a, b, ioa) of adjacent ones -> (z, label, id): the
    least code (z, label) of each chain of objects that overlap enough."""
    code = lambda z, c: z.cast("long") * (1 << 32) + F.col(c)
    nodes = objects.select("z", "label", code(F.col("z"), "label").alias("node"))
    strong = edges.filter(F.col("ioa") >= ioa).select(code(F.col("z"), "a").alias("a"), code(F.col("z") + 1, "b").alias("b"))
    return nodes.join(connected(nodes.select("node"), strong), "node").select("z", "label", F.col("component").alias("id"))


def consensus(voxels: DataFrame, views: list[str], iou: float) -> DataFrame:
    """(view_a, a, view_b, b, n, iou) of objects of two views that overlap enough to be one."""
    out = None
    for i, a in enumerate(views):
        for b in views[i + 1 :]:
            p = pair_overlap(voxels, a, b).filter(F.col("iou") >= iou)
            p = p.select(F.lit(a).alias("view_a"), F.col("pred").alias("a"), F.lit(b).alias("view_b"), F.col("truth").alias("b"), "n", "iou")
            out = p if out is None else out.unionByName(p)
    return out

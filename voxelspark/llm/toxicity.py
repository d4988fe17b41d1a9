"""Toxicity by weak supervision.

A bounded sample of labelled rows (``MAX_LABELLED``, smallest hashes of the id) is all that the
model is fitted on; every document is scored, over its whole text.

1. Terms are the words of a text and their first 3, 4, 5 and 6 bytes.  Terms that stand in some
   positive rows of the sample are counted there in rows of either label, and those that speak for
   the label beyond chance are kept, best first.
2. Voters: the kept terms are dealt into lexicons that vote when one of their terms occurs; a fixed
   list of insults is one more; patterns of the text (symbol noise, shouting, repetition, no kept
   term at all) are the others; the label itself votes as an annotator who may err.
3. The label model: a latent label, for each voter its firing rate under either value (expectation
   maximisation), and the correlations of voters given the label.  A voter that others repeat
   counts by so much less.  Its posterior is the training target.
4. A linear classifier over the kept terms, trained on the posteriors with a ridge penalty.  Its
   probability is the score.

Parameters that bound the fit, which sees labelled rows only: ``MAX_LABELLED`` rows, ``CANDIDATES``
terms to choose from (those in most positive rows), ``TERMS`` terms kept.

Defined cases: null and empty texts have no terms and get the score of the bias; without labelled
rows of both values the score is 0; null labels and labels of null ids are not used; a null id has
no checksum and is not held out; several labels of one id count as several rows; extra columns are
ignored; a text's score depends on nothing but the text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.llm import textscan as ts
from voxelspark.llm.common import cut, table

MAX_LABELLED = 20_000
MIN_POSITIVE = 4  # rows with the label that a term must stand in
CANDIDATES = 1_000_000
TERMS = 768
LEXICONS = 48
PREFIXES = (3, 4, 5, 6)
THRESHOLD = 0.3
#: A short list of common English insults, one voter among many.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "dumb", "fool", "jerk", "garbage")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each term's every occurrence."""
    words = ts.scan(column, ts.NOT_LETTERS)
    rows, hashes = [words.row], [words.hash]
    for size in PREFIXES:
        row, h = words.prefixes(size)
        rows.append(row)
        hashes.append(h)
    return np.concatenate(rows), np.concatenate(hashes)


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def known(row: np.ndarray, h: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in the sorted vocabulary) of the terms that it holds, distinct."""
    if not len(vocabulary):
        return row[:0], row[:0]
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    ok = vocabulary[at] == h
    return distinct(row[ok], at[ok])


def patterns(column: pa.Array) -> np.ndarray:
    """Votes of the pattern voters: symbol noise, shouting, exclamation, repetition."""
    raw, at = ts.text_bytes(column)
    n = np.diff(at)
    some = np.flatnonzero(n)

    def share(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(len(n))
        if len(some):
            out[some] = np.add.reduceat(mask, at[some], dtype=np.int64) / n[some]
        return out

    upper = (raw >= 65) & (raw <= 90)
    noise = np.isin(raw, np.frombuffer(b"#$%&*|~^", dtype=np.uint8))
    same = np.zeros(len(raw), dtype=bool)
    same[4:] = raw[4:] == raw[:-4]
    for i in range(4):  # what is before a row is another text
        same[at[some[n[some] > i]] + i] = False
    return np.stack([share(noise) > 0.05, share(upper) > 0.3, share(raw == 33) > 0.01, share(same) > 0.5], axis=1)


@dataclass
class Model:
    """Sorted term hashes, their weights and the bias; ``fitted`` False scores everything 0."""

    vocabulary: np.ndarray
    weights: np.ndarray
    bias: float
    fitted: bool = True


def label_model(votes: np.ndarray, annotator: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Posterior of label 1 for each row.  ``votes`` (rows, voters) bool; ``annotator`` 0 or 1."""
    all_votes = np.concatenate([votes, annotator[:, None] > 0], axis=1).astype(np.float32)
    post = np.where(annotator > 0, 0.95, 0.02).astype(np.float64)
    trust = np.ones(all_votes.shape[1])
    for step in range(rounds):
        p1, n1 = post, post.sum()
        fire1 = (all_votes.T @ p1 + 0.5) / (n1 + 1)
        fire0 = (all_votes.T @ (1 - p1) + 0.5) / (len(post) - n1 + 1)
        if step % 5 == 4:  # correlations given the label, over rows
            rest = all_votes - (np.outer(p1, fire1) + np.outer(1 - p1, fire0))
            spread = rest.T @ rest / len(post)
            scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
            tie = np.clip(spread / np.outer(scale, scale), 0, 1)
            tie[tie < 0.1] = 0
            np.fill_diagonal(tie, 0)
            trust = 1 / (1 + tie.sum(axis=1))
        on, off = np.log(fire1 / fire0) * trust, np.log((1 - fire1) / (1 - fire0)) * trust
        prior = np.log((n1 + 1) / (len(post) - n1 + 1))
        logit = prior + all_votes @ (on - off) + off.sum()
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post


def linear(x: np.ndarray, target: np.ndarray, ridge: float = 1e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets, by accelerated gradient descent."""
    n, d = x.shape
    w, v = np.zeros(d + 1, np.float32), np.zeros(d + 1, np.float32)
    rate = 4.0 / (1 + float(np.square(x).sum(axis=1).mean()))
    goal = target.astype(np.float32)
    for step in range(rounds):
        ahead = w + (step / (step + 3)) * (w - v)
        z = x @ ahead[:-1] + ahead[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - goal) / n
        grad = np.append(x.T @ g + ridge * ahead[:-1], g.sum()).astype(np.float32)
        v, w = w, ahead - rate * grad
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, kept: int = TERMS) -> Model:
    """docs (doc_id, text), labels (doc_id, toxic): fitted on ``limit`` labelled rows at most, with
    ``kept`` terms at most."""
    none = Model(np.zeros(0, np.uint64), np.zeros(0, np.float32), 0.0, False)
    chosen = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select("doc_id", (F.col("toxic") > 0).cast("int").alias("y"))
    chosen = cut(chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(limit))
    sample = cut(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("y", "text"))

    def positive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in ts.blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(distinct(*terms(part.column("text")))[1].view(np.int64))], ["h"])

    often = sample.filter("y = 1").select("text").mapInArrow(positive, "h long").groupBy("h").count().filter(F.col("count") >= MIN_POSITIVE)
    often = often.orderBy(F.desc("count"), "h").limit(CANDIDATES).select("h")
    candidates = np.sort(often.toPandas()["h"].to_numpy(dtype=np.int64).view(np.uint64))
    sizes = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    if not sizes.get(0) or not sizes.get(1) or not len(candidates):
        return none

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(candidates)), dtype=np.int64)
        for part in ts.blocks(batches, "text"):
            y = np.asarray(part.column("y"))
            row, at = known(*terms(part.column("text")), candidates)
            for label in (0, 1):
                total[label] += np.bincount(at[y[row] == label], minlength=len(candidates))
        here = np.flatnonzero(total.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(total[0, here]), pa.array(total[1, here])], ["at", "neg", "pos"])

    found = sample.mapInArrow(counted, "at long, neg long, pos long").groupBy("at").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).toPandas()
    p, n, pos, neg = sizes[1], sizes[0], found.pos.to_numpy(), found.neg.to_numpy()
    odds = np.log((pos + 0.5) / (p - pos + 0.5)) - np.log((neg + 0.5) / (n - neg + 0.5))
    error = np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5) + 1 / (p - pos + 0.5) + 1 / (n - neg + 0.5))
    sure = odds - 2 * error  # the least that the evidence allows
    best = np.argsort(-sure, kind="stable")
    best = best[sure[best] > 0.5][:kept]
    if not len(best):
        return none
    order = np.argsort(candidates[found["at"].to_numpy()[best]])
    rank = np.empty(len(best), dtype=np.int64)
    rank[:] = order  # place in the vocabulary -> rank of the term
    vocabulary = candidates[found["at"].to_numpy()[best]][order]
    seeds = ts.scan(pa.array([" ".join(INSULTS)]), ts.NOT_LETTERS).hash

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in ts.blocks(batches, "text"):
            row, h = terms(part.column("text"))
            held, at = known(row, h, vocabulary)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(held, np.arange(part.num_rows + 1)).astype(np.int32)), pa.array(at.astype(np.int32)))
            insult = np.bincount(row[np.isin(h, seeds)], minlength=part.num_rows) > 0
            shape = np.concatenate([insult[:, None], patterns(part.column("text"))], axis=1).astype(np.int64) @ (1 << np.arange(5))
            yield pa.RecordBatch.from_arrays([part.column("y"), lists, pa.array(shape)], ["y", "at", "shape"])

    data = sample.mapInArrow(rows, "y int, at array<int>, shape long").toPandas()
    x = np.zeros((len(data), len(vocabulary)), dtype=np.float32)
    for i, at in enumerate(data["at"]):
        x[i, at] = 1
    lexicons = np.zeros((len(data), LEXICONS), dtype=bool)
    for v in range(LEXICONS):
        lexicons[:, v] = x[:, rank % LEXICONS == v].any(axis=1)
    shape = (data["shape"].to_numpy()[:, None] >> np.arange(5)) & 1 > 0
    votes = np.concatenate([lexicons, shape, ~x.any(axis=1)[:, None]], axis=1)
    posterior = label_model(votes, data.y.to_numpy())
    weights, bias = linear(x, posterior)
    return Model(vocabulary, weights, bias)


def _values(column: pa.Array, model: Model) -> np.ndarray:
    if not model.fitted:
        return np.zeros(len(column))
    row, at = known(*terms(column), model.vocabulary)
    z = np.bincount(row, weights=model.weights[at], minlength=len(column)) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) -> (doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in ts.blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_values(part.column("text"), model))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in ts.blocks(batches, "text"):
            yield part.filter(pa.array(_values(part.column("text"), model) < threshold))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

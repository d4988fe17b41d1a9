"""Preparation of a training corpus in five stages.

Each stage takes what its predecessor kept, as a table read back from Parquet, and returns the
rows that stay, with the columns of ``documents``; the last adds each row's shard and slot.

Defined cases, for every stage: an empty table gives an empty table; nulls may stand in any column
(a null text holds no word, a null source is a source of its own); further columns are kept as they
are, whatever their names; rows that repeat are rows of their own, but for near duplicates, where
one of a group stays; no stage changes a text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.llm import decontaminate, mixing, neardup, sharding, toxicity
from voxelspark.llm.common import remove, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents (score at the threshold or above) go.  Null and empty texts have the score
    of the bias; without labels of both values nothing is rejected."""
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    return toxicity.accepted(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words a shingle, similarity 0.8.  Documents without
    words are no duplicates and stay; rows that share an id and not a text both stay."""
    return neardup.deduplicated(docs, size=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.  Items without letters or digits are in no document."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as they are drawn: not at all, once or twice.  A source without words gives none."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot; columns of the input with these names give way."""
    placed = sharding.shards(docs)
    return placed.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The toxicity model and the edit distances are beyond SQL; the tests hold the stages against
#: brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and removed once
    the next one's are.  The last stage has written its own rows down when it returns."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    out = STAGES[-1][1](spark, docs, sf_dir)
    remove(spark, folder)
    return out

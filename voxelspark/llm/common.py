"""Helpers shared by the corpus operators: reading tables, durable cuts of lineage, row ranks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPACE_WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def space_words(text: Column) -> Column:
    """Number of maximal runs of bytes other than ASCII white space; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; only where none is named
    (tests on one machine) one is made."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints"))
    elif named and not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back, so that a lost executor costs a read
    and not a recomputation.  The shuffle files that made it are removed once it is written."""
    shared_folder(df.sparkSession)
    return _without_shuffles(df, lambda d: d.checkpoint(eager=True))


def _without_shuffles(df: DataFrame, write):
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        return write(df.select("*"))  # a plan of its own, made under the setting
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str, by: str) -> str:
    """Writes ``df`` as a table of the shared folder, a folder for each value of ``by``, for the caller to
    remove; gives its path.  The shuffle files that made it are removed."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _without_shuffles(df, lambda d: d.write.partitionBy(by).parquet(path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store, whichever it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BROADCAST_BYTES = 32 << 20


def fits(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of a table have at most ``most`` bytes, each with 16 beside its columns."""
    size = F.lit(16)
    for name, kind in df.dtypes:
        size = size + (F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + 16 if kind in ("string", "binary") else F.lit(8))
    return (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= most


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Writes ``df`` down, and marks it for broadcast if it fits in so many bytes."""
    df = cut(df)
    return F.broadcast(df) if fits(df, most) else df


def ranked(df: DataFrame, order: list[str], rank: str, group: list[str] = ()) -> DataFrame:
    """Adds ``rank``: the 0-based place of each row in ``order`` (nulls first), within ``group``.

    No task holds a whole group: the rows are range-partitioned and sorted by group and order,
    numbered within their part, and written down once, so that parts stay what they were.  The
    rows of each part and group are counted, and a row's place in its part is added to the count
    of the parts before.  Only the counts (a row for each group that a part holds) meet.
    """
    group = list(group)
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    parts = df.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    parts = cut(parts.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}))
    size = parts.groupBy("__part", *group).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    earlier = W.partitionBy(*[F.col(c) for c in group]).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    start = small(size.select("__part", *group, (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__shift")))
    match = F.col("l.__part") == F.col("r.__part")
    for c in group:
        match = match & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    out = parts.alias("l").join(start.alias("r"), match)
    return out.select(*[F.col(f"l.`{c}`") for c in df.columns], (F.col("l.__at") + F.col("r.__shift")).cast("long").alias(rank))


def numbered(df: DataFrame) -> DataFrame:
    """(row, at): each row as a struct of its columns, and a number of its own that stays the same
    however often this is computed.

    Rows of Parquet files are known by file and place in it; other rows are written to the shared
    folder first.  Only the files are numbered, so no row is moved and equal rows differ."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    place = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("i")]
    try:
        placed = None if "_metadata" in map(str.lower, df.columns) else df.select(whole, *place)
    except AnalysisException:  # no files
        placed = None
    if placed is None:
        folder = f"{shared_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
        df.select(whole).write.parquet(folder)
        placed = df.sparkSession.read.parquet(folder).select("row", *place)
    files = small(ranked(placed.select("path").distinct(), ["path"], "file"))
    return placed.join(files, "path").select("row", (F.shiftleft("file", 40) + F.col("i")).alias("at"))

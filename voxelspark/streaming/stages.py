"""Streaming forms: the state of stages as records arrive, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _late(events: DataFrame, late: str) -> DataFrame:
    """A stream with its watermark; times without a zone are read in the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def windowed(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Events by window and type, with a watermark on ``ts``; works on a batch as well."""
    e = _late(events, late)
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    out = e.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each user, ended by a gap."""
    e = _late(events, late)
    out = e.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def once(records: DataFrame, keys: list[str], late: str = "2 hours") -> DataFrame:
    """Records without repeats of their keys within the watermark."""
    return _late(records, late).dropDuplicatesWithinWatermark(keys) if records.isStreaming else records.dropDuplicates(keys)


def keep_latest(path: str):
    """For ``writeStream.foreachBatch``: appends the last record of each key of a batch, with the
    batch's number, so that a batch written twice does not change what ``latest`` reads."""
    from voxelspark.operators.workflow import latest

    def write(batch: DataFrame, number: int) -> None:
        latest(batch, ["user_id", "event_type"], "ts", "event_id").withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write

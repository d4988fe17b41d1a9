"""Runs of the records of each key, in the order of their times: a run ends where no record follows for a
while.  A stream keeps them as state with timers, keys in buckets; a table gives the same rows by windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_OUT = "key long, start long, end long, records long, changes long, last string"
_RECORD = ["key", "at", "id", "status"]
_RUN = ["key", "start", "end", "records", "changes", "last"]
_PIECE = 100_000


def _packed(rows: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(piece: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(piece).read_all().to_pandas()


def extended(opened: pd.DataFrame | None, records: pd.DataFrame, keep: int) -> pd.DataFrame:
    """The runs (key, start, end, records, changes, last) of records (key, at, id, status), each once, that
    follow the open runs, at most one a key; by key and time."""
    rows = records.sort_values(["key", "at", "id", "status"]).assign(start=lambda r: r["at"], records=1, changes=0)
    if opened is not None:
        first = opened.rename(columns={"end": "at", "last": "status"})
        rows = pd.concat([first, rows[first.columns]]).sort_values("key", kind="stable")
    if rows.empty:
        return pd.DataFrame(columns=_RUN)
    key, at, status = (rows[c].to_numpy() for c in ("key", "at", "status"))
    new = np.r_[True, (key[1:] != key[:-1]) | (np.diff(at) > keep)]
    changes = rows["changes"].to_numpy() + (~new & np.r_[False, status[1:] != status[:-1]])
    begin = np.flatnonzero(new)
    last = np.r_[begin[1:], len(rows)] - 1
    n = np.add.reduceat(rows["records"].to_numpy(), begin)
    return pd.DataFrame({"key": key[begin], "start": rows["start"].to_numpy()[begin], "end": at[last], "records": n, "changes": np.add.reduceat(changes, begin), "last": status[last]})


class Runs(StatefulProcessor):
    """State of a bucket of keys: the records that the watermark has not passed, and the runs they are in,
    as packed tables, so that what a record costs is not a call or a row of the state store.

    Records wait until no earlier one can come, then they are taken in order of (time, id), a repeated
    id once.  A bucket has one timer, for the end of the first run that might be over; it takes all records
    up to the watermark, gives out the runs that are over and sets the next, so keys that fall silent keep
    nothing.  Records at or before the watermark are late and dropped, as are those without a key or time.
    """

    def __init__(self, keep_ms: int):
        self.keep = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "piece binary")
        self.open = handle.getValueState("open", "piece binary")
        self.due = handle.getValueState("due", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed, first = timerValues.getCurrentWatermarkInMs() * 1000, None
        for batch in rows:
            fresh = batch.loc[batch["at"] > passed, _RECORD]
            if len(fresh):
                self.waiting.appendValue((_packed(fresh),))
                least = int(fresh["at"].min())
                first = least if first is None else min(first, least)
        if first is not None:
            ms, due = self._over(first), (self.due.get() if self.due.exists() else None)
            if due is None or ms < due[0]:
                if due:
                    self.handle.deleteTimer(due[0])
                self._set(ms)
        return iter(())

    def _set(self, ms: int) -> None:
        self.handle.registerTimer(ms)
        self.due.update((ms,))

    def _over(self, at):
        """When a run that ends at a microsecond is over, in milliseconds."""
        return -(-at // 1000) + self.keep

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        pieces = [_unpacked(p[0]) for p in self.waiting.get()]
        held = pd.concat(pieces, ignore_index=True).drop_duplicates() if pieces else pd.DataFrame(columns=_RECORD)
        ready = held["at"] <= passed * 1000
        rest = held[~ready]
        found = extended(_unpacked(self.open.get()[0]) if self.open.exists() else None, held[ready], self.keep * 1000)
        # Over are runs before another of the same key, and those that no record can reach any more.
        over = (found["key"] == found["key"].shift(-1)) | (self._over(found["end"]) < passed)
        kept, done = found[~over], found[over]
        if len(pieces):
            self.waiting.clear()
            for i in range(0, len(rest), _PIECE):
                self.waiting.appendValue((_packed(rest[i : i + _PIECE]),))
        self.open.update((_packed(kept),)) if len(kept) else self.open.clear()
        if len(kept) or len(rest):
            first = min(int(times.min()) for times in (kept["end"], rest["at"]) if len(times))
            self._set(max(self._over(first), passed + 1))
        else:
            self.due.clear()
        if len(done):
            yield done

    def close(self) -> None:
        pass


def _records(events: DataFrame) -> DataFrame:
    return events.filter(F.col("key").isNotNull() & F.col("ts").isNotNull()).select("key", "ts", F.col("id").cast("long"), F.coalesce("status", F.lit("")).alias("status"))


def stream_runs(events: DataFrame, keep_minutes: int, late: str = "2 hours", buckets: int = 256) -> DataFrame:
    """A stream (key, id, ts, status) -> (key, start, end, records, changes, last) of each run, once the
    watermark has passed its end by ``keep_minutes``.  Needs the RocksDB state store.  A task holds the
    records of one bucket of keys between two watermarks; the number of buckets stays with the state."""
    seen = _records(events).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    # A record without an id comes first at its time, as in a table.
    seen = seen.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), F.col("key").cast("long").alias("key"), F.unix_micros("ts").alias("at"), F.coalesce("id", F.lit(-(2**63))).alias("id"), "status", "ts")
    found = seen.groupBy("bucket").transformWithStateInPandas(Runs(keep_minutes * 60_000), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
    return found.withColumns({c: F.timestamp_micros(c) for c in ("start", "end")})


def batch_runs(events: DataFrame, keep_minutes: int) -> DataFrame:
    """All runs of a table, those of ``stream_runs`` and those not over at its end."""
    seen = _records(events).withColumn("at", F.unix_micros(F.col("ts").cast("timestamp"))).dropDuplicates(["key", "id", "at", "status"])
    order = W.partitionBy("key").orderBy("at", "id", "status")
    gap = F.col("at") - F.lag("at").over(order)
    marked = seen.withColumn("new", F.when(gap.isNull() | (gap > keep_minutes * 60_000_000), 1).otherwise(0)).withColumn("before", F.lag("status").over(order))
    marked = marked.withColumn("run", F.sum("new").over(order))
    change = F.when((F.col("new") == 0) & (F.col("status") != F.col("before")), 1).otherwise(0)
    runs = marked.groupBy("key", "run").agg(F.min("at").alias("a"), F.max("at").alias("b"), F.count("*").alias("records"), F.sum(change).alias("changes"), F.max(F.struct("at", "id", "status"))["status"].alias("last"))
    return runs.select("key", F.timestamp_micros("a").alias("start"), F.timestamp_micros("b").alias("end"), "records", "changes", "last")

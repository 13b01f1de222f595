"""Stream health as data: lag, message counts, resume points, and a staleness listener."""

from __future__ import annotations

import json
import logging
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from aerometer import constants as K

log = logging.getLogger(__name__)


def lag_report(ends: DataFrame, positions: DataFrame) -> DataFrame:
    """Per topic partition and consumer group: end offset minus position, never below zero. A
    partition nobody reads stays in the report without a group."""
    pos = positions.select("topic", "partition", "group", "current_offset")
    ahead = F.col("end_offset") - F.col("current_offset")
    lag = F.when(ahead < 0, F.lit(0)).otherwise(ahead)
    verdict = (F.when(F.col("current_offset").isNull(), "inactive").when(F.col("lag") == 0, "up to date")
               .otherwise("behind"))
    return (ends.select("topic", "partition", "end_offset").join(pos, ["topic", "partition"], "left")
            .withColumn("lag", lag).withColumn("verdict", verdict))


def group_lag(report: DataFrame) -> DataFrame:
    """Pending records and verdict per consumer group and topic."""
    out = report.where(F.col("group").isNotNull()).groupBy("group", "topic").agg(F.sum("lag").alias("lag"))
    return out.withColumn("verdict", F.when(F.col("lag") == 0, "up to date").otherwise("behind"))


def topic_counts(offsets: DataFrame) -> DataFrame:
    """Messages ever written per topic: the sum of its partitions' end offsets."""
    return offsets.groupBy("topic").agg(F.sum("end_offset").alias("messages"))


def resume_points(batch_log: DataFrame) -> DataFrame:
    """Per store, the last cycle it stored successfully, 0 when none."""
    done = F.max(F.when(F.col("ok"), F.col("cycle")))
    return batch_log.groupBy("store").agg(F.coalesce(done, F.lit(0)).alias("cycle"))


def progress_lag(query: StreamingQuery) -> list[dict]:
    """Offsets of each source of a running query, from its last progress."""
    last = query.lastProgress
    if not last:
        return []
    progress = last if isinstance(last, dict) else json.loads(last.json)
    return [{"source": s["description"], "end_offset": s.get("endOffset"), "latest_offset": s.get("latestOffset"),
             "input_rows": s.get("numInputRows"), "metrics": s.get("metrics")} for s in progress["sources"]]


PROGRESS = ("query string, batch_id bigint, input_rows bigint, start_offset string, end_offset string, state_rows bigint, "
            "state_bytes bigint, watermark string, duration_ms bigint")


class ProgressLog(StreamingQueryListener):
    """Keeps what each finished batch reports: rows read, offsets, state size, watermark, time taken.

    Rows wait in memory until `every` of them are there or the query ends, then go to a table of their own
    at `path`; without a path they stay (`rows`). `name` keeps queries of other names out. Call `close` when
    the listener has been removed.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, name: str | None = None, every: int = 100):
        self.spark, self.path, self.name, self.every = spark, path, name, every
        self.rows: list[tuple] = []
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.name and p.name != self.name:
            return
        self.rows.append((
            p.name, p.batchId, p.numInputRows, *(json.dumps([getattr(s, o) for s in p.sources]) for o in ("startOffset", "endOffset")),
            sum(s.numRowsTotal for s in p.stateOperators), sum(s.memoryUsedBytes for s in p.stateOperators),
            p.eventTime.get("watermark"), p.batchDuration))
        if self.path and len(self.rows) >= self.every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()

    def flush(self) -> None:
        ready, self.rows = self.rows, []
        if ready:
            self.spark.createDataFrame(ready, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def close(self, wait_s: float = 30) -> None:
        """Waits for the query's last report, then writes what is left."""
        self.ended.wait(wait_s)
        if self.path:
            self.flush()


class StalenessListener(StreamingQueryListener):
    """Warns when no batch with rows has finished for a while, at most once per `warn_every_s`."""

    def __init__(self, threshold_s: float = K.STALE_SECONDS, warn_every_s: float = 30,
                 clock: Callable[[], float] = time.time, warn: Callable[[str], None] = log.warning):
        self.threshold_s, self.warn_every_s, self.clock, self.warn = threshold_s, warn_every_s, clock, warn
        self.last_write, self.last_warning = clock(), float("-inf")

    def check(self) -> None:
        now = self.clock()
        quiet = now - self.last_write
        if quiet > self.threshold_s and now - self.last_warning >= self.warn_every_s:
            self.warn(f"stream is running but nothing was written for {quiet:.0f} s (limit {self.threshold_s:.0f} s)")
            self.last_warning = now

    def onQueryStarted(self, event) -> None:
        self.last_write = self.clock()

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows > 0:
            self.last_write = self.clock()
        else:
            self.check()

    def onQueryIdle(self, event) -> None:
        self.check()

    def onQueryTerminated(self, event) -> None:
        pass

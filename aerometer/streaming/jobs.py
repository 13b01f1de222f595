"""Streaming jobs: measurements, per-cycle totals, deduplication and the raw archive.

Each job is its own query with its own checkpoint, so every store resumes from where it got to.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from aerometer import constants as K
from aerometer import schemas as S
from aerometer.functions import scalars as X
from aerometer.operators import flights as fl
from aerometer.operators import points as pt
from aerometer.sinks.store import PointStore
from aerometer.sources import records

Sink = Callable[[DataFrame, int], None]
WIDTH = "spark.sql.shuffle.partitions"


def start(stream: DataFrame, sink: Sink, checkpoint: str, mode: str = "append",
          trigger: str | None = "3 seconds", name: str | None = None, state_tasks: int | None = None) -> StreamingQuery:
    """Run `sink` on every micro-batch; trigger=None works off what is there and stops.

    state_tasks is how many tasks keep the query's state. Each of them stores a version with every batch, however little it
    holds, so a small state is kept by few. It counts when the checkpoint is new, which then keeps it; without it the session's shuffle width does.
    """
    writer = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    if state_tasks is None:
        return writer.start()
    # a query takes a copy of the session's settings when it is started
    conf = stream.sparkSession.conf
    width = conf.get(WIDTH)
    conf.set(WIDTH, state_tasks)
    try:
        return writer.start()
    finally:
        conf.set(WIDTH, width)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write one batch into its own folder, replacing what an earlier attempt left there: a batch
    replayed after a failure is stored once."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")


# ---------------------------------------------------------------------------- measurements

def point_sink(path: str, focus: str = K.FOCUS_COUNTRY, region: Sequence[str] = tuple(K.REGION_COUNTRIES),
               heartbeat: bool = False) -> Sink:
    """The nine measurements of each batch's latest cycle, in one write.

    An empty batch is skipped, or leaves a zero-valued point with heartbeat=True.
    """
    # Rebalancing by measurement keeps files few and splits the large detail table.
    return measured(lambda out, batch_id: write_batch(out.hint("rebalance", "measurement"), path, batch_id, ["measurement"]),
                    focus, region, heartbeat)


def measured(write: Sink, focus: str = K.FOCUS_COUNTRY, region: Sequence[str] = tuple(K.REGION_COUNTRIES),
             heartbeat: bool = False) -> Sink:
    """A sink that hands the points of each batch's latest cycle to write."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = records.parse_records(batch).persist()
        try:
            if not rows.isEmpty():
                write(pt.measurement_points(fl.latest_cycle(rows), None, focus, region), batch_id)
            elif heartbeat:
                write(pt.heartbeat_point(batch, F.current_timestamp()), batch_id)
        finally:
            rows.unpersist()

    return sink


def kept_store(store: PointStore, keep_days: int | None = None, compact_every: int | None = None) -> Sink:
    """Writes points to a store; after every so many batches it folds small folders and drops expired days."""
    def write(points: DataFrame, batch_id: int) -> None:
        store.write(points, batch_id)
        if compact_every and batch_id % compact_every == compact_every - 1:
            store.compact()
            if keep_days is not None:
                store.expire(keep_days)

    return write


def run_measurements(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = "3 seconds",
                     **options) -> StreamingQuery:
    return start(stream, point_sink(path, **options), checkpoint, trigger=trigger)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Stored points, the latest batch winning where an identity was written twice. Filters on
    `measurement` read only that measurement's folders."""
    stored = spark.read.schema(S.POINT + ", batch_id bigint").parquet(path)
    return pt.upsert_view(stored, "batch_id")


# ---------------------------------------------------------------------------- recovery

def run_restarting(make: Callable[[], StreamingQuery], restarts: int = 3, wait_s: float = 0.0) -> int:
    """Runs a query to its end, starting it anew from its checkpoint when it fails; returns how often.

    Only failures in a row count against `restarts`: a run that finished a batch begins the count again.
    After the last one the error is raised.
    """
    failed = total = 0
    while True:
        query = make()
        try:
            query.awaitTermination()
            return total
        except StreamingQueryException:
            failed = 1 if any(p["numInputRows"] for p in query.recentProgress) else failed + 1
            total += 1
            if failed > restarts:
                raise
            time.sleep(wait_s)


# ---------------------------------------------------------------------------- finished snapshots

def finished_snapshots(stream: DataFrame, at: str = "cycle_time", delay: str = "1 hour", by: Sequence[str] = ("cycle",),
                       **rules) -> DataFrame:
    """Summaries of cycles that are over, beside every row that came in, for snapshot_sink.

    `at` is the event time of a cycle, one value for all its rows. A cycle's state is kept until the watermark,
    the greatest `at` seen less the delay, passes it; then it is put out once and its state dropped.
    """
    marked = stream.withWatermark(at, delay)
    totals = fl.batch_summary(marked, by=[at, *by], **rules)
    total, row = F.struct(*totals.columns), F.struct(*marked.columns)
    kinds = {n: StructType([StructField(f.name, f.dataType) for f in df.schema]) for n, df in (("total", totals), ("row", marked))}
    return totals.select(total.cast(kinds["total"]).alias("total"), F.lit(None).cast(kinds["row"]).alias("row")).unionByName(
        marked.select(F.lit(None).cast(kinds["total"]).alias("total"), row.cast(kinds["row"]).alias("row")))


def snapshot_sink(path: str, at: str = "cycle_time", delay_s: float = 3600) -> Sink:
    """Stores finished snapshots below path/finished, rows that came after their cycle was closed below
    path/late, and each batch's greatest `at` below path/seen, from which the watermark follows.

    Rows are late against the watermark of the batch before, as in Spark's own rule, so each row is either
    counted in its snapshot or stored as late, never both. That watermark is known beforehand, so the batch is gone
    through once: what is kept of it goes to path/kept and is sorted into the two tables from there. A task of the
    batch reports on all its state, so every further pass over it would send that to the driver again.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = None
        if batch_id >= 2:
            seen = spark.read.schema("newest timestamp, batch_id bigint").parquet(f"{path}/seen")
            mark = seen.where(F.col("batch_id") <= batch_id - 2).agg(
                (F.max("newest") - F.make_dt_interval(secs=F.lit(float(delay_s)))).alias("mark")).first()["mark"]
        newest = Observation()
        late = F.col(f"row.{at}") <= F.lit(mark).cast("timestamp")
        write_batch(batch.observe(newest, F.max(f"row.{at}").alias("newest"))
                    .where(F.col("total").isNotNull() | F.coalesce(late, F.lit(False))), f"{path}/kept", batch_id)
        kept = spark.read.schema(batch.schema).parquet(f"{path}/kept/batch_id={batch_id}")
        write_batch(kept.where("total IS NOT NULL").select("total.*"), f"{path}/finished", batch_id)
        write_batch(kept.where("row IS NOT NULL").select("row.*"), f"{path}/late", batch_id)
        write_batch(spark.createDataFrame([(newest.get["newest"],)], "newest timestamp"), f"{path}/seen", batch_id)

    return sink


# ---------------------------------------------------------------------------- write sessions

def write_sessions(log: DataFrame, threshold_s: float, time: str = "write_time", key: Sequence[str] = (),
                   delay: str = "0 seconds") -> DataFrame:
    """Stretches of a write log (a stream) without a pause of more than `threshold_s` seconds, per key: writes,
    _first and _last in microseconds. A session is put out, and its state dropped, once the watermark is a
    threshold past its last write."""
    gap = f"{int(threshold_s * 1_000_000)} microseconds"  # a write at the very end of a session still joins it
    micros = F.unix_micros(time)
    return (log.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
            .groupBy(*key, F.session_window(time, gap).alias("_session"))
            .agg(F.count(F.lit(1)).alias("writes"), F.min(micros).alias("_first"), F.max(micros).alias("_last")).drop("_session"))


# ---------------------------------------------------------------------------- stateful totals

def cycle_totals(stream: DataFrame, cycle: str = "cycle", **rules) -> DataFrame:
    """Running summary of every cycle: a cycle that arrives in several batches is totalled over all
    of them. State is one short row per cycle."""
    return fl.batch_summary(stream.where(F.col(cycle).isNotNull()), by=[cycle], **rules)


def run_totals(totals: DataFrame, path: str, checkpoint: str, trigger: str | None = "3 seconds") -> StreamingQuery:
    """Store the changed rows of each batch."""
    return start(totals, lambda b, i: write_batch(b, path, i), checkpoint, "update", trigger)


def read_totals(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest stored row of every key."""
    stored = spark.read.parquet(path)
    rest = [c for c in stored.columns if c not in keys and c != "batch_id"]
    last = F.max_by(F.struct(*rest), "batch_id").alias("r")
    return stored.groupBy(*keys).agg(last).select(*keys, "r.*")


def current_cycle(totals: DataFrame, cycle: str = "cycle") -> DataFrame:
    """The row of the highest cycle seen so far; a late older cycle never replaces it."""
    return fl.latest_cycle(totals, cycle)


def dedup_stream(stream: DataFrame, keys: Sequence[str] = ("icao24", "cycle"), time: str = "ts",
                 delay: str = "10 minutes") -> DataFrame:
    """First row of every key; the state of a key is dropped after `delay`."""
    return (stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
            .dropDuplicatesWithinWatermark(list(keys)))


# ---------------------------------------------------------------------------- archive and routes

def archive_rows(stream: DataFrame, zone: str = "UTC", per_cycle: bool = False) -> DataFrame:
    """Raw text with the ingest date and hour in the given zone, and the cycle when asked."""
    local = F.from_utc_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), zone)
    cols = [F.col("value"), F.date_format(local, "yyyy-MM-dd").alias("date"), F.hour(local).alias("hour")]
    if per_cycle:
        cols.append(X.cycle_from_body("value").alias("cycle"))
    return stream.select(*cols)


def archive(stream: DataFrame, path: str, checkpoint: str, zone: str = "UTC", per_cycle: bool = False,
            trigger: str | None = "3 seconds", compression: str = "gzip") -> StreamingQuery:
    """Continuous raw archive in date/hour folders, each record stored exactly once; its text files are packed
    (compression="none" leaves them plain), which readers undo by the file name."""
    parts = ["date", "hour"] + (["cycle"] if per_cycle else [])
    writer = (archive_rows(stream, zone, per_cycle).writeStream.format("text").partitionBy(*parts)
              .option("checkpointLocation", checkpoint).option("path", path).option("compression", compression).outputMode("append"))
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


# --- fixed values: storage modes of the raw and archive routes ------------------------------
ROUTES = {"raw": (True, "online"), "archive": (False, "offline")}


def route(df: DataFrame, routes: Sequence[str] = ("raw", "archive")) -> DataFrame:
    """One event per flight and route: headers (topic, timestamp, cycle) and the JSON body, which
    says whether the record goes to the point store and which stores are in use."""
    both = len(set(routes)) > 1
    targets = F.array(*[F.struct(F.lit(r).alias("topic"), F.lit(ROUTES[r][0]).alias("influxable"),
                                 F.lit("both" if both else ROUTES[r][1]).alias("storage_mode")) for r in routes])
    sent = df.select("*", F.inline(targets))
    headers = F.create_map(F.lit("topic"), F.col("topic"), F.lit("timestamp"), F.col("processing_time_ms").cast("string"),
                           F.lit("cycle"), X.zero_pad("cycle"))
    body = F.to_json(F.struct(*[F.col(c) for c in df.columns], "influxable", "storage_mode"))
    return sent.select("topic", headers.alias("headers"), body.alias("body"))


def aggregate_event(df: DataFrame, by: Sequence[str] = (), now: Column | None = None) -> DataFrame:
    """The snapshot aggregate as an event of the third topic; now is the clock unless given."""
    now = F.current_timestamp() if now is None else now
    agg = fl.snapshot_aggregate(df, by, now=now)
    headers = F.create_map(F.lit("topic"), F.lit("aggregate"), F.lit("timestamp"), F.unix_millis(now).cast("string"))
    return agg.select(F.lit("aggregate").alias("topic"), headers.alias("headers"),
                      F.to_json(F.struct(*agg.columns)).alias("body"))

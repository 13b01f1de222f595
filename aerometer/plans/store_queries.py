"""The point store, recovery, finished snapshots, write sessions and bounded batches over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometer.operators import lookback as lb
from aerometer.operators import sequences as seq
from aerometer.plans import bindings as b
from aerometer.plans.flight_queries import FL, PIPELINE_SQL
from aerometer.plans.point_queries import CYCLE_TIME_SQL, cycle_time, event_points, n_if
from aerometer.plans.registry import register
from aerometer.plans.stream_queries import finish
from aerometer.session import work_dir
from aerometer.sinks.store import PointStore
from aerometer.streaming import jobs, monitor

# ---- the point store


def event_store(s, d, batches: int, name: str, compact_every: int | None = None, keep_days: int | None = None) -> PointStore:
    """Event points written to a store in so many batches, the later the higher version."""
    store = PointStore(s, work_dir(s, name))
    write = jobs.kept_store(store, keep_days, compact_every)
    points = event_points(s, d)
    for k in range(batches):
        write(points.where(F.col("event_id") % batches == k), k)
    return store


def stored_sql(batches: int) -> str:
    """Event points as the store keeps them: the highest batch wins, of equal ones the greatest value."""
    return f"""WITH points AS (SELECT measurement, "user", time, value FROM (
      SELECT event_type AS measurement, user_id AS "user", date_trunc('hour', ts) AS time, value, row_number() OVER (
        PARTITION BY event_type, user_id, date_trunc('hour', ts) ORDER BY event_id % {batches} DESC, value DESC) AS r FROM events) WHERE r = 1)"""


TOTALS_SQL = "count(*) AS points, round(sum(value), 2) AS total"


def totals(points: DataFrame, *by) -> DataFrame:
    return points.groupBy(*by).agg(F.count(F.lit(1)).alias("points"), F.round(F.sum("value"), 2).alias("total"))


def store_one_day(s, d):
    store = event_store(s, d, 4, "store-day")
    day = store.days()[-3]
    since = dt.datetime.combine(day, dt.time())
    return totals(store.read(since, since + dt.timedelta(days=1)), "measurement", F.to_date("time").alias("date"))


register("store_one_day", store_one_day,
         stored_sql(4) + f""" SELECT measurement, cast(time AS date) AS date, {TOTALS_SQL} FROM points WHERE cast(time AS date) =
           (SELECT DISTINCT cast(ts AS date) AS date FROM events ORDER BY date DESC LIMIT 1 OFFSET 2) GROUP BY 1, 2""")


def store_retention(s, d):
    """A week is kept: older days are dropped as folders while batches come in."""
    store = event_store(s, d, 4, "store-retention", compact_every=2, keep_days=7)
    store.expire(7)
    return totals(store.read(), F.to_date("time").alias("date"))


register("store_retention", store_retention,
         stored_sql(4) + f""" SELECT cast(time AS date) AS date, {TOTALS_SQL} FROM points
           WHERE cast(time AS date) >= cast((SELECT max(time) FROM points) - INTERVAL 7 DAY AS date) GROUP BY 1""")


def store_compaction(s, d):
    """Twelve batches, folded after every third; readers see what they would without folding."""
    store = event_store(s, d, 12, "store-compaction", compact_every=3)
    return totals(store.read(), "measurement")


register("store_compaction", store_compaction, stored_sql(12) + f" SELECT measurement, {TOTALS_SQL} FROM points GROUP BY 1")


def store_look_back(s, d):
    """The last value of each user and type in the last 36 hours, from the days that these touch."""
    store = event_store(s, d, 4, "store-look-back")
    until = store.newest()
    points = store.read(until - dt.timedelta(hours=36), until)
    return lb.last_per(points.select("measurement", lb.tag("user"), "value", "time"), ["measurement", "user"]).select(
        "measurement", "user", "value", F.unix_millis("time").alias("time"))


register("store_look_back", store_look_back,
         stored_sql(4) + """ SELECT measurement, cast("user" AS varchar) AS "user", value, epoch_ms(time) AS time FROM (
           SELECT *, row_number() OVER (PARTITION BY measurement, "user" ORDER BY time DESC) AS r FROM points
           WHERE time >= (SELECT max(time) FROM points) - INTERVAL 36 HOUR AND time < (SELECT max(time) FROM points)) WHERE r = 1""")

# ---- feeds in time order


#: Rows of a feed's file, about, and files of a part at most; keys of a part that a state task holds, about.
FILE_ROWS, MOST_FILES, TASK_KEYS = 250_000, 64, 250_000


class Feed:
    """A folder that files are delivered to in the order of their part, as a stream of its own.

    Every part has the same number of files, and a batch takes so many: batches are as many as parts, whatever the
    input's size. A part with fewer rows than files has fewer, so that a batch may reach into the next part.
    A query that keeps state by `keys` needs `state_tasks` for it: by the different keys of a part, one a core at least, the session's
    shuffle width at most.
    """

    def __init__(self, rows: DataFrame, name: str, part: str = "part", most: int = MOST_FILES, keys: tuple[str, ...] = ()):
        self.spark, self.schema = rows.sparkSession, rows.drop(part).schema
        self.base = work_dir(self.spark, name)
        rows.write.partitionBy(part).parquet(f"{self.base}/staged")
        self.part = part
        held = F.approx_count_distinct(F.xxhash64(*keys)) if keys else F.lit(0)
        sizes, held = self.spark.read.parquet(f"{self.base}/staged").groupBy(part).agg(F.count("*").alias("n"), held.alias("keys")).agg(
            F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("keys"), F.lit(0))).first()
        self.files = max(1, min(most, -(-sizes // FILE_ROWS)))
        self.state_tasks = min(int(self.spark.conf.get(jobs.WIDTH)), max(self.spark.sparkContext.defaultParallelism, -(-held // TASK_KEYS)))
        self.spark.createDataFrame([], self.schema).write.parquet(f"{self.base}/input")

    def deliver(self, parts) -> None:
        staged = self.spark.read.parquet(f"{self.base}/staged")
        for k in parts:
            staged.where(F.col(self.part) == k).drop(self.part).repartition(self.files).write.mode("append").parquet(f"{self.base}/input")

    def stream(self, max_files: int | None = None) -> DataFrame:
        """A part a batch, or so many files."""
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", max_files or self.files)
        return reader.parquet(f"{self.base}/input")


FIRST_YEAR, YEARS = 1995, 7


def yearly(s, d, columns, held_back: str = "false"):
    """Flights by year; those held back come last of all."""
    lines = b.table(s, d, "lineitem")
    part = F.when(F.expr(held_back), YEARS).otherwise(F.greatest(F.lit(0), F.least(F.lit(YEARS - 1), F.year("l_shipdate") - FIRST_YEAR)))
    return lines.select(*[F.expr(b.FLIGHT_COLUMNS[c]).alias(c) for c in columns], part.alias("part"))


# ---- recovery


class FailsOnce:
    """A sink that breaks off each of the given batches at its first attempt, with half of its rows written."""

    def __init__(self, sink: jobs.Sink, batches):
        self.sink, self.left = sink, set(batches)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id in self.left:
            self.left.discard(batch_id)
            self.sink(batch.where(F.xxhash64(*batch.columns) % 2 == 0), batch_id)
            raise RuntimeError(f"batch {batch_id} was broken off")
        self.sink(batch, batch_id)


SUMMARY_COLS = ["on_ground", "altitude_meters", "velocity_kmh", "cycle"]


def no_country(stream: DataFrame) -> DataFrame:
    return stream.withColumns({"origin_country": F.lit(None).cast("string"), "vertical_rate": F.lit(0.0),
                               "altitude_feet": F.lit(None).cast("double")})


def stream_recovery(s, d):
    """Stateful totals in two halves; in each a batch is broken off and the query starts again from its checkpoint."""
    feed = Feed(yearly(s, d, SUMMARY_COLS), "recovery", keys=("cycle",))
    store = lambda batch, i: jobs.write_batch(batch, f"{feed.base}/data", i)
    sink = FailsOnce(store, [1, 4])
    run = lambda: jobs.start(jobs.cycle_totals(no_country(feed.stream())), sink, f"{feed.base}/checkpoint", "update", None,
                             state_tasks=feed.state_tasks)
    for half in (range(3), range(3, YEARS)):
        feed.deliver(half)
        jobs.run_restarting(run)
    return jobs.read_totals(s, f"{feed.base}/data", ["cycle"]).select(
        "cycle", "total_flights", "in_air", "on_ground", "avg_altitude_meters", "avg_velocity_kmh", "max_velocity_kmh")


register("stream_recovery", stream_recovery, FL + f"SELECT cycle, {PIPELINE_SQL} FROM flights GROUP BY cycle")

# ---- finished snapshots

CLOSED_AFTER = 400  # days: no row of a year comes later than the last of that year


def finished_snapshots(s, d):
    """Each cycle once, when it is over, and what came after that beside it. Flights of the seventh line come last."""
    feed = Feed(yearly(s, d, SUMMARY_COLS, "l_linenumber = 7"), "snapshots", keys=("cycle",))

    def run():
        stream = no_country(feed.stream()).withColumn("cycle_time", cycle_time())
        finish(jobs.start(jobs.finished_snapshots(stream, delay=f"{CLOSED_AFTER} days"),
                          jobs.snapshot_sink(f"{feed.base}/out", delay_s=CLOSED_AFTER * b.DAY_S), f"{feed.base}/checkpoint", trigger=None,
                          state_tasks=feed.state_tasks))

    feed.deliver(range(YEARS))
    run()
    feed.deliver([YEARS])
    run()
    done = s.read.parquet(f"{feed.base}/out/finished").select("cycle", F.lit("finished").alias("state"), "total_flights", "in_air", "avg_altitude_meters")
    late = s.read.parquet(f"{feed.base}/out/late").groupBy("cycle").agg(F.count(F.lit(1)).alias("n"))
    return done.unionByName(late.select("cycle", F.lit("late").alias("state"), F.col("n").alias("total_flights"),
                                        F.lit(None).cast("long").alias("in_air"), F.lit(None).cast("double").alias("avg_altitude_meters")))


AIR = b.AIR_SQL
register("finished_snapshots", finished_snapshots,
         FL.rstrip() + f""", timed AS (SELECT *, {CYCLE_TIME_SQL} AS cycle_time, icao24 LIKE '%-7' AS held FROM flights
         ), closed AS (SELECT max(cycle_time) FILTER (WHERE NOT held) - INTERVAL {CLOSED_AFTER} DAY AS first_mark,
           max(cycle_time) - INTERVAL {CLOSED_AFTER} DAY AS last_mark FROM timed)
         SELECT cycle, 'finished' AS state, count(*) AS total_flights, {n_if(AIR)} AS in_air,
           round(coalesce(avg(altitude_meters) FILTER (WHERE {AIR}), 0), 1) AS avg_altitude_meters
         FROM timed, closed WHERE cycle_time <= last_mark AND NOT (held AND cycle_time <= first_mark) GROUP BY cycle
         UNION ALL SELECT cycle, 'late', count(*), NULL, NULL FROM timed, closed WHERE held AND cycle_time <= first_mark GROUP BY cycle""")

# ---- deduplication with state that expires


def stream_dedup(s, d):
    """First flight of each aircraft and cycle; a key's state is dropped after the delay, as time goes on."""
    feed = Feed(yearly(s, d, ["icao24", "cycle", "ts"]), "dedup", keys=("icao24", "cycle"))
    feed.deliver(range(YEARS))
    unique = jobs.dedup_stream(feed.stream(), ["icao24", "cycle"], "ts", f"{CLOSED_AFTER} days").select("icao24", "cycle")
    finish(jobs.start(unique, lambda f, i: jobs.write_batch(f, f"{feed.base}/data", i), f"{feed.base}/checkpoint", trigger=None,
                      state_tasks=feed.state_tasks))
    return s.read.parquet(f"{feed.base}/data").groupBy("cycle").agg(F.count(F.lit(1)).alias("aircraft"))


register("stream_dedup", stream_dedup,
         FL + "SELECT cycle, count(*) AS aircraft FROM (SELECT DISTINCT icao24, cycle FROM flights) GROUP BY cycle")

# ---- write sessions


def stream_gap_sessions(s, d):
    """Pauses of half an hour in the event log as the stream finds them: what lies between its sessions."""
    log = b.table(s, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("write_time"))
    parts = log.withColumn("part", F.floor(F.dayofmonth("write_time") / 10).cast("int"))
    # a write long after all others closes every session
    end = log.agg((F.max("write_time") + F.expr("interval 100 days")).alias("write_time")).select(
        F.lit("~end").alias("event_type"), "write_time", F.lit(4).alias("part"))
    feed = Feed(parts.unionByName(end), "sessions", keys=("event_type", "write_time"))
    feed.deliver(range(5))
    found = jobs.write_sessions(feed.stream(), 1800, key=["event_type"], delay="15 days")
    finish(jobs.start(found, lambda batch, i: jobs.write_batch(batch, f"{feed.base}/data", i), f"{feed.base}/checkpoint", trigger=None,
                      state_tasks=feed.state_tasks))
    sessions = s.read.parquet(f"{feed.base}/data").where("event_type <> '~end'")
    return seq.pauses(sessions, 1800, ["event_type"]).select(
        "event_type", F.unix_micros("previous_write").alias("previous_us"), F.unix_micros("next_write").alias("next_us"),
        F.round("gap_s", 6).alias("gap_s"))


register("stream_gap_sessions", stream_gap_sessions,
         """SELECT event_type, epoch_us(p) AS previous_us, epoch_us(ts) AS next_us,
           round((epoch_us(ts) - epoch_us(p)) / 1000000.0::double, 6) AS gap_s FROM (
           SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS p FROM events)
           WHERE epoch_us(ts) - epoch_us(p) > 1800000000""")

# ---- bounded batches


def bounded_batches(s, d):
    """Line items in files, one file a batch; the progress table against what each batch wrote."""
    lines = b.table(s, d, "lineitem").select("l_orderkey", "l_quantity", F.col("l_linenumber").alias("part"))
    feed = Feed(lines, "bounded", most=4)
    feed.deliver(range(1, 8))
    log = monitor.ProgressLog(s, f"{feed.base}/progress", "bounded", every=3)
    s.streams.addListener(log)
    try:
        sink = lambda batch, i: jobs.write_batch(batch, f"{feed.base}/data", i)
        finish(jobs.start(feed.stream(1).select("*", F.col("_metadata.file_name").alias("file")), sink, f"{feed.base}/checkpoint",
                          trigger=None, name="bounded"))
        log.close()
    finally:
        s.streams.removeListener(log)
    told = s.read.schema(monitor.PROGRESS).parquet(f"{feed.base}/progress").groupBy("batch_id").agg(F.max("input_rows").alias("input_rows"))
    wrote = s.read.parquet(f"{feed.base}/data").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("written"), F.count_distinct("file").alias("files"))
    both = told.where("input_rows > 0").join(wrote, "batch_id", "full")
    return both.agg(F.sum("input_rows").alias("input_rows"), F.sum("written").alias("written"),
                    F.bool_and(F.col("input_rows").eqNullSafe(F.col("written"))).alias("agree"), F.max("files").alias("most_files"))


register("bounded_batches", bounded_batches,
         "SELECT count(*) AS input_rows, count(*) AS written, true AS agree, 1::bigint AS most_files FROM lineitem")

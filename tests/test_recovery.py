"""Restarts, finished snapshots, write sessions and progress tables."""

import datetime as dt
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from aerometer.operators import sequences as seq
from aerometer.streaming import jobs, monitor

T0 = dt.datetime(2024, 1, 1)


class Folder:
    """A folder that grows file by file, each file one micro-batch."""

    def __init__(self, spark, base, schema):
        self.spark, self.base, self.schema, self.n = spark, str(base), schema, 0
        os.makedirs(f"{self.base}/in")

    def add(self, rows):
        self.n += 1
        tmp = f"{self.base}/tmp{self.n}"
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(tmp)
        (part,) = [f for f in os.listdir(tmp) if f.startswith("part-")]
        os.rename(f"{tmp}/{part}", f"{self.base}/in/{self.n:03d}.parquet")
        os.utime(f"{self.base}/in/{self.n:03d}.parquet", (1_700_000_000 + self.n,) * 2)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.base}/in")


def test_a_broken_off_batch_is_made_good(spark, tmp_path):
    feed = Folder(spark, tmp_path, "k int, v int")
    for n in range(4):
        feed.add([(i, n) for i in range(10)])
    left = {1, 3}

    def sink(batch, i):
        if i in left:
            left.discard(i)
            jobs.write_batch(batch.where("k < 5"), f"{feed.base}/out", i)
            raise RuntimeError("broken off")
        jobs.write_batch(batch, f"{feed.base}/out", i)

    runs = jobs.run_restarting(lambda: jobs.start(feed.stream(), sink, f"{feed.base}/cp", trigger=None))
    assert runs == 2
    rows = spark.read.parquet(f"{feed.base}/out").select("k", "v").collect()
    assert sorted(map(tuple, rows)) == sorted((i, n) for n in range(4) for i in range(10))


def test_a_batch_that_never_works_ends_in_its_error(spark, tmp_path):
    feed = Folder(spark, tmp_path, "k int")
    feed.add([(1,)])
    tries = []

    def sink(batch, i):
        tries.append(i)
        raise RuntimeError("never")

    with pytest.raises(StreamingQueryException):
        jobs.run_restarting(lambda: jobs.start(feed.stream(), sink, f"{feed.base}/cp", trigger=None), restarts=2)
    assert tries == [0, 0, 0]


FLIGHT = ("cycle int, cycle_time timestamp, on_ground boolean, altitude_meters double, velocity_kmh double, origin_country string, "
          "vertical_rate double, altitude_feet double")


@pytest.mark.parametrize("seed", [1, 2])
def test_each_row_is_counted_once_or_late(spark, tmp_path, seed):
    """Cycles an hour apart arrive shuffled over batches: each is published once, and no row is lost or counted twice."""
    rnd = random.Random(seed)
    feed = Folder(spark, tmp_path, FLIGHT)
    sent = []
    for n in range(8):
        batch = [max(0, n * 2 + rnd.choice([0, 0, 1, 1, -1, -3, -6])) for _ in range(25)]
        sent += batch
        feed.add([(c, T0 + dt.timedelta(hours=c), c % 2 == 0, 1.0 * c, 10.0, "x", 0.0, 100.0) for c in batch])
    feed.add([(99, T0 + dt.timedelta(hours=99), True, 1.0, 1.0, "x", 0.0, 1.0)])

    def run():
        query = jobs.start(jobs.finished_snapshots(feed.stream(), delay="3 hours"), jobs.snapshot_sink(f"{feed.base}/out", delay_s=3 * 3600),
                           f"{feed.base}/cp", trigger=None)
        query.awaitTermination()
        return query

    state = [p["stateOperators"][0]["numRowsTotal"] for p in run().recentProgress if p["stateOperators"]]
    done = spark.read.parquet(f"{feed.base}/out/finished").collect()
    late = spark.read.parquet(f"{feed.base}/out/late").collect()
    assert len({r.cycle for r in done}) == len(done) and {r.cycle for r in done} == set(sent)
    assert late and sum(r.total_flights for r in done) + len(late) == len(sent)
    for r in done:
        assert r.total_flights + sum(x.cycle == r.cycle for x in late) == sent.count(r.cycle)
        assert r.in_air == (0 if r.cycle % 2 == 0 else r.total_flights)
    assert max(state) > 3 and state[-1] <= 1
    feed.add([(3, T0 + dt.timedelta(hours=3), True, 1.0, 1.0, "x", 0.0, 1.0)])
    run()
    assert spark.read.parquet(f"{feed.base}/out/finished").count() == len(done)
    assert spark.read.parquet(f"{feed.base}/out/late").count() == len(late) + 1


def test_sessions_give_the_gaps_and_drop_their_state(spark, tmp_path):
    rnd = random.Random(3)
    feed = Folder(spark, tmp_path, "store string, write_time timestamp")
    rows, at = [], {"a": 0.0, "b": 0.0}
    for _ in range(120):
        k = rnd.choice("ab")
        at[k] += rnd.choice([1, 5, 60, 60.000001, 59.9, 200, 1000])
        rows.append((k, T0 + dt.timedelta(seconds=at[k])))
    rows.sort(key=lambda r: r[1])
    for n in range(0, 120, 15):
        part = rows[n:n + 15]
        rnd.shuffle(part)
        feed.add(part)
    feed.add([("~end", T0 + dt.timedelta(days=30))])
    found = jobs.write_sessions(feed.stream(), 60, key=["store"], delay="1 hour")
    query = jobs.start(found, lambda b, i: jobs.write_batch(b, f"{feed.base}/out", i), f"{feed.base}/cp", trigger=None)
    query.awaitTermination()
    sessions = spark.read.parquet(f"{feed.base}/out")
    assert sessions.agg(F.sum("writes")).first()[0] == 120
    got = sorted(map(tuple, seq.pauses(sessions, 60, ["store"]).collect()))
    want = sorted(map(tuple, seq.write_gaps(spark.createDataFrame(rows, feed.schema), 60, key=["store"]).collect()))
    assert got == want and len(got) > 20
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(state) > 3 and state[-1] <= 1


def test_gaps_at_chunk_edges(spark):
    times = [0, 60, 120.000001, 180, 300, 300, 359.999999, 420]
    log = spark.createDataFrame([(T0 + dt.timedelta(seconds=t),) for t in times] + [(None,)], "write_time timestamp")
    got = sorted(round(r.gap_s, 6) for r in seq.write_gaps(log, 60).collect())
    assert got == sorted(round(b - a, 6) for a, b in zip(times, times[1:]) if round(b - a, 6) > 60)


def test_progress_table(spark, tmp_path):
    feed = Folder(spark, tmp_path, "k int")
    for n in range(5):
        feed.add([(i,) for i in range(n + 1)])
    log = monitor.ProgressLog(spark, f"{feed.base}/progress", "told", every=2)
    spark.streams.addListener(log)
    try:
        query = jobs.start(feed.stream(), lambda b, i: b.count(), f"{feed.base}/cp", trigger=None, name="told")
        query.awaitTermination()
        log.close()
    finally:
        spark.streams.removeListener(log)
    rows = spark.read.parquet(f"{feed.base}/progress").where("input_rows > 0").orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows) for r in rows] == [(n, n + 1) for n in range(5)]
    assert len({r.end_offset for r in rows}) == 5 and all(r.end_offset and r.query == "told" for r in rows)

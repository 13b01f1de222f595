"""Streaming jobs on files: parity with the batch form, late and split cycles, replay, health."""

import json
import os

import pytest
from pyspark.sql import functions as F

from aerometer import constants as K
from aerometer.operators import flights as fl
from aerometer.operators import points as pt
from aerometer.sources import files, records
from aerometer.streaming import jobs, monitor


def record(cycle, i, country="Egypt", **extra):
    return json.dumps({"icao24": f"a{i}", "callsign": f"ABC{i}", "origin_country": country, "on_ground": i % 4 == 0,
                       "altitude_meters": 100.0 * i, "altitude_feet": 328.0 * i, "velocity_kmh": 90.0 * i, "cycle": cycle,
                       "processing_time_ms": 1_700_000_000_000 + cycle * 1000 + i, **extra})


class Feed:
    """A folder that grows file by file, each file one micro-batch."""

    def __init__(self, spark, path):
        self.spark, self.base, self.n = spark, str(path), 0
        os.makedirs(f"{self.base}/in")

    def add(self, *lines):
        self.n += 1
        with open(f"{self.base}/in/{self.n:03d}.json", "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(f"{self.base}/in/{self.n:03d}.json", (1_700_000_000 + self.n, 1_700_000_000 + self.n))

    def stream(self):
        return records.open_stream(self.spark, "files", f"{self.base}/in", max_per_trigger=1)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def done(query):
    query.awaitTermination()
    assert query.exception() is None


def test_measurements_equal_batch(spark, feed):
    lines = [record(5, i, "Egypt" if i % 3 else "Chad") for i in range(12)] + ["broken", "[1]", record(4, 99)]
    feed.add(*lines)
    done(jobs.run_measurements(feed.stream(), f"{feed.base}/out", f"{feed.base}/cp", None))
    batch = records.parse_records(spark.createDataFrame([(x,) for x in lines], "value string"))
    cols = ["measurement", "series", "field", "value", "value_str", "time"]
    want = sorted(map(tuple, pt.measurement_points(fl.latest_cycle(batch)).select(*cols).collect()), key=repr)
    got = sorted(map(tuple, jobs.read_points(spark, f"{feed.base}/out").select(*cols).collect()), key=repr)
    assert got == want and len(got) > 100


def test_replayed_batch_is_stored_once(spark, feed):
    feed.add(*[record(1, i) for i in range(4)])
    batch = spark.read.text(f"{feed.base}/in")
    sink = jobs.point_sink(f"{feed.base}/out")
    sink(batch, 0)
    first = spark.read.parquet(f"{feed.base}/out").count()
    sink(batch, 0)
    assert spark.read.parquet(f"{feed.base}/out").count() == first


def test_empty_batch(spark, feed):
    empty = spark.createDataFrame([], "value string")
    jobs.point_sink(f"{feed.base}/quiet")(empty, 0)
    assert not os.path.exists(f"{feed.base}/quiet")
    jobs.point_sink(f"{feed.base}/beat", heartbeat=True)(empty, 0)
    rows = jobs.read_points(spark, f"{feed.base}/beat").collect()
    assert len(rows) == 6 and {r["value"] for r in rows} == {0.0} and {r["measurement"] for r in rows} == {K.M_SUMMARY}


def test_split_and_late_cycles(spark, feed):
    """A cycle cut over two batches is totalled over both; a late older one does not become current."""
    for lines in ([record(2, i) for i in range(3)], [record(2, i) for i in range(3, 5)] + [record(3, 0)], [record(1, 9)]):
        feed.add(*lines)
    totals = jobs.cycle_totals(records.parse_records(feed.stream()))
    done(jobs.run_totals(totals, f"{feed.base}/out", f"{feed.base}/cp", None))
    seen = jobs.read_totals(spark, f"{feed.base}/out", ["cycle"])
    assert {r["cycle"]: r["total_flights"] for r in seen.collect()} == {1: 1, 2: 5, 3: 1}
    assert [r["cycle"] for r in jobs.current_cycle(seen).collect()] == [3]


def test_restart_continues_from_the_checkpoint(spark, feed):
    feed.add(record(1, 0), record(1, 1))
    run = lambda: done(jobs.run_totals(jobs.cycle_totals(records.parse_records(feed.stream())),
                                       f"{feed.base}/out", f"{feed.base}/cp", None))
    run()
    feed.add(record(1, 2))
    run()
    assert jobs.read_totals(spark, f"{feed.base}/out", ["cycle"]).first()["total_flights"] == 3


def test_dedup(spark, feed):
    feed.add(record(1, 0), record(1, 0), record(1, 1))
    feed.add(record(1, 1), record(2, 1))
    stream = records.parse_records(feed.stream()).withColumn("ts", F.timestamp_millis("processing_time_ms"))
    unique = jobs.dedup_stream(stream).select("icao24", "cycle")
    done(jobs.start(unique, lambda b, i: jobs.write_batch(b, f"{feed.base}/out", i), f"{feed.base}/cp", trigger=None))
    rows = spark.read.parquet(f"{feed.base}/out").select("icao24", "cycle").collect()
    assert sorted(map(tuple, rows)) == [("a0", 1), ("a1", 1), ("a1", 2)]


def test_archive_round_trip(spark, feed):
    feed.add(*[record(c, i) for c in (1, 2) for i in range(3)])
    done(jobs.archive(feed.stream(), f"{feed.base}/arch", f"{feed.base}/cp", "Africa/Cairo", True, trigger=None))
    back = files.read_archive(spark, f"{feed.base}/arch")
    assert back.groupBy("cycle").count().orderBy("cycle").collect() == [(1, 3), (2, 3)]
    plan = back.where(F.col("date") == "1999-01-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_routes(spark):
    df = records.parse_records(spark.createDataFrame([(record(7, 1),)], "value string"))
    both = {r["topic"]: (json.loads(r["body"]), r["headers"]) for r in jobs.route(df).collect()}
    assert both["raw"][0]["influxable"] is True and both["archive"][0]["influxable"] is False
    assert both["raw"][0]["storage_mode"] == "both" and both["raw"][1]["cycle"] == "000007"
    alone = jobs.route(df, ["archive"]).first()
    assert json.loads(alone["body"])["storage_mode"] == "offline"
    assert json.loads(jobs.aggregate_event(df).first()["body"])["total_flights"] == 1


def test_progress_lag(spark, feed):
    feed.add(record(1, 0))
    query = jobs.run_measurements(feed.stream(), f"{feed.base}/out", f"{feed.base}/cp", None)
    done(query)
    assert monitor.progress_lag(query)[0]["input_rows"] is not None


def test_staleness_listener():
    now, warnings = [0.0], []
    listener = monitor.StalenessListener(60, 30, lambda: now[0], warnings.append)
    for t, expected in ((50, 0), (61, 1), (80, 1), (92, 2)):
        now[0] = t
        listener.onQueryIdle(None)
        assert len(warnings) == expected
    listener.onQueryStarted(None)
    now[0] = 140
    listener.onQueryIdle(None)
    assert len(warnings) == 2

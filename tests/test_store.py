"""The point store: replays, pruned reads, retention and folding."""

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aerometer import schemas as S
from aerometer.sinks.store import FOLDED, PointStore
from aerometer.streaming import jobs

DAY = dt.datetime(2024, 3, 1)


def points(spark, rows):
    """rows of (day number, hour, series, value)."""
    full = [("m" if v is None or v >= 0 else "n", s, {"s": s}, "value", v, None, None if day is None else DAY + dt.timedelta(days=day, hours=h))
            for day, h, s, v in rows]
    return spark.createDataFrame(full, S.POINT)


def held(store, **bounds):
    return sorted(((r.series, str(r.time), r.value) for r in store.read(**bounds).collect()), key=repr)


def parquet_files(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*.parquet"))


@pytest.fixture
def store(spark, tmp_path):
    return PointStore(spark, str(tmp_path / "store"))


def test_a_replayed_batch_is_stored_once(spark, store):
    batch = points(spark, [(0, 1, "a", 1.0), (1, 1, "a", 2.0), (None, 0, "z", 5.0)])
    store.write(batch, 0)
    before = held(store)
    store.write(batch, 0)
    assert held(store) == before and len(before) == 3
    assert store.stored().count() == 3


def test_the_latest_batch_wins(spark, store):
    store.write(points(spark, [(0, 1, "a", 1.0), (0, 1, "b", 1.0)]), 0)
    store.write(points(spark, [(0, 1, "a", 0.5)]), 1)
    assert [v for _, _, v in held(store)] == [0.5, 1.0]


def test_a_day_is_read_from_its_own_files(spark, store):
    for k in range(4):
        store.write(points(spark, [(day, k, "a", float(day)) for day in range(10)]), k)
    since = DAY + dt.timedelta(days=4)
    rows = store.stored(since=since, until=since + dt.timedelta(hours=12), measurements=["m"])
    opened = {r[0] for r in rows.select("_metadata.file_path").distinct().collect()}
    assert len(opened) == 4 and all("date=2024-03-05" in f for f in opened)
    plan = rows._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    partition, pushed = (next(x for x in plan.splitlines() if x.startswith(name)) for name in ("PartitionFilters:", "PushedFilters:"))
    assert "date" in partition and ">= 2024-03-05" in partition
    assert "GreaterThanOrEqual(time" in pushed and "EqualTo(measurement,m)" in pushed
    assert held(store, since=since, until=since + dt.timedelta(hours=2)) == [("a", "2024-03-05 00:00:00", 4.0), ("a", "2024-03-05 01:00:00", 4.0)]
    scans = store.read(since=since)._jdf.queryExecution().executedPlan().toString()
    assert scans.count("FileScan") == 1


def test_days_follow_utc_in_any_zone(spark, store):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        rows = spark.sql("SELECT 'm' AS measurement, 's' AS series, map('a', 'b') AS tags, 'value' AS field, 1D AS value, "
                         "cast(null AS string) AS value_str, timestamp'2024-03-01 23:30:00 UTC' AS time")
        store.write(rows, 0)
        assert store.days() == [dt.date(2024, 3, 1)]
        at = dt.datetime(2024, 3, 1, 23, 30, tzinfo=dt.timezone.utc)
        assert store.newest() == at and store.read(since=at, until=at + dt.timedelta(seconds=1)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_expired_days_are_gone_from_storage(spark, store):
    store.write(points(spark, [(day, 5, "a", float(day)) for day in range(20)] + [(None, 0, "z", 5.0)]), 0)
    gone = store.expire(7)
    assert gone == [(DAY + dt.timedelta(days=k)).date() for k in range(12)]
    assert {f.split("/")[0] for f in parquet_files(store.path)} == {
        *(f"date={(DAY + dt.timedelta(days=k)).date()}" for k in range(12, 20)), "date=__HIVE_DEFAULT_PARTITION__"}
    assert len(held(store)) == 9 and store.expire(7) == []
    store.write(points(spark, [(2, 5, "late", 1.0)]), 1)
    assert store.expire(7) == [(DAY + dt.timedelta(days=2)).date()]


def test_folding_keeps_rows_and_bounds_files(spark, store):
    write, most, want = jobs.kept_store(store, compact_every=5), 0, {}
    for k in range(50):
        rows = [(k % 3, 0, f"s{k % 7}", float(k)), (0, 1, "hot", float(k % 4)), (1, 2, f"n{k}", float(k))]
        write(points(spark, rows).coalesce(1), k)
        want |= {(s, str(DAY + dt.timedelta(days=d, hours=h)), ): v for d, h, s, v in rows}
        most = max(most, len(parquet_files(store.path)))
        if k % 10 == 9:
            assert held(store) == sorted(((*key, v) for key, v in want.items()), key=repr)
    # per day: at most one folded folder of this round, one of the last, and the fresh ones since both
    assert most <= 3 * (2 + 10) and store.stored().count() < 4 * len(want)
    store.compact(at_least=1)
    store.compact(at_least=1)
    assert all(len(t[FOLDED]) == 1 and not t[0] for t in store.folders().values())
    assert held(store) == sorted(((*key, v) for key, v in want.items()), key=repr)


def test_an_older_batch_never_wins_after_folding(spark, store):
    for k, v in enumerate([3.0, 2.0, 1.0]):
        store.write(points(spark, [(0, 1, "a", v)]), k)
    store.compact()
    store.write(points(spark, [(0, 1, "a", 9.0)]), 1)  # a replay of a folded batch
    assert [v for *_, v in held(store)] == [1.0]
    store.compact()
    store.write(points(spark, [(0, 1, "a", 0.0)]), 3)
    assert [v for *_, v in held(store)] == [0.0]


def test_an_open_reader_survives_one_round_of_folding(spark, store):
    for k in range(3):
        store.write(points(spark, [(0, k, "a", float(k))]), k)
    reader = store.read()
    store.compact()
    assert reader.count() == 3


def test_an_empty_store(spark, store):
    assert store.days() == [] and store.newest() is None and store.expire(1) == [] and store.compact() == []
    assert store.read().count() == 0
    store.write(points(spark, []), 0)
    assert store.read().count() == 0 and not os.path.exists(f"{store.path}/date=2024-03-01")


def test_points_with_further_columns(spark, store):
    store.write(points(spark, [(0, 1, "a", 1.0)]).withColumns({"date": F.lit("x"), "version": F.lit(9), "batch": F.lit(1)}), 0)
    assert held(store) == [("a", "2024-03-01 01:00:00", 1.0)]

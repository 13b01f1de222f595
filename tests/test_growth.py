"""What may not grow with the input: disk beyond it, batches, and the memory of one task."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerometer.llm import toxicity as tx
from aerometer.operators import models as md
from aerometer.plans import point_queries as pq
from aerometer.plans import store_queries as sq
from aerometer.plans import stream_queries as st
from aerometer.session import work_dir
from aerometer.sources import files
from aerometer.streaming import jobs

SMOKE = "/root/testdata/sf0.001"


def data_files(base):
    return [os.path.join(r, f) for r, _, fs in os.walk(base) for f in fs if f.startswith("part-")]


def test_records_and_their_archive_are_packed(spark):
    base = st.json_folder(spark, SMOKE, "packed")
    stream = st.records.open_stream(spark, "files", f"{base}/input", max_per_trigger=None)
    st.finish(jobs.archive(stream, f"{base}/archive", f"{base}/checkpoint", trigger=None))
    plain = sum(r.n for r in spark.read.text(f"{base}/input").select(F.sum(F.length("value") + 1).alias("n")).collect())
    for folder in ("input", "archive"):
        found = data_files(f"{base}/{folder}")
        assert found and all(f.endswith(".gz") for f in found)
        assert sum(map(os.path.getsize, found)) < plain / 3
    kept = files.read_archive(spark, f"{base}/archive").count()
    assert kept == spark.read.parquet(f"{SMOKE}/lineitem.parquet").count()


def test_a_feed_has_as_many_batches_as_parts(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        feed = sq.Feed(sq.yearly(spark, SMOKE, ["icao24", "cycle"]), "parts")
        feed.deliver(range(sq.YEARS))
        seen = []
        sq.finish(jobs.start(feed.stream(), lambda batch, i: seen.append(i), f"{feed.base}/checkpoint", trigger=None))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(seen) <= sq.YEARS + 1
    assert spark.read.parquet(f"{feed.base}/input").count() == spark.read.parquet(f"{SMOKE}/lineitem.parquet").count()


def test_a_state_is_parsed_once(spark):
    out = st.state_vectors(spark, SMOKE)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2  # the snapshot and its states


def test_points_are_not_sorted_for_their_greatest_text(spark):
    """Only the texts that differ reach the step that sorts."""
    for query in (pq._profile, st.state_vectors):
        plan = query(spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
        tops = [line for line in plan.splitlines() if "Aggregate" in line]
        assert "max(" in tops[0] and "max(" not in tops[1] and ("value_str" in tops[1] or "squawk" in tops[1])


def test_points_of_the_batch_report_are_dealt_over_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(pq, "GROUPS_A_TASK", 1000)
    flights = spark.read.parquet(f"{SMOKE}/lineitem.parquet").count()
    out = pq._batch_points(spark, SMOKE)
    assert out.rdd.getNumPartitions() >= flights * 7 // 1000 > 4


def test_points_of_the_batch_report_are_not_shuffled(spark, monkeypatch):
    """Flights are, before each becomes seven points with a text of its own."""
    monkeypatch.setattr(pq, "GROUPS_A_TASK", 1000)
    out = pq._batch_points(spark, SMOKE)
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(plan) if "REPARTITION_BY_NUM" in line]
    assert len(dealt) == 1 and "icao24" in plan[dealt[0]] and "measurement" not in plan[dealt[0]]
    assert any("Generate inline" in line for line in plan[:dealt[0]]) and not any("Generate" in line for line in plan[dealt[0]:])
    assert sum("Exchange hashpartitioning(measurement" in line for line in plan) <= 1  # of a few bands
    assert out.count() > 5 * spark.read.parquet(f"{SMOKE}/lineitem.parquet").count()


def test_terms_are_handed_on_in_parts():
    texts = [" ".join(f"word{i}x{k}" for k in range(2000)) for i in range(60)]
    rows = pd.DataFrame({"text": texts, "toxic": 1, "fold": 0})
    parts = list(tx.term_rows(iter([rows])))
    most = max(len(tx.terms(t)) for t in texts)
    assert len(parts) > 1 and max(map(len, parts)) <= tx.HELD_TERMS + most
    assert sum(map(len, parts)) == sum(len(tx.terms(t)) for t in texts)


def test_a_batch_of_snapshots_is_gone_through_once(spark, tmp_path):
    """Every pass over a batch's tasks sends the reports of all its state to the driver."""
    batch = spark.range(0, 200, 1, 23).selectExpr(
        "if(id < 3, named_struct('cycle', id), null) AS total",
        "if(id < 3, null, named_struct('cycle', id, 'cycle_time', timestamp_seconds(id * 3600))) AS row")
    sink, tracker = jobs.snapshot_sink(str(tmp_path), delay_s=3600), spark.sparkContext.statusTracker()
    for batch_id in range(3):
        spark.sparkContext.setJobGroup(f"snapshots-{batch_id}", "")
        try:
            sink(batch, batch_id)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(f"snapshots-{batch_id}") for s in tracker.getJobInfo(j).stageIds]
        assert [s.numTasks for s in stages if s].count(23) == 1
    assert spark.read.parquet(f"{tmp_path}/finished").count() == 9
    # the mark is an hour before the newest row, and there is one from the third batch on
    assert [r.batch_id for r in spark.read.parquet(f"{tmp_path}/late").collect()] == [2] * 196
    assert spark.read.parquet(f"{tmp_path}/seen").distinct().count() == 3


def test_weighted_rows_stay_where_they_are(spark):
    """Rows dealt by class would be read by as many tasks as there are classes."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(0, 2300, 1, 23).select("id", (F.col("id") % 5 == 0).cast("double").alias("label"))
        got = md.class_weights(rows, "label")
        assert got.rdd.getNumPartitions() == 23
        assert {(r.label, round(r.weight, 6)) for r in got.distinct().collect()} == {(0.0, 0.625), (1.0, 2.5)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_state_has_as_many_tasks_as_its_keys_need(spark):
    rows = spark.range(3000).selectExpr("id", "id % 3 AS few", "cast(id % 2 AS int) AS part")
    width, each = spark.conf.get(jobs.WIDTH), sq.TASK_KEYS
    spark.conf.set(jobs.WIDTH, 50)
    try:
        sq.TASK_KEYS = 100
        assert sq.Feed(rows, "few", keys=("few",)).state_tasks == spark.sparkContext.defaultParallelism
        assert 12 <= sq.Feed(rows, "many", keys=("id", "few")).state_tasks <= 18
        sq.TASK_KEYS = 1
        assert sq.Feed(rows, "most", keys=("id",)).state_tasks == 50
    finally:
        sq.TASK_KEYS = each
        spark.conf.set(jobs.WIDTH, width)


@pytest.mark.parametrize("query, column", [("stream_recovery", "total_flights"), ("stream_dedup", "aircraft")])
def test_a_stream_does_not_keep_its_state_by_the_shuffle_width(spark, monkeypatch, query, column):
    bases = []
    monkeypatch.setattr(sq, "work_dir", lambda s, name: bases.append(work_dir(s, name)) or bases[-1])
    width = spark.conf.get(jobs.WIDTH)
    spark.conf.set(jobs.WIDTH, 9)
    try:
        total = getattr(sq, query)(spark, SMOKE).agg(F.sum(column)).first()[0]
        assert spark.conf.get(jobs.WIDTH) == "9"
    finally:
        spark.conf.set(jobs.WIDTH, width)
    folder = f"{bases[0]}/checkpoint/state/0".removeprefix("file://")
    assert len([f for f in os.listdir(folder) if f.isdigit()]) == spark.sparkContext.defaultParallelism
    assert 0 < total <= spark.read.parquet(f"{SMOKE}/lineitem.parquet").count()

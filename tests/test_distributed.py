"""The split forms of quantiles, sequences and gaps against brute force on skewed data."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerometer.operators import evaluate as ev
from aerometer.operators import features as ft
from aerometer.operators import quantiles as qn
from aerometer.operators import sequences as seq
from aerometer.operators import splits as sp


@pytest.fixture(scope="module")
def skewed():
    """One key holds a third of the rows; values are repeated, negative, tiny, huge or missing."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        v = rng.choice([rng.gauss(0, 1), round(rng.expovariate(0.01), 2), 5.0, -1e9 * rng.random(), 1e-12, 0.0])
        rows.append((key, None if rng.random() < 0.02 else v, i))
    return rows


def test_quantiles(spark, skewed):
    df = spark.createDataFrame(skewed, "k string, v double, i int")
    probs = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r["k"]: [r[n] for n in probs] for r in qn.exact_quantiles(df, ["k"], "v", probs).collect()}
    pdf = pd.DataFrame(skewed, columns=["k", "v", "i"]).dropna()
    for k, part in pdf.groupby("k"):
        np.testing.assert_allclose(got[k], part.v.quantile(list(probs.values())), rtol=1e-12, atol=1e-15)
    whole = qn.exact_quantiles(df, [], "v", probs).first()
    np.testing.assert_allclose([whole[n] for n in probs], pdf.v.quantile(list(probs.values())), rtol=1e-12, atol=1e-15)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert qn.exact_quantiles(df, ["k"], "v", {"m": 0.5}).count() == 0
    assert qn.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] is None
    assert qn.fit_quantiles(df, ["v"], {"m": 0.5}) == {"v": {"m": None}}


def test_extreme_values_keep_their_order(spark):
    vals = [float("-inf"), -1e308, -1e-9, 0.0, 1e-300, 2e-7, 1e308, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    buckets = [r[0] for r in df.select(qn.value_bucket(F.col("v"))).collect()]
    assert buckets == sorted(buckets)


def test_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    assert {r["k"]: r["m"] for r in qn.exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()} == {None: 2.0, "a": 5.0}


@pytest.mark.parametrize("depth", [8, 37])
def test_blocks_equal_plain_windows(spark, skewed, depth):
    df = spark.createDataFrame(skewed, "k string, v double, i int")
    chunk = F.floor(F.col("i") / 100)
    cols, wins = {"v": [1, 4]}, {"mean": [3, 8], "std": [5]}

    def run(**blocks):
        x = seq.add_lags(df, ["k"], "i", cols, **blocks)
        x = seq.add_lead(x, ["k"], "i", "v", 2, "ahead", **blocks)
        x = seq.add_rolling(x, ["k"], "i", "v", wins, **blocks)
        return x.orderBy("i").toPandas()

    plain, blocked = run(), run(block_rows=depth, chunk=chunk)
    pd.testing.assert_frame_equal(plain, blocked[plain.columns], rtol=1e-9)


def test_calendar_lags_skip_gaps(spark):
    days = [1, 2, 4, 9]
    df = spark.createDataFrame([("a", dt.date(2024, 1, d), float(d)) for d in days], "meter_id string, date date, v double")
    got = seq.add_lags(df, ["meter_id"], "date", {"v": [1, 7]}, calendar=True).orderBy("date").collect()
    assert [(r["lag_v_1"], r["lag_v_7"]) for r in got] == [(None, None), (1.0, None), (None, None), (None, 2.0)]
    rows = seq.add_lags(df, ["meter_id"], "date", {"v": [1]}).orderBy("date").collect()
    assert [r["lag_v_1"] for r in rows] == [None, 1.0, 2.0, 4.0]


def test_gaps(spark):
    start = dt.datetime(2024, 1, 1)
    offsets = [0, 10, 70, 131, 4000, 4060, 4121, 90000]
    log = spark.createDataFrame([("s", start + dt.timedelta(seconds=o)) for o in offsets], "store string, write_time timestamp")
    got = sorted(r["gap_s"] for r in seq.write_gaps(log, 60, key=["store"]).collect())
    assert got == [61.0, 61.0, 3869.0, 85879.0]
    assert seq.write_gaps(log, 60).count() == 4


def test_auc(spark, skewed):
    rng = random.Random(3)
    rows = [(round(rng.random(), 3), rng.random() < 0.3) for _ in range(2000)]
    df = spark.createDataFrame(rows, "s double, y boolean")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert ev.auc(df, "s", F.col("y")).first()["auc"] == pytest.approx(want, abs=1e-12)


def test_auc_of_crowded_scores(spark):
    """All scores within a millionth of one half: the ranges still hold about as many each, and the area is exact."""
    rng = random.Random(4)
    rows = [(0.5 + round(rng.uniform(-1, 1), 4) * 1e-6, rng.random() < 0.4) for _ in range(3000)] + [(None, True), (float("nan"), True), (0.5, None)]
    df = spark.createDataFrame(rows, "s double, y boolean")
    pos, neg = [s for s, y in rows[:-3] if y], [s for s, y in rows[:-3] if not y] + [0.5]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert ev.auc(df, "s", F.col("y"), depth=100).first()["auc"] == pytest.approx(want, abs=1e-12)
    scores = df.where("s IS NOT NULL AND NOT isnan(s)").select("s").distinct()
    sizes = [r["count"] for r in ev.score_ranges(scores, "s", "range", 100).groupBy("range").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 200
    assert ev.auc(df.where("y"), "s", F.col("y")).first()["auc"] is None
    assert ev.auc(df.limit(0), "s", F.col("y")).first()["auc"] is None


def test_cleaning(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, None), (100.0, None)], "a double, b double")
    filled = [r["a"] for r in ft.impute_median(df, ["a", "b"]).collect()]
    assert filled == [1.0, 2.0, 2.0, 100.0]
    cut = [r["a"] for r in ft.winsorize(df, ["a", "b"], 0.0, 0.5).collect()]
    assert cut == [1.0, 2.0, None, 2.0]


def test_splits_partition_all_rows(spark):
    df = spark.range(5000).withColumn("date", F.expr("date_add(date'2024-01-01', cast(id % 100 as int))"))
    shares = {r["split"]: r["rows"] for r in sp.split_summary(sp.hash_split(df, "id")).collect()}
    assert sum(shares.values()) == 5000 and abs(shares["train"] - 3500) < 200
    by_date = sp.temporal_split(df, "date").groupBy("split").agg(F.min("date").alias("a"), F.max("date").alias("z"))
    ends = {r["split"]: (r["a"], r["z"]) for r in by_date.collect()}
    assert ends["train"][1] < ends["val"][0] and ends["val"][1] < ends["test"][0]


def test_constant_and_short_series_are_not_anomalous(spark):
    from aerometer.operators import anomaly as an

    rows = [("flat", dt.date(2024, 1, d), 5.0) for d in range(1, 9)] + [("single", dt.date(2024, 1, 1), 7.0)]
    rows += [("spiky", dt.date(2024, 1, d), 1.0 + d / 100) for d in range(1, 25)] + [("spiky", dt.date(2024, 1, 25), 99.0)]
    df = spark.createDataFrame(rows, "meter_id string, date date, energy_sum double")
    flagged = an.anomaly_flags(df)
    assert {r["meter_id"] for r in flagged.where("anomaly").collect()} == {"spiky"}
    s = an.anomaly_summary(flagged).first()
    assert s["z_anomalies"] + s["iqr_anomalies"] - s["overlap"] == s["combined"] == 1

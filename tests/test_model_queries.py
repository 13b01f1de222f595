"""The registered model queries, whose fits no SQL states, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from aerometer.plans import bindings as b

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
BOARDS = {"social_group_models": 5, "tariff_models": 3, "next_day_models": 2, "peak_models": 3, "peak_models_same_day": 1,
          "weather_models": 3}


def rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", sorted(BOARDS))
def test_boards(spark, name):
    got = rows(spark, name)
    assert len({r["model"] for r in got}) == BOARDS[name]
    assert sum(bool(r["best"]) for r in got) == 1
    for r in got:
        for c, v in r.asDict().items():
            if c.split("_")[-1] in ("accuracy", "f1", "auc", "precision", "recall"):
                assert 0 <= v <= 1, (c, v)
            if c.split("_")[-1] in ("rmse", "mae"):
                assert v >= 0, (c, v)


def test_same_day_columns_give_the_peak_away(spark):
    past = {r["model"]: r for r in rows(spark, "peak_models")}
    same = {r["model"]: r for r in rows(spark, "peak_models_same_day")}
    assert same["LinearRegression"]["r2"] > past["LinearRegression"]["r2"]


def test_importance(spark):
    got = rows(spark, "social_group_importance")
    assert [r["rank"] for r in got] == sorted(r["rank"] for r in got) and all(r["importance"] >= 0 for r in got)


def test_clusters_hold_every_row(spark):
    meters = b.meter_daily(spark, SF_DIR).select("meter_id").distinct().count()
    days = b.meter_daily(spark, SF_DIR).count()
    assert sum(r["count"] for r in rows(spark, "household_clusters")) == meters
    assert sum(r["count"] for r in rows(spark, "load_shape_clusters")) == days
    sweep = rows(spark, "kmeans_sweep")
    assert [r["k"] for r in sweep if r["best"]] and all(-1 <= r["silhouette"] <= 1 for r in sweep)
    assert len(rows(spark, "pca_projection")) == meters
    assert len(rows(spark, "cluster_features")) == 9


def test_grouped_forecast(spark):
    assert {r["scale"] for r in rows(spark, "grouped_forecast")} == {"original", "log"}

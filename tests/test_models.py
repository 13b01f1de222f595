"""Model pipelines on a small separable table: mechanics and invariants, not quality."""

import pytest
from pyspark.sql import functions as F

from aerometer.operators import evaluate as ev
from aerometer.operators import models as md
from aerometer.operators import splits as sp


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 3).cast("double").alias("label"),
        ((F.col("id") % 3) * 10 + (F.col("id") % 7) / 10).alias("x"), (F.col("id") % 5).cast("double").alias("y"))
    vec, _ = md.assemble(sp.hash_split(df, "id"), ["x", "y"])
    return vec.cache()


def test_classifiers(spark, rows):
    names = ["DecisionTree", "LogisticRegression", "LinearSVM_OvR", "MultilayerPerceptron", "RandomForest"]
    fitted = md.fit_classifiers(rows.where("split = 'train'"), names, 2, 3)
    board = md.classification_board(rows, fitted).collect()
    assert {r["model"] for r in board} == set(names) and sum(r["best"] for r in board) == 1
    assert board[0]["best"] and board[0]["val_f1"] > 0.95
    ranked = md.importances(spark, fitted["RandomForest"][0], ["x", "y"]).collect()
    assert ranked[0]["feature"] == "x" and ranked[0]["rank"] == 1
    assert md.importances(spark, fitted["LogisticRegression"][0], ["x", "y"]).first()["feature"] == "x"


def test_binary_board_ranks_by_auc(rows):
    two = rows.where("label < 2")
    fitted = md.fit_classifiers(md.class_weights(two.where("split = 'train'"), "label"), ["DecisionTree"], 2, 2, "weight")
    row = md.classification_board(two, fitted, binary=True).first()
    assert row["auc"] == 1.0 and row["best"]


def test_regressors(spark, rows):
    data = rows.drop("label").withColumn("label", F.col("x") * 2 + F.col("y"))
    board = md.regression_board(data, md.fit_regressors(data.where("split = 'train'"), ["LinearRegression", "GBT"])).collect()
    assert board[0]["model"] == "LinearRegression" and board[0]["r2"] > 0.99


def test_class_weights_balance(rows):
    weighted = md.class_weights(rows.where("id < 100"), "label").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert len({round(r["w"], 6) for r in weighted}) == 1


def test_confusion_invariants(spark):
    pred = spark.createDataFrame([("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")], "label string, prediction string")
    counts = {r["label"]: (r["a"], r["b"], r["c"]) for r in ev.confusion(pred, ["a", "b", "c"]).collect()}
    assert counts == {"a": (5, 2, 0), "b": (0, 3, 0), "c": (1, 0, 0)}
    shares = ev.confusion(pred, ["a", "b", "c"], normalise=True).collect()
    assert all(abs(r["a"] + r["b"] + r["c"] - 1) < 1e-12 for r in shares)
    per = {r["class"]: r for r in ev.class_metrics(pred).collect()}
    assert per["a"]["specificity"] == 0.75 and per["c"]["recall"] == 0.0
    whole = ev.weighted_metrics(pred).first()
    assert whole["f1"] == pytest.approx(sum(p["f1"] * p["total"] for p in per.values()) / 11)


def test_clusters(spark, rows):
    board, model = md.kmeans_sweep(rows, [2, 3])
    best = [r["k"] for r in board.collect() if r["best"]]
    assert len(best) == 1 and len(model.clusterCenters()) == best[0]
    sizes = ev.cluster_sizes(model.transform(rows)).collect()
    assert sum(r["count"] for r in sizes) == 400 and abs(sum(r["share"] for r in sizes) - 100) < 0.1
    assert ev.variance_ratio(model.transform(rows), ["x", "y"]).first()["feature"] == "x"
    assert md.pca2(rows).select("pc1", "pc2").dropna().count() == 400


def test_peak_label(spark):
    morning = [1.0 if 14 <= i < 18 else 0.1 for i in range(48)]
    evening = [1.0 if 34 <= i < 40 else 0.1 for i in range(48)]
    rows = md.peak_label(spark, [morning, evening]).collect()
    assert [r["pattern"][:7] for r in rows] == ["Morning", "Evening"] and rows[1]["peak_slot"] == 34


def test_grouped_forecaster(spark, rows):
    data = rows.select("x", "y", F.concat(F.lit("c"), F.col("label").cast("int").cast("string")).alias("cat"),
                       (F.col("x") + 1).alias("target"))
    model = md.grouped_forecaster(data, {"one": ["x"], "two": ["y"]}, ["cat"])
    scored = md.grouped_predict(model, data)
    assert ev.regression_metrics(scored, "target").first()["r2"] > 0.9
    assert ev.regression_metrics(scored, "target", log=True).first()["r2"] > 0.9

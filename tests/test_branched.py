"""The branched forecaster: gradients, averaging, early stopping, unseen categories; measures of the model boards."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerometer.operators import branched as bn
from aerometer.operators import evaluate as ev
from aerometer.operators import models as md

BRANCHES = {"past": ["a", "b"], "weather": ["c"]}


def made(spark, n=3000, seed=2):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        a, b, c, k = rnd.gauss(0, 1), rnd.gauss(5, 2), rnd.uniform(-2, 2), rnd.choice("xyz")
        level = {"x": abs(a), "y": c * c / 2, "z": max(0.0, b - 5)}[k]
        rows.append((i, a, b, c, k, "s", math.expm1(1 + level + rnd.gauss(0, 0.05)), "train" if i % 10 < 7 else "val" if i % 10 < 8 else "test"))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, kind string, grp string, target double, split string")


def test_gradient_against_differences():
    net = bn.Network((3, 2), (4, 2), hidden=5, embedded=2, top=6)
    rng = np.random.default_rng(1)
    w = net.start(3) + rng.normal(0, 0.05, net.size)
    xs, cs, y = [rng.normal(size=(9, 3)), rng.normal(size=(9, 2))], [rng.integers(0, 4, 9), rng.integers(0, 2, 9)], rng.normal(size=9)
    _, got = net.gradient(w, xs, cs, y)
    for i in range(net.size):
        up, down = w.copy(), w.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        want = (net.gradient(up, xs, cs, y)[0] - net.gradient(down, xs, cs, y)[0]) / 2e-6
        assert got[i] == pytest.approx(want, abs=1e-5), net.parts
    assert sum(int(np.prod(s)) for _, s, _ in net.parts) == net.size


def test_it_beats_a_linear_model(spark):
    df = made(spark).repartition(4, "id")
    train, val, test = (df.where(F.col("split") == s) for s in ("train", "val", "test"))
    model = bn.fit(train, val, BRANCHES, ["kind", "grp"])
    own = ev.regression_metrics(model.predict(test), "target", log=True).first()
    vectors, prepare = md.assemble(train.withColumn("label", F.log1p("target")), ["a", "b", "c"])
    line = md.regressor("LinearRegression").fit(vectors)
    other = ev.regression_metrics(line.transform(prepare.transform(test)).withColumn("prediction", F.expm1("prediction")), "target", log=True).first()
    assert own["rmse"] < 0.5 * other["rmse"] and own["r2"] > 0.7
    assert min(model.history) < 0.7 * model.history[0]
    assert model.predict(test).columns == [*test.columns, "prediction"] and model.predict(test).count() == test.count()


def test_a_category_not_seen_and_early_stopping(spark):
    df = made(spark, 400)
    train, val = df.where("split = 'train' AND kind <> 'z'"), df.where("split = 'val'")
    model = bn.fit(train, val, BRANCHES, ["kind", "grp"], rounds=30, patience=1)
    assert model.net.categories == (3, 2) and len(model.history) < 30
    got = model.predict(df.where("kind = 'z'")).select("prediction").collect()
    assert got and all(math.isfinite(r.prediction) for r in got)
    error = lambda w: bn.BranchedModel(model.prepare, model.net, w, model.centre, model.spread, []).predict(val).agg(
        F.sqrt(F.avg((F.log1p("prediction") - F.log1p("target")) ** 2))).first()[0]
    assert error(model.weights) == pytest.approx(min(model.history))


def test_rows_of_both_parts_are_prepared_once(spark):
    """Rounds read what was prepared; preparing validation rows anew in each round grows with rows and rounds."""
    df, kept = made(spark, 400), {}

    def written(rows, name):
        kept[name] = rows.persist()
        return kept[name]

    train, val = df.where("split = 'train'"), df.where("split = 'val'")
    model = bn.fit(train, val, BRANCHES, ["kind", "grp"], rounds=2, written=written)
    for name in ("branched-train", "branched-val"):
        assert {"x0", "x1", "c0", "c1"} <= set(kept[name].columns) and "a" not in kept[name].columns
    one = [r.prediction for r in model.predict(val).orderBy("id").collect()]
    other = [r.prediction for r in model.scored(kept["branched-val"]).collect()]
    assert sorted(one) == pytest.approx(sorted(other))


def test_a_local_pass_against_a_plain_loop():
    net, rng = bn.Network((2,), (3,), hidden=4, embedded=2, top=5), np.random.default_rng(5)
    x, c, y, n = rng.normal(size=(150, 2)), rng.integers(0, 3, 150), rng.normal(size=150), 150
    rows = pd.DataFrame({"x0": list(x), "c0": c, "y": y})
    own, m, v = net.start(), np.zeros(net.size), np.zeros(net.size)
    dealt = np.random.default_rng(md.SEED)
    order = np.concatenate([dealt.permutation(n) for _ in range(bn.PASSES)])
    for step, at in enumerate(range(0, len(order), bn.BATCH), 1):
        some = order[at:at + bn.BATCH]
        _, g = net.gradient(own, [x[some]], [c[some]], y[some])
        m, v = bn.BETA1 * m + (1 - bn.BETA1) * g, bn.BETA2 * v + (1 - bn.BETA2) * g * g
        own = own - 0.01 * (m / (1 - bn.BETA1 ** step)) / (np.sqrt(v / (1 - bn.BETA2 ** step)) + 1e-8)
    got = next(bn.local_pass(net, net.start(), 0.01)(iter([rows])))["part"].to_numpy()
    assert got[0] == n and got[1:] / n == pytest.approx(own)


def test_without_validation_rows(spark):
    df = made(spark, 100)
    model = bn.fit(df, df.limit(0), BRANCHES, ["kind", "grp"], rounds=2)
    assert model.history == [] and model.predict(df).count() == 100


def test_measures_of_the_boards_by_hand(spark):
    """Leaderboard numbers against plain sums over the collected predictions."""
    df = made(spark, 900).withColumn("label", (F.col("target") > 6).cast("double"))
    vectors, _ = md.assemble(df, ["a", "b", "c"], fit_on=df.where("split = 'train'"))
    models = md.fit_classifiers(vectors.where("split = 'train'"), ["RandomForest", "LogisticRegression"], 3, 2)
    for row in md.classification_board(vectors, models, binary=True).collect():
        pred = md.positive_score(models[row.model][0].transform(vectors.where("split = 'test'"))).select("label", "prediction", "score").collect()
        hits = sum(r.label == r.prediction for r in pred)
        assert row.accuracy == pytest.approx(hits / len(pred))
        pos, neg = [r.score for r in pred if r.label == 1], [r.score for r in pred if r.label == 0]
        assert row.auc == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg)))
        f1 = 0.0
        for c in (0.0, 1.0):
            tp = sum(r.label == c == r.prediction for r in pred)
            p, r_ = (tp / (sum(getattr(x, k) == c for x in pred) or 1) for k in ("prediction", "label"))
            f1 += (2 * p * r_ / (p + r_) if p + r_ else 0.0) * sum(x.label == c for x in pred) / len(pred)
        assert row.test_f1 == pytest.approx(f1)
    numbers = vectors.withColumn("label", F.log1p("target"))
    fits = md.fit_regressors(numbers.where("split = 'train'"), ["LinearRegression", "GBT"])
    for row in md.regression_board(numbers, fits).collect():
        pred = fits[row.model][0].transform(numbers.where("split = 'test'")).select("label", "prediction").collect()
        off = [r.label - r.prediction for r in pred]
        mean = sum(r.label for r in pred) / len(pred)
        assert row.test_rmse == pytest.approx(math.sqrt(sum(e * e for e in off) / len(off)))
        assert row.mae == pytest.approx(sum(map(abs, off)) / len(off))
        assert row.r2 == pytest.approx(1 - sum(e * e for e in off) / sum((r.label - mean) ** 2 for r in pred))

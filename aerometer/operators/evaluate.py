"""Evaluation tables as plain aggregations over prediction rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerometer.functions import scalars as X
from aerometer.session import staged


# ---------------------------------------------------------------------------- classes

def pair_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, predicted, n): one row per pair seen; everything about classes follows from it."""
    return (pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def confusion(pred: DataFrame, classes: Sequence, label: str = "label", prediction: str = "prediction",
              normalise: bool = False) -> DataFrame:
    """One row per label, one column per predicted class: counts, or shares of the row."""
    wide = pair_counts(pred, label, prediction).groupBy("label").agg(
        *[F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("n"))), F.lit(0)).alias(str(c)) for c in classes],
        F.sum("n").alias("_total"))
    if normalise:
        wide = wide.withColumns({str(c): F.try_divide(F.col(f"`{c}`"), F.col("_total")) for c in classes})
    return wide.drop("_total")


def class_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: total, correct, precision, recall, f1, specificity (0 where undefined)."""
    pairs = pair_counts(pred, label, prediction)
    all_rows = pairs.agg(F.sum("n").alias("t")).scalar()
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("total"), F.lit(0).cast("bigint").alias("hits"),
                 F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("correct")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("total"),
                 F.col("n").alias("hits"), F.lit(0).cast("bigint").alias("correct")))))
    per = sides.groupBy("class").agg(F.sum("total").alias("total"), F.sum("correct").alias("correct"),
                                     F.sum("hits").alias("_hits")).withColumn("_all", all_rows)
    negatives = F.col("_all") - F.col("total")
    true_neg = negatives - (F.col("_hits") - F.col("correct"))
    per = per.withColumns({
        "precision": X.or_zero(F.try_divide("correct", "_hits")),
        "recall": X.or_zero(F.try_divide("correct", "total")),
        "specificity": X.or_zero(F.try_divide(true_neg, negatives))})
    both = F.col("precision") + F.col("recall")
    return per.withColumn("f1", X.or_zero(F.try_divide(2 * F.col("precision") * F.col("recall"), both))).drop("_hits", "_all")


def weighted_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy and the class metrics weighted by class size."""
    per = class_metrics(pred, label, prediction)

    def mean(c: str) -> Column:
        return X.or_zero(F.try_divide(F.sum(F.col(c) * F.col("total")), F.sum("total")))

    return per.agg(F.sum("total").alias("rows"), X.or_zero(F.try_divide(F.sum("correct"), F.sum("total"))).alias("accuracy"),
                   mean("f1").alias("f1"), mean("precision").alias("precision"), mean("recall").alias("recall"))


def score_ranges(scores: DataFrame, score: str, out: str, depth: int, most: int = 4096) -> DataFrame:
    """scores with the number of the equal-depth range each lies in (out): about `depth` rows a range, however
    crowded the scores are; ranges grow beyond `depth` only past `most` of them."""
    n = scores.count()
    parts = max(1, min(most, -(-n // depth)))
    if parts == 1:
        return scores.withColumn(out, F.lit(0.0))
    at = scores.agg(F.percentile_approx(score, [k / parts for k in range(1, parts)], 20 * parts).alias("q")).first()["q"]
    cuts = [float("-inf"), *sorted(set(at)), float("inf")]
    return Bucketizer(splits=cuts, inputCol=score, outputCol=out).transform(scores)


def auc(pred: DataFrame, score: Column | str, positive: Column, depth: int = 50_000) -> DataFrame:
    """One row: the exact area under the ROC curve, ties counted half; null and NaN scores are left out.

    Scores are counted once each and laid into equal-depth ranges; prefix sums run over the ranges and,
    separately, inside each range, so no task sees all scores, however close together they are.
    """
    s = X.as_col(score).cast("double")
    per_score = (pred.select((s + F.lit(0.0)).alias("_s"), F.coalesce(positive, F.lit(False)).alias("_p"))
                 .where(F.col("_s").isNotNull() & ~F.isnan("_s"))
                 .groupBy("_s").agg(F.count_if("_p").alias("pos"), F.count_if(~F.col("_p")).alias("neg")))
    per_score = score_ranges(staged(per_score, "auc-scores"), "_s", "_b", depth)
    across = Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = (per_score.groupBy("_b").agg(F.sum("neg").alias("_n"))
              .select(F.col("_b").alias("_bb"), F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_below")))
    inside = Window.partitionBy("_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (per_score.withColumn("_inside", F.coalesce(F.sum("neg").over(inside), F.lit(0)))
              .join(before, F.col("_b") == F.col("_bb")))
    won = F.sum(F.col("pos") * (F.col("_below") + F.col("_inside") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(won, pairs).alias("auc"))


# ---------------------------------------------------------------------------- numbers

def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction", log: bool = False,
                       by: Sequence[str] = ()) -> DataFrame:
    """rmse, mae, r2 and mape (in percent, zero labels left out); log=True measures log1p values."""
    y, p = F.col(label), F.col(prediction)
    if log:
        y, p = F.log1p(y), F.log1p(F.when(p < 0, F.lit(0.0)).otherwise(p))
    used = pred.select(*by, y.cast("double").alias("y"), p.cast("double").alias("p")).where(
        F.col("y").isNotNull() & F.col("p").isNotNull())
    err = F.col("y") - F.col("p")
    out = used.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("_mse"), F.var_pop("y").alias("_var"),
        (F.avg(F.abs(F.try_divide(err, F.col("y")))) * 100).alias("mape"))
    return out.select(*by, "rows", "rmse", "mae",
                      (1 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"), "mape")


def residual_summary(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    res = F.col(label) - F.col(prediction)
    return pred.agg(F.avg(res).alias("mean"), F.stddev_samp(res).alias("std"), F.min(res).alias("min"),
                    F.max(res).alias("max"))


def leaderboard(rows: DataFrame, by: str, larger_is_better: bool, model: str = "model") -> DataFrame:
    """Marks the model that wins on the validation measure `by` and sorts by it; ties by name.
    `rows` holds one row per model."""
    key = F.col(by) if larger_is_better else -F.col(by)
    best = rows.where(key.isNotNull()).agg(F.min_by(model, F.struct(-key, model)).alias("b")).scalar()
    return rows.withColumn("best", F.col(model) == best).orderBy(key.desc_nulls_last(), model)


def results_summary(parts: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One (metric, value) row per task: each part is a title and a one-value table."""
    rows = [df.select(F.lit(title).alias("metric"), F.col(df.columns[0]).cast("string").alias("value"))
            for title, df in parts]
    return reduce(DataFrame.unionAll, rows)


# ---------------------------------------------------------------------------- clusters

def cluster_sizes(pred: DataFrame, cluster: str = "cluster") -> DataFrame:
    counts = pred.groupBy(cluster).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("t")).scalar()
    return counts.withColumn("share", X.pct(F.col("count"), total))


def variance_ratio(pred: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Per feature, the share of its variance that lies between the clusters, largest first."""
    long = pred.select(F.col(cluster).alias("_c"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])))
    per = (long.where(F.col("v").isNotNull()).groupBy("feature", "_c")
           .agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("var")))
    n = F.sum("n")
    grand = F.sum(F.col("n") * F.col("m")) / n
    between = F.sum(F.col("n") * F.col("m") * F.col("m")) / n - grand * grand
    within = F.sum(F.col("n") * F.col("var")) / n
    return (per.groupBy("feature").agg(between.alias("_b"), within.alias("_w"))
            .select("feature", X.or_zero(F.try_divide(F.col("_b"), F.col("_b") + F.col("_w"))).alias("ratio"))
            .orderBy(F.desc("ratio"), "feature"))

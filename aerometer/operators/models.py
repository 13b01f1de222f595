"""Model pipelines on the feature table: classification, regression, clustering, projection."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (PCA, OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer.operators import evaluate as ev
from aerometer.operators.quantiles import fit_quantiles
from aerometer.session import work_dir

SEED = 42

# --- fixed values: feature names of the tasks -----------------------------------------------
PAST = ["rolling_mean_7d", "rolling_mean_14d", "rolling_mean_30d", "rolling_std_7d", "lag_sum_1", "lag_sum_2",
        "lag_sum_7", "lag_mean_1", "lag_mean_2", "lag_mean_3", "lag_mean_7", "lag_max_1", "lag_max_7"]
SAME_DAY = ["energy_sum", "energy_mean", "energy_median", "energy_max", "energy_min", "energy_std", "cv",
            "peak_to_mean_ratio", "load_factor", "hh_range", "hh_stddev"]
HALF_HOUR = ["hh_morning_peak_avg", "hh_daytime_avg", "hh_peak_hour_avg", "hh_offpeak_night_avg", "hh_night_ratio",
             "hh_peak_to_offpeak_ratio"]
WEATHER = ["temperatureMax", "temperatureMin", "temperatureHigh", "temperatureLow", "humidity", "cloudCover",
           "pressure", "windSpeed", "windBearing", "dewPoint"]
CALENDAR = ["month", "quarter", "season", "day_of_week", "is_weekend", "is_holiday"]
CYCLIC = ["sin_month", "cos_month", "sin_day", "cos_day"]
WEATHER_DERIVED = ["temp_avg", "temp_range", "temp2", "temp_pressure", "temp_wind", "heat_index",
                   "temp_x_cos_month", "temp2_x_cos_month", "is_heating_season"]
SOCIAL_FEATURES = [*PAST, *SAME_DAY, *HALF_HOUR, *WEATHER, *CALENDAR, "tariff_index"]
TARIFF_FEATURES = [*PAST, *SAME_DAY, *HALF_HOUR, *WEATHER, *CALENDAR]
FORECAST_FEATURES = [*PAST, *SAME_DAY, *WEATHER, *CALENDAR]
WEATHER_FEATURES = [*WEATHER, *WEATHER_DERIVED, *CALENDAR, *CYCLIC]


def peak_features(same_day: bool = False) -> list[str]:
    """Past-only inputs by default: the other columns of the same day give the day's peak away."""
    extra = [c for c in SAME_DAY if c != "energy_max"] if same_day else []
    return [*PAST, *extra, *WEATHER, *CALENDAR]


# ---------------------------------------------------------------------------- preparation

def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: training passes over the table many times,
    and a lost executor must not set off the whole feature plan again."""
    spark: SparkSession = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def index_labels(df: DataFrame, col: str, out: str = "label") -> tuple[DataFrame, list[str]]:
    """Adds the alphabetical index of a text label, leaving rows without one out; returns the labels
    in index order."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error").fit(df.where(F.col(col).isNotNull()))
    return model.transform(df.where(F.col(col).isNotNull())), list(model.labels)


def assembler(cols: Sequence[str], scale: bool = True, out: str = "features") -> list:
    """Pipeline stages from columns to one vector, centred and scaled when asked."""
    if not scale:
        return [VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error")]
    return [VectorAssembler(inputCols=list(cols), outputCol=f"{out}_raw", handleInvalid="error"),
            StandardScaler(inputCol=f"{out}_raw", outputCol=out, withMean=True, withStd=True)]


def assemble(df: DataFrame, cols: Sequence[str], scale: bool = True,
             fit_on: DataFrame | None = None) -> tuple[DataFrame, PipelineModel]:
    """`fit_on` gives the rows that means and scales are taken from, all rows unless set."""
    model = Pipeline(stages=assembler(cols, scale)).fit(df if fit_on is None else fit_on)
    return model.transform(df), model


def clean_features(df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99,
                   fit_on: DataFrame | None = None) -> DataFrame:
    """Extremes are pulled in to the lo/hi quantiles and missing values take the median, all taken
    from the observed values of `fit_on` (all rows unless set) in one pass; NaN counts as missing and
    a column without any value becomes 0."""
    def numbers(rows: DataFrame) -> DataFrame:
        return rows.withColumns({c: F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols})

    doubles = numbers(df)
    cuts = fit_quantiles(numbers(df if fit_on is None else fit_on), cols, {"lo": lo, "median": 0.5, "hi": hi})

    def clean(c: str) -> Column:
        q, v = cuts[c], F.col(c)
        if q["median"] is None:
            return F.lit(0.0)
        return (F.when(v.isNull(), F.lit(q["median"])).when(v < q["lo"], F.lit(q["lo"]))
                .when(v > q["hi"], F.lit(q["hi"])).otherwise(v))

    return doubles.withColumns({c: clean(c) for c in cols})


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Weights that balance the classes: all rows / (classes x rows of the class).

    The counts, one row a class, go to the rows: joined by a shuffle, rows of a class would end in one task,
    and every model would be fitted by as many tasks as there are classes.
    """
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    total = n.agg(F.sum("_n").alias("t"), F.count(F.lit(1)).alias("k")).select(F.struct("t", "k")).scalar()
    return (df.join(F.broadcast(n.withColumnRenamed(label, "_l")), F.col(label) == F.col("_l"))
            .withColumn(out, total["t"] / (total["k"] * F.col("_n"))).drop("_l", "_n"))


# ---------------------------------------------------------------------------- estimators

def classifier(name: str, n_features: int, n_classes: int, weight_col: str | None = None):
    common = {"labelCol": "label", "featuresCol": "features"}
    if name == "MultilayerPerceptron":
        return MultilayerPerceptronClassifier(layers=[n_features, 16, n_classes], maxIter=40, seed=SEED, **common)
    if weight_col:
        common["weightCol"] = weight_col
    if name == "LogisticRegression":
        return LogisticRegression(maxIter=30, regParam=0.01, **common)
    if name == "RandomForest":
        return RandomForestClassifier(numTrees=20, maxDepth=6, seed=SEED, **common)
    if name == "DecisionTree":
        return DecisionTreeClassifier(maxDepth=6, seed=SEED, **common)
    if name == "LinearSVM_OvR":
        return OneVsRest(classifier=LinearSVC(maxIter=20, regParam=0.01), **common)
    raise ValueError(f"unknown classifier {name!r}")


def regressor(name: str):
    common = {"labelCol": "label", "featuresCol": "features"}
    if name == "LinearRegression":
        return LinearRegression(regParam=0.001, **common)
    if name == "RandomForest":
        return RandomForestRegressor(numTrees=20, maxDepth=6, seed=SEED, **common)
    if name == "GBT":
        return GBTRegressor(maxIter=20, maxDepth=4, seed=SEED, **common)
    raise ValueError(f"unknown regressor {name!r}")


def timed_fit(estimator, train: DataFrame):
    start = time.monotonic()
    model = estimator.fit(train)
    return model, time.monotonic() - start


def fit_classifiers(train: DataFrame, names: Sequence[str], n_features: int, n_classes: int,
                    weight_col: str | None = None) -> dict[str, tuple]:
    """{name: (model, seconds)}."""
    return {n: timed_fit(classifier(n, n_features, n_classes, weight_col), train) for n in names}


def fit_regressors(train: DataFrame, names: Sequence[str]) -> dict[str, tuple]:
    return {n: timed_fit(regressor(n), train) for n in names}


def positive_score(pred: DataFrame, positive: int = 1) -> DataFrame:
    return pred.withColumn("score", F.get(vector_to_array("probability"), F.lit(positive)))


# ---------------------------------------------------------------------------- tasks

def classification_board(data: DataFrame, models: dict[str, tuple], binary: bool = False) -> DataFrame:
    """Leaderboard of fitted classifiers on rows with a `split` column; binary ones rank by AUC.
    Every model is scored once per split and only its measures reach the driver."""
    rows = []
    for name, (model, seconds) in models.items():
        val = model.transform(data.where(F.col("split") == "val"))
        test = model.transform(data.where(F.col("split") == "test"))
        on_val, on_test = ev.weighted_metrics(val).first(), ev.weighted_metrics(test).first()
        row = {"model": name, "val_f1": on_val["f1"], "test_f1": on_test["f1"], "accuracy": on_test["accuracy"],
               "precision": on_test["precision"], "recall": on_test["recall"], "time_s": round(seconds, 1)}
        if binary:
            for key, part in (("val_auc", val), ("auc", test)):
                row[key] = ev.auc(positive_score(part), "score", F.col("label") == 1).first()["auc"]
        rows.append(row)
    board = data.sparkSession.createDataFrame(rows, _board_schema(rows[0]))
    return ev.leaderboard(board, "val_auc" if binary else "val_f1", True)


def regression_board(data: DataFrame, models: dict[str, tuple], log: bool = False) -> DataFrame:
    """Leaderboard of fitted regressors: validation RMSE decides, or validation R2 with log=True."""
    rows = []
    for name, (model, seconds) in models.items():
        val = ev.regression_metrics(model.transform(data.where(F.col("split") == "val"))).first()
        test = ev.regression_metrics(model.transform(data.where(F.col("split") == "test"))).first()
        rows.append({"model": name, "val_rmse": val["rmse"], "val_r2": val["r2"], "test_rmse": test["rmse"],
                     "mae": test["mae"], "r2": test["r2"], "time_s": round(seconds, 1)})
    board = data.sparkSession.createDataFrame(rows, _board_schema(rows[0]))
    return ev.leaderboard(board, "val_r2", True) if log else ev.leaderboard(board, "val_rmse", False)


def _board_schema(row: dict) -> str:
    return ", ".join(f"`{c}` {'string' if c == 'model' else 'double'}" for c in row)


def importances(spark: SparkSession, model, cols: Sequence[str]) -> DataFrame:
    """Ranked importance of every feature: tree importances, or the size of the coefficients
    (inputs are scaled, so a coefficient is already per standard deviation)."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()).mean(axis=0)
    else:
        values = abs(model.coefficients.toArray())
    ranked = sorted(zip(cols, values), key=lambda cv: (-cv[1], cv[0]))
    return spark.createDataFrame([(i + 1, c, float(v)) for i, (c, v) in enumerate(ranked)],
                                 "rank int, feature string, importance double")


# ---------------------------------------------------------------------------- clusters

def kmeans_sweep(df: DataFrame, ks: Sequence[int] = range(2, 7)) -> tuple[DataFrame, object]:
    """(k, silhouette, best) per k, and the model with the best silhouette."""
    scored = []
    for k in ks:
        model = KMeans(k=k, seed=SEED, featuresCol="features", predictionCol="cluster", maxIter=20).fit(df)
        score = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(model.transform(df))
        scored.append((k, score, model))
    best = max(scored, key=lambda t: (t[1], -t[0]))
    rows = [(k, float(s), k == best[0]) for k, s, _ in scored]
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double, best boolean"), best[2]


# --- fixed values: peak windows of a load shape (half-hour slots) and their labels ----------
PEAK_WINDOWS = {"Morning Peak (07:00 - 09:00)": range(14, 18), "Evening Peak (17:00 - 20:00)": range(34, 40)}


def peak_label(spark: SparkSession, centres: Sequence[Sequence[float]]) -> DataFrame:
    """(cluster, peak_slot, pattern) per cluster centre: the window with the higher mean names it."""
    rows = []
    for i, centre in enumerate(centres):
        means = {name: sum(centre[s] for s in slots) / len(slots) for name, slots in PEAK_WINDOWS.items()}
        rows.append((i, max(range(len(centre)), key=lambda s: centre[s]), max(means, key=means.get)))
    return spark.createDataFrame(rows, "cluster int, peak_slot int, pattern string")


def pca2(df: DataFrame) -> DataFrame:
    """The first two principal components of `features` as pc1 and pc2."""
    model = PCA(k=2, inputCol="features", outputCol="_pc").fit(df)
    xy = vector_to_array("_pc")
    return model.transform(df).withColumns({"pc1": F.get(xy, F.lit(0)), "pc2": F.get(xy, F.lit(1))}).drop("_pc")


# ---------------------------------------------------------------------------- grouped forecaster

def grouped_forecaster(train: DataFrame, branches: dict[str, list[str]], cats: Sequence[str],
                       target: str = "target") -> PipelineModel:
    """Boosted trees on the log target over separately scaled feature groups and one-hot
    categories. The result predicts `log_prediction` and, on the original scale, `prediction`."""
    stages = []
    for name, cols in branches.items():
        stages += assembler(cols, True, f"branch_{name}")
    stages.append(StringIndexer(inputCols=list(cats), outputCols=[f"{c}_i" for c in cats],
                                stringOrderType="alphabetAsc", handleInvalid="keep"))
    stages.append(OneHotEncoder(inputCols=[f"{c}_i" for c in cats], outputCols=[f"{c}_v" for c in cats]))
    stages.append(VectorAssembler(inputCols=[f"branch_{b}" for b in branches] + [f"{c}_v" for c in cats],
                                  outputCol="features"))
    stages.append(GBTRegressor(labelCol="log_target", featuresCol="features", predictionCol="log_prediction",
                               maxIter=20, maxDepth=4, seed=SEED))
    return Pipeline(stages=stages).fit(train.withColumn("log_target", F.log1p(target)))


def grouped_predict(model: PipelineModel, df: DataFrame, target: str = "target") -> DataFrame:
    return (model.transform(df.withColumn("log_target", F.log1p(target)))
            .withColumn("prediction", F.expm1("log_prediction")))

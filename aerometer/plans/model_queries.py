"""Splits, evaluation tables and model tasks over the meter feature table."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometer.operators import anomaly as an
from aerometer.operators import branched as bn
from aerometer.operators import evaluate as ev
from aerometer.operators import features as ft
from aerometer.operators import models as md
from aerometer.operators import sequences as seq
from aerometer.operators import splits as sp
from aerometer.plans import bindings as b
from aerometer.plans import meter_queries as mq
from aerometer.plans.meter_queries import HH_SQL, M, MA, day_text, flagged, rounded
from aerometer.plans.registry import SQL, register

KEY = ["meter_id", "date"]
MH = b.with_ctes(b.METER_SQL, b.HOUSEHOLD_SQL)
HASH_SQL = "(('0x' || substr(md5(meter_id || '|' || cast(date AS varchar)), 1, 8))::bigint % 100)"
SPLIT_SQL = f"CASE WHEN {HASH_SQL} < 70 THEN 'train' WHEN {HASH_SQL} < 85 THEN 'val' ELSE 'test' END"


def share_sql(source: str) -> str:
    return f"""SELECT split, count(*) AS rows, round(100.0::double * count(*) / (SELECT count(*) FROM ({source})), 1) AS share
      FROM ({source}) GROUP BY split"""


# ---- splits

register("split_summary",
         lambda s, d: sp.split_summary(sp.hash_split(b.meter_daily(s, d), KEY)),
         M + share_sql(f"SELECT {SPLIT_SQL} AS split FROM meter_daily"))
register("split_rows",
         lambda s, d: day_text(sp.hash_split(b.meter_daily(s, d), KEY).select("meter_id", "date", "split")),
         M + f"SELECT meter_id, cast(date AS varchar) AS date, {SPLIT_SQL} AS split FROM meter_daily")
register("holdout_split_summary",
         lambda s, d: sp.split_summary(sp.hash_split(b.meter_daily(s, d), KEY, (80,), ("train", "test"))),
         M + share_sql(f"SELECT CASE WHEN {HASH_SQL} < 80 THEN 'train' ELSE 'test' END AS split FROM meter_daily"))
DAY_NO = "date_diff('day', DATE '1970-01-01', date)"
TEMPORAL = f"""SELECT CASE WHEN {DAY_NO} <= (SELECT quantile_cont({DAY_NO}, 0.70) FROM meter_daily) THEN 'train'
  WHEN {DAY_NO} <= (SELECT quantile_cont({DAY_NO}, 0.85) FROM meter_daily) THEN 'val' ELSE 'test' END AS split
  FROM meter_daily"""
register("temporal_split_summary",
         lambda s, d: sp.split_summary(sp.temporal_split(b.meter_daily(s, d), "date")),
         M + share_sql(TEMPORAL))
register("capped_rows",
         lambda s, d: day_text(sp.cap_rows(b.meter_daily(s, d).select("meter_id", "date"), KEY, 200)),
         M + """SELECT meter_id, cast(date AS varchar) AS date,
           row_number() OVER (ORDER BY md5(meter_id || '|' || cast(date AS varchar)), meter_id, meter_daily.date) <= 200 AS sampled
           FROM meter_daily""")
register("label_index",
         lambda s, d: md.index_labels(b.household(s, d), "social_group")[0]
         .groupBy("social_group", "label").agg(F.count(F.lit(1)).alias("households")),
         MH + """SELECT social_group, cast(rank - 1 AS double) AS label, households FROM (
           SELECT social_group, count(*) AS households, rank() OVER (ORDER BY social_group) AS rank
           FROM household GROUP BY social_group)""")

# ---- evaluation tables on rule-based predictions

# The rule guesses a household's tariff band from the day's energy; label and guess are texts.
GUESS_SQL = """guesses AS (SELECT social_group AS label, tariff,
    CASE WHEN energy_sum < 60 THEN 'AUTOMOBILE' WHEN energy_sum < 120 THEN 'BUILDING'
      WHEN energy_sum < 180 THEN 'FURNITURE' WHEN energy_sum < 240 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS prediction,
    round(energy_max / 1000, 3) AS score FROM meter_daily JOIN household USING (meter_id))"""
MG = b.with_ctes(b.METER_SQL, b.HOUSEHOLD_SQL, GUESS_SQL)
CLASSES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def guesses(s, d):
    e = F.col("energy_sum")
    guess = (F.when(e < 60, CLASSES[0]).when(e < 120, CLASSES[1]).when(e < 180, CLASSES[2])
             .when(e < 240, CLASSES[3]).otherwise(CLASSES[4]))
    return ft.with_household(b.meter_daily(s, d), b.household(s, d)).select(
        F.col("social_group").alias("label"), "tariff", guess.alias("prediction"),
        F.round(F.col("energy_max") / 1000, 3).alias("score"))


_counts = ", ".join(f"count(*) FILTER (WHERE prediction = '{c}') AS \"{c}\"" for c in CLASSES)
_shares = ", ".join(f"round(count(*) FILTER (WHERE prediction = '{c}') / count(*)::double, 6) AS \"{c}\"" for c in CLASSES)
register("confusion_matrix", lambda s, d: ev.confusion(guesses(s, d), CLASSES),
         MG + f"SELECT label, {_counts} FROM guesses GROUP BY label")
register("confusion_matrix_normalised",
         lambda s, d: rounded(ev.confusion(guesses(s, d), CLASSES, normalise=True), CLASSES),
         MG + f"SELECT label, {_shares} FROM guesses GROUP BY label")
PER_CLASS_SQL = """per_class AS (SELECT class, total, correct, correct / nullif(hits, 0)::double AS p,
    correct / nullif(total, 0)::double AS r, (n - total - hits + correct) / nullif(n - total, 0)::double AS sp
  FROM (SELECT c.class, count(*) FILTER (WHERE label = c.class) AS total,
      count(*) FILTER (WHERE label = c.class AND prediction = c.class) AS correct,
      count(*) FILTER (WHERE prediction = c.class) AS hits, count(*) AS n
    FROM guesses, (SELECT label AS class FROM guesses UNION SELECT prediction FROM guesses) c GROUP BY c.class)),
scored AS (SELECT class, total, correct, coalesce(p, 0) AS p, coalesce(r, 0) AS r, coalesce(sp, 0) AS sp,
    coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM per_class)"""
MC = b.with_ctes(b.METER_SQL, b.HOUSEHOLD_SQL, GUESS_SQL, PER_CLASS_SQL)
RATES = ["precision", "recall", "specificity", "f1"]
register("class_metrics", lambda s, d: rounded(ev.class_metrics(guesses(s, d)), RATES),
         MC + """SELECT class, total, correct, round(p, 6) AS precision, round(r, 6) AS recall,
           round(sp, 6) AS specificity, round(f, 6) AS f1 FROM scored""")
register("weighted_metrics",
         lambda s, d: rounded(ev.weighted_metrics(guesses(s, d)), ["accuracy", "f1", "precision", "recall"]),
         MC + """SELECT cast(sum(total) AS bigint) AS rows, round(sum(correct) / sum(total)::double, 6) AS accuracy,
           round(sum(f * total) / sum(total), 6) AS f1, round(sum(p * total) / sum(total), 6) AS precision,
           round(sum(r * total) / sum(total), 6) AS recall FROM scored""")
register("auc",
         lambda s, d: rounded(ev.auc(guesses(s, d), "score", F.col("tariff") == "ToU"), ["auc"]),
         MG + """SELECT round(sum(pos * (below + neg / 2.0::double)) / (sum(pos) * sum(neg)), 6) AS auc FROM (
           SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
           FROM (SELECT score, count(*) FILTER (WHERE tariff = 'ToU') AS pos, count(*) FILTER (WHERE tariff <> 'ToU') AS neg
             FROM guesses GROUP BY score))""")

# Naive forecasts of the next day: yesterday's value again, the mean of a week, today's value.
NAIVE_SQL = f"""naive AS (SELECT meter_id, date, {SPLIT_SQL} AS split,
    lead(energy_sum) OVER w AS label, energy_sum AS same, lag(energy_sum) OVER w AS previous,
    avg(energy_sum) OVER (PARTITION BY meter_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS week
  FROM meter_daily WINDOW w AS (PARTITION BY meter_id ORDER BY date)),
guess AS (SELECT split, label, 'same' AS model, same AS prediction FROM naive
  UNION ALL SELECT split, label, 'previous', previous FROM naive
  UNION ALL SELECT split, label, 'week', week FROM naive),
used AS (SELECT * FROM guess WHERE label IS NOT NULL AND prediction IS NOT NULL)"""
MN = b.with_ctes(b.METER_SQL, NAIVE_SQL)


def naive(s, d):
    x = ft.next_day(b.meter_daily(s, d))
    x = seq.add_lags(x, ["meter_id"], "date", {"energy_sum": [1]}, {"energy_sum": "sum"})
    x = seq.add_rolling(x, ["meter_id"], "date", "energy_sum", {"mean": [7]})
    x = sp.hash_split(x, KEY)
    return x.select("split", F.col("target").alias("label"), F.inline(F.array(
        F.struct(F.lit("same").alias("model"), F.col("energy_sum").alias("prediction")),
        F.struct(F.lit("previous").alias("model"), F.col("lag_sum_1").alias("prediction")),
        F.struct(F.lit("week").alias("model"), F.col("rolling_mean_7d").alias("prediction")))))


def metrics_sql(y: str, p: str) -> str:
    return f"""count(*) AS rows, round(sqrt(avg(({y} - {p}) * ({y} - {p}))), 6) AS rmse,
      round(avg(abs({y} - {p})), 6) AS mae,
      round(1 - avg(({y} - {p}) * ({y} - {p})) / nullif(var_pop({y}), 0), 6) AS r2,
      round(100 * avg(abs(({y} - {p}) / nullif({y}, 0))), 6) AS mape"""


ERRORS = ["rmse", "mae", "r2", "mape"]
register("regression_metrics",
         lambda s, d: rounded(ev.regression_metrics(naive(s, d), by=["model", "split"]), ERRORS),
         MN + f"SELECT model, split, {metrics_sql('label', 'prediction')} FROM used GROUP BY model, split")
register("regression_metrics_log",
         lambda s, d: rounded(ev.regression_metrics(naive(s, d), log=True, by=["model"]), ERRORS),
         MN + f"SELECT model, {metrics_sql('ln(1 + label)', 'ln(1 + CASE WHEN prediction < 0 THEN 0 ELSE prediction END)')} FROM used GROUP BY model")
register("residual_summary",
         lambda s, d: rounded(ev.residual_summary(naive(s, d).where("model = 'week'")), ["mean", "std", "min", "max"]),
         MN + """SELECT round(avg(label - prediction), 6) AS mean, round(stddev_samp(label - prediction), 6) AS std,
           round(min(label - prediction), 6) AS min, round(max(label - prediction), 6) AS max
           FROM used WHERE model = 'week'""")


def _naive_board(s, d):
    per = ev.regression_metrics(naive(s, d), by=["model", "split"])
    wide = per.groupBy("model").agg(
        F.max(F.when(F.col("split") == "val", F.col("rmse"))).alias("val_rmse"),
        F.max(F.when(F.col("split") == "test", F.col("rmse"))).alias("test_rmse"),
        F.max(F.when(F.col("split") == "test", F.col("mae"))).alias("mae"))
    return rounded(ev.leaderboard(wide, "val_rmse", False), ["val_rmse", "test_rmse", "mae"])


register("model_leaderboard", _naive_board,
         MN + """SELECT model, round(val_rmse, 6) AS val_rmse, round(test_rmse, 6) AS test_rmse, round(mae, 6) AS mae,
           row_number() OVER (ORDER BY val_rmse, model) = 1 AS best FROM (
           SELECT model, sqrt(avg((label - prediction) * (label - prediction)) FILTER (WHERE split = 'val')) AS val_rmse,
             sqrt(avg((label - prediction) * (label - prediction)) FILTER (WHERE split = 'test')) AS test_rmse,
             avg(abs(label - prediction)) FILTER (WHERE split = 'test') AS mae FROM used GROUP BY model)""")

# ---- clusters by rule

BEHAVIOUR_COLS = ["energy_sum", "energy_max", "energy_mean", "energy_count"]
register("cluster_sizes",
         lambda s, d: ev.cluster_sizes(b.household(s, d).withColumnRenamed("social_group", "cluster")),
         MH + """SELECT social_group AS cluster, count(*) AS count,
           round(100.0::double * count(*) / (SELECT count(*) FROM household), 2) AS share FROM household GROUP BY 1""")
register("variance_ratio",
         lambda s, d: rounded(ev.variance_ratio(
             b.meter_daily(s, d).withColumn("cluster", F.weekday("date")), BEHAVIOUR_COLS), ["ratio"]),
         M + " UNION ALL ".join(
             f"""SELECT '{c}' AS feature, round(sum(n * (m - g) * (m - g)) / sum(n) / any_value(v), 6) AS ratio
             FROM (SELECT count(*) AS n, avg({c}) AS m, (SELECT avg({c}) FROM meter_daily) AS g,
               (SELECT var_pop({c}) FROM meter_daily) AS v FROM meter_daily GROUP BY isodow(date))"""
             for c in BEHAVIOUR_COLS))


def _results(s, d):
    f = an.anomaly_summary(flagged(s, d))
    board = _naive_board(s, d).where("best")
    return ev.results_summary([
        ("Best forecast RMSE", board.select("val_rmse")),
        ("Class F1", ev.weighted_metrics(guesses(s, d)).select(F.round("f1", 6))),
        ("Combined anomaly rate", f.select("combined_share")),
        ("Meters", f.select("meters"))])


register("results_summary", _results,
         b.with_ctes(b.METER_SQL, b.HOUSEHOLD_SQL, GUESS_SQL, PER_CLASS_SQL, NAIVE_SQL, MA[5:].split("FROM readings GROUP BY meter_id, date),\n", 1)[1].rstrip())
         + """SELECT 'Best forecast RMSE' AS metric, cast(round(min(e), 6) AS varchar) AS value FROM (
             SELECT sqrt(avg((label - prediction) * (label - prediction))) AS e FROM used WHERE split = 'val' GROUP BY model)
           UNION ALL SELECT 'Class F1', cast(round(sum(f * total) / sum(total), 6) AS varchar) FROM scored
           UNION ALL SELECT 'Combined anomaly rate', cast(round(100.0::double * count(*) FILTER (WHERE anomaly) / count(*), 2) AS varchar) FROM flagged
           UNION ALL SELECT 'Meters', cast(count(DISTINCT meter_id) AS varchar) FROM flagged""")

# ---- fitted models


def _line(s, d):
    """Next day's energy from today's, by least squares."""
    x = ft.next_day(b.meter_daily(s, d)).where("target is not null").select("energy_sum", F.col("target").alias("label"))
    vec, _ = md.assemble(x, ["energy_sum"], scale=False)
    m = LinearRegression(solver="normal").fit(vec)
    return s.createDataFrame([(round(float(m.coefficients[0]), 6), round(float(m.intercept), 5))],
                             "slope double, intercept double")


register("next_day_line", _line,
         M + """SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 5) AS intercept FROM (
           SELECT energy_sum AS x, lead(energy_sum) OVER (PARTITION BY meter_id ORDER BY date) AS y FROM meter_daily)
           WHERE y IS NOT NULL""")


def features(s, d):
    """The daily feature table with every join, before cleaning."""
    hh = ft.hh_blocks(b.meter_hh(s, d)).drop("hh_range", "hh_stddev")
    table = ft.feature_table(b.meter_daily(s, d, median=True), hh, b.weather_daily(s, d), b.holidays(s), b.household(s, d))
    return ft.weather_features(table).withColumns({
        "hh_range": F.col("range"), "hh_stddev": F.col("energy_std"),
        "tariff_index": (F.col("tariff") == "ToU").cast("double")})


def written_features(s, d):
    """The feature table, written once per call: one task passes over it several times."""
    return md.materialise(features(s, d), "features")


def prepared(s, d, cols, label, name, temporal=False):
    """Cleaned, scaled and split rows of one task, written once."""
    base = written_features(s, d).withColumn("label", label).where(F.col("label").isNotNull())
    return _vectors(base.select(*KEY, "label", *cols), cols, name, temporal)


def _vectors(base, cols, name, temporal=False):
    split = sp.temporal_split(base, "date") if temporal else sp.hash_split(base, KEY)
    clean = md.clean_features(split, cols, fit_on=split.where("split = 'train'"))
    vec, _ = md.assemble(clean, cols, fit_on=clean.where("split = 'train'"))
    return md.materialise(vec.select(*KEY, "label", "split", "features"), name)


def _social(s, d):
    indexed, labels = md.index_labels(written_features(s, d), "social_group")
    cols = md.SOCIAL_FEATURES
    return _vectors(indexed.select(*KEY, "label", *cols), cols, "social"), cols, len(labels)


def social_group_models(s, d):
    data, cols, k = _social(s, d)
    names = ["RandomForest", "DecisionTree", "LogisticRegression", "MultilayerPerceptron", "LinearSVM_OvR"]
    fitted = md.fit_classifiers(data.where("split = 'train'"), names, len(cols), k)
    return md.classification_board(data, fitted)


def social_group_importance(s, d):
    data, cols, k = _social(s, d)
    model, _ = md.fit_classifiers(data.where("split = 'train'"), ["RandomForest"], len(cols), k)["RandomForest"]
    return md.importances(s, model, cols)


def tariff_models(s, d):
    data = prepared(s, d, md.TARIFF_FEATURES, (F.col("tariff") == "ToU").cast("double"), "tariff")
    train = md.class_weights(data.where("split = 'train'"), "label")
    fitted = md.fit_classifiers(train, ["RandomForest", "DecisionTree", "LogisticRegression"],
                                len(md.TARIFF_FEATURES), 2, "weight")
    return md.classification_board(data, fitted, binary=True)


def next_day_models(s, d):
    data = prepared(s, d, md.FORECAST_FEATURES, F.col("target"), "forecast")
    return md.regression_board(data, md.fit_regressors(data.where("split = 'train'"), ["LinearRegression", "RandomForest"]))


def peak_models(s, d):
    data = prepared(s, d, md.peak_features(), F.col("energy_max"), "peak")
    return md.regression_board(data, md.fit_regressors(data.where("split = 'train'"), ["LinearRegression", "RandomForest", "GBT"]))


def peak_models_same_day(s, d):
    data = prepared(s, d, md.peak_features(same_day=True), F.col("energy_max"), "peak-same-day")
    return md.regression_board(data, md.fit_regressors(data.where("split = 'train'"), ["LinearRegression"]))


def weather_models(s, d):
    data = prepared(s, d, md.WEATHER_FEATURES, F.log1p("energy_sum"), "weather", temporal=True)
    return md.regression_board(data, md.fit_regressors(data.where("split = 'train'"), ["LinearRegression", "RandomForest", "GBT"]), log=True)


CLUSTER_COLS = ["avg_daily_mean", "avg_daily_max", "avg_daily_std", "avg_daily_sum", "avg_cv", "avg_peak_ratio",
                "avg_load_factor", "avg_reading_count", "avg_stddev"]


def household_vectors(s, d):
    rows = ft.impute_median(ft.household_behaviour(b.meter_daily(s, d)), CLUSTER_COLS).fillna(0.0)
    vec, _ = md.assemble(rows, CLUSTER_COLS)
    return md.materialise(vec.select("meter_id", "features", *CLUSTER_COLS), "households")


def kmeans_sweep(s, d):
    return md.kmeans_sweep(household_vectors(s, d))[0]


def household_clusters(s, d):
    vec = household_vectors(s, d)
    _, model = md.kmeans_sweep(vec)
    return ev.cluster_sizes(model.transform(vec))


def cluster_features(s, d):
    vec = household_vectors(s, d)
    _, model = md.kmeans_sweep(vec)
    return ev.variance_ratio(model.transform(vec), CLUSTER_COLS)


def load_shape_clusters(s, d):
    shape = ft.load_shape(b.meter_hh(s, d))
    vec, _ = md.assemble(shape, [f"s{i}" for i in range(ft.SLOTS)], scale=False)
    data = md.materialise(vec.select(*KEY, "features"), "load-shapes")
    _, model = md.kmeans_sweep(data, [2])
    names = md.peak_label(s, [list(c) for c in model.clusterCenters()])
    return ev.cluster_sizes(model.transform(data)).join(names, "cluster")


def pca_projection(s, d):
    return md.pca2(household_vectors(s, d)).select("meter_id", "pc1", "pc2")


BRANCHES = {
    "series": ["rolling_mean_7d", "rolling_mean_14d", "rolling_mean_30d", "rolling_std_7d", "lag_sum_1", "lag_sum_2",
               "lag_sum_7", "lag_mean_1", "lag_max_1", "lag_max_7"],
    "weather": [*md.WEATHER, "temp_avg", "temp_range", "heat_index"],
    "calendar": ["month", "season", "day_of_week", "is_weekend", "is_holiday", *md.CYCLIC],
}


def grouped_forecast(s, d):
    cols = [c for group in BRANCHES.values() for c in group]
    rows = (written_features(s, d).where("target is not null")
            .select(*KEY, "target", "tariff", "social_group", *cols))
    split = sp.hash_split(rows, KEY, (80,), ("train", "test"))
    data = md.materialise(md.clean_features(split, cols, fit_on=split.where("split = 'train'")), "grouped")
    model = md.grouped_forecaster(data.where("split = 'train'"), BRANCHES, ["tariff", "social_group"])
    scored = md.materialise(
        md.grouped_predict(model, data.where("split = 'test'")).select("target", "prediction"), "grouped-scored")
    linear = ev.regression_metrics(scored, "target").withColumn("scale", F.lit("original"))
    return linear.unionByName(ev.regression_metrics(scored, "target", log=True).withColumn("scale", F.lit("log")))


def branched_forecast(s, d):
    """The branched net and a linear model on the same rows, with their errors on the test rows."""
    cols = [c for group in BRANCHES.values() for c in group]
    rows = (written_features(s, d).where("target is not null").select(*KEY, "target", "tariff", "social_group", *cols))
    split = sp.hash_split(rows, KEY)
    data = md.materialise(md.clean_features(split, cols, fit_on=split.where("split = 'train'")), "branched")
    part = {name: data.where(F.col("split") == name) for name in ("train", "val", "test")}
    net = bn.fit(part["train"], part["val"], BRANCHES, ["tariff", "social_group"], written=md.materialise)
    vectors, model = md.assemble(part["train"].withColumn("label", F.log1p("target")), cols)
    line = md.regressor("LinearRegression").fit(vectors)
    guesses = {"branched": net.predict(part["test"]).select("target", "prediction"),
               "linear": line.transform(model.transform(part["test"])).select("target", F.expm1("prediction").alias("prediction"))}
    scored = md.materialise(reduce(DataFrame.unionByName, (g.withColumn("model", F.lit(n)) for n, g in guesses.items())), "branched-scored")
    return reduce(DataFrame.unionByName, (
        ev.regression_metrics(scored, "target", log=log, by=["model"]).withColumn("scale", F.lit("log" if log else "original")) for log in (False, True)))


def feature_rows(s, d):
    """The whole feature table, numbers rounded and the date as text."""
    table = features(s, d)
    return day_text(mq.rounded(table, [n for n, t in table.dtypes if t == "double"]))


ROLLED = ", ".join(
    f"{mq.ROLL_FN[st]}(energy_sum) OVER (PARTITION BY meter_id ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) "
    f"AS rolling_{st}_{n}d" for st, ns in ft.ROLLING.items() for n in ns)
LAGGED = ", ".join(f"lag({c}, {k}) OVER w AS lag_{ft.LAG_NAMES[c]}_{k}" for c, ks in ft.LAGS.items() for k in ks)
HH_NAMES = [*ft.HH_BLOCKS, "hh_night_ratio", "hh_peak_to_offpeak_ratio"]
ALL_WEATHER = ["temperatureMax", "temperatureMin", "temperatureHigh", "temperatureLow", "humidity", "cloudCover", "pressure",
               "windSpeed", "windBearing", "dewPoint"]
register("feature_table", feature_rows,
         b.with_ctes(b.METER_SQL, mq.HH_SQL, b.WEATHER_SQL, b.HOLIDAY_SQL, b.HOUSEHOLD_SQL,
                     f"""seqs AS (SELECT *, {LAGGED}, {ROLLED}, lead(energy_sum) OVER w AS target
                       FROM meter_daily WINDOW w AS (PARTITION BY meter_id ORDER BY date))""",
                     f"""wide AS (SELECT q.*, h.* EXCLUDE (meter_id, date, hh_range, hh_stddev), w.* EXCLUDE (date), u.* EXCLUDE (meter_id),
                       {mq.CALENDAR.replace('date', 'q.date')}, ("temperatureMax" + "temperatureMin") / 2 AS t,
                       cos(month(q.date) * (2 * pi() / 12)) AS cm, q.date IN (SELECT date FROM holiday) AS holiday
                       FROM seqs q JOIN household u ON q.meter_id = u.meter_id
                       LEFT JOIN hh h ON q.meter_id = h.meter_id AND q.date = h.date LEFT JOIN weather_daily w ON q.date = w.date)""")
         + "SELECT meter_id, cast(date AS varchar) AS date, energy_count, social_group, tariff, "
         + mq.r_sql([*mq.DAILY, *mq.LAG, *mq.ROLL, "target", *HH_NAMES, *ALL_WEATHER, *mq.CYCLIC]) + ", "
         + ", ".join(f"round({e}, 6) AS {n}" for n, e in mq.DERIVED.items())
         + """, round(energy_std / nullif(energy_mean, 0), 6) AS cv, round(energy_max / nullif(energy_mean, 0), 6) AS peak_to_mean_ratio,
           round(energy_mean / nullif(energy_max, 0), 6) AS load_factor, round(energy_max - energy_min, 6) AS range,
           round(energy_max - energy_min, 6) AS hh_range, round(energy_std, 6) AS hh_stddev,
           cast(month AS integer) AS month, cast(quarter AS integer) AS quarter, cast(season AS integer) AS season,
           cast(day_of_week AS integer) AS day_of_week, is_weekend, CASE WHEN holiday THEN 1 ELSE 0 END AS is_holiday,
           CASE WHEN t IS NULL THEN NULL WHEN t < 15.5 THEN 1 ELSE 0 END AS is_heating_season,
           CASE WHEN tariff = 'ToU' THEN 1.0::double ELSE 0.0::double END AS tariff_index FROM wide""")
# ---- what the models are given

CLEANED = ["energy_sum", "energy_std", "lag_sum_1", "rolling_mean_7d", "temperatureMax", "hh_night_ratio"]


def cleaned(s, d):
    """Cleaned feature rows with their split; cuts and medians are those of the training rows."""
    split = sp.hash_split(feature_rows(s, d).select(*KEY, "tariff", "social_group", *CLEANED), KEY)
    return md.materialise(md.clean_features(split, CLEANED, fit_on=split.where("split = 'train'")), "cleaned")


def cleaned_values(s, d):
    rows = cleaned(s, d).unpivot(["split"], CLEANED, "feature", "v")
    return rows.groupBy("split", "feature").agg(
        F.count("v").alias("rows"), F.round(F.min("v"), 5).alias("least"), F.round(F.max("v"), 5).alias("most"), F.round(F.avg("v"), 5).alias("mean"))


def scaled_values(s, d):
    """Mean and spread of each scaled feature by split: 0 and 1 on the training rows."""
    data = cleaned(s, d)
    vec, _ = md.assemble(data, CLEANED, fit_on=data.where("split = 'train'"))
    values = vec.select("split", F.posexplode(vector_to_array("features")).alias("k", "v"))
    return values.groupBy("split", F.element_at(F.array(*[F.lit(c) for c in CLEANED]), F.col("k") + 1).alias("feature")).agg(
        (F.round(F.avg("v"), 4) + 0.0).alias("mean"), F.round(F.stddev_samp("v"), 4).alias("spread"))


def split_labels(s, d):
    """Rows by split and class of the two classification tasks."""
    data = cleaned(s, d)
    both = data.select("split", F.explode(F.array(F.concat(F.lit("tariff: "), "tariff"), F.concat(F.lit("group: "), "social_group"))).alias("label"))
    return both.where("label IS NOT NULL").groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows"))


_FEATURES_SQL = f"""SELECT *, CASE WHEN h < 70 THEN 'train' WHEN h < 85 THEN 'val' ELSE 'test' END AS split FROM (
  SELECT *, (('0x' || substr(md5(meter_id || '|' || date), 1, 8))::bigint % 100) AS h FROM ({SQL['feature_table']}))"""
_CUTS = ", ".join(f"quantile_cont({c}, {q}) AS {n}_{c}" for c in CLEANED for n, q in (("lo", 0.01), ("md", 0.5), ("hi", 0.99)))
CLEANED_SQL = f"""WITH ft AS ({_FEATURES_SQL}), cuts AS (SELECT {_CUTS} FROM ft WHERE split = 'train'),
  clean AS (SELECT split, tariff, social_group, {", ".join(f"CASE WHEN {c} IS NULL THEN md_{c} WHEN {c} < lo_{c} THEN lo_{c} WHEN {c} > hi_{c} THEN hi_{c} ELSE {c} END AS {c}" for c in CLEANED)} FROM ft, cuts)"""
register("cleaned_values", cleaned_values, CLEANED_SQL + " UNION ALL ".join(
    f" SELECT split, '{c}' AS feature, count({c}) AS rows, round(min({c}), 5) AS least, round(max({c}), 5) AS most, round(avg({c}), 5) AS mean "
    "FROM clean GROUP BY split" for c in CLEANED))
register("scaled_values", scaled_values, CLEANED_SQL + " UNION ALL ".join(
    f" SELECT split, '{c}' AS feature, round((avg({c}) - any_value(m)) / any_value(s), 4) + 0.0::double AS mean, round(stddev_samp({c}) / any_value(s), 4) AS spread "
    f"FROM clean, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM clean WHERE split = 'train') GROUP BY split" for c in CLEANED))
register("split_labels", split_labels, CLEANED_SQL + """ SELECT split, label, count(*) AS rows FROM (
  SELECT split, unnest(['tariff: ' || tariff, 'group: ' || social_group]) AS label FROM clean) WHERE label IS NOT NULL GROUP BY 1, 2""")

for _q in (social_group_models, social_group_importance, tariff_models, next_day_models, peak_models,
           peak_models_same_day, weather_models, kmeans_sweep, household_clusters, cluster_features,
           load_shape_clusters, pca_projection, grouped_forecast, branched_forecast):
    register(_q.__name__, _q)

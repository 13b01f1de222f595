"""Meter features, joins, cleaning and anomalies over the event readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerometer import constants as K
from aerometer.functions import scalars as X
from aerometer.operators import anomaly as an
from aerometer.operators import features as ft
from aerometer.operators import quantiles as qn
from aerometer.operators import sequences as seq
from aerometer.plans import bindings as b
from aerometer.plans.registry import register

M = b.with_ctes(b.METER_SQL)


def rounded(df, cols, dp=6):
    return df.withColumns({c: F.round(c, dp) for c in cols})


def day_text(df, col="date"):
    return df.withColumn(col, F.col(col).cast("string"))


def r_sql(cols, dp=6):
    return ", ".join(f'round("{c}", {dp}) AS "{c}"' for c in cols)


DAILY = ["energy_mean", "energy_max", "energy_min", "energy_sum", "energy_std", "energy_median"]
register("meter_daily",
         lambda s, d: day_text(rounded(b.meter_daily(s, d, median=True), DAILY)),
         M + f"SELECT meter_id, cast(date AS varchar) AS date, energy_count, {r_sql(DAILY)} FROM meter_daily")
register("intraday_ratios",
         lambda s, d: day_text(rounded(ft.intraday_ratios(b.meter_daily(s, d)), [
             "cv", "peak_to_mean_ratio", "load_factor", "range"])
             .select("meter_id", "date", "cv", "peak_to_mean_ratio", "load_factor", "range")),
         M + """SELECT meter_id, cast(date AS varchar) AS date, round(energy_std / nullif(energy_mean, 0), 6) AS cv,
           round(energy_max / nullif(energy_mean, 0), 6) AS peak_to_mean_ratio,
           round(energy_mean / nullif(energy_max, 0), 6) AS load_factor,
           round(energy_max - energy_min, 6) AS range FROM meter_daily""")

# ---- sequences

LAG = [f"lag_{ft.LAG_NAMES[c]}_{k}" for c, ks in ft.LAGS.items() for k in ks]
LAG_SQL = ", ".join(f"round(lag({c}, {k}) OVER w, 6) AS lag_{ft.LAG_NAMES[c]}_{k}"
                    for c, ks in ft.LAGS.items() for k in ks)
register("meter_lags",
         lambda s, d: day_text(rounded(ft.meter_lags(b.meter_daily(s, d)), LAG).select("meter_id", "date", *LAG)),
         M + f"""SELECT meter_id, cast(date AS varchar) AS date, {LAG_SQL} FROM meter_daily
           WINDOW w AS (PARTITION BY meter_id ORDER BY date)""")
CAL_SQL = ", ".join(f"round(d{k}.{c}, 6) AS lag_{ft.LAG_NAMES[c]}_{k}" for c, ks in ft.LAGS.items() for k in ks)
CAL_JOINS = " ".join(f"LEFT JOIN meter_daily d{k} ON d{k}.meter_id = m.meter_id AND d{k}.date = m.date - {k}"
                     for k in sorted({k for ks in ft.LAGS.values() for k in ks}))
register("meter_lags_calendar",
         lambda s, d: day_text(rounded(ft.meter_lags(b.meter_daily(s, d), calendar=True), LAG)
                               .select("meter_id", "date", *LAG)),
         M + f"SELECT m.meter_id, cast(m.date AS varchar) AS date, {CAL_SQL} FROM meter_daily m {CAL_JOINS}")
ROLL = [f"rolling_{st}_{n}d" for st, ns in ft.ROLLING.items() for n in ns]
ROLL_FN = {"mean": "avg", "std": "stddev_samp"}
ROLL_SQL = ", ".join(
    f"round({ROLL_FN[st]}(energy_sum) OVER (PARTITION BY meter_id ORDER BY date ROWS BETWEEN {n} PRECEDING "
    f"AND 1 PRECEDING), 6) AS rolling_{st}_{n}d" for st, ns in ft.ROLLING.items() for n in ns)
register("meter_rolling",
         lambda s, d: day_text(rounded(ft.meter_rolling(b.meter_daily(s, d)), ROLL).select("meter_id", "date", *ROLL)),
         M + f"SELECT meter_id, cast(date AS varchar) AS date, {ROLL_SQL} FROM meter_daily")
register("next_day_target",
         lambda s, d: day_text(rounded(ft.next_day(b.meter_daily(s, d)), ["target"])
                               .select("meter_id", "date", "target")),
         M + """SELECT meter_id, cast(date AS varchar) AS date,
           round(lead(energy_sum) OVER (PARTITION BY meter_id ORDER BY date), 6) AS target FROM meter_daily""")


def _reading_sequences(s, d):
    """Lag and trailing mean on raw readings: series of any length, so cut into blocks, here shorter
    than the longest series so that edges are copied; ties in time are ordered by event."""
    out = seq.add_sequences(b.readings(s, d), ["meter_id"], ["ts", "event_id"], [
        seq.lags({"energy": [1, 3]}), seq.rolling("energy", {"mean": [5]}, suffix="r")],
        block_rows=20, chunk=F.date_trunc("minute", "ts"))
    return rounded(out, ["rolling_mean_5r"]).select("event_id", "lag_energy_1", "lag_energy_3", "rolling_mean_5r")


register("reading_sequences", _reading_sequences,
         M + """SELECT event_id, lag(energy, 1) OVER w AS lag_energy_1, lag(energy, 3) OVER w AS lag_energy_3,
           round(avg(energy) OVER (PARTITION BY meter_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6)
             AS rolling_mean_5r FROM readings WINDOW w AS (PARTITION BY meter_id ORDER BY ts, event_id)""")

# ---- half-hourly

BLOCK_SQL = ",\n".join(
    f"avg(energy) FILTER (WHERE slot BETWEEN {r.start} AND {r.stop - 1}) AS {n}" for n, r in ft.HH_BLOCKS.items())
HH_COLS = [*ft.HH_BLOCKS, "hh_stddev", "hh_range", "hh_night_ratio", "hh_peak_to_offpeak_ratio"]
HH_SQL = f"""hh AS (SELECT *, hh_offpeak_night_avg / nullif(day_avg, 0) AS hh_night_ratio,
    hh_peak_hour_avg / nullif(hh_offpeak_night_avg, 0) AS hh_peak_to_offpeak_ratio
  FROM (SELECT meter_id, date, {BLOCK_SQL}, avg(energy) AS day_avg, stddev_samp(energy) AS hh_stddev,
    max(energy) - min(energy) AS hh_range FROM readings GROUP BY meter_id, date))"""
register("meter_hh_features",
         lambda s, d: day_text(rounded(ft.hh_blocks(b.meter_hh(s, d)), HH_COLS)),
         b.with_ctes(b.METER_SQL, HH_SQL) + f"SELECT meter_id, cast(date AS varchar) AS date, {r_sql(HH_COLS)} FROM hh")
SLOTS = [f"s{i}" for i in range(ft.SLOTS)]
SHAPE_SQL = """shape AS (SELECT meter_id, date, """ + ", ".join(
    f"coalesce(avg(energy) FILTER (WHERE slot = {i}), 0) AS s{i}" for i in range(ft.SLOTS)) + """
  FROM readings GROUP BY meter_id, date)"""
NORM = "nullif(sqrt(" + " + ".join(f"s{i} * s{i}" for i in range(ft.SLOTS)) + "), 0)"
register("load_shape",
         lambda s, d: day_text(rounded(ft.load_shape(b.meter_hh(s, d)), SLOTS)),
         b.with_ctes(b.METER_SQL, SHAPE_SQL) + "SELECT meter_id, cast(date AS varchar) AS date, "
         + ", ".join(f"round(coalesce(s{i} / {NORM}, 0), 6) AS s{i}" for i in range(ft.SLOTS)) + " FROM shape")
register("half_hour_profile",
         lambda s, d: b.meter_hh(s, d).groupBy("slot").agg(
             F.count(F.lit(1)).alias("n"), F.round(F.avg("energy"), 6).alias("mean")),
         M + "SELECT slot, count(*) AS n, round(avg(energy), 6) AS mean FROM readings GROUP BY slot")
BEHAVIOUR = {
    "avg_daily_mean": "avg(energy_mean)", "avg_daily_max": "avg(energy_max)", "avg_daily_std": "avg(energy_std)",
    "avg_daily_sum": "avg(energy_sum)", "avg_cv": "avg(energy_std / nullif(energy_mean, 0))",
    "avg_peak_ratio": "avg(energy_max / nullif(energy_mean, 0))",
    "avg_load_factor": "avg(energy_mean / nullif(energy_max, 0))", "avg_reading_count": "avg(energy_count)",
    "avg_stddev": "stddev_samp(energy_sum)"}
register("household_behaviour",
         lambda s, d: rounded(ft.household_behaviour(ft.with_hh(
             b.meter_daily(s, d), ft.hh_blocks(b.meter_hh(s, d)).select("meter_id", "date", "hh_peak_hour_avg"))),
             [*BEHAVIOUR, "avg_peak_hour_max"]),
         b.with_ctes(b.METER_SQL, HH_SQL) + "SELECT meter_id, "
         + ", ".join(f"round({e}, 6) AS {n}" for n, e in BEHAVIOUR.items())
         + """, round(max(hh_peak_hour_avg), 6) AS avg_peak_hour_max, count(*) AS days
           FROM meter_daily LEFT JOIN hh USING (meter_id, date) GROUP BY meter_id""")

# ---- joins and derived columns

MW = b.with_ctes(b.METER_SQL, b.WEATHER_SQL, b.HOLIDAY_SQL, b.HOUSEHOLD_SQL)
WEATHER_COLS = ["temperatureMax", "temperatureMin", "humidity", "cloudCover", "pressure", "windSpeed", "dewPoint"]
register("weather_join",
         lambda s, d: day_text(rounded(ft.with_weather(b.meter_daily(s, d), b.weather_daily(s, d)),
                                       ["energy_sum", *WEATHER_COLS])
                               .select("meter_id", "date", "energy_sum", *WEATHER_COLS)),
         MW + f"""SELECT meter_id, cast(date AS varchar) AS date, {r_sql(['energy_sum', *WEATHER_COLS])}
           FROM meter_daily LEFT JOIN weather_daily USING (date)""")
register("holiday_join",
         lambda s, d: ft.with_holidays(b.meter_daily(s, d), b.holidays(s)).groupBy("is_holiday").agg(
             F.count(F.lit(1)).alias("days"), F.round(F.avg("energy_sum"), 6).alias("mean")),
         MW + """SELECT CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday, count(*) AS days,
           round(avg(energy_sum), 6) AS mean FROM meter_daily m LEFT JOIN holiday h ON m.date = h.date GROUP BY 1""")
register("household_join",
         lambda s, d: ft.with_household(b.meter_daily(s, d), b.household(s, d)).groupBy("social_group", "tariff").agg(
             F.count(F.lit(1)).alias("days"), F.round(F.avg("energy_sum"), 6).alias("mean")),
         MW + """SELECT social_group, tariff, count(*) AS days, round(avg(energy_sum), 6) AS mean
           FROM meter_daily JOIN household USING (meter_id) GROUP BY 1, 2""")
register("daily_hh_join",
         lambda s, d: ft.with_hh(b.meter_daily(s, d), ft.hh_blocks(b.meter_hh(s, d))).groupBy("meter_id").agg(
             F.count("hh_peak_hour_avg").alias("peak_days"),
             F.round(F.avg("hh_peak_hour_avg"), 6).alias("peak_mean"), F.round(F.sum("energy_sum"), 6).alias("energy")),
         b.with_ctes(b.METER_SQL, HH_SQL) + """SELECT meter_id, count(hh_peak_hour_avg) AS peak_days,
           round(avg(hh_peak_hour_avg), 6) AS peak_mean, round(sum(energy_sum), 6) AS energy
           FROM meter_daily LEFT JOIN hh USING (meter_id, date) GROUP BY 1""")

CALENDAR = """month(date) AS month, quarter(date) AS quarter, (month(date) % 12) // 3 AS season,
  isodow(date) AS day_of_week, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  sin(month(date) * (2 * pi() / 12)) AS sin_month, cos(month(date) * (2 * pi() / 12)) AS cos_month,
  sin((isodow(date) - 1) * (2 * pi() / 7)) AS sin_day, cos((isodow(date) - 1) * (2 * pi() / 7)) AS cos_day"""
CYCLIC = ["sin_month", "cos_month", "sin_day", "cos_day"]
register("calendar_parts",
         lambda s, d: day_text(rounded(
             ft.calendar_parts(b.meter_daily(s, d).groupBy("date").agg(F.count(F.lit(1)).alias("meters")),
                               holidays=b.holidays(s)), CYCLIC, 6)),
         MW + f"""SELECT cast(c.date AS varchar) AS date, meters, cast(month AS integer) AS month,
           cast(quarter AS integer) AS quarter, cast(season AS integer) AS season,
           cast(day_of_week AS integer) AS day_of_week, is_weekend, {r_sql(CYCLIC, 6)},
           CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday
           FROM (SELECT date, count(*) AS meters, {CALENDAR} FROM meter_daily GROUP BY date) c
           LEFT JOIN holiday h ON c.date = h.date""")
DERIVED = {
    "temp_avg": "t", "temp_range": '"temperatureMax" - "temperatureMin"', "temp2": "t * t",
    "temp_pressure": "t * pressure", "temp_wind": 't * "windSpeed"', "heat_index": "t * humidity",
    "temp_x_cos_month": "t * cm", "temp2_x_cos_month": "t * t * cm"}
# Products and sums of the columns are the same in both engines to the last bit; cosines are not.
COSINES = ["temp_x_cos_month", "temp2_x_cos_month"]
register("weather_features",
         lambda s, d: day_text(rounded(
             ft.weather_features(ft.calendar_parts(ft.with_weather(b.meter_daily(s, d), b.weather_daily(s, d)))),
             COSINES).select("meter_id", "date", *DERIVED, "is_heating_season")),
         MW + "SELECT meter_id, cast(date AS varchar) AS date, "
         + ", ".join((f"round({e}, 6)" if n in COSINES else e) + f" AS {n}" for n, e in DERIVED.items())
         + """, CASE WHEN t IS NULL THEN NULL WHEN t < 15.5 THEN 1 ELSE 0 END AS is_heating_season
           FROM (SELECT *, ("temperatureMax" + "temperatureMin") / 2 AS t, cos(month(date) * (2 * pi() / 12)) AS cm
             FROM meter_daily LEFT JOIN weather_daily USING (date))""")
BIN_SQL = "CASE " + " ".join(f'WHEN t < {e} THEN \'{l}\'' for e, l in zip(K.THERMAL_EDGES, K.THERMAL_LABELS)) \
    + f" ELSE '{K.THERMAL_LABELS[-1]}' END"
register("thermal_bins",
         lambda s, d: rounded(ft.thermal_bins(
             ft.with_weather(b.meter_daily(s, d), b.weather_daily(s, d)), "temperatureMax", "energy_sum",
             K.THERMAL_EDGES, K.THERMAL_LABELS), ["mean", "std"], 9),
         MW + f"""SELECT {BIN_SQL} AS bin, round(avg(energy_sum), 9) AS mean, round(stddev_samp(energy_sum), 9) AS std,
           count(energy_sum) AS count FROM (SELECT *, "temperatureMax" AS t FROM meter_daily JOIN weather_daily USING (date))
           WHERE t IS NOT NULL GROUP BY 1""")
register("log_target",
         lambda s, d: b.meter_daily(s, d).groupBy("meter_id").agg(
             F.round(F.avg(X.log_target("energy_sum")), 6).alias("mean_log"),
             F.round(X.unlog(F.avg(X.log_target("energy_sum"))), 6).alias("geometric")),
         M + """SELECT meter_id, round(avg(ln(1 + energy_sum)), 6) AS mean_log,
           round(exp(avg(ln(1 + energy_sum))) - 1, 6) AS geometric FROM meter_daily GROUP BY 1""")

# ---- cleaning

IMPUTED = ["temperatureMax", "humidity", "energy_std"]
register("imputed",
         lambda s, d: day_text(rounded(ft.impute_median(
             ft.with_weather(b.meter_daily(s, d), b.weather_daily(s, d)), IMPUTED), IMPUTED)
             .select("meter_id", "date", *IMPUTED)),
         MW + f""", j AS (SELECT * FROM meter_daily LEFT JOIN weather_daily USING (date))
         SELECT meter_id, cast(date AS varchar) AS date, """
         + ", ".join(f'round(coalesce("{c}", (SELECT quantile_cont("{c}", 0.5) FROM j)), 6) AS "{c}"' for c in IMPUTED)
         + " FROM j")
WINSOR = ["energy_sum", "energy_max"]
register("winsorized",
         lambda s, d: day_text(rounded(ft.winsorize(b.meter_daily(s, d), WINSOR), WINSOR)
                               .select("meter_id", "date", *WINSOR)),
         M + "SELECT meter_id, cast(date AS varchar) AS date, "
         + ", ".join(f"round(least(greatest({c}, (SELECT quantile_cont({c}, 0.01) FROM meter_daily)), "
                     f"(SELECT quantile_cont({c}, 0.99) FROM meter_daily)), 6) AS {c}" for c in WINSOR)
         + " FROM meter_daily")
register("complete_rows",
         lambda s, d: ft.complete_rows(ft.with_weather(b.meter_daily(s, d), b.weather_daily(s, d)),
                                       ["energy_sum", "energy_std", "temperatureMax", "humidity"], 1.0)
         .groupBy("meter_id").agg(F.count(F.lit(1)).alias("days")),
         MW + """SELECT meter_id, count(*) AS days FROM meter_daily LEFT JOIN weather_daily USING (date)
           WHERE energy_sum IS NOT NULL AND energy_std IS NOT NULL AND "temperatureMax" IS NOT NULL AND humidity IS NOT NULL
           GROUP BY 1""")
register("without_outliers",
         lambda s, d: ft.drop_outliers(b.meter_daily(s, d), "energy_sum").groupBy("meter_id").agg(
             F.count(F.lit(1)).alias("days"), F.round(F.max("energy_sum"), 6).alias("highest")),
         M + """, q AS (SELECT quantile_cont(energy_sum, 0.25) AS q1, quantile_cont(energy_sum, 0.75) AS q3 FROM meter_daily)
         SELECT meter_id, count(*) AS days, round(max(energy_sum), 6) AS highest FROM meter_daily, q
         WHERE energy_sum BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY 1""")
register("reading_quantiles",
         lambda s, d: rounded(qn.exact_quantiles(b.readings(s, d), ["meter_id"], "energy",
                                                 {"p05": 0.05, "p50": 0.5, "p95": 0.95}), ["p05", "p50", "p95"]),
         M + """SELECT meter_id, round(quantile_cont(energy, 0.05), 6) AS p05, round(quantile_cont(energy, 0.5), 6) AS p50,
           round(quantile_cont(energy, 0.95), 6) AS p95 FROM readings GROUP BY 1""")
register("overall_quantiles",
         lambda s, d: rounded(qn.exact_quantiles(b.readings(s, d), [], "energy",
                                                 {"p01": 0.01, "p50": 0.5, "p99": 0.99}), ["p01", "p50", "p99"]),
         M + """SELECT round(quantile_cont(energy, 0.01), 6) AS p01, round(quantile_cont(energy, 0.5), 6) AS p50,
           round(quantile_cont(energy, 0.99), 6) AS p99 FROM readings""")

# ---- anomalies

FLAG_SQL = """flagged AS (
  SELECT *, z_anom AND iqr_anom AS z_and_iqr, z_anom OR iqr_anom AS anomaly, z_anom AND NOT iqr_anom AS z_only,
    iqr_anom AND NOT z_anom AS iqr_only
  FROM (SELECT m.meter_id, m.date, energy_sum, mean, (energy_sum - mean) / nullif(sd, 0) AS z_score,
      coalesce(abs((energy_sum - mean) / nullif(sd, 0)) > 3, false) AS z_anom,
      q3 > q1 AND (energy_sum < q1 - 1.5 * (q3 - q1) OR energy_sum > q3 + 1.5 * (q3 - q1)) AS iqr_anom
    FROM meter_daily m JOIN (SELECT meter_id, avg(energy_sum) AS mean, stddev_samp(energy_sum) AS sd,
        quantile_cont(energy_sum, 0.25) AS q1, quantile_cont(energy_sum, 0.75) AS q3
      FROM meter_daily GROUP BY meter_id) s ON m.meter_id = s.meter_id))"""
MA = b.with_ctes(b.METER_SQL, FLAG_SQL)


def flagged(s, d):
    return an.anomaly_flags(b.meter_daily(s, d))


FLAGS = ["z_anom", "iqr_anom", "z_and_iqr", "anomaly", "z_only", "iqr_only"]
register("anomaly_flags",
         lambda s, d: day_text(rounded(flagged(s, d), ["mean", "z_score"])
                               .select("meter_id", "date", "mean", "z_score", *FLAGS)),
         MA + f"""SELECT meter_id, cast(date AS varchar) AS date, round(mean, 6) AS mean, round(z_score, 6) AS z_score,
           {', '.join(FLAGS)} FROM flagged""")


def share(a: str, total: str, dp: int = 2) -> str:
    return f"round(100.0::double * {a} / {total}, {dp})"


register("anomaly_summary",
         lambda s, d: an.anomaly_summary(flagged(s, d)),
         MA + f"""SELECT *, {share('combined', 'records')} AS combined_share, {share('z_anomalies', 'records')} AS z_share,
           {share('iqr_anomalies', 'records')} AS iqr_share, {share('overlap', 'records')} AS overlap_share,
           {share('affected_meters', 'meters')} AS affected_share FROM (
           SELECT count(*) AS records, count(*) FILTER (WHERE z_anom) AS z_anomalies,
             count(*) FILTER (WHERE iqr_anom) AS iqr_anomalies, count(*) FILTER (WHERE z_and_iqr) AS overlap,
             count(*) FILTER (WHERE anomaly) AS combined, count(*) FILTER (WHERE z_only) AS z_only,
             count(*) FILTER (WHERE iqr_only) AS iqr_only, count(DISTINCT meter_id) AS meters,
             count(DISTINCT CASE WHEN anomaly THEN meter_id END) AS affected_meters FROM flagged)""")
register("anomaly_households",
         lambda s, d: an.anomaly_frequency(flagged(s, d)),
         MA + f"""SELECT meter_id, count(*) FILTER (WHERE anomaly) AS flagged_days, count(*) AS days,
           {share('count(*) FILTER (WHERE anomaly)', 'count(*)', 1)} AS share FROM flagged GROUP BY 1""")
register("top_anomaly_households",
         lambda s, d: an.top_households(flagged(s, d)),
         MA + f"""SELECT meter_id, count(*) FILTER (WHERE anomaly) AS flagged_days, count(*) AS days,
           {share('count(*) FILTER (WHERE anomaly)', 'count(*)', 1)} AS share FROM flagged GROUP BY 1
           ORDER BY count(*) FILTER (WHERE anomaly) / count(*)::double DESC, days DESC, meter_id LIMIT 10""")
register("top_anomalies",
         lambda s, d: day_text(rounded(an.top_anomalies(flagged(s, d), cols=[
             "meter_id", "date", "energy_sum", "mean", "z_score", "z_anom", "iqr_anom"]),
             ["energy_sum", "mean", "z_score"])),
         MA + """SELECT meter_id, cast(date AS varchar) AS date, round(energy_sum, 6) AS energy_sum, round(mean, 6) AS mean,
           round(z_score, 6) AS z_score, z_anom, iqr_anom FROM flagged WHERE z_score IS NOT NULL
           ORDER BY abs(z_score) DESC, meter_id, flagged.date LIMIT 10""")
register("iqr_flags_any_size",
         lambda s, d: an.iqr_flags(b.readings(s, d), "meter_id", "energy").groupBy("meter_id").agg(
             F.count_if("iqr_anom").alias("flagged"), F.count(F.lit(1)).alias("readings")),
         M + """SELECT meter_id, count(*) FILTER (WHERE q3 > q1 AND (energy < q1 - 1.5 * (q3 - q1) OR energy > q3 + 1.5 * (q3 - q1)))
           AS flagged, count(*) AS readings FROM readings JOIN (SELECT meter_id, quantile_cont(energy, 0.25) AS q1,
             quantile_cont(energy, 0.75) AS q3 FROM readings GROUP BY 1) USING (meter_id) GROUP BY 1""")
register("iqr_flags_global",
         lambda s, d: an.iqr_flags(b.meter_daily(s, d), "meter_id", "energy_sum", scope="global")
         .groupBy("iqr_anom").agg(F.count(F.lit(1)).alias("days"), F.round(F.min("energy_sum"), 6).alias("lowest")),
         M + """, q AS (SELECT quantile_cont(energy_sum, 0.25) AS q1, quantile_cont(energy_sum, 0.75) AS q3 FROM meter_daily)
         SELECT energy_sum < q1 - 1.5 * (q3 - q1) OR energy_sum > q3 + 1.5 * (q3 - q1) AS iqr_anom, count(*) AS days,
           round(min(energy_sum), 6) AS lowest FROM meter_daily, q GROUP BY 1""")
register("extreme_values",
         lambda s, d: day_text(an.extreme_values(b.meter_daily(s, d), "energy_sum")
                               .select("meter_id", "date", F.round("energy_sum", 6).alias("energy_sum"))),
         M + """SELECT meter_id, cast(date AS varchar) AS date, round(energy_sum, 6) AS energy_sum FROM meter_daily
           WHERE energy_sum < (SELECT quantile_cont(energy_sum, 0.05) FROM meter_daily)
             OR energy_sum > (SELECT quantile_cont(energy_sum, 0.95) FROM meter_daily)""")
register("min_reading_days",
         lambda s, d: an.min_readings(b.meter_daily(s, d), 3).groupBy("meter_id").agg(F.count(F.lit(1)).alias("days")),
         M + "SELECT meter_id, count(*) AS days FROM meter_daily WHERE energy_count >= 3 GROUP BY 1")

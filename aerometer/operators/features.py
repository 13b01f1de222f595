"""Meter features: daily and half-hourly aggregates, joins with dimensions, cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometer.functions import scalars as X
from aerometer.operators import sequences as seq
from aerometer.operators.quantiles import exact_quantiles, fit_quantiles

SLOTS = 48


# ---------------------------------------------------------------------------- aggregates

def daily_stats(readings: DataFrame, key: str = "meter_id", ts: str = "ts", value: str = "energy",
                median: bool = True, any_size: bool = False) -> DataFrame:
    """One row per meter and day: sum, mean, median, min, max, sd and count of the readings.

    A meter-day has as many readings as the day has slots, so the exact median is part of the same
    aggregation. `any_size` ranks it in buckets (see `quantiles`) instead, for keys whose readings
    are not bounded so; leave the median out where it is not needed.
    """
    r = readings.select(F.col(key).alias("meter_id"), F.to_date(ts).alias("date"),
                        F.col(value).alias("v"))
    inside = [F.percentile("v", 0.5).alias("energy_median")] if median and not any_size else []
    base = r.groupBy("meter_id", "date").agg(
        F.avg("v").alias("energy_mean"), F.max("v").alias("energy_max"), F.min("v").alias("energy_min"),
        F.sum("v").alias("energy_sum"), F.stddev_samp("v").alias("energy_std"),
        F.count("v").cast("int").alias("energy_count"), *inside)
    if inside or not median:
        return base
    med = exact_quantiles(r, ["meter_id", "date"], "v", {"energy_median": 0.5})
    return base.join(med, ["meter_id", "date"], "left")


# --- fixed values: half-hour slots of each block of the day ---------------------------------
HH_BLOCKS = {
    "hh_morning_peak_avg": range(14, 18),      # 07:00-09:00
    "hh_daytime_avg": range(18, 34),           # 09:00-17:00
    "hh_peak_hour_avg": range(34, 40),         # 17:00-20:00
    "hh_offpeak_night_avg": range(0, 14),      # 00:00-07:00
}


def hh_blocks(hh: DataFrame, blocks: dict[str, range] | None = None, key: Sequence[str] = ("meter_id", "date"),
              slot: str = "slot", value: str = "energy") -> DataFrame:
    """Mean per block of the day, the night ratio (night / whole-day mean) and the peak to
    off-peak ratio; a ratio over zero or a missing block is null."""
    blocks = blocks or HH_BLOCKS
    v = F.col(value)
    means = [F.avg(F.when(F.col(slot).between(r.start, r.stop - 1), v)).alias(n) for n, r in blocks.items()]
    out = hh.groupBy(*key).agg(*means, F.avg(v).alias("_all"), F.stddev_samp(v).alias("hh_stddev"),
                               (F.max(v) - F.min(v)).alias("hh_range"))
    return out.withColumns({
        "hh_night_ratio": F.try_divide("hh_offpeak_night_avg", "_all"),
        "hh_peak_to_offpeak_ratio": F.try_divide("hh_peak_hour_avg", "hh_offpeak_night_avg"),
    }).drop("_all")


def load_shape(hh: DataFrame, slots: int = SLOTS, key: Sequence[str] = ("meter_id", "date"),
               slot: str = "slot", value: str = "energy", normalise: bool = True) -> DataFrame:
    """The mean of every slot of the day as columns s0..s47, missing slots 0; normalised rows have
    unit length (an all-zero day stays zero)."""
    names = [f"s{i}" for i in range(slots)]
    wide = hh.groupBy(*key).agg(*[
        X.or_zero(F.avg(F.when(F.col(slot) == i, F.col(value)))).alias(n) for i, n in enumerate(names)])
    if not normalise:
        return wide
    norm = F.sqrt(sum((F.col(n) * F.col(n) for n in names[1:]), F.col(names[0]) * F.col(names[0])))
    return (wide.withColumn("_norm", norm)
            .select(*key, *[X.or_zero(F.try_divide(n, "_norm")).alias(n) for n in names]))


def intraday_ratios(df: DataFrame) -> DataFrame:
    """cv, peak to mean, load factor and range of a meter-day."""
    return df.withColumns({
        "cv": F.try_divide("energy_std", "energy_mean"),
        "peak_to_mean_ratio": F.try_divide("energy_max", "energy_mean"),
        "load_factor": F.try_divide("energy_mean", "energy_max"),
        "range": F.col("energy_max") - F.col("energy_min"),
    })


def household_behaviour(daily: DataFrame, hh: DataFrame | None = None, key: str = "meter_id") -> DataFrame:
    """One row per meter: averages of the daily statistics, for clustering."""
    d = intraday_ratios(daily)
    aggs = [F.avg("energy_mean").alias("avg_daily_mean"), F.avg("energy_max").alias("avg_daily_max"),
            F.avg("energy_std").alias("avg_daily_std"), F.avg("energy_sum").alias("avg_daily_sum"),
            F.avg("cv").alias("avg_cv"), F.avg("peak_to_mean_ratio").alias("avg_peak_ratio"),
            F.avg("load_factor").alias("avg_load_factor"),
            F.avg("energy_count").alias("avg_reading_count"),
            F.stddev_samp("energy_sum").alias("avg_stddev"), F.count(F.lit(1)).alias("days")]
    if "hh_peak_hour_avg" in daily.columns:
        aggs.append(F.max("hh_peak_hour_avg").alias("avg_peak_hour_max"))
    return d.groupBy(key).agg(*aggs)


# ---------------------------------------------------------------------------- joins

def with_weather(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Every meter-day with its day's weather, null where the day is missing. Catalyst broadcasts
    the weather side when its measured size allows, and joins by shuffle otherwise."""
    return daily.join(weather, "date", "left")


def with_holidays(daily: DataFrame, holidays: DataFrame) -> DataFrame:
    days = holidays.select("date").distinct().withColumn("_h", F.lit(1))
    return (daily.join(days, "date", "left")
            .withColumn("is_holiday", F.coalesce("_h", F.lit(0))).drop("_h"))


def with_household(daily: DataFrame, household: DataFrame) -> DataFrame:
    return daily.join(household, "meter_id")


def with_hh(daily: DataFrame, hh: DataFrame) -> DataFrame:
    return daily.join(hh, ["meter_id", "date"], "left")


# ---------------------------------------------------------------------------- calendar, weather

def calendar_parts(df: DataFrame, date: str = "date", holidays: DataFrame | None = None) -> DataFrame:
    d = F.col(date)
    month_sin, month_cos = X.cyclical(F.month(d), 12)
    day_sin, day_cos = X.cyclical(F.weekday(d), 7)
    out = df.withColumns({
        "month": F.month(d), "quarter": F.quarter(d), "season": X.season(F.month(d)),
        "day_of_week": F.weekday(d) + 1, "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "sin_month": month_sin, "cos_month": month_cos, "sin_day": day_sin, "cos_day": day_cos})
    return with_holidays(out, holidays) if holidays is not None else out


def weather_features(df: DataFrame, heating_below: float = 15.5) -> DataFrame:
    """Derived weather columns; needs the daily weather columns and cos_month."""
    hi, lo = F.col("temperatureMax"), F.col("temperatureMin")
    avg = (hi + lo) / 2
    out = df.withColumns({"temp_avg": avg, "temp_range": hi - lo})
    t = F.col("temp_avg")
    return out.withColumns({
        "temp2": t * t, "temp_pressure": t * F.col("pressure"), "temp_wind": t * F.col("windSpeed"),
        "heat_index": t * F.col("humidity"), "temp_x_cos_month": t * F.col("cos_month"),
        "temp2_x_cos_month": t * t * F.col("cos_month"),
        "is_heating_season": (t < heating_below).cast("int")})


def thermal_bins(df: DataFrame, temperature: Column | str, value: str, edges: Sequence[float],
                 labels: Sequence[str]) -> DataFrame:
    """Mean, sd and count of a value per temperature bin; rows without a temperature are left out."""
    return (df.select(X.band(temperature, edges, labels).alias("bin"), F.col(value).alias("v"))
            .where(F.col("bin").isNotNull()).groupBy("bin")
            .agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.count("v").alias("count")))


# ---------------------------------------------------------------------------- cleaning

def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null values take the column's exact median."""
    cuts = fit_quantiles(df, cols, {"median": 0.5})
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(cuts[c]["median"])) for c in cols})


def winsorize(df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Values beyond the exact lo/hi quantiles are pulled in to them; nulls stay."""
    cuts = fit_quantiles(df, cols, {"lo": lo, "hi": hi})

    def clip(c: str) -> Column:
        low, high = cuts[c]["lo"], cuts[c]["hi"]
        if low is None:
            return F.col(c)
        return F.when(F.col(c) < low, F.lit(low)).when(F.col(c) > high, F.lit(high)).otherwise(F.col(c))

    return df.withColumns({c: clip(c) for c in cols})


def complete_rows(df: DataFrame, cols: Sequence[str], min_present: float = 1.0) -> DataFrame:
    """Rows whose share of non-null values among `cols` reaches `min_present`."""
    present = sum((F.col(c).isNotNull().cast("int") for c in cols[1:]), F.col(cols[0]).isNotNull().cast("int"))
    return df.where(present >= F.lit(min_present * len(cols)))


def drop_outliers(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Rows within k interquartile ranges of the quartiles (both ends kept)."""
    cut = fit_quantiles(df, [col], {"q1": 0.25, "q3": 0.75})[col]
    if cut["q1"] is None:
        return df.limit(0)
    reach = (cut["q3"] - cut["q1"]) * k
    return df.where(F.col(col).between(cut["q1"] - reach, cut["q3"] + reach))


# ---------------------------------------------------------------------------- feature table

# --- fixed values: lag and rolling depths of the daily features -----------------------------
LAGS = {"energy_sum": [1, 2, 7], "energy_mean": [1, 2, 3, 7], "energy_max": [1, 7]}
LAG_NAMES = {"energy_sum": "sum", "energy_mean": "mean", "energy_max": "max"}
ROLLING = {"mean": [7, 14, 30], "std": [7]}


def meter_lags(daily: DataFrame, calendar: bool = False, **blocks) -> DataFrame:
    """Lag columns of the daily table. A meter has one row per day, so a series is as long as the
    calendar and is not split; pass block_rows and chunk to split it."""
    return seq.add_lags(daily, ["meter_id"], "date", LAGS, LAG_NAMES, calendar=calendar, **blocks)


def meter_rolling(daily: DataFrame, include_current: bool = False, **blocks) -> DataFrame:
    return seq.add_rolling(daily, ["meter_id"], "date", "energy_sum", ROLLING, include_current, **blocks)


def next_day(daily: DataFrame, col: str = "energy_sum", **blocks) -> DataFrame:
    return seq.add_lead(daily, ["meter_id"], "date", col, 1, "target", **blocks)


def feature_table(daily: DataFrame, hh: DataFrame | None = None, weather: DataFrame | None = None,
                  holidays: DataFrame | None = None, household: DataFrame | None = None) -> DataFrame:
    """All daily features: lags, rolling statistics, ratios, calendar, and the given tables.

    Lags, rolling statistics and the next-day target share one ordering of each meter's days.
    """
    out = seq.add_sequences(intraday_ratios(daily), ["meter_id"], ["date"], [
        seq.lags(LAGS, LAG_NAMES), seq.rolling("energy_sum", ROLLING), seq.lead("energy_sum", 1, "target")])
    if hh is not None:
        out = with_hh(out, hh)
    if weather is not None:
        out = with_weather(out, weather)
    out = calendar_parts(out, "date", holidays)
    if household is not None:
        out = with_household(out, household)
    return out

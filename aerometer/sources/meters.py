"""CSV loads of the meter data: half-hour blocks, weather, households, holidays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer import schemas as S
from aerometer.sources.files import read_csv

#: Header names of the files by column.
METER_NAMES = {"LCLid": "meter_id", "day": "date"}
HOUSEHOLD_NAMES = {"LCLid": "meter_id", "stdorToU": "tariff", "Acorn_grouped": "social_group"}
HOLIDAY_NAMES = {"Bank holidays": "date", "Type": "name"}
SLOTS = [f"hh_{k}" for k in range(48)]
#: The hours that count as day for the daytime high and, from the evening on, the overnight low.
DAY_HOURS = (6, 18)


def daily_blocks(spark: SparkSession, location: str | list[str]) -> DataFrame:
    return read_csv(spark, location, S.METER_DAILY, METER_NAMES)


def households(spark: SparkSession, location: str | list[str]) -> DataFrame:
    return read_csv(spark, location, S.HOUSEHOLD, HOUSEHOLD_NAMES)


def holidays(spark: SparkSession, location: str | list[str]) -> DataFrame:
    return read_csv(spark, location, S.HOLIDAY, HOLIDAY_NAMES)


def hourly_weather(spark: SparkSession, location: str | list[str]) -> DataFrame:
    return read_csv(spark, location, S.WEATHER_HOURLY)


def half_hour_blocks(spark: SparkSession, location: str | list[str]) -> DataFrame:
    """Wide block files (a row per meter and day, 48 slot columns) as meter_id, date, slot, ts, energy.

    Slots are found by each file's own header; a slot without a readable number, or that the file lacks,
    gives no row. Rows without a meter or a day are left out.
    """
    wide = read_csv(spark, location, "meter_id string, date date, " + ", ".join(f"{s} double" for s in SLOTS), METER_NAMES)
    long = wide.where("meter_id IS NOT NULL AND date IS NOT NULL").unpivot(["meter_id", "date"], SLOTS, "name", "energy")
    slot = F.substring("name", 4, 2).cast("int")
    return long.where("energy IS NOT NULL").select(
        "meter_id", "date", slot.alias("slot"),
        (F.col("date").cast("timestamp") + F.make_dt_interval(mins=slot * 30)).alias("ts"), "energy")


def weather_by_day(hourly: DataFrame) -> DataFrame:
    """Hourly weather rolled up to the columns of daily weather, in one grouping.

    The high is that of the day's hours, the low that of the night after it, so the hours before morning
    count for the low of the day before; days that have only such hours are left out. The wind's bearing
    is the mean direction. Hourly files have no cloud cover: it is null.
    """
    begins, ends = DAY_HOURS
    hour, day = F.hour("time"), F.to_date("time")
    # an hour before morning goes to its own day and, as part of the night, to the day before
    to = F.when(hour < begins, F.array(F.struct(day.alias("date"), F.lit(True).alias("own")),
                                       F.struct(F.date_sub(day, 1).alias("date"), F.lit(False).alias("own")))).otherwise(
        F.array(F.struct(day.alias("date"), F.lit(True).alias("own"))))
    sent = hourly.where("time IS NOT NULL").select("*", F.inline(to))
    mine = lambda c: F.when(F.col("own"), F.col(c))
    turn = lambda f: F.avg(F.when(F.col("own"), f(F.radians("windBearing"))))
    night = ~F.col("own") | (hour >= ends)
    out = sent.groupBy("date").agg(
        F.max(mine("temperature")).alias("temperatureMax"), F.min(mine("temperature")).alias("temperatureMin"),
        F.max(F.when(F.col("own") & (hour >= begins) & (hour < ends), F.col("temperature"))).alias("temperatureHigh"),
        F.min(F.when(night, F.col("temperature"))).alias("temperatureLow"),
        F.avg(mine("humidity")).alias("humidity"), F.lit(None).cast("double").alias("cloudCover"),
        F.avg(mine("pressure")).alias("pressure"), F.avg(mine("windSpeed")).alias("windSpeed"),
        F.pmod(F.degrees(F.atan2(turn(F.sin), turn(F.cos))), F.lit(360.0)).alias("windBearing"),
        F.avg(mine("dewPoint")).alias("dewPoint"), F.count(F.when(F.col("own"), 1)).alias("_hours"))
    return out.where("_hours > 0").select(*[n for n, _ in S.fields(S.WEATHER_DAILY)])

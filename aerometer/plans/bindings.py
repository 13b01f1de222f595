"""The engine's views over the given star-schema tables, as DataFrames and as SQL.

Each view exists twice: `flights(...)`, `meter_daily(...)` ... build it with Spark, and the `*_SQL`
texts say the same for a second engine. Views read and join only what the asked columns need.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer.functions import scalars as X
from aerometer.operators import features as ft

# Stand-ins for the focus country, the region members and the holidays in the given tables.
FOCUS = "NATION_4"
REGION = ["NATION_4", "NATION_9", "NATION_14", "NATION_19", "NATION_24"]
HOLIDAYS = ["2024-01-01", "2024-01-26"]
DAY_S = 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FLIGHT_COLUMNS = {
    "icao24": "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))",
    "callsign": "p_brand",
    "origin_country": "n_name",
    "time_position": "unix_seconds(cast(l_shipdate as timestamp))",
    "longitude": "cast(l_partkey % 360 - 180 as double)",
    "latitude": "cast(l_suppkey % 180 - 90 as double)",
    "altitude_meters": "case when l_tax = 0 then null else l_extendedprice / 10 end",
    "altitude_feet": "round((case when l_tax = 0 then null else l_extendedprice / 10 end) * 3.28084D, 0)",
    "on_ground": "case when l_returnflag = 'A' and l_linenumber = 1 then null else l_returnflag = 'R' end",
    "velocity_ms": "l_quantity * 25 / 3.6D",
    "velocity_kmh": "l_quantity * 25",
    "true_track": "cast(l_suppkey % 360 as double)",
    "vertical_rate": "(l_discount - 0.05D) * 100",
    "geo_altitude_meters": "case when l_linenumber = 3 then null else l_extendedprice / 10 + 50 end",
    "squawk": "case when l_linenumber = 2 then null else lpad(cast(l_partkey % 10000 as string), 4, '0') end",
    "processing_time_ms": "unix_millis(cast(l_shipdate as timestamp)) + l_linenumber",
    "cycle": "year(l_shipdate) * 12 + month(l_shipdate)",
    "ts": "cast(l_shipdate as timestamp)",
}


def flights(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None, since: dt.datetime | None = None,
            countries: Sequence[str] | None = None) -> DataFrame:
    """Flight records from line items. Country and call sign need the order and part tables; they
    are joined only when asked for. Every line item has one order and one part. `since` and `countries`
    leave out other line items and nations before anything is joined."""
    columns = list(columns or FLIGHT_COLUMNS)
    return lineitem_with(spark, sf_dir, "origin_country" in columns or countries is not None, "callsign" in columns, since, countries).select(
        *[F.expr(FLIGHT_COLUMNS[c]).alias(c) for c in columns])


def lineitem_with(spark: SparkSession, sf_dir: str, country: bool, brand: bool, since: dt.datetime | None = None,
                  countries: Sequence[str] | None = None) -> DataFrame:
    out = table(spark, sf_dir, "lineitem")
    if since is not None:
        # a literal of the column's own type reaches the scan
        out = out.where(F.col("l_shipdate") >= F.expr(f"{dict(out.dtypes)['l_shipdate']}'{since:%Y-%m-%d %H:%M:%S}'"))
    if country:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        nation = nation if countries is None else nation.where(F.col("n_name").isin(list(countries)))
        home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
        owner = orders.join(home, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "n_name")
        out = out.join(owner, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    if brand:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        out = out.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    return out


def label(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Country and call sign for a few line items (l_orderkey, l_partkey): the large tables are joined
    to these rows only."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("origin_country"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("callsign"))
    return (rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(part, F.col("l_partkey") == F.col("p_partkey")))


FLIGHTS_SQL = """flights AS (
  SELECT cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) AS icao24,
    p_brand AS callsign, n_name AS origin_country,
    cast(epoch(l_shipdate) as bigint) AS time_position,
    cast(l_partkey % 360 - 180 as double) AS longitude,
    cast(l_suppkey % 180 - 90 as double) AS latitude,
    CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice / 10 END AS altitude_meters,
    round((CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice / 10 END) * 3.28084::double, 0) AS altitude_feet,
    CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN NULL ELSE l_returnflag = 'R' END AS on_ground,
    l_quantity * 25 / 3.6::double AS velocity_ms, l_quantity * 25 AS velocity_kmh,
    cast(l_suppkey % 360 as double) AS true_track,
    (l_discount - 0.05::double) * 100 AS vertical_rate,
    CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice / 10 + 50 END AS geo_altitude_meters,
    CASE WHEN l_linenumber = 2 THEN NULL ELSE lpad(cast(l_partkey % 10000 as varchar), 4, '0') END AS squawk,
    epoch_ms(l_shipdate) + l_linenumber AS processing_time_ms,
    cast(year(l_shipdate) * 12 + month(l_shipdate) as integer) AS cycle,
    l_shipdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""

FOCUS_SQL = f"'{FOCUS}'"
REGION_SQL = "(" + ", ".join(f"'{c}'" for c in REGION) + ")"
AIR_SQL = "NOT coalesce(on_ground, false)"


# ---------------------------------------------------------------------------- meters

def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter readings from events: one meter per user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("meter_id"), "ts", F.col("value").alias("energy"), "event_id")


def meter_hh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select(
        "meter_id", F.to_date("ts").alias("date"), X.half_hour_slot("ts").alias("slot"), "energy")


def meter_daily(spark: SparkSession, sf_dir: str, median: bool = False) -> DataFrame:
    return ft.daily_stats(readings(spark, sf_dir), median=median)


METER_SQL = """readings AS (
  SELECT cast(user_id as varchar) AS meter_id, ts, cast(ts as date) AS date,
    cast(hour(ts) * 2 + floor(minute(ts) / 30) as integer) AS slot, value AS energy, event_id FROM events),
meter_daily AS (
  SELECT meter_id, date, avg(energy) AS energy_mean, max(energy) AS energy_max, min(energy) AS energy_min,
    sum(energy) AS energy_sum, stddev_samp(energy) AS energy_std, cast(count(energy) as integer) AS energy_count,
    quantile_cont(energy, 0.5) AS energy_median
  FROM readings GROUP BY meter_id, date)"""


def household(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("meter_id"), F.col("c_mktsegment").alias("social_group"),
        F.when(F.col("c_custkey") % 5 == 0, "ToU").otherwise("Std").alias("tariff"))


HOUSEHOLD_SQL = """household AS (
  SELECT cast(c_custkey as varchar) AS meter_id, c_mktsegment AS social_group,
    CASE WHEN c_custkey % 5 = 0 THEN 'ToU' ELSE 'Std' END AS tariff FROM customer)"""


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """28 days of weather, each from all customers whose key falls on it; the last two days of the
    readings have none. Sums are in whole cents, so they do not depend on the order of rows."""
    cents = F.sum(F.round(F.col("c_acctbal") * 100).cast("bigint"))
    c = table(spark, sf_dir, "customer").groupBy((F.col("c_custkey") % 28).alias("k")).agg(
        cents.alias("cents"), F.count("*").alias("n"))
    k, top = F.col("k"), F.col("cents") / F.col("n") / 40000
    return c.select(
        F.date_add(F.lit("2024-01-01").cast("date"), k.cast("int")).alias("date"),
        top.alias("temperatureMax"), (top - 5 - k % 3).alias("temperatureMin"),
        (top - 0.5).alias("temperatureHigh"), (top - 4).alias("temperatureLow"),
        (F.lit(0.5) + (k % 10) * F.lit(0.03)).alias("humidity"), ((k % 4) * F.lit(0.25)).alias("cloudCover"),
        (F.lit(1000.0) + k % 25).alias("pressure"), (k % 7).cast("double").alias("windSpeed"),
        ((k * 37) % 360).cast("double").alias("windBearing"), (top - 6).alias("dewPoint"))


WEATHER_SQL = """weather_daily AS (
  SELECT DATE '2024-01-01' + cast(k as integer) AS date, top AS "temperatureMax",
    top - 5 - k % 3 AS "temperatureMin", top - 0.5::double AS "temperatureHigh",
    top - 4 AS "temperatureLow", 0.5::double + (k % 10) * 0.03::double AS humidity,
    (k % 4) * 0.25::double AS "cloudCover", 1000.0::double + k % 25 AS pressure,
    cast(k % 7 as double) AS "windSpeed", cast((k * 37) % 360 as double) AS "windBearing",
    top - 6 AS "dewPoint"
  FROM (SELECT c_custkey % 28 AS k,
      cast(sum(cast(round(c_acctbal * 100) AS bigint)) AS double) / count(*) / 40000 AS top FROM customer GROUP BY 1))"""


def holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d,) for d in HOLIDAYS], "date string").select(F.to_date("date").alias("date"))


HOLIDAY_SQL = "holiday AS (SELECT unnest([DATE '2024-01-01', DATE '2024-01-26']) AS date)"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

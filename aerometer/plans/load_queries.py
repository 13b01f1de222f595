"""CSV loads, the sectioned log and resuming from storage, over files that the queries write from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometer.operators import flights as fl
from aerometer.plans import bindings as b
from aerometer.plans.flight_queries import FL
from aerometer.plans.meter_queries import M, rounded
from aerometer.plans.registry import register
from aerometer.session import work_dir
from aerometer.sinks import reports
from aerometer.sources import files, meters, records


def csv_files(df: DataFrame, name: str, quoted: bool = False) -> str:
    path = work_dir(df.sparkSession, name)
    df.write.option("header", True).option("quoteAll", quoted).csv(path)
    return path


def half_hour_load(s, d):
    """Readings as wide blocks, one file set per part of the meters, each with its own order of columns."""
    wide = (b.meter_hh(s, d).groupBy(F.col("meter_id").alias("LCLid"), F.col("date").alias("day"))
            .pivot("slot", list(range(48))).agg(F.sum("energy")))
    wide = wide.select("LCLid", "day", *[F.col(str(k)).alias(f"hh_{k}") for k in range(48)])
    part = F.pmod(F.col("LCLid").cast("int"), F.lit(3))
    orders = (wide.columns, wide.columns[::-1], ["hh_1", "LCLid", *[c for c in wide.columns if c not in ("hh_1", "LCLid")]])
    paths = [csv_files(wide.where(part == k).select(*cols), f"half-hours-{k}", quoted=k == 2) for k, cols in enumerate(orders)]
    rows = meters.half_hour_blocks(s, paths)
    return rounded(rows.groupBy("meter_id", "slot").agg(
        F.count(F.lit(1)).alias("days"), F.sum("energy").alias("energy"), F.unix_millis(F.max("ts")).alias("last")), ["energy"])


register("half_hour_load", half_hour_load,
         M + """SELECT meter_id, slot, count(*) AS days, round(sum(energy), 6) AS energy,
           epoch_ms(max(cast(date AS timestamp) + slot * INTERVAL 30 MINUTE)) AS last
         FROM (SELECT meter_id, date, slot, sum(energy) AS energy FROM readings GROUP BY 1, 2, 3) GROUP BY 1, 2""")


def hourly_rows(s, d):
    """Weather of every hour that has events, from their number and the sum of their values in whole cents."""
    per = b.table(s, d, "events").groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("time")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
    n, t = F.col("n"), F.col("cents") / F.col("n") / 1000
    return per.select(
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), t.alias("temperature"), ((n % 10) * F.lit(0.05)).alias("humidity"),
        (F.lit(1000.0) + n % 25).alias("pressure"), (n % 7).cast("double").alias("windSpeed"),
        ((n * 37) % 360).cast("double").alias("windBearing"), (t - 5).alias("dewPoint"), F.lit("clear").alias("summary"))


WEATHER_VALUES = ["temperatureMax", "temperatureMin", "temperatureHigh", "temperatureLow", "humidity", "pressure", "windSpeed", "dewPoint"]


def hourly_weather_load(s, d):
    daily = meters.weather_by_day(meters.hourly_weather(s, csv_files(hourly_rows(s, d), "hourly-weather")))
    return rounded(daily.withColumn("windBearing", F.round("windBearing", 4) % 360), WEATHER_VALUES)


register("hourly_weather_load", hourly_weather_load,
         """WITH hours AS (SELECT *, cast(time AS date) AS day, hour(time) AS h, cents / n / 1000 AS t FROM (
           SELECT date_trunc('hour', ts) AS time, count(*) AS n, cast(sum(cast(round(value * 100) AS bigint)) AS double) AS cents
           FROM events GROUP BY 1)), night AS (
           SELECT CASE WHEN h < 6 THEN day - 1 ELSE day END AS day, min(t) AS low FROM hours WHERE h < 6 OR h >= 18 GROUP BY 1)
         SELECT cast(day AS date) AS date, round(max(t), 6) AS "temperatureMax", round(min(t), 6) AS "temperatureMin",
           round(max(t) FILTER (WHERE h >= 6 AND h < 18), 6) AS "temperatureHigh", round(any_value(low), 6) AS "temperatureLow",
           round(avg((n % 10) * 0.05::double), 6) AS humidity, NULL::double AS "cloudCover", round(avg(1000.0::double + n % 25), 6) AS pressure,
           round(avg((n % 7)::double), 6) AS "windSpeed", round((degrees(atan2(avg(sin(radians((n * 37) % 360))),
             avg(cos(radians((n * 37) % 360))))) + 360) % 360, 4) % 360 AS "windBearing", round(avg(t - 5), 6) AS "dewPoint"
         FROM hours LEFT JOIN night USING (day) GROUP BY day""")


def household_load(s, d):
    rows = b.household(s, d).select(F.col("social_group").alias("Acorn_grouped"), F.lit("block").alias("file"),
                                    F.col("tariff").alias("stdorToU"), F.col("meter_id").alias("LCLid"))
    return meters.households(s, csv_files(rows, "households")).groupBy("tariff", "social_group").agg(
        F.count(F.lit(1)).alias("meters"), F.max("meter_id").alias("last_meter"))


register("household_load", household_load,
         b.with_ctes(b.HOUSEHOLD_SQL) + "SELECT tariff, social_group, count(*) AS meters, max(meter_id) AS last_meter FROM household GROUP BY 1, 2")

#: Holidays by month and day in the given dates.
HOLIDAY_DAYS = {"01-01": "New Year's Day", "12-25": "Christmas, first day", "12-26": "Christmas, second day"}


def holiday_load(s, d):
    """Holidays among the ship dates, by a file whose names hold commas, joined with the flights of these days."""
    day = F.col("l_shipdate").cast("date")
    names = F.create_map(*[F.lit(x) for pair in HOLIDAY_DAYS.items() for x in pair])
    rows = (b.table(s, d, "lineitem").select(day.alias("Bank holidays")).distinct()
            .withColumn("Type", F.try_element_at(names, F.date_format("Bank holidays", "MM-dd"))).where("Type IS NOT NULL"))
    held = meters.holidays(s, csv_files(rows, "holidays", quoted=True))
    return held.join(b.table(s, d, "lineitem").select(day.alias("date")), "date").groupBy("date", "name").agg(F.count(F.lit(1)).alias("flights"))


register("holiday_load", holiday_load,
         "SELECT * FROM (SELECT cast(l_shipdate AS date) AS date, CASE strftime(l_shipdate, '%m-%d') "
         + " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in HOLIDAY_DAYS.items())
         + " END AS name, count(*) AS flights FROM lineitem GROUP BY 1, 2) WHERE name IS NOT NULL")

# ---- one file with headed sections


def sectioned_report(s, d):
    """A report of three sections written as one file and read back by its marks."""
    path = work_dir(s, "report")
    flights = b.flights(s, d, ["origin_country", "on_ground", "altitude_meters", "cycle"])
    countries, cycles = fl.country_metrics(flights), flights.groupBy("cycle").agg(F.count(F.lit(1)).alias("flights"))
    parts = b.table(s, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("parts"), F.min("p_name").alias("a name, quoted"))
    reports.write_report(s, path, "FLIGHT REPORT", {"Generated": "20240101_000000"}, {
        "COUNTRIES": (countries, [F.desc("flight_count"), "country"]), "CYCLES": (cycles, ["cycle"]), "PARTS: BY BRAND": (parts, ["p_brand"])})
    back = reports.read_report(s, path)
    one = reports.section(back, "COUNTRIES", "country string, flight_count bigint").select(
        F.lit("COUNTRIES").alias("name"), F.col("country").alias("key"), F.col("flight_count").alias("n"))
    two = reports.section(back, "CYCLES", "cycle string, flights bigint").select(F.lit("CYCLES"), "cycle", "flights")
    three = back.where("section = 3").select("name", F.concat_ws("/", F.col("cells")["p_brand"], F.col("cells")["a name, quoted"]),
                                             F.col("cells")["parts"].cast("bigint"))
    return one.union(two).union(three)


register("sectioned_report", sectioned_report,
         FL + """SELECT 'COUNTRIES' AS name, origin_country AS key, count(*) AS n FROM flights GROUP BY 2
           UNION ALL SELECT 'CYCLES', cast(cycle AS varchar), count(*) FROM flights GROUP BY 2
           UNION ALL SELECT 'PARTS: BY BRAND', p_brand || '/' || min(p_name), count(*) FROM part GROUP BY p_brand""")

# ---- resuming from what storage holds


def resumed_reads(s, d):
    """Logs by cycle arrive in two deliveries; each run reads the files that its store has not got yet, found by their
    names, and stores what it read under the same cycle."""
    base = work_dir(s, "resume")
    rows = b.flights(s, d, ["icao24", "velocity_kmh", "cycle"])
    middle = rows.agg(F.expr("(min(cycle) + max(cycle)) div 2")).first()[0] or 0
    name = F.concat(F.lit("flights_cycle-"), F.lpad(F.col("cycle").cast("string"), 6, "0"), F.lit(".log"))
    runs = []
    for part in (F.col("cycle") <= middle, F.col("cycle") > middle):
        (rows.where(part).select(F.to_json(F.struct(*rows.columns)).alias("value"), name.alias("log"))
         .write.mode("append").partitionBy("log").text(f"{base}/logs"))
        done = files.resume_point(s, {"totals": f"{base}/totals"}, "part-*")["totals"]
        if fresh := files.files_after(s, f"{base}/logs", done, "part-*"):
            read = records.parse_records(s.read.text(fresh))
            totals = read.groupBy("cycle").agg(F.count(F.lit(1)).alias("flights"), F.round(F.sum("velocity_kmh"), 1).alias("speed"))
            totals.withColumn("log", name).write.mode("append").partitionBy("log").parquet(f"{base}/totals")
        runs.append(done)
    out = s.read.parquet(f"{base}/totals").drop("log")
    return out.withColumn("run", F.when(F.col("cycle") > runs[1], 2).otherwise(1))


register("resumed_reads", resumed_reads,
         FL + """SELECT cycle, count(*) AS flights, round(sum(velocity_kmh), 1) AS speed,
           CASE WHEN cycle > (SELECT (min(cycle) + max(cycle)) // 2 FROM flights) THEN 2 ELSE 1 END AS run FROM flights GROUP BY cycle""")


def newest_log(s, d):
    """Where the newest of several logs holds all customers, its rows and not the others' are found."""
    base = work_dir(s, "logs")
    rows = b.table(s, d, "customer").select(F.to_json(F.struct(F.col("c_name").alias("icao24"), F.col("c_custkey").alias("cycle"))).alias("value"))
    for k, part in enumerate((rows.where("value IS NULL"), rows.limit(0), rows)):
        part.coalesce(4).write.text(f"{base}/log-{k}")
    newest = files.newest_log(s, [f"{base}/log-{k}" for k in range(3)], "part-*")
    log = records.parse_records(s.read.text(newest.rsplit("/", 1)[0]))
    return log.agg(F.count(F.lit(1)).alias("records"), F.max("cycle").alias("newest"))


register("newest_log", newest_log, "SELECT count(*) AS records, cast(max(c_custkey) AS integer) AS newest FROM customer")

"""Fleet statistics, top-k lists and the snapshot aggregate over the flight view."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerometer import constants as K
from aerometer.functions import scalars as X
from aerometer.operators import flights as fl
from aerometer.operators import points as pt
from aerometer.plans import bindings as b
from aerometer.plans.registry import register
from aerometer.sources import records

FL = b.with_ctes(b.FLIGHTS_SQL)
SUMMARY_COLS = ["origin_country", "on_ground", "altitude_meters", "altitude_feet", "velocity_kmh",
                "vertical_rate"]


def _band_sql(col: str, edges, labels) -> str:
    steps = " ".join(f"WHEN {col} < {e} THEN '{l}'" for e, l in zip(edges, labels))
    return f"CASE {steps} ELSE '{labels[-1]}' END"


ALT_BAND = _band_sql("altitude_feet", K.ALTITUDE_EDGES, K.ALTITUDE_LABELS)
SPEED_BAND = _band_sql("velocity_kmh", K.SPEED_EDGES, K.SPEED_LABELS)
CLIMB_BAND = "CASE WHEN vertical_rate > 1 THEN 'Climbing' WHEN vertical_rate < -1 THEN 'Descending' ELSE 'Level' END"
AIR = b.AIR_SQL

# ---- batch statistics

register("flight_general_stats",
         lambda s, d: fl.general_stats(b.flights(s, d, ["on_ground"])),
         FL + """SELECT count(*) AS total_flights, count(*) - count(*) FILTER (WHERE on_ground) AS flights_airborne,
           count(*) FILTER (WHERE on_ground) AS flights_on_ground,
           round(100.0::double * (count(*) - count(*) FILTER (WHERE on_ground)) / count(*), 2) AS airborne_percentage FROM flights""")


def _focus_sql(air: str) -> str:
    return FL + f"""SELECT count(*) FILTER (WHERE origin_country = {b.FOCUS_SQL}) AS total_flights,
      count(*) FILTER (WHERE origin_country = {b.FOCUS_SQL} AND {air}) AS flights_airborne,
      count(*) FILTER (WHERE origin_country = {b.FOCUS_SQL}) - count(*) FILTER (WHERE origin_country = {b.FOCUS_SQL} AND {air}) AS flights_on_ground,
      round(100.0::double * count(*) FILTER (WHERE origin_country = {b.FOCUS_SQL}) / count(*), 2) AS percentage_of_total,
      round(coalesce(avg(altitude_meters) FILTER (WHERE origin_country = {b.FOCUS_SQL}), 0), 2) AS avg_altitude_m,
      round(coalesce(max(altitude_meters) FILTER (WHERE origin_country = {b.FOCUS_SQL}), 0), 2) AS max_altitude_m,
      round(coalesce(avg(velocity_kmh) FILTER (WHERE origin_country = {b.FOCUS_SQL}), 0), 2) AS avg_velocity_kmh,
      round(coalesce(max(velocity_kmh) FILTER (WHERE origin_country = {b.FOCUS_SQL}), 0), 2) AS max_velocity_kmh
      FROM flights"""


FOCUS_COLS = ["origin_country", "on_ground", "altitude_meters", "velocity_kmh"]
register("flight_focus_stats",
         lambda s, d: fl.focus_stats(b.flights(s, d, FOCUS_COLS), b.FOCUS), _focus_sql(AIR))
register("flight_focus_stats_null_ground",
         lambda s, d: fl.focus_stats(b.flights(s, d, FOCUS_COLS), b.FOCUS, null_on_ground="ground"),
         _focus_sql("on_ground = false"))
register("flight_focus_stats_absent",
         lambda s, d: fl.focus_stats(b.flights(s, d, FOCUS_COLS), "Nowhere"),
         _focus_sql(AIR).replace(b.FOCUS_SQL, "'Nowhere'"))

register("flight_altitude_stats",
         lambda s, d: fl.altitude_stats(b.flights(s, d, ["altitude_meters"])),
         FL + """SELECT round(avg(altitude_meters), 2) AS avg_meters, round(max(altitude_meters), 2) AS max_meters,
           round(min(altitude_meters), 2) AS min_meters, round(stddev_samp(altitude_meters), 2) AS stddev_meters,
           round(avg(altitude_meters) * 3.28084::double, 2) AS avg_feet,
           round(max(altitude_meters) * 3.28084::double, 2) AS max_feet FROM flights""")
register("flight_velocity_stats",
         lambda s, d: fl.velocity_stats(b.flights(s, d, ["velocity_kmh"])),
         FL + """SELECT round(avg(velocity_kmh), 2) AS avg_kmh, round(max(velocity_kmh), 2) AS max_kmh,
           round(min(velocity_kmh), 2) AS min_kmh, round(stddev_samp(velocity_kmh), 2) AS stddev_kmh FROM flights""")
register("geo_bbox",
         lambda s, d: fl.geographic(b.flights(s, d, ["longitude", "latitude"])),
         FL + """SELECT round(avg(longitude), 4) AS center_longitude, round(avg(latitude), 4) AS center_latitude,
           round(min(longitude), 4) AS min_longitude, round(max(longitude), 4) AS max_longitude,
           round(min(latitude), 4) AS min_latitude, round(max(latitude), 4) AS max_latitude FROM flights""")

# ---- groups and distributions

register("flight_country_top10",
         lambda s, d: fl.country_top(b.flights(s, d, ["origin_country", "velocity_kmh", "altitude_meters"])),
         FL + """SELECT origin_country AS country, count(*) AS flight_count,
           round(avg(velocity_kmh), 2) AS avg_speed_kmh, round(avg(altitude_meters), 2) AS avg_altitude_m
           FROM flights GROUP BY origin_country ORDER BY flight_count DESC, country LIMIT 10""")
register("altitude_distribution",
         lambda s, d: fl.altitude_distribution(b.flights(s, d, ["altitude_feet"])),
         FL + f"""SELECT {ALT_BAND} AS category, count(*) AS count FROM flights
           WHERE altitude_feet IS NOT NULL GROUP BY 1""")
register("speed_distribution",
         lambda s, d: fl.speed_distribution(b.flights(s, d, ["velocity_kmh"])),
         FL + f"SELECT {SPEED_BAND} AS category, count(*) AS count FROM flights GROUP BY 1")
register("vertical_movement",
         lambda s, d: fl.vertical_movement(b.flights(s, d, ["vertical_rate"])),
         FL + f"""SELECT {CLIMB_BAND} AS movement, count(*) AS count FROM flights
           WHERE vertical_rate IS NOT NULL GROUP BY 1""")

# ---- top-k



def _top_items(s, d, col):
    """The ten line items with the greatest value, labelled afterwards; an aircraft has one line item,
    so call sign and country never decide."""
    names = ["icao24", "velocity_kmh", "altitude_meters", "altitude_feet"]
    items = b.table(s, d, "lineitem").select("l_orderkey", "l_partkey", *[F.expr(b.FLIGHT_COLUMNS[c]).alias(c) for c in names])
    return b.label(s, d, fl.top_k(items.where(F.col(col).isNotNull()), [F.desc(col), "icao24"], 10))


register("fastest10",
         lambda s, d: fl.fastest(_top_items(s, d, "velocity_kmh")),
         FL + """SELECT icao24, callsign, origin_country AS country, round(velocity_kmh, 2) AS speed_kmh,
           round(coalesce(altitude_feet, 0), 2) AS altitude_ft FROM flights
           ORDER BY velocity_kmh DESC, icao24, callsign, origin_country, altitude_feet NULLS FIRST LIMIT 10""")
register("highest10",
         lambda s, d: fl.highest(_top_items(s, d, "altitude_meters")),
         FL + """SELECT icao24, callsign, origin_country AS country, round(altitude_meters, 2) AS altitude_m,
           round(altitude_meters * 3.28084::double, 2) AS altitude_ft, round(velocity_kmh, 2) AS speed_kmh
           FROM flights WHERE altitude_meters IS NOT NULL
           ORDER BY altitude_meters DESC, icao24, callsign, origin_country, velocity_kmh LIMIT 10""")
register("top3_countries",
         lambda s, d: fl.top_countries(b.flights(s, d, ["origin_country"]), 3),
         FL + """SELECT origin_country AS country, count(*) AS count FROM flights GROUP BY 1
           ORDER BY count DESC, country LIMIT 3""")
register("top5_countries_per_cycle",
         lambda s, d: fl.top_countries(b.flights(s, d, ["origin_country", "cycle"]), 5, ["cycle"]),
         FL + """SELECT cycle, country, count FROM (
             SELECT cycle, origin_country AS country, count(*) AS count,
               row_number() OVER (PARTITION BY cycle ORDER BY count(*) DESC, origin_country) AS r
             FROM flights GROUP BY cycle, origin_country) WHERE r <= 5""")
register("highest_aircraft",
         lambda s, d: fl.arg_max(
             b.flights(s, d, ["icao24", "altitude_meters", "altitude_feet", "origin_country", "on_ground"])
             .where(X.in_air("on_ground")),
             F.coalesce("altitude_meters", F.lit(-999999.0)),
             ["icao24", "altitude_meters", "altitude_feet", "origin_country"]),
         FL + f"""SELECT icao24, altitude_meters, altitude_feet, origin_country FROM flights WHERE {AIR}
           ORDER BY coalesce(altitude_meters, -999999) DESC, icao24 DESC LIMIT 1""")
register("sample_details",
         lambda s, d: fl.sample_rows(
             b.flights(s, d, ["icao24", "cycle", "velocity_kmh", "altitude_meters", "time_position", "longitude",
                              "latitude"]),
             ["icao24", "cycle", "time_position", "velocity_kmh", "altitude_meters", "longitude", "latitude"], 100),
         FL + """SELECT icao24, cycle, velocity_kmh, altitude_meters, time_position, longitude, latitude FROM flights
           ORDER BY icao24, cycle, time_position, velocity_kmh, altitude_meters NULLS FIRST, longitude, latitude
           LIMIT 100""")

# ---- streaming summary rules, over all rows, per cycle, and for the latest cycle

PIPELINE_SQL = f"""count(*) AS total_flights, count(*) FILTER (WHERE {AIR}) AS in_air,
  count(*) - count(*) FILTER (WHERE {AIR}) AS on_ground,
  round(coalesce(avg(altitude_meters) FILTER (WHERE {AIR}), 0), 1) AS avg_altitude_meters,
  round(coalesce(avg(velocity_kmh) FILTER (WHERE {AIR} AND velocity_kmh <= 1200), 0), 1) AS avg_velocity_kmh,
  round(coalesce(max(velocity_kmh) FILTER (WHERE {AIR} AND velocity_kmh <= 1200), 0), 1) AS max_velocity_kmh"""
SUMMARY = ["origin_country", "on_ground", "altitude_meters", "velocity_kmh"]
NO_COUNTRY = ["on_ground", "altitude_meters", "velocity_kmh"]


def summary_input(s, d, *extra, since=None):
    """The summary measurement itself never looks at the country, so it is not joined in."""
    return (b.flights(s, d, [*NO_COUNTRY, *extra], since)
            .withColumns({"origin_country": F.lit(None).cast("string"), "vertical_rate": F.lit(0.0),
                          "altitude_feet": F.lit(None).cast("double")}))


register("pipeline_summary", lambda s, d: fl.pipeline_summary(summary_input(s, d)),
         FL + f"SELECT {PIPELINE_SQL} FROM flights")
register("pipeline_summary_per_cycle",
         lambda s, d: fl.pipeline_summary(summary_input(s, d, "cycle"), by=["cycle"]),
         FL + f"SELECT cycle, {PIPELINE_SQL} FROM flights GROUP BY cycle")
register("pipeline_summary_latest_cycle",
         lambda s, d: fl.pipeline_summary(fl.latest_cycle(summary_input(s, d, "cycle"))),
         FL + f"SELECT {PIPELINE_SQL} FROM flights WHERE cycle = (SELECT max(cycle) FROM flights)")
register("pipeline_summary_all_rows",
         lambda s, d: fl.pipeline_summary(summary_input(s, d), cap=None, airborne_only=False),
         FL + f"""SELECT count(*) AS total_flights, count(*) FILTER (WHERE {AIR}) AS in_air,
           count(*) - count(*) FILTER (WHERE {AIR}) AS on_ground, round(avg(altitude_meters), 1) AS avg_altitude_meters,
           round(avg(velocity_kmh), 1) AS avg_velocity_kmh, round(max(velocity_kmh), 1) AS max_velocity_kmh
           FROM flights""")
register("focus_climb",
         lambda s, d: fl.focus_climb(b.flights(s, d, SUMMARY_COLS), b.FOCUS),
         FL + f"""SELECT count(*) FILTER (WHERE vertical_rate > 1) AS "Climbing", count(*) FILTER (WHERE vertical_rate < -1) AS "Descending",
           count(*) FILTER (WHERE NOT (vertical_rate > 1 OR vertical_rate < -1)) AS "Level" FROM flights
           WHERE origin_country = {b.FOCUS_SQL}""")
register("focus_bands",
         lambda s, d: fl.focus_bands(b.flights(s, d, SUMMARY_COLS), b.FOCUS),
         FL + f"""SELECT count(*) FILTER (WHERE altitude_feet < 10000) AS "{K.ALTITUDE_LABELS[0]}",
           count(*) FILTER (WHERE altitude_feet >= 10000 AND altitude_feet < 30000) AS "{K.ALTITUDE_LABELS[1]}",
           count(*) FILTER (WHERE altitude_feet >= 30000) AS "{K.ALTITUDE_LABELS[2]}" FROM flights
           WHERE origin_country = {b.FOCUS_SQL}""")
register("region_summary",
         lambda s, d: fl.region_summary(b.flights(s, d, SUMMARY_COLS), b.REGION),
         FL + f"""SELECT count(*) AS total_flights, count(*) FILTER (WHERE {AIR}) AS in_air FROM flights
           WHERE origin_country IN {b.REGION_SQL}""")
register("focus_summary",
         lambda s, d: fl.focus_summary(b.flights(s, d, SUMMARY_COLS), b.FOCUS),
         FL + f"""SELECT count(*) AS total_flights, count(*) FILTER (WHERE {AIR}) AS in_air FROM flights
           WHERE origin_country = {b.FOCUS_SQL}""")
COUNTRY_COLS = ["origin_country", "on_ground", "altitude_meters"]
register("region_by_country",
         lambda s, d: fl.region_by_country(b.flights(s, d, COUNTRY_COLS), b.REGION),
         FL + f"""SELECT origin_country AS country, count(*) AS flight_count, count(*) FILTER (WHERE {AIR}) AS in_air,
           round(coalesce(avg(altitude_meters), 0), 1) AS avg_altitude_meters FROM flights
           WHERE origin_country IN {b.REGION_SQL} GROUP BY 1""")
register("region_semi_join",
         lambda s, d: fl.country_counts(fl.in_region(
             b.flights(s, d, COUNTRY_COLS),
             b.table(s, d, "nation").join(b.table(s, d, "region").where("r_name = 'MIDDLE EAST'"),
                                          F.col("n_regionkey") == F.col("r_regionkey")).select("n_name"))),
         FL + """SELECT origin_country AS country, count(*) AS flight_count FROM flights
           WHERE origin_country IN (SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey
             WHERE r_name = 'MIDDLE EAST') GROUP BY 1""")
register("country_counts",
         lambda s, d: fl.country_counts(b.flights(s, d, COUNTRY_COLS)),
         FL + "SELECT origin_country AS country, count(*) AS flight_count FROM flights GROUP BY 1")

# ---- snapshot aggregate

SNAP_COLS = ["icao24", "callsign", "origin_country", "on_ground", "altitude_meters", "altitude_feet",
             "velocity_ms", "velocity_kmh", "cycle"]


def _snapshot_per_cycle(s, d):
    agg = fl.snapshot_aggregate(b.flights(s, d, SNAP_COLS), by=["cycle"], now=F.expr("timestamp'2024-01-02 03:04:05.678901'"))
    top = F.transform("top_countries", lambda t: F.concat_ws(":", t["country"], t["count"].cast("string")))
    return agg.select(
        "cycle", "timestamp", "total_flights", "in_air", "on_ground", "avg_altitude_meters", "avg_altitude_feet",
        "max_altitude_meters", "avg_velocity_kmh", "max_velocity_kmh",
        F.concat_ws(",", top).alias("top_countries"),
        F.round("highest_aircraft.altitude_meters", 3).alias("highest_altitude"),
        F.col("highest_aircraft.callsign").alias("highest_callsign"),
        F.round("highest_aircraft.altitude_feet", 2).alias("highest_feet"),
        F.col("highest_aircraft.country").alias("highest_country"), "data_quality.*")


register("snapshot_aggregate", _snapshot_per_cycle,
         FL + f""", tops AS (SELECT cycle, string_agg(country || ':' || n, ',' ORDER BY n DESC, country) AS top_countries
           FROM (SELECT cycle, origin_country AS country, count(*) AS n,
               row_number() OVER (PARTITION BY cycle ORDER BY count(*) DESC, origin_country) AS r
             FROM flights GROUP BY 1, 2) WHERE r <= 5 GROUP BY cycle),
         highest AS (SELECT * FROM (SELECT cycle, callsign, altitude_meters, altitude_feet, origin_country,
             row_number() OVER (PARTITION BY cycle ORDER BY altitude_meters DESC NULLS LAST, icao24 DESC, callsign DESC,
               origin_country DESC) AS r
           FROM flights WHERE {AIR}) WHERE r = 1 AND altitude_meters IS NOT NULL)
         SELECT f.cycle, '2024-01-02T03:04:05.678901Z' AS timestamp, count(*) AS total_flights, count(*) FILTER (WHERE {AIR}) AS in_air,
           count(*) - count(*) FILTER (WHERE {AIR}) AS on_ground,
           round(coalesce(avg(f.altitude_meters) FILTER (WHERE {AIR}), 0), 0) AS avg_altitude_meters,
           round(coalesce(avg(f.altitude_meters) FILTER (WHERE {AIR}), 0) * 3.28084::double, 0) AS avg_altitude_feet,
           round(coalesce(max(f.altitude_meters) FILTER (WHERE {AIR}), 0), 0) AS max_altitude_meters,
           round(coalesce(avg(velocity_kmh) FILTER (WHERE {AIR}), 0), 1) AS avg_velocity_kmh,
           round(coalesce(max(velocity_kmh) FILTER (WHERE {AIR}), 0), 1) AS max_velocity_kmh,
           any_value(top_countries) AS top_countries,
           round(max(f.altitude_meters) FILTER (WHERE {AIR}), 3) AS highest_altitude,
           any_value(h.callsign) AS highest_callsign, round(any_value(h.altitude_feet), 2) AS highest_feet,
           any_value(h.origin_country) AS highest_country,
           count(*) AS has_position, count(f.altitude_meters) AS has_altitude, count(velocity_ms) AS has_velocity,
           count(*) FILTER (WHERE f.callsign <> 'UNKNOWN') AS has_callsign
         FROM flights f JOIN tops t ON f.cycle = t.cycle LEFT JOIN highest h ON f.cycle = h.cycle GROUP BY f.cycle""")
register("data_quality",
         lambda s, d: fl.data_quality(b.flights(s, d, ["altitude_meters", "velocity_ms", "callsign"])),
         FL + """SELECT count(*) AS has_position, count(altitude_meters) AS has_altitude,
           count(velocity_ms) AS has_velocity, count(*) FILTER (WHERE callsign <> 'UNKNOWN') AS has_callsign FROM flights""")
def _probe(s, d):
    out = fl.probe_summary(b.flights(s, d, ["longitude", "latitude", "on_ground", "origin_country"]))
    return out.withColumn("top_countries", F.concat_ws(",", F.transform(
        "top_countries", lambda t: F.concat_ws(":", t["country"], t["count"].cast("string")))))


register("probe_summary", _probe,
         FL + f"""SELECT (SELECT string_agg(c, ',') FROM (SELECT origin_country || ':' || count(*) AS c FROM flights GROUP BY origin_country
             ORDER BY count(*) DESC, origin_country LIMIT 5)) AS top_countries, count(*) AS total, count(*) FILTER (WHERE longitude IS NOT NULL AND latitude IS NOT NULL) AS with_position,
           round(100.0::double * count(*) FILTER (WHERE longitude IS NOT NULL AND latitude IS NOT NULL) / count(*), 1) AS position_share,
           count(*) FILTER (WHERE {AIR}) AS in_air, count(*) - count(*) FILTER (WHERE {AIR}) AS on_ground FROM flights""")
register("latest_cycle",
         lambda s, d: fl.max_cycle(b.flights(s, d, ["cycle"])),
         FL + "SELECT max(cycle) AS max_cycle FROM flights")
register("batch_timestamp",
         lambda s, d: fl.batch_timestamp(b.flights(s, d, ["processing_time_ms"]))
         .select(F.unix_millis("batch_time").alias("batch_ms")),
         FL + "SELECT min(processing_time_ms) AS batch_ms FROM flights")

# ---- projections and scalars

register("derived_flags",
         lambda s, d: records.derive_flags(
             b.flights(s, d, ["icao24", "origin_country", "altitude_meters", "altitude_feet", "velocity_ms",
                              "velocity_kmh"]), b.FOCUS)
         .groupBy("is_high_altitude", "is_fast", "is_focus")
         .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("altitude_km"), 4).alias("mean_km"),
              F.round(F.avg("velocity_kts"), 4).alias("mean_kts")),
         FL + f"""SELECT altitude_feet > 30000 AS is_high_altitude, velocity_kmh > 700 AS is_fast,
           origin_country = {b.FOCUS_SQL} AS is_focus, count(*) AS n,
           round(avg(altitude_meters / 1000.0::double), 4) AS mean_km,
           round(avg(velocity_ms * 1.944::double), 4) AS mean_kts FROM flights GROUP BY 1, 2, 3""")

DETAIL_COLS = ["icao24", "callsign", "origin_country", "on_ground", "squawk", *K.DETAIL_FIELDS.values()]
DETAIL_SQL = f"""SELECT icao24, callsign, origin_country AS country, substr(callsign, 1, 3) AS airline,
  CASE WHEN coalesce(on_ground, false) THEN 'True' ELSE 'False' END AS on_ground,
  CASE WHEN coalesce(on_ground, false) THEN 1.0::double ELSE 0.0::double END AS on_ground_num,
  round(altitude_meters, 4) AS altitude_m, altitude_feet AS altitude_ft, velocity_kmh, true_track,
  round(vertical_rate, 4) AS vertical_rate, longitude, latitude, round(geo_altitude_meters, 4) AS geo_altitude_m,
  squawk FROM flights"""


def _detail(s, d):
    out = pt.flight_detail(b.flights(s, d, DETAIL_COLS))
    return out.withColumns({c: F.round(c, 4) for c in ("altitude_m", "vertical_rate", "geo_altitude_m")})


register("flight_detail", _detail, FL + DETAIL_SQL)
register("focus_flight_detail", lambda s, d: _detail(s, d).where(F.col("country") == b.FOCUS),
         FL + DETAIL_SQL + f" WHERE origin_country = {b.FOCUS_SQL}")
register("scalar_functions",
         lambda s, d: b.flights(s, d, ["icao24", "callsign", "cycle", "time_position", "on_ground"]).groupBy(
             X.normalise_callsign(F.when(F.col("on_ground"), F.col("callsign"))).alias("callsign"),
             X.operator_code(F.concat(F.lit("X"), F.col("callsign"))).alias("operator"),
             X.zero_pad("cycle").alias("cycle_text"), X.epoch_iso("time_position").alias("day"),
             X.bool_tag("on_ground").alias("ground_tag"),
             X.safe_cast(F.element_at(F.split("icao24", "-"), -1), "int", 0).alias("line"),
             X.safe_cast("icao24", "double", -1.0).alias("unparsable")
         ).agg(F.count(F.lit(1)).alias("n")),
         FL + """SELECT CASE WHEN on_ground THEN callsign ELSE 'UNKNOWN' END AS callsign,
           substr('X' || callsign, 1, 3) AS operator, lpad(cast(cycle as varchar), 6, '0') AS cycle_text,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS day,
           CASE WHEN on_ground THEN 'True' WHEN NOT on_ground THEN 'False' END AS ground_tag,
           cast(split_part(icao24, '-', 2) as integer) AS line, -1.0::double AS unparsable, count(*) AS n
           FROM flights GROUP BY ALL""")

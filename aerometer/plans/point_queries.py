"""Measurement points and the saved look-back queries over them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from aerometer import constants as K
from aerometer.functions import scalars as X
from aerometer.operators import flights as fl
from aerometer.operators import lookback as lb
from aerometer.operators import points as pt
from aerometer.plans import bindings as b
from aerometer.plans.flight_queries import ALT_BAND, CLIMB_BAND, DETAIL_COLS, FL, SPEED_BAND, summary_input
from aerometer.plans.registry import register
from aerometer.session import staged

AIR = b.AIR_SQL
DAYS = 100  # look-back of the registered queries: three to four monthly cycles
SECONDS = DAYS * b.DAY_S

# A cycle's points carry the first instant of its month.
def cycle_time():
    return F.expr("make_timestamp((cycle - 1) div 12, (cycle - 1) % 12 + 1, 1, 0, 0, 0)")


CYCLE_TIME_SQL = "make_timestamp(((cycle - 1) // 12)::bigint, ((cycle - 1) % 12 + 1)::bigint, 1::bigint, 0::bigint, 0::bigint, 0.0)"

COLS = {
    K.M_DETAIL: [*DETAIL_COLS, "cycle"], K.M_FOCUS_DETAIL: [*DETAIL_COLS, "cycle"],
    K.M_COUNTRY: ["origin_country", "on_ground", "altitude_meters", "cycle"],
    K.M_REGION_COUNTRY: ["origin_country", "on_ground", "altitude_meters", "cycle"],
}
SUMMARY_COLS = ["origin_country", "on_ground", "altitude_meters", "altitude_feet", "velocity_kmh",
                "vertical_rate", "cycle"]


def cycle_points(s, d, *names, since=None, countries=None):
    """Points of the named measurements for every cycle; all nine when none is named. `since` and `countries` keep
    other flights from being read and joined."""
    if names == (K.M_SUMMARY,):
        return pt.measurement_points(summary_input(s, d, "cycle", since=since), cycle_time(), by=["cycle"], only=names)
    cols = [*dict.fromkeys(c for n in names for c in COLS.get(n, SUMMARY_COLS))] or [*DETAIL_COLS, "cycle"]
    return pt.measurement_points(b.flights(s, d, cols, since, countries), cycle_time(), b.FOCUS, b.REGION, ["cycle"],
                                 names or None)


def month_start(cycle: int) -> dt.datetime:
    return dt.datetime((cycle - 1) // 12, (cycle - 1) % 12 + 1, 1)


def look_back(s, d, *names, countries=None):
    """(points, now) of the last DAYS before now, just after the newest cycle's time. One column is read for the
    newest cycle; the window's bounds are then constants, and only flights of its cycles are read."""
    newest = b.flights(s, d, ["cycle"]).agg(F.max("cycle")).first()[0]
    if newest is None:
        return cycle_points(s, d, *names), F.lit(None).cast("timestamp")
    now = month_start(newest) + dt.timedelta(seconds=1)
    first = next(c for c in range(newest - DAYS // 28 - 1, newest + 1) if month_start(c) >= now - dt.timedelta(seconds=SECONDS))
    return (cycle_points(s, d, *names, since=month_start(first), countries=countries),
            F.expr(f"timestamp'{now:%Y-%m-%d %H:%M:%S}'"))


def ms(df, col="time"):
    return df.withColumn(col, F.unix_millis(col))


NOW_SQL = f"(SELECT {CYCLE_TIME_SQL} + INTERVAL 1 SECOND FROM (SELECT max(cycle) AS cycle FROM flights))"
IN_WINDOW = f"{CYCLE_TIME_SQL} >= {NOW_SQL} - INTERVAL {DAYS} DAY AND {CYCLE_TIME_SQL} < {NOW_SQL}"
NEWEST = "cycle = (SELECT max(cycle) FROM flights)"
TIME_MS = f"epoch_ms({CYCLE_TIME_SQL}) AS time"

# ---- long form

KEEP = ["measurement", "field", "value", "value_str", "time"]


def _focus_points(s, d):
    p = cycle_points(s, d, K.M_FOCUS_DETAIL)
    return ms(p.select(lb.tag("icao24"), lb.tag("callsign"), lb.tag("airline"), lb.tag("on_ground"), *KEEP)
              .withColumn("value", F.round("value", 4)))


DETAIL_FIELDS_SQL = {"altitude_m": "altitude_meters", "altitude_ft": "altitude_feet", "velocity_kmh": "velocity_kmh",
                     "true_track": "true_track", "vertical_rate": "vertical_rate", "longitude": "longitude",
                     "latitude": "latitude", "geo_altitude_m": "geo_altitude_meters"}
DETAIL_LONG_SQL = " UNION ALL ".join(
    [f"SELECT *, 'on_ground_num' AS field, CASE WHEN {AIR} THEN 0.0::double ELSE 1.0::double END AS value, "
     "NULL::varchar AS value_str FROM flights"]
    + [f"SELECT *, '{f}', {c}, NULL FROM flights WHERE {c} IS NOT NULL" for f, c in DETAIL_FIELDS_SQL.items()]
    + ["SELECT *, 'squawk', NULL, squawk FROM flights WHERE squawk IS NOT NULL"])

register("sparse_points_long", _focus_points,
         FL + f"""SELECT icao24, callsign, substr(callsign, 1, 3) AS airline,
           CASE WHEN {AIR} THEN 'False' ELSE 'True' END AS on_ground, '{K.M_FOCUS_DETAIL}' AS measurement,
           field, round(value, 4) AS value, value_str, {TIME_MS}
           FROM ({DETAIL_LONG_SQL}) WHERE origin_country = {b.FOCUS_SQL}""")


def _profile(s, d):
    flights = staged(b.flights(s, d, [*DETAIL_COLS, "cycle"]), "measurement-points")
    points = pt.measurement_points(flights, cycle_time(), b.FOCUS, b.REGION, ["cycle"])
    # the greatest of texts is found by sorting, so texts are grouped first and the few that are left sorted
    texts = points.groupBy("measurement", "field", "value_str").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return (texts.groupBy("measurement", "field")
            .agg(F.sum("n").alias("points"), F.round(F.sum("total"), 1).alias("total"), F.max("value_str").alias("text")))


def _summary_cells(measurement: str, cells: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{measurement}' AS measurement, '{f}' AS field, cast(v AS double) AS value, NULL AS value_str "
        f"FROM (SELECT {e} AS v FROM flights GROUP BY cycle)" for f, e in cells.items())


HERE, THERE = f"origin_country = {b.FOCUS_SQL}", f"origin_country IN {b.REGION_SQL}"


def n_if(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


SUMMARY_CELLS = {
    "total_flights": "count(*)", "in_air": n_if(AIR), "on_ground": f"count(*) - {n_if(AIR)}",
    "avg_altitude_meters": f"round(coalesce(avg(altitude_meters) FILTER (WHERE {AIR}), 0), 1)",
    "avg_velocity_kmh": f"round(coalesce(avg(velocity_kmh) FILTER (WHERE {AIR} AND velocity_kmh <= 1200), 0), 1)",
    "max_velocity_kmh": f"round(coalesce(max(velocity_kmh) FILTER (WHERE {AIR} AND velocity_kmh <= 1200), 0), 1)"}
CLIMB_CELLS = {c: n_if(f"{HERE} AND {CLIMB_BAND} = '{c}'") for c in K.CLIMB_LABELS}
BAND_CELLS = {c: n_if(f"{HERE} AND altitude_feet IS NOT NULL AND {ALT_BAND} = '{c}'") for c in K.ALTITUDE_LABELS}
PER_COUNTRY = {"flight_count": "count(*)", "in_air": n_if(AIR),
               "avg_altitude_meters": "round(coalesce(avg(altitude_meters), 0), 1)"}
ALL_POINTS_SQL = " UNION ALL ".join([
    f"SELECT '{K.M_DETAIL}' AS measurement, field, value, value_str FROM details",
    f"SELECT '{K.M_FOCUS_DETAIL}', field, value, value_str FROM details WHERE {HERE}",
    _summary_cells(K.M_SUMMARY, SUMMARY_CELLS), _summary_cells(K.M_CLIMB, CLIMB_CELLS),
    _summary_cells(K.M_BANDS, BAND_CELLS),
    _summary_cells(K.M_REGION, {"total_flights": n_if(THERE), "in_air": n_if(f"{THERE} AND {AIR}")}),
    _summary_cells(K.M_FOCUS, {"total_flights": n_if(HERE), "in_air": n_if(f"{HERE} AND {AIR}")}),
    *[f"SELECT '{K.M_REGION_COUNTRY}', '{f}', cast({e} AS double), NULL FROM flights WHERE {THERE} "
      "GROUP BY cycle, origin_country" for f, e in PER_COUNTRY.items()],
    f"SELECT '{K.M_COUNTRY}', 'flight_count', cast(count(*) AS double), NULL FROM flights GROUP BY cycle, origin_country"])
register("measurement_points", _profile,
         FL.rstrip() + f""", details AS ({DETAIL_LONG_SQL}), points AS ({ALL_POINTS_SQL})
         SELECT measurement, field, count(*) AS points, round(sum(value), 1) AS total, max(value_str) AS text
         FROM points GROUP BY 1, 2""")

# ---- saved queries


def _latest(measurement: str, field: str, expr: str, steps=None):
    def query(s, d):
        points, now = look_back(s, d, measurement)
        return ms(lb.latest_stat(points, measurement, field, now, SECONDS, steps))

    level = ""
    if steps:
        whens = " ".join(f"WHEN value < {e} THEN '{l}'" for e, l in zip(*steps))
        level = f", CASE {whens} ELSE '{steps[1][-1]}' END AS level"
    sql = FL + f"""SELECT *{level} FROM (SELECT '{field}' AS field, cast({expr} AS double) AS value, {TIME_MS}
      FROM flights WHERE {NEWEST} GROUP BY cycle)"""
    return query, sql


register("latest_total_flights", *_latest(K.M_SUMMARY, "total_flights", "count(*)"))
register("latest_in_air", *_latest(K.M_SUMMARY, "in_air", n_if(AIR)))
register("latest_focus_total", *_latest(K.M_FOCUS, "total_flights", n_if(HERE)))
register("latest_region_total", *_latest(K.M_REGION, "total_flights", n_if(THERE)))
register("latest_mean_speed", *_latest(K.M_SUMMARY, "avg_velocity_kmh", SUMMARY_CELLS["avg_velocity_kmh"], K.SPEED_STEPS))
register("latest_mean_altitude",
         *_latest(K.M_SUMMARY, "avg_altitude_meters", SUMMARY_CELLS["avg_altitude_meters"], K.ALTITUDE_STEPS))

LIVE_SQL = f"""live AS (
  SELECT icao24, callsign, origin_country AS country, substr(callsign, 1, 3) AS airline,
    max(CASE WHEN field = 'latitude' THEN value END) AS latitude,
    max(CASE WHEN field = 'longitude' THEN value END) AS longitude,
    round(max(CASE WHEN field = 'altitude_m' THEN value END), 4) AS altitude_m,
    max(CASE WHEN field = 'velocity_kmh' THEN value END) AS velocity_kmh
  FROM (SELECT *, row_number() OVER (PARTITION BY icao24, callsign, origin_country, field
      ORDER BY cycle DESC, value DESC) AS r FROM ({DETAIL_LONG_SQL}) WHERE {IN_WINDOW}
      AND field IN ('latitude', 'longitude', 'altitude_m', 'velocity_kmh'))
  WHERE r = 1 GROUP BY 1, 2, 3, 4)"""
register("latest_position_pivot",
         lambda s, d: lb.live_positions(*look_back(s, d, K.M_DETAIL), SECONDS)
         .withColumn("altitude_m", F.round("altitude_m", 4)),
         FL.rstrip() + f", {LIVE_SQL} SELECT * FROM live WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
register("focus_live_flights",
         lambda s, d: lb.focus_live(*look_back(s, d, K.M_FOCUS_DETAIL, countries=[b.FOCUS]), SECONDS)
         .withColumn("altitude_m", F.round("altitude_m", 4)),
         FL.rstrip() + f""", {LIVE_SQL} SELECT *, coalesce(velocity_kmh, 0) AS "Speed (km/h)" FROM live
           WHERE country = {b.FOCUS_SQL}""")
def _levels(col: str, steps) -> str:
    return "CASE " + " ".join(f"WHEN {col} < {e} THEN '{l}'" for e, l in zip(*steps)) + f" ELSE '{steps[1][-1]}' END"


LAST_COUNTRY = f"""last_country AS (SELECT origin_country AS country, {TIME_MS}, cast(n AS double) AS value FROM (
    SELECT cycle, origin_country, count(*) AS n,
      row_number() OVER (PARTITION BY origin_country ORDER BY cycle DESC) AS r
    FROM flights WHERE {IN_WINDOW} GROUP BY cycle, origin_country) WHERE r = 1)"""
TOP10 = "SELECT time, country, value FROM last_country WHERE value > 0 ORDER BY value DESC, country LIMIT 10"
register("top10_countries_latest",
         lambda s, d: ms(lb.country_ranking(*look_back(s, d, K.M_COUNTRY), seconds=SECONDS)),
         FL.rstrip() + f", {LAST_COUNTRY} SELECT *, {_levels('value', K.COUNTRY_STEPS)} AS country_level FROM ({TOP10})")
WIDE = [f"NATION_{i}" for i in range(25)]


def _ranking_wide(points, now):
    return lb.country_ranking_wide(points, WIDE, now, seconds=SECONDS)


register("top10_pivot",
         lambda s, d: ms(_ranking_wide(*look_back(s, d, K.M_COUNTRY))),
         FL.rstrip() + f", {LAST_COUNTRY} SELECT time, "
         + ", ".join(f"max(CASE WHEN country = '{c}' THEN value END) AS \"{c}\"" for c in WIDE)
         + f" FROM ({TOP10}) GROUP BY time")


def _split(measurement: str, mapping: dict[str, str], cells: dict[str, str]):
    def long(s, d):
        points, now = look_back(s, d, measurement)
        return ms(lb.split_share(points, measurement, mapping, now, SECONDS))

    def wide(s, d):
        points, now = look_back(s, d, measurement)
        return ms(lb.split_share_wide(points, measurement, mapping, now, SECONDS))

    newest = f"FROM flights WHERE {NEWEST} GROUP BY cycle"
    long_sql = " UNION ALL ".join(
        f"SELECT '{mapping[f]}' AS field, cast({cells[f]} AS double) AS value, {TIME_MS} {newest}" for f in mapping)
    wide_sql = (f"SELECT {TIME_MS}, "
                + ", ".join(f"cast({cells[f]} AS double) AS \"{mapping[f]}\"" for f in mapping) + " " + newest)
    return (long, FL + long_sql), (wide, FL + wide_sql)


_climb = _split(K.M_CLIMB, K.CLIMB_RELABEL, CLIMB_CELLS)
_bands = _split(K.M_BANDS, K.ALTITUDE_RELABEL, BAND_CELLS)
_air = _split(K.M_SUMMARY, K.AIR_RELABEL, SUMMARY_CELLS)
register("climb_split", *_climb[1])
register("altitude_band_split", *_bands[1])
register("air_ground_split", *_air[0])


register("region_table",
         lambda s, d: lb.region_table(*look_back(s, d, K.M_REGION_COUNTRY, countries=b.REGION), SECONDS),
         FL.rstrip() + f""", t AS (SELECT cycle, origin_country AS country,
             {', '.join(f'cast({e} AS double) AS {f}' for f, e in PER_COUNTRY.items())},
             row_number() OVER (PARTITION BY origin_country ORDER BY cycle DESC) AS r
           FROM flights WHERE {THERE} AND {IN_WINDOW} GROUP BY cycle, origin_country)
         SELECT country, flight_count, in_air, avg_altitude_meters,
           {_levels('flight_count', K.REGION_COUNT_STEPS)} AS count_level,
           {_levels('in_air', K.REGION_AIR_STEPS)} AS air_level,
           {_levels('avg_altitude_meters', K.REGION_ALT_STEPS)} AS altitude_level FROM t WHERE r = 1""")

# ---- batch report as points


GROUPS_A_TASK = 1_000_000  # points that one task groups, about
REPORT_COLS = ["icao24", "callsign", "origin_country", "on_ground", *pt.DETAIL_VALUES]


def _totals(points):
    return points.groupBy("measurement", "series", "field").agg(
        F.count(F.lit(1)).alias("points"), F.round(F.sum("value"), 4).alias("value"))


def _batch_points(s, d):
    at = F.lit("2024-01-01").cast("timestamp")
    # joined and written once: the report reads it for statistics, bands, countries, top lists and details
    flights = staged(b.flights(s, d, REPORT_COLS), "batch-report")
    # nearly every point is a group of its own: flights are dealt by series, over as many tasks as their points need, and not the points
    tasks = max(1, -(-flights.count() * len(pt.DETAIL_VALUES) // GROUPS_A_TASK))
    return pt.batch_points(flights, at, b.FOCUS, tasks=tasks, each=_totals)


def _cells(measurement: str, category: str, cells: dict[str, str], where: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{measurement}' AS measurement, '{{"category":"{category}","metric":"{m}"}}' AS series,
        'value' AS field, cast({e} AS double) AS value FROM flights {where}""" for m, e in cells.items())


def _tagged(measurement: str, tags: dict[str, str], fields: dict[str, str], source: str) -> str:
    series = " || ',' || ".join(f"'\"{t}\":\"' || {e} || '\"'" for t, e in tags.items()) or "''"
    return " UNION ALL ".join(
        f"SELECT '{measurement}', '{{' || {series} || '}}', '{f}', cast({e} AS double) FROM ({source})"
        for f, e in fields.items())


_alt, _vel = f"FILTER (WHERE {HERE})", f"FILTER (WHERE {HERE})"
BATCH_SQL = " UNION ALL ".join([
    _cells("flight_statistics", "general", {
        "total_flights": "count(*)", "flights_airborne": f"count(*) - {n_if('on_ground')}",
        "flights_on_ground": n_if("on_ground"),
        "airborne_percentage": f"round(100.0::double * (count(*) - {n_if('on_ground')}) / count(*), 2)"}),
    _cells("egypt_statistics", "egypt", {
        "total_flights": n_if(HERE), "flights_airborne": n_if(f"{HERE} AND {AIR}"),
        "flights_on_ground": f"{n_if(HERE)} - {n_if(f'{HERE} AND {AIR}')}",
        "percentage_of_total": f"round(100.0::double * {n_if(HERE)} / count(*), 2)",
        "avg_altitude_m": f"round(avg(altitude_meters) {_alt}, 2)",
        "max_altitude_m": f"round(max(altitude_meters) {_alt}, 2)",
        "avg_velocity_kmh": f"round(avg(velocity_kmh) {_vel}, 2)",
        "max_velocity_kmh": f"round(max(velocity_kmh) {_vel}, 2)"}),
    _cells("flight_statistics", "altitude", {
        "avg_meters": "round(avg(altitude_meters), 2)", "max_meters": "round(max(altitude_meters), 2)",
        "min_meters": "round(min(altitude_meters), 2)", "stddev_meters": "round(stddev_samp(altitude_meters), 2)",
        "avg_feet": "round(avg(altitude_meters) * 3.28084::double, 2)",
        "max_feet": "round(max(altitude_meters) * 3.28084::double, 2)"}),
    _cells("flight_statistics", "velocity", {
        "avg_kmh": "round(avg(velocity_kmh), 2)", "max_kmh": "round(max(velocity_kmh), 2)",
        "min_kmh": "round(min(velocity_kmh), 2)", "stddev_kmh": "round(stddev_samp(velocity_kmh), 2)"}),
    _tagged("country_statistics", {"country": "origin_country"},
            {"flight_count": "n", "avg_speed_kmh": "round(s, 2)", "avg_altitude_m": "round(a, 2)"},
            "SELECT origin_country, count(*) AS n, avg(velocity_kmh) AS s, avg(altitude_meters) AS a FROM flights "
            "GROUP BY 1 ORDER BY n DESC, origin_country LIMIT 10"),
    _tagged("altitude_distribution", {"category": "k"}, {"count": "n"},
            f"SELECT {ALT_BAND} AS k, count(*) AS n FROM flights WHERE altitude_feet IS NOT NULL GROUP BY 1"),
    _tagged("speed_distribution", {"category": "k"}, {"count": "n"},
            f"SELECT {SPEED_BAND} AS k, count(*) AS n FROM flights GROUP BY 1"),
    _tagged("vertical_movement", {"movement": "k"}, {"count": "n"},
            f"SELECT {CLIMB_BAND} AS k, count(*) AS n FROM flights GROUP BY 1"),
    _tagged("fastest_flights", {"callsign": "callsign", "country": "origin_country"},
            {"speed_kmh": "round(velocity_kmh, 2)", "altitude_ft": "round(coalesce(altitude_feet, 0), 2)"},
            "SELECT * FROM flights ORDER BY velocity_kmh DESC, icao24, callsign, origin_country, "
            "altitude_feet NULLS FIRST LIMIT 10"),
    _tagged("highest_flights", {"callsign": "callsign", "country": "origin_country"},
            {"altitude_m": "round(altitude_meters, 2)", "altitude_ft": "round(altitude_meters * 3.28084::double, 2)",
             "speed_kmh": "round(velocity_kmh, 2)"},
            "SELECT * FROM flights WHERE altitude_meters IS NOT NULL ORDER BY altitude_meters DESC, icao24, callsign, "
            "origin_country, velocity_kmh LIMIT 10"),
    _tagged("flight_details", {"icao24": "icao24", "callsign": "callsign", "country": "origin_country",
                               "on_ground": "CASE WHEN on_ground THEN 'True' WHEN NOT on_ground THEN 'False' ELSE 'None' END"},
            {c: c for c in ("altitude_meters", "altitude_feet", "velocity_kmh", "true_track", "vertical_rate", "longitude",
                            "latitude")}, "SELECT * FROM flights"),
    _tagged("geographic_center", {}, {"longitude": "round(x, 4)", "latitude": "round(y, 4)"},
            "SELECT avg(longitude) AS x, avg(latitude) AS y FROM flights")])
register("batch_report_points", _batch_points,
         FL.rstrip() + f""", points AS ({BATCH_SQL})
         SELECT measurement, series, field, count(*) AS points, round(sum(value), 4) AS value
         FROM points WHERE value IS NOT NULL GROUP BY 1, 2, 3""")

# ---- event points: upsert, retention, last value, generic value text


def event_points(s, d):
    """One point per event: type, user, hour; later events replace earlier ones of the same hour."""
    e = b.table(s, d, "events").select(
        "event_type", F.col("user_id").cast("string").alias("user"), "value", "event_id",
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("time"))
    tags = F.create_map(F.lit("user"), F.col("user"))
    return e.select(F.col("event_type").alias("measurement"), F.to_json(tags).alias("series"), tags.alias("tags"),
                    F.lit("value").alias("field"), "value", F.lit(None).cast("string").alias("value_str"), "time",
                    "event_id")


register("point_upsert",
         lambda s, d: ms(pt.upsert_view(event_points(s, d), "event_id")
                         .select("measurement", lb.tag("user"), "value", "time")),
         """SELECT measurement, "user", value, epoch_ms(time) AS time FROM (
           SELECT event_type AS measurement, cast(user_id AS varchar) AS "user", value, date_trunc('hour', ts) AS time,
             row_number() OVER (PARTITION BY event_type, user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS r
           FROM events) WHERE r = 1""")
register("point_retention",
         lambda s, d: pt.retain(event_points(s, d), 7).groupBy("measurement")
         .agg(F.count(F.lit(1)).alias("points"), F.unix_millis(F.min("time")).alias("oldest")),
         """SELECT event_type AS measurement, count(*) AS points, epoch_ms(min(date_trunc('hour', ts))) AS oldest FROM events
           WHERE date_trunc('hour', ts) >= (SELECT max(date_trunc('hour', ts)) FROM events) - INTERVAL 7 DAY GROUP BY 1""")
register("last_value_per_user",
         lambda s, d: lb.last_per(
             b.table(s, d, "events").select("user_id", "event_type", "value", "ts", "event_id"),
             ["user_id", "event_type"], "ts", ["event_id"]).select("user_id", "event_type", "value", "event_id"),
         """SELECT user_id, event_type, value, event_id FROM (SELECT *, row_number() OVER (
           PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
register("latest_value_pivot",
         lambda s, d: lb.pivot_fields(
             lb.last_per(b.table(s, d, "events").select("user_id", "event_type", "value", "ts", "event_id"),
                         ["user_id", "event_type"], "ts", ["event_id"]),
             ["user_id"], "event_type", "value", ["view", "signup", "error", "click", "purchase"]),
         """SELECT user_id, max(value) FILTER (WHERE event_type = 'view') AS view,
           max(value) FILTER (WHERE event_type = 'signup') AS signup, max(value) FILTER (WHERE event_type = 'error') AS error,
           max(value) FILTER (WHERE event_type = 'click') AS click, max(value) FILTER (WHERE event_type = 'purchase') AS purchase
           FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
           WHERE r = 1 GROUP BY user_id""")
register("look_back_counts",
         lambda s, d: lb.look_back(
             b.table(s, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("time")), 36 * 3600,
             b.table(s, d, "events").agg(F.max("ts").cast("timestamp")).scalar())
         .groupBy("event_type").agg(F.count(F.lit(1)).alias("n")),
         """SELECT event_type, count(*) AS n FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 36 HOUR
           AND ts < (SELECT max(ts) FROM events) GROUP BY 1""")
register("value_or_text_points",
         lambda s, d: pt.value_points(
             b.table(s, d, "events").select(
                 "event_type", F.when(F.col("event_id") % 5 == 0, F.col("event_type"))
                 .otherwise(F.col("value").cast("string")).alias("stat"), F.col("ts").cast("timestamp").alias("time")),
             "event_statistics", ["event_type"], "stat")
         .groupBy(lb.tag("event_type"), "value_str")
         .agg(F.count("value").alias("numbers"), F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n")),
         """SELECT event_type, CASE WHEN event_id % 5 = 0 THEN event_type END AS value_str,
           count(CASE WHEN event_id % 5 <> 0 THEN value END) AS numbers,
           round(sum(CASE WHEN event_id % 5 <> 0 THEN value END), 2) AS total, count(*) AS n FROM events GROUP BY 1, 2""")
register("relabelled_counts",
         lambda s, d: lb.relabel(
             b.table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")),
             "event_type", {"view": "seen", "click": "pressed"}, "other")
         .groupBy("event_type").agg(F.sum("n").alias("n")),
         """SELECT CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'pressed' ELSE 'other' END AS event_type,
           count(*) AS n FROM events GROUP BY 1""")

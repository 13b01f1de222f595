"""Streaming jobs run over the given tables, sources, routes and health reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerometer import constants as K
from aerometer import schemas as S
from aerometer.functions import scalars as X
from aerometer.operators import flights as fl
from aerometer.operators import sequences as seq
from aerometer.plans import bindings as b
from aerometer.plans.flight_queries import DETAIL_COLS, FL, PIPELINE_SQL, SNAP_COLS
from aerometer.plans.meter_queries import M, rounded
from aerometer.plans.point_queries import CLIMB_CELLS, HERE, THERE, n_if
from aerometer.plans.registry import register
from aerometer.session import work_dir
from aerometer.sources import files, records
from aerometer.streaming import jobs, monitor

AIR = b.AIR_SQL


def table_stream(s, d, name):
    """A given table read as a stream; the pattern fits a single file and a folder of files."""
    return s.readStream.schema(b.table(s, d, name).schema).parquet(f"{d}/{name}.parquet*")


def finish(query):
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def stream_flights(s, d, columns):
    """The flight view over a stream of line items; orders and parts are static."""
    lines = table_stream(s, d, "lineitem")
    if "origin_country" in columns:
        nation = b.table(s, d, "nation").select("n_nationkey", "n_name")
        home = b.table(s, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
        owner = b.table(s, d, "orders").join(home, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "n_name")
        lines = lines.join(owner, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(*[F.expr(b.FLIGHT_COLUMNS[c]).alias(c) for c in columns])


def stream_cycle_totals(s, d):
    base = work_dir(s, "cycle-totals")
    flights = stream_flights(s, d, ["on_ground", "altitude_meters", "velocity_kmh", "cycle"]).withColumns({
        "origin_country": F.lit(None).cast("string"), "vertical_rate": F.lit(0.0), "altitude_feet": F.lit(None).cast("double")})
    finish(jobs.run_totals(jobs.cycle_totals(flights), f"{base}/data", f"{base}/checkpoint", None))
    return jobs.read_totals(s, f"{base}/data", ["cycle"]).select(
        "cycle", "total_flights", "in_air", "on_ground", "avg_altitude_meters", "avg_velocity_kmh", "max_velocity_kmh")


register("stream_cycle_totals", stream_cycle_totals, FL + f"SELECT cycle, {PIPELINE_SQL} FROM flights GROUP BY cycle")


def stream_country_counts(s, d):
    base = work_dir(s, "country-counts")
    flights = stream_flights(s, d, ["origin_country", "on_ground", "altitude_meters"])
    finish(jobs.run_totals(fl.country_metrics(flights), f"{base}/data", f"{base}/checkpoint", None))
    return jobs.read_totals(s, f"{base}/data", ["country"])


register("stream_country_counts", stream_country_counts,
         FL + f"""SELECT origin_country AS country, count(*) AS flight_count, {n_if(AIR)} AS in_air,
           round(coalesce(avg(altitude_meters), 0), 1) AS avg_altitude_meters FROM flights GROUP BY 1""")

RECORD_COLS = [*DETAIL_COLS, "velocity_ms", "time_position", "processing_time_ms", "cycle"]


FILE_ROWS = 500_000


def json_folder(s, d, name):
    """The flight view written as JSON records, one per line. Packed files cannot be split, so their rows are bounded."""
    base = work_dir(s, name)
    lines = b.flights(s, d, RECORD_COLS).select(F.to_json(F.struct(*RECORD_COLS)).alias("value"))
    lines.write.option("maxRecordsPerFile", FILE_ROWS).text(f"{base}/input", compression="gzip")
    return base


def stream_measurements(s, d):
    base = json_folder(s, d, "measurements")
    stream = records.open_stream(s, "files", f"{base}/input", max_per_trigger=None)
    finish(jobs.run_measurements(stream, f"{base}/points", f"{base}/checkpoint", None, focus=b.FOCUS, region=b.REGION))
    points = jobs.read_points(s, f"{base}/points")
    # Detail identities repeat (the same aircraft twice in a cycle); the store keeps the greatest value.
    return (points.groupBy("measurement", "field").agg(F.count(F.lit(1)).alias("points"), F.round(F.sum("value"), 1).alias("total")))


_LATEST = "latest AS (SELECT * FROM flights WHERE cycle = (SELECT max(cycle) FROM flights))"


def _cell_rows(measurement, cells, group=""):
    return [f"SELECT '{measurement}' AS measurement, '{f}' AS field, count(*) AS points, round(sum(v), 1) AS total FROM "
            f"(SELECT cast({e} AS double) AS v FROM latest {group})" for f, e in cells.items()]


def _detail_rows(measurement, where):
    """Points and totals of each detail field: one point per identity, its greatest value."""
    who = "icao24, callsign, origin_country, coalesce(on_ground, false)"
    numbers = {"on_ground_num": "cast(coalesce(on_ground, false) AS double)", **K.DETAIL_FIELDS}
    return [f"SELECT '{measurement}', '{f}', count(*), round(sum(v), 1) FROM (SELECT max(cast({e} AS double)) AS v "
            f"FROM latest WHERE {where} AND {e} IS NOT NULL GROUP BY {who}) HAVING count(*) > 0" for f, e in numbers.items()] + [
        f"SELECT '{measurement}', 'squawk', count(*), cast(NULL AS double) FROM (SELECT 1 FROM latest WHERE {where} "
        f"AND squawk IS NOT NULL GROUP BY {who}) HAVING count(*) > 0"]


_SUMMARY = {
    "total_flights": "count(*)", "in_air": n_if(AIR), "on_ground": f"count(*) - {n_if(AIR)}",
    "avg_altitude_meters": f"round(coalesce(avg(altitude_meters) FILTER (WHERE {AIR}), 0), 1)",
    "avg_velocity_kmh": f"round(coalesce(avg(velocity_kmh) FILTER (WHERE {AIR} AND velocity_kmh <= 1200), 0), 1)",
    "max_velocity_kmh": f"round(coalesce(max(velocity_kmh) FILTER (WHERE {AIR} AND velocity_kmh <= 1200), 0), 1)"}
_BANDS = {"Low (< 10K ft)": "altitude_feet < 10000", "Medium (10K-30K ft)": "altitude_feet >= 10000 AND altitude_feet < 30000",
          "High (> 30K ft)": "altitude_feet >= 30000"}
register("stream_measurements", stream_measurements,
         FL.rstrip() + f", {_LATEST} " + " UNION ALL ".join([
             *_cell_rows("pipeline_summary", _SUMMARY), *_cell_rows("vertical_rate_stats", CLIMB_CELLS),
             *_cell_rows("altitude_bands", {k: n_if(f"{HERE} AND {c}") for k, c in _BANDS.items()}),
             *_cell_rows("arab_world_summary", {"total_flights": n_if(THERE), "in_air": n_if(f"{THERE} AND {AIR}")}),
             *_cell_rows("egypt_summary", {"total_flights": n_if(HERE), "in_air": n_if(f"{HERE} AND {AIR}")}),
             *_cell_rows("arab_country_metrics", {"flight_count": "count(*)", "in_air": n_if(AIR),
                                                  "avg_altitude_meters": "round(coalesce(avg(altitude_meters), 0), 1)"},
                         f"WHERE {THERE} GROUP BY origin_country"),
             *_cell_rows("country_metrics", {"flight_count": "count(*)"}, "GROUP BY origin_country"),
             *_detail_rows("flight_details", "true"), *_detail_rows("egypt_flight_detail", HERE)]))


def stream_archive(s, d):
    base = json_folder(s, d, "archive")
    stream = records.open_stream(s, "files", f"{base}/input", max_per_trigger=None)
    finish(jobs.archive(stream, f"{base}/archive", f"{base}/checkpoint", "Europe/London", trigger=None))
    return files.read_archive(s, f"{base}/archive").where(F.col("date") >= "2000-01-01").groupBy("cycle").agg(
        F.count(F.lit(1)).alias("records"), F.round(F.sum("velocity_kmh"), 1).alias("speed"))


register("stream_archive", stream_archive,
         FL + "SELECT cycle, count(*) AS records, round(sum(velocity_kmh), 1) AS speed FROM flights GROUP BY cycle")

# ---- sources

# Text records made from line items: some are cut off, some are arrays or bare numbers, some carry
# quoted or unreadable numbers.
TEXT = """case
  when l_linenumber = 7 then concat('{"icao24": "', cast(l_orderkey as string))
  when l_linenumber = 5 and l_linestatus = 'F' and l_returnflag = 'A' then concat('{"icao24": "x", "cycle": 5}', case l_suppkey % 3 when 0 then ']' when 1 then '] [' else '] [{"cycle": 5}' end)
  when l_linenumber = 6 and l_returnflag = 'A' then concat('[', cast(l_orderkey as string), ']')
  when l_linenumber = 6 and l_returnflag = 'N' then cast(l_orderkey as string)
  else concat('{"icao24": "', cast(l_orderkey as string), '", "altitude_meters": ',
    case l_linenumber when 1 then concat('"', cast(l_extendedprice as string), '"') when 2 then '"abc"'
      when 3 then 'null' else cast(l_extendedprice as string) end,
    ', "cycle": ', cast(l_linenumber as string), ', "on_ground": ', case when l_returnflag = 'R' then 'true' else 'false' end, '}')
  end"""
NUMBERED_SQL = "l_linenumber <> 7 AND NOT (l_linenumber = 6 AND l_returnflag IN ('A', 'N'))"
GOOD_SQL = f"{NUMBERED_SQL} AND NOT (l_linenumber = 5 AND l_linestatus = 'F' AND l_returnflag = 'A')"


def text_records(s, d):
    return b.table(s, d, "lineitem").select(F.expr(TEXT).alias("value"))


register("parsed_records",
         lambda s, d: records.parse_records(text_records(s, d)).groupBy("cycle", "on_ground").agg(
             F.count(F.lit(1)).alias("records"), F.count("altitude_meters").alias("with_altitude"),
             F.round(F.sum("altitude_meters"), 2).alias("altitude"), F.max("icao24").alias("last_icao24")),
         f"""SELECT l_linenumber AS cycle, l_returnflag = 'R' AS on_ground, count(*) AS records,
           count(CASE WHEN l_linenumber NOT IN (2, 3) THEN 1 END) AS with_altitude,
           round(sum(CASE WHEN l_linenumber NOT IN (2, 3) THEN l_extendedprice END), 2) AS altitude,
           max(cast(l_orderkey AS varchar)) AS last_icao24 FROM lineitem WHERE {GOOD_SQL} GROUP BY 1, 2""")


def json_log_scan(s, d):
    """Batch rules: a bad line is a row of nulls and counts in the total."""
    path = work_dir(s, "json-log")
    text_records(s, d).write.text(path)
    return fl.general_stats(records.read_flight_log(s, path))


register("json_log_scan", json_log_scan,
         f"""SELECT total_flights, total_flights - flights_on_ground AS flights_airborne, flights_on_ground,
           round(100.0::double * (total_flights - flights_on_ground) / total_flights, 2) AS airborne_percentage FROM (
           SELECT count(*) AS total_flights, count(*) FILTER (WHERE {GOOD_SQL} AND l_returnflag = 'R') AS flights_on_ground
           FROM lineitem)""")
register("cycle_from_body",
         lambda s, d: text_records(s, d).groupBy(X.cycle_from_body("value").alias("cycle")).agg(
             F.count(F.lit(1)).alias("records")),
         f"""SELECT CASE WHEN {NUMBERED_SQL} THEN l_linenumber END AS cycle, count(*) AS records FROM lineitem GROUP BY 1""")

# Raw snapshots: one per line item with up to three states; short states and states without a
# position are dropped.
SNAPSHOT = """concat('{"time": ', cast(unix_seconds(cast(l_shipdate as timestamp)) as string), ', "states": [["a',
  cast(l_orderkey as string), '", ', case when l_linenumber = 1 then 'null' when l_linenumber = 2 then '""' else '"  AB1 "' end,
  ', "Land", 1, 2, ', case when l_linenumber = 3 then 'null' else '0.0' end, ', ', cast(l_suppkey % 90 as string), ', ',
  cast(l_extendedprice as string), ', ', case when l_returnflag = 'R' then 'true' else 'false' end, ', ', cast(l_quantity as string),
  ', 10.5, -1.5, null, 1000.0, "0012", false, 0], ["short", "x", "Land", 1, 2, 3.0], ["seven", "y", "Land", 1, 2, 3.0, 4.0]]}')"""


def state_vectors(s, d):
    snaps = b.table(s, d, "lineitem").select(F.expr(SNAPSHOT).alias("value"), F.col("l_linenumber").alias("n"))
    out = records.explode_states(snaps, cycle="n", now=F.expr("timestamp'2024-01-01 00:00:00'"))
    # the greatest of texts is found by sorting, so texts are grouped first and the few that are left sorted
    texts = out.groupBy("cycle", "callsign", "on_ground", "snapshot_timestamp", "squawk").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("altitude_feet", "velocity_kmh", "latitude")])
    return texts.groupBy("cycle", "callsign", "on_ground").agg(
        F.sum("n").alias("records"), F.round(F.sum("altitude_feet"), 1).alias("feet"),
        F.round(F.sum("velocity_kmh"), 1).alias("kmh"), F.max("snapshot_timestamp").alias("newest"),
        F.max("squawk").alias("squawk"), F.round(F.sum("latitude"), 2).alias("latitude"))


register("state_vectors", state_vectors,
         """SELECT l_linenumber AS cycle, callsign, on_ground, count(*) AS records, round(sum(feet), 1) AS feet,
           round(sum(kmh), 1) AS kmh, strftime(max(l_shipdate), '%Y-%m-%dT%H:%M:%SZ') AS newest, max(squawk) AS squawk,
           round(sum(latitude), 2) AS latitude
         FROM (SELECT *, CASE WHEN l_linenumber <= 2 THEN 'UNKNOWN' ELSE 'AB1' END AS callsign, l_returnflag = 'R' AS on_ground,
             round(l_extendedprice * 3.28084::double, 0) AS feet, round(l_quantity * 3.6::double, 1) AS kmh, '0012' AS squawk,
             cast(l_suppkey % 90 AS double) AS latitude FROM lineitem WHERE l_linenumber <> 3
           UNION ALL SELECT *, 'y', NULL, NULL, NULL, NULL, 4.0::double FROM lineitem) GROUP BY 1, 2, 3""")


def csv_daily_load(s, d):
    path = work_dir(s, "daily-csv")
    daily = b.meter_daily(s, d).withColumnRenamed("meter_id", "LCLid").withColumnRenamed("date", "day")
    daily.write.option("header", True).csv(path)
    loaded = files.read_csv(s, path, S.METER_DAILY, {"LCLid": "meter_id", "day": "date"})
    return rounded(loaded.groupBy("meter_id").agg(
        F.count(F.lit(1)).alias("days"), F.sum("energy_sum").alias("energy"), F.sum("energy_count").alias("readings"),
        F.count("energy_std").alias("with_std")), ["energy"])


register("csv_daily_load", csv_daily_load,
         M + """SELECT meter_id, count(*) AS days, round(sum(energy_sum), 6) AS energy, cast(sum(energy_count) AS bigint) AS readings,
           count(energy_std) AS with_std FROM meter_daily GROUP BY 1""")

# ---- routes


def routed_events(s, d):
    sent = jobs.route(b.flights(s, d, ["icao24", "on_ground", "processing_time_ms", "cycle"]))
    body = F.from_json("body", "icao24 string, influxable boolean, storage_mode string, cycle int")
    return sent.select("topic", F.try_element_at("headers", F.lit("cycle")).alias("cycle_text"), body.alias("r")).groupBy(
        "topic", "cycle_text", "r.influxable", "r.storage_mode").agg(
        F.count(F.lit(1)).alias("events"), F.max("r.icao24").alias("last_icao24"), F.max("r.cycle").alias("cycle"))


register("routed_events", routed_events,
         FL + """SELECT topic, lpad(cast(cycle AS varchar), 6, '0') AS cycle_text, topic = 'raw' AS influxable,
           'both' AS storage_mode, count(*) AS events, max(icao24) AS last_icao24, max(cycle) AS cycle
           FROM flights, (SELECT unnest(['raw', 'archive']) AS topic) GROUP BY topic, flights.cycle""")



def aggregate_events(s, d):
    """The third topic: one event per cycle, read back from its body."""
    sent = jobs.aggregate_event(b.flights(s, d, SNAP_COLS), ["cycle"], F.expr("timestamp'2024-01-02 03:04:05'"))
    body = F.from_json("body", "cycle int, timestamp string, total_flights bigint, top_countries array<struct<country:string,count:bigint>>, "
                               "highest_aircraft struct<callsign:string>")
    r = sent.select("topic", F.try_element_at("headers", F.lit("timestamp")).alias("sent_ms"), body.alias("r"))
    return r.select("topic", "sent_ms", "r.cycle", "r.timestamp", "r.total_flights", F.get("r.top_countries", 0)["country"].alias("first_country"),
                    F.col("r.highest_aircraft.callsign").alias("highest_callsign"))


register("aggregate_events", aggregate_events,
         FL.rstrip() + f""", tops AS (SELECT cycle, origin_country FROM (SELECT cycle, origin_country, row_number() OVER (
             PARTITION BY cycle ORDER BY count(*) DESC, origin_country) AS r FROM flights GROUP BY 1, 2) WHERE r = 1),
           highest AS (SELECT cycle, callsign FROM (SELECT *, row_number() OVER (PARTITION BY cycle ORDER BY altitude_meters DESC NULLS LAST,
             icao24 DESC, callsign DESC, origin_country DESC) AS r FROM flights WHERE {AIR}) WHERE r = 1 AND altitude_meters IS NOT NULL)
         SELECT 'aggregate' AS topic, '1704164645000' AS sent_ms, f.cycle, '2024-01-02T03:04:05.000000Z' AS timestamp, count(*) AS total_flights,
           any_value(t.origin_country) AS first_country, any_value(h.callsign) AS highest_callsign
         FROM flights f JOIN tops t ON f.cycle = t.cycle LEFT JOIN highest h ON f.cycle = h.cycle GROUP BY f.cycle""")

# ---- health reports

register("batch_gap_watchdog",
         lambda s, d: seq.write_gaps(b.table(s, d, "events").select("event_type", F.col("ts").alias("write_time")), 1800,
                                     key=["event_type"])
         .select("event_type", F.unix_micros("previous_write").alias("previous_us"),
                 F.unix_micros("next_write").alias("next_us"), F.round("gap_s", 6).alias("gap_s")),
         """SELECT event_type, epoch_us(p) AS previous_us, epoch_us(ts) AS next_us,
           round((epoch_us(ts) - epoch_us(p)) / 1000000.0::double, 6) AS gap_s FROM (
           SELECT event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS p FROM events)
           WHERE epoch_us(ts) - epoch_us(p) > 1800000000""")


def offsets(s, d):
    """Topics are event types; the reader has seen all events of the first three weeks."""
    e = b.table(s, d, "events").select("event_type", (F.col("user_id") % 4).cast("int").alias("partition"), "ts")
    seen = F.count_if(F.col("ts") < F.lit("2024-01-22").cast("timestamp_ntz"))
    per = e.groupBy(F.col("event_type").alias("topic"), "partition").agg(
        F.count(F.lit(1)).alias("end_offset"), seen.alias("current_offset"))
    ends = per.select("topic", "partition", "end_offset")
    positions = per.where("topic <> 'error'").select("topic", "partition", F.lit("reader").alias("group"), "current_offset")
    return ends, positions


OFFSETS_SQL = """ends AS (SELECT event_type AS topic, cast(user_id % 4 AS integer) AS partition, count(*) AS end_offset,
    count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-22') AS seen FROM events GROUP BY 1, 2)"""
register("topic_lag", lambda s, d: monitor.lag_report(*offsets(s, d)),
         f"""WITH {OFFSETS_SQL} SELECT topic, partition, end_offset, CASE WHEN topic <> 'error' THEN 'reader' END AS "group",
           CASE WHEN topic <> 'error' THEN seen END AS current_offset, CASE WHEN topic <> 'error' THEN end_offset - seen END AS lag,
           CASE WHEN topic = 'error' THEN 'inactive' WHEN end_offset = seen THEN 'up to date' ELSE 'behind' END AS verdict FROM ends""")
register("group_lag", lambda s, d: monitor.group_lag(monitor.lag_report(*offsets(s, d))),
         f"""WITH {OFFSETS_SQL} SELECT 'reader' AS "group", topic, cast(sum(end_offset - seen) AS bigint) AS lag,
           CASE WHEN sum(end_offset - seen) = 0 THEN 'up to date' ELSE 'behind' END AS verdict FROM ends
           WHERE topic <> 'error' GROUP BY topic""")
register("topic_counts", lambda s, d: monitor.topic_counts(offsets(s, d)[0]),
         "SELECT event_type AS topic, count(*) AS messages FROM events GROUP BY 1")
register("resume_points",
         lambda s, d: monitor.resume_points(b.table(s, d, "events").select(
             F.col("event_type").alias("store"), F.dayofmonth("ts").alias("cycle"), (F.col("value") > 100).alias("ok"))),
         """SELECT event_type AS store, cast(coalesce(max(CASE WHEN value > 100 THEN day(ts) END), 0) AS integer) AS cycle
           FROM events GROUP BY 1""")

"""Hand-made rows for the null, coercion and boundary rules."""

import datetime as dt

from pyspark.sql import functions as F

from aerometer import constants as K
from aerometer import schemas as S
from aerometer.functions import scalars as X
from aerometer.operators import flights as fl
from aerometer.operators import lookback as lb
from aerometer.operators import points as pt
from aerometer.sources import records


def flights(spark, rows):
    names = [n for n, _ in S.fields(S.FLIGHT)]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], S.FLIGHT)


def one(spark, col, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(col.alias("x")).first()["x"]


def test_parse_drops_what_is_not_an_object(spark):
    texts = ['{"icao24":"a","altitude_meters":"123.4","on_ground":true}', '{"icao24":"b","altitude_meters":"abc"}',
             "{}", '["x"]', "12", "null", "", "{oops", None, ' {"icao24":"c","cycle":7}']
    rows = records.parse_records(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    got = {r["icao24"]: (r["altitude_meters"], r["on_ground"], r["cycle"]) for r in rows}
    assert got == {"a": (123.4, True, None), "b": (None, None, None), None: (None, None, None), "c": (None, None, 7)}


def test_states(spark):
    text = ('{"time": 0, "states": [["a","  AB1 ","Land",1,2,0.0,1.0,1000.0,null,100.0,9.0,-1.5,null,1010.0,"0012",false,0],'
            '["b","","Land",1,2,3.0],["c",null,"Land",1,2,null,1.0],["d",null,"Land",1,2,3.0,4.0]]}')
    df = spark.createDataFrame([(text,), ('{"time": 5, "states": null}',), ("bad",)], "value string")
    now = F.expr("timestamp'2024-01-01 00:00:00'")
    rows = {r["icao24"]: r for r in records.explode_states(df, cycle=F.lit(3), now=now).collect()}
    assert set(rows) == {"a", "d"}
    a, d = rows["a"], rows["d"]
    assert (a["callsign"], a["altitude_feet"], a["velocity_kmh"], a["on_ground"]) == ("AB1", 3281.0, 360.0, None)
    assert (a["squawk"], a["cycle"], a["snapshot_timestamp"]) == ("0012", 3, "2024-01-01T00:00:00Z")
    assert (d["callsign"], d["altitude_meters"], d["velocity_ms"]) == ("UNKNOWN", None, None)


def test_null_ground_flag(spark):
    df = flights(spark, [dict(on_ground=g, origin_country="Egypt") for g in (True, False, None)])
    assert fl.pipeline_summary(df).first()["in_air"] == 2
    assert fl.general_stats(df).first()["flights_airborne"] == 2
    assert fl.focus_stats(df).first()["flights_airborne"] == 2
    assert fl.focus_stats(df, null_on_ground="ground").first()["flights_airborne"] == 1


def test_empty_input_gives_zeros(spark):
    df = flights(spark, [])
    assert tuple(fl.pipeline_summary(df).first()) == (0, 0, 0, 0.0, 0.0, 0.0)
    assert set(fl.focus_stats(df).first()) == {0, 0.0}
    assert fl.snapshot_aggregate(df).count() == 0


def test_speed_cap_and_airborne_means(spark):
    df = flights(spark, [dict(velocity_kmh=v, altitude_meters=a, on_ground=g) for v, a, g in (
        (1200.0, 100.0, False), (1200.1, 300.0, None), (10.0, 900.0, True))])
    row = fl.pipeline_summary(df).first()
    assert (row["avg_velocity_kmh"], row["max_velocity_kmh"], row["avg_altitude_meters"]) == (1200.0, 1200.0, 200.0)
    free = fl.pipeline_summary(df, cap=None, airborne_only=False).first()
    assert (free["max_velocity_kmh"], free["avg_altitude_meters"]) == (1200.1, 433.3)


def test_bands(spark):
    df = spark.createDataFrame([(float(v),) for v in (9999, 10000, 29999, 30000, 30001)] + [(None,)], "v double")
    got = [r[0] for r in df.select(X.band("v", K.ALTITUDE_EDGES, K.ALTITUDE_LABELS)).collect()]
    low, mid, high = K.ALTITUDE_LABELS
    assert got == [low, mid, mid, high, high, None]
    climb = spark.createDataFrame([(1.0,), (1.01,), (-1.0,), (-1.01,), (None,)], "v double")
    assert [r[0] for r in climb.select(X.climb_band("v")).collect()] == ["Level", "Climbing", "Level", "Descending", None]


def test_missing_climb_rate_is_level_in_the_stream_and_left_out_in_the_batch(spark):
    df = flights(spark, [dict(origin_country="Egypt", vertical_rate=None), dict(origin_country="Egypt", vertical_rate=5.0)])
    assert tuple(fl.focus_climb(df).first()) == (1, 0, 1)
    assert [tuple(r) for r in fl.vertical_movement(df).collect()] == [("Climbing", 1)]


def test_countries(spark):
    df = flights(spark, [dict(origin_country=c) for c in (None, "", " Egypt ", "Egypt", "Chad")])
    assert {r["country"]: r["flight_count"] for r in fl.country_counts(df).collect()} == {
        "Unknown": 1, "": 1, "Egypt": 2, "Chad": 1}
    assert [(r["country"], r["count"]) for r in fl.top_countries(df, 5).collect()] == [(" Egypt ", 1), ("Chad", 1), ("Egypt", 1)]
    assert fl.region_by_country(df).first()["flight_count"] == 2


def test_top_k_boundary_ties_go_by_name(spark):
    df = flights(spark, [dict(origin_country=f"C{i:02d}") for i in range(12)])
    assert [r["country"] for r in fl.country_top(df).collect()] == [f"C{i:02d}" for i in range(10)]


def test_latest_cycle(spark):
    mixed = flights(spark, [dict(cycle=c) for c in (1, 2, 2, None)])
    assert [r["cycle"] for r in fl.latest_cycle(mixed).collect()] == [2, 2]
    assert fl.latest_cycle(flights(spark, [dict(cycle=None)] * 3)).count() == 3


def test_batch_timestamp_ignores_zero(spark):
    df = flights(spark, [dict(processing_time_ms=t) for t in (0, None, 5000, 4000)])
    assert fl.batch_timestamp(df).select(F.unix_millis("batch_time")).first()[0] == 4000


def test_snapshot_aggregate(spark):
    df = flights(spark, [
        dict(icao24="a", callsign="X1", origin_country="B", altitude_meters=1000.0, velocity_ms=1.0, on_ground=False),
        dict(icao24="b", callsign="UNKNOWN", origin_country="A", altitude_meters=None, on_ground=None),
        dict(icao24="c", callsign="X3", origin_country="", altitude_meters=9000.0, on_ground=True)])
    row = fl.snapshot_aggregate(df).first()
    assert (row["total_flights"], row["in_air"], row["avg_altitude_feet"]) == (3, 2, 3281.0)
    assert [tuple(t) for t in row["top_countries"]] == [("A", 1), ("B", 1)]
    assert row["highest_aircraft"]["callsign"] == "X1"
    assert tuple(row["data_quality"]) == (3, 2, 1, 2)


def test_scalars(spark):
    assert one(spark, X.zero_pad(F.lit(1234567))) == "1234567"
    assert one(spark, X.zero_pad(F.lit(42))) == "000042"
    assert one(spark, X.pct(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, X.epoch_iso(F.lit(1))) == "1970-01-01T00:00:01Z"
    assert one(spark, X.normalise_callsign(F.lit("   "))) == ""
    assert one(spark, X.operator_code(F.lit("UNKNOWN"))) == "Unknown"
    assert one(spark, X.operator_code(F.lit("AB"))) == "Unknown"
    assert one(spark, X.cycle_from_body(F.lit('{"cycle": "12"}'))) == 12
    assert one(spark, X.cycle_from_body(F.lit("{}"))) is None
    assert one(spark, X.safe_cast(F.lit("12x"), "int", 5)) == 5


def test_points_are_sparse(spark):
    df = flights(spark, [dict(icao24="a", callsign="ABC1", origin_country="Egypt", altitude_meters=1.0, squawk=" ",
                              processing_time_ms=1000, cycle=1)])
    points = pt.measurement_points(df).collect()
    detail = {p["field"]: p["value"] for p in points if p["measurement"] == K.M_DETAIL}
    assert detail == {"on_ground_num": 0.0, "altitude_m": 1.0}
    assert {p["measurement"] for p in points} == {K.M_DETAIL, K.M_FOCUS_DETAIL, *pt.SUMMARY_FIELDS, *pt.COUNTRY_FIELDS}
    tags = next(p["tags"] for p in points if p["measurement"] == K.M_DETAIL)
    assert tags == {"icao24": "a", "callsign": "ABC1", "country": "Egypt", "airline": "ABC", "on_ground": "False"}
    wide = pt.measurements(df)
    assert set(wide) == {p["measurement"] for p in points}


def test_batch_sample_points(spark):
    df = flights(spark, [dict(icao24=f"{i:03d}", on_ground=None, velocity_kmh=float(i)) for i in range(120)])
    for sample, n in ((None, 120), (100, 100)):
        out = pt.batch_points(df, F.lit("2024-01-01").cast("timestamp"), sample=sample)
        detail = out.where(F.col("measurement") == K.M_DETAIL)
        assert detail.count() == n and detail.first()["tags"]["on_ground"] == "None"


def test_upsert_keeps_the_latest_write(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("m", "{}", {}, "f", float(v), None, t, v) for v in (1, 3, 2)]
    df = spark.createDataFrame(rows, S.POINT + ", batch_id bigint")
    assert [r["value"] for r in pt.upsert_view(df, "batch_id").collect()] == [3.0]


def test_look_back_bounds(spark):
    now = dt.datetime(2024, 1, 1, 0, 1, 0)
    df = spark.createDataFrame([(now - dt.timedelta(seconds=s),) for s in (0, 1, 20, 21)], "time timestamp")
    assert lb.look_back(df, 20, F.lit(now)).count() == 2


def test_region_list_accepts_a_table(spark):
    df = flights(spark, [dict(origin_country=c) for c in ("A", "B", "C")])
    members = spark.createDataFrame([("A",), ("C",)], "name string")
    assert fl.in_region(df, members).count() == fl.in_region(df, ["A", "C"]).count() == 2

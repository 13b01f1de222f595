"""File sources and report sinks."""

import os

import pytest

from aerometer import schemas as S
from aerometer.sinks.reports import write_sections
from aerometer.sources import files, records


def put(path, text, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    if mtime:
        os.utime(path, (mtime, mtime))


def test_newest_log_and_cycle(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/2024-01-01/10/flights_cycle-000007.log", "{}", 1_700_000_100)
    put(f"{base}/2024-01-01/11/flights_cycle-12.log", "{}", 1_700_000_000)
    put(f"{base}/other.txt", "x", 1_800_000_000)
    assert files.newest_log(spark, base).endswith("flights_cycle-000007.log")
    listed = files.list_files(spark, base, "*.log")
    assert files.max_cycle_from_paths(listed).first()["max_cycle"] == 12
    assert files.max_cycle_from_paths(listed.limit(0)).first()["max_cycle"] == 0


def test_plain_archive(spark, tmp_path):
    base = str(tmp_path)
    put(f"{base}/2024-01-01/10/flights_cycle-1.log", '{"icao24":"a","cycle":1}\nbad\n')
    put(f"{base}/2024-01-02/03/flights_cycle-2.log", '{"icao24":"b","cycle":2}\n')
    rows = files.read_plain_archive(spark, base).orderBy("icao24").collect()
    assert [(r["icao24"], str(r["date"]), r["hour"], r["file_cycle"]) for r in rows] == [
        ("a", "2024-01-01", 10, 1), ("b", "2024-01-02", 3, 2)]
    assert files.read_plain_archive(spark, base, date="2024-01-02").count() == 1


def test_flight_log(spark, tmp_path):
    path = f"{tmp_path}/x.log"
    put(path, '{"icao24":"a","on_ground":true}\nbad line\n')
    assert records.read_flight_log(spark, path).count() == 2
    assert records.read_flight_log(spark, path, keep_malformed=False).count() == 1
    empty = f"{tmp_path}/empty.log"
    put(empty, "")
    with pytest.raises(ValueError):
        records.read_flight_log(spark, empty)


def test_csv_is_cast_field_by_field(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "LCLid,day,energy_sum,extra\nM1,2024-01-01,1.5,x\nM2,nonsense,Null,y\n")
    df = files.read_csv(spark, f"{tmp_path}/a.csv", S.METER_DAILY, {"LCLid": "meter_id", "day": "date"})
    rows = df.orderBy("meter_id").collect()
    assert [(r["meter_id"], str(r["date"]), r["energy_sum"], r["energy_std"]) for r in rows] == [
        ("M1", "2024-01-01", 1.5, None), ("M2", "None", None, None)]


def test_sections(spark, tmp_path):
    write_sections({"models": spark.createDataFrame([("a", 1.0)], "model string, f1 double")}, f"{tmp_path}/log")
    assert spark.read.option("header", True).csv(f"{tmp_path}/log/models").first()["model"] == "a"


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        records.open_stream(spark, "pigeon", "x")


def test_only_single_objects_are_records(spark):
    from aerometer.sources.records import parse_records

    texts = ['{"cycle": 1}', '\t{"cycle": 2}', '\n {"cycle": 3} \n', '{"cycle": 4} trailing', '{"cycle": 5}{"cycle": 6}',
             '{"cycle": 7},{"cycle": 8}', '[{"cycle": 9}]', '5', 'null', '', None, '{"cycle": 10', '{"cycle": "11"}',
             '{"cycle": 12.0}', '{"cycle": 12.5}', '{}', '{"cycle": 13}]', '{"cycle": 14}] [', '{"cycle": 15}] [{"cycle": 16}',
             '{"cycle": 17}}', '{"cycle": 18}} ]', '{"cycle": 19}]}', '{"cycle": 20, "squawk": "}]"} ', '{"cycle": 21, "x": [{"a": 1} ]}']
    got = parse_records(spark.createDataFrame([(t,) for t in texts], "value string")).select("cycle").collect()
    assert sorted((r.cycle for r in got), key=repr) == sorted([1, 2, 3, 11, 12, None, None, 20, 21], key=repr)


def test_a_state_that_is_no_list_costs_only_itself(spark):
    from aerometer.sources.records import explode_states

    good = '["a1", " AB1 ", "Egypt", 1, 2, 30.5, 0.0, 1000.5, false, "200", null, null, [1, 2], null, "77", false, 0]'
    text = '{"time": 100, "states": [{"x": 1}, "bad", null, 7, %s, ["a2", "", "", 1, 2, null, 3.0], ["a3", null, null, 1, 2, 0.0]]}' % good
    rows = explode_states(spark.createDataFrame([(text,), ('{"time": 1, "states": null}',), ("junk",)], "value string")).collect()
    assert [(r.icao24, r.callsign, r.longitude, r.velocity_ms, r.squawk) for r in rows] == [("a1", "AB1", 30.5, 200.0, "77")]


def test_csv_files_keep_their_own_header(spark, tmp_path):
    from aerometer.sources.files import read_csv

    (tmp_path / "a.csv").write_text('LCLid,tariff,n\nm1,Std,1\nm2,"To,U",x\n')
    (tmp_path / "b.csv").write_text("﻿n,extra,LCLid\n3,q,m3\n\n4,q,m4\n")
    (tmp_path / "c.csv").write_text("tariff\nStd\n")
    got = read_csv(spark, str(tmp_path), "meter_id string, tariff string, n int", {"LCLid": "meter_id"}).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([
        ("m1", "Std", 1), ("m2", "To,U", None), ("m3", None, 3), ("m4", None, 4), (None, "Std", None)], key=repr)


def test_half_hour_blocks_of_any_column_order(spark, tmp_path):
    from aerometer.sources import meters

    slots = [f"hh_{k}" for k in range(48)]
    (tmp_path / "block_0.csv").write_text(
        ",".join(["LCLid", "day", *slots]) + "\n" + ",".join(["M1", "2024-01-01", *(str(k / 10) for k in range(48))]) + "\n"
        + ",".join(["M2", "2024-01-01", "Null", *(["1.5"] * 47)]) + "\n" + ",".join(["M3", "no day", *(["1"] * 48)]) + "\n")
    (tmp_path / "block_1.csv").write_text("hh_47,day,LCLid,hh_0\n2.5,2024-01-02,M1,\n,,M4,1\n")
    rows = meters.half_hour_blocks(spark, str(tmp_path)).collect()
    got = {(r.meter_id, str(r.ts)): r.energy for r in rows}
    assert len(rows) == 48 + 47 + 1 and got[("M1", "2024-01-01 00:30:00")] == 0.1 and got[("M1", "2024-01-01 23:30:00")] == 4.7
    assert got[("M1", "2024-01-02 23:30:00")] == 2.5 and ("M2", "2024-01-01 00:00:00") not in got
    assert {(r.slot, r.ts.hour * 2 + r.ts.minute // 30) for r in rows} == {(k, k) for k in range(48)}


def test_hourly_weather_by_day(spark, tmp_path):
    from aerometer.sources import meters

    lines = ["time,temperature,windBearing,humidity,icon"]
    temps = {("2024-01-01", 5): 3.0, ("2024-01-01", 6): 4.0, ("2024-01-01", 17): 9.0, ("2024-01-01", 18): 12.0,
             ("2024-01-02", 0): 1.0, ("2024-01-02", 5): -2.0, ("2024-01-02", 12): 7.0}
    lines += [f"{d} {h:02d}:00:00,{t},{350 if h < 12 else 10},0.5,x" for (d, h), t in temps.items()]
    (tmp_path / "w.csv").write_text("\n".join([*lines, "nonsense,1,1,1,x"]) + "\n")
    days = {str(r.date): r for r in meters.weather_by_day(meters.hourly_weather(spark, str(tmp_path / "w.csv"))).collect()}
    one, two = days["2024-01-01"], days["2024-01-02"]
    assert (one.temperatureMax, one.temperatureMin, one.temperatureHigh, one.temperatureLow) == (12.0, 3.0, 9.0, -2.0)
    assert (two.temperatureMax, two.temperatureMin, two.temperatureHigh, two.temperatureLow) == (7.0, -2.0, 7.0, None)
    assert min(one.windBearing, 360 - one.windBearing) < 1e-6 and one.cloudCover is None and one.humidity == 0.5
    assert set(days) == {"2024-01-01", "2024-01-02"}
    empty = spark.createDataFrame([], S.WEATHER_HOURLY)
    assert meters.weather_by_day(empty).collect() == []


def test_households_and_holidays(spark, tmp_path):
    from aerometer.sources import meters

    (tmp_path / "h.csv").write_text('LCLid,stdorToU,Acorn,Acorn_grouped,file\nM1,Std,ACORN-A,Affluent,b0\nM2,ToU,"A,B",,b1\n')
    (tmp_path / "d.csv").write_text('Bank holidays,Type\n2012-12-26,"Boxing, Day"\n')
    assert sorted(map(tuple, meters.households(spark, str(tmp_path / "h.csv")).collect())) == [("M1", "Std", "Affluent"), ("M2", "ToU", None)]
    assert [(str(r.date), r.name) for r in meters.holidays(spark, str(tmp_path / "d.csv")).collect()] == [("2012-12-26", "Boxing, Day")]


def test_a_report_is_one_file_and_reads_back(spark, tmp_path):
    from aerometer.sinks import reports

    models = spark.createDataFrame([("b", 0.5, None), ("a, \"quoted\"", 0.25, "two\nlines"), ("c", None, "")], "Model string, F1 double, Note string")
    many = spark.range(5000).selectExpr("id AS Rank", "concat('f', id) AS Feature").repartition(7)
    path = str(tmp_path / "report")
    reports.write_report(spark, path, "MODEL REPORT", {"Generated": "x", "Best Model": "b"},
                         {"MODEL COMPARISON": (models, ["Model"]), "EMPTY": (models.limit(0), ["Model"]), "FEATURES": (many, ["Rank"])})
    (file,) = [f for f in os.listdir(path) if f.startswith("part-")]
    with open(f"{path}/{file}", encoding="utf-8") as f:
        text = f.read().splitlines()
    assert text[:5] == ["MODEL REPORT", "Generated,x", "Best Model,b", "", "── SECTION 1: MODEL COMPARISON " + "─" * 31]
    assert text[5] == "Model,F1,Note" and text[7:9] == ["b,0.5,", 'c,,""'] or text[7] == "b,0.5,"
    back = reports.read_report(spark, path)
    assert [tuple(r) for r in reports.section(back, "MODEL COMPARISON", "Model string, F1 double").orderBy("Model").collect()] == [
        ("a, \"quoted\"", 0.25), ("b", 0.5), ("c", None)]
    assert reports.section(back, "EMPTY", "Model string").count() == 0
    rank = [r.cells["Rank"] for r in back.where("name = 'FEATURES'").orderBy("place").collect()]
    assert rank == [str(i) for i in range(5000)]
    spark.createDataFrame([("no sections",)], "value string").write.text(f"{path}-plain")
    assert reports.read_report(spark, f"{path}-plain").count() == 0


def test_resume_reads_new_files_only(spark, tmp_path):
    for n in (1, 2, 10):
        put(f"{tmp_path}/logs/2024-01-01/flights_cycle-{n:06d}.log", "{}")
    put(f"{tmp_path}/logs/notes.log", "x")
    put(f"{tmp_path}/points/cycle-2.json", "x")
    at = files.resume_point(spark, {"points": f"{tmp_path}/points", "archive": f"{tmp_path}/none"})
    assert at == {"points": 2, "archive": 0}
    left = lambda n: [p.rsplit("/", 1)[1] for p in files.files_after(spark, f"{tmp_path}/logs", n, "*.log")]
    assert left(at["points"]) == ["flights_cycle-000010.log"] and len(left(0)) == 3 and left(10) == []

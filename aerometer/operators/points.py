"""Measurement points: sparse long form, the two emissions, upsert and retention."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometer import constants as K
from aerometer.functions import scalars as X
from aerometer.operators import flights as fl


def to_points(df: DataFrame, measurement: str, tags: Sequence[str], fields: Sequence[str],
              text_fields: Sequence[str] = (), time: str = "time") -> DataFrame:
    """Wide rows to one row per present field; null fields and empty texts vanish."""
    cells = [_cell(measurement, f, F.col(f"`{f}`")) for f in fields]
    cells += [_cell(measurement, f, None, F.nullif(F.col(f"`{f}`"), F.lit(""))) for f in text_fields]
    return _emit(df, cells, F.col(time), _tag_map(*[(t, t) for t in tags]))


def value_points(df: DataFrame, measurement: str, tags: Sequence[str], value: Column | str,
                 time: str = "time") -> DataFrame:
    """One `value` field per row: a number where the text parses as one, the text otherwise."""
    text = X.as_col(value).cast("string")
    num = text.try_cast("double")
    cell = _cell(measurement, "value", num, F.when(num.isNull(), text))
    return _emit(df, [cell], F.col(time), _tag_map(*[(t, t) for t in tags]))


def flight_detail(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One detail row per flight: five tags, eight optional numbers, the ground flag, the squawk."""
    grounded = ~X.in_air("on_ground")
    callsign = X.text_or("callsign", "UNKNOWN")
    return df.select(
        *extra, X.text_or("icao24", "unknown").alias("icao24"), callsign.alias("callsign"),
        X.text_or("origin_country", "Unknown").alias("country"),
        X.operator_code(callsign).alias("airline"), X.bool_tag(grounded).alias("on_ground"),
        X.bool_num(grounded).alias("on_ground_num"),
        *[F.col(src).alias(name) for name, src in K.DETAIL_FIELDS.items()],
        F.nullif(F.trim("squawk"), F.lit("")).alias("squawk"))


DETAIL_TAGS = ["icao24", "callsign", "country", "airline", "on_ground"]
DETAIL_NUMBERS = ["on_ground_num", *K.DETAIL_FIELDS]


def measurements(df: DataFrame, focus: str = K.FOCUS_COUNTRY,
                 region: Sequence[str] = tuple(K.REGION_COUNTRIES), by: Sequence[str] = (),
                 only: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The nine wide tables of a batch (or of every group in `by`), each lazy; `only` names some.

    Five of them come from the same aggregation and two from the same country grouping, so
    written together they cost three passes over the persisted batch.
    """
    keep = list(by)

    def total() -> DataFrame:
        return fl.batch_summary(df, focus, region, by=by)

    def per_country() -> DataFrame:
        return fl.country_metrics(df, by)

    tables = {
        K.M_DETAIL: lambda: flight_detail(df, extra=by),
        K.M_SUMMARY: lambda: total().select(
            *keep, "total_flights", "in_air", "on_ground", "avg_altitude_meters", "avg_velocity_kmh",
            "max_velocity_kmh"),
        K.M_CLIMB: lambda: total().select(*keep, *K.CLIMB_LABELS),
        K.M_BANDS: lambda: total().select(*keep, *[f"`{b}`" for b in K.ALTITUDE_LABELS]),
        K.M_REGION: lambda: total().select(
            *keep, F.col("region_total").alias("total_flights"), F.col("region_in_air").alias("in_air")),
        K.M_REGION_COUNTRY: lambda: per_country().where(F.col("country").isin(list(region))),
        K.M_COUNTRY: lambda: per_country().select(*keep, "country", "flight_count"),
        K.M_FOCUS: lambda: total().select(
            *keep, F.col("focus_total").alias("total_flights"), F.col("focus_in_air").alias("in_air")),
        K.M_FOCUS_DETAIL: lambda: flight_detail(df, extra=by).where(F.col("country") == focus),
    }
    return {name: build() for name, build in tables.items() if only is None or name in only}


def _tag_map(*pairs: tuple[str, Column | str]) -> Column:
    if not pairs:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[x for name, c in pairs for x in (F.lit(name), X.as_col(c).cast("string"))])


def _cell(measurement: Column | str, field: str, value: Column | None, text: Column | None = None,
          tags: Column | None = None) -> Column:
    name = F.lit(measurement) if isinstance(measurement, str) else measurement
    none_text, none_num = F.lit(None).cast("string"), F.lit(None).cast("double")
    own = [] if tags is None else [tags.alias("tags")]
    return F.struct(name.alias("measurement"), *own, F.lit(field).alias("field"),
                    (none_num if value is None else value.cast("double")).alias("value"),
                    (none_text if text is None else text).alias("value_str"))


def _emit(df: DataFrame, cells: Sequence[Column], time: Column, tags: Column | None = None) -> DataFrame:
    """One pass from wide rows to points: cells without a measurement or a value vanish.

    `tags` are shared by all cells of a row and built once per row; without it each cell brings
    its own.
    """
    shared = [] if tags is None else [tags.alias("tags"), F.to_json(tags).alias("series")]
    names = ["time"] if tags is None else ["time", "tags", "series"]
    wide = df.select(time.alias("time"), *shared, F.array(*cells).alias("_cells"))
    out = wide.select(*names, F.inline("_cells")).where(
        F.col("measurement").isNotNull() & (F.col("value").isNotNull() | F.col("value_str").isNotNull()))
    series = F.to_json("tags").alias("series") if tags is None else F.col("series")
    return out.select("measurement", series, "tags", "field", "value", "value_str", "time")


SUMMARY_FIELDS = {
    K.M_SUMMARY: {c: c for c in ("total_flights", "in_air", "on_ground", "avg_altitude_meters",
                                 "avg_velocity_kmh", "max_velocity_kmh")},
    K.M_CLIMB: {c: c for c in K.CLIMB_LABELS},
    K.M_BANDS: {c: c for c in K.ALTITUDE_LABELS},
    K.M_REGION: {"total_flights": "region_total", "in_air": "region_in_air"},
    K.M_FOCUS: {"total_flights": "focus_total", "in_air": "focus_in_air"},
}
COUNTRY_FIELDS = {K.M_COUNTRY: ["flight_count"],
                  K.M_REGION_COUNTRY: ["flight_count", "in_air", "avg_altitude_meters"]}


def measurement_points(df: DataFrame, time: Column | None = None, focus: str = K.FOCUS_COUNTRY,
                       region: Sequence[str] = tuple(K.REGION_COUNTRIES),
                       by: Sequence[str] = (), only: Sequence[str] | None = None) -> DataFrame:
    """All points of a batch in long form: one grouping by country, from which the five summaries and two
    country tables are added up, and one projection for both detail tables. Where no exchange is reused
    the batch is read three times, so hand in a persisted or written one if it is costly to make.

    `time` is the point time, computed from the `by` columns or a literal; by default it is the
    batch's smallest ingest time, or the clock when there is none. `only` names measurements.
    """
    if time is None:
        if by:
            raise ValueError("grouped points need a time column")
        time = fl.batch_timestamp(df).scalar()

    def asked(name: str) -> bool:
        return only is None or name in only

    parts = []
    summary = [_cell(m, f, F.col(f"`{c}`")) for m, fields in SUMMARY_FIELDS.items() if asked(m)
               for f, c in fields.items()]
    cells = fl.country_cells(df, by) if summary else None
    if summary:
        parts.append(_emit(fl.summary_of_cells(cells, focus, region, by), summary, time, _tag_map()))
    country = []
    if asked(K.M_COUNTRY):
        country += [_cell(K.M_COUNTRY, f, F.col(f)) for f in COUNTRY_FIELDS[K.M_COUNTRY]]
    if asked(K.M_REGION_COUNTRY):
        member = F.when(F.col("country").isin(list(region)), F.lit(K.M_REGION_COUNTRY))
        country += [_cell(member, f, F.col(f)) for f in COUNTRY_FIELDS[K.M_REGION_COUNTRY]]
    if country:
        metrics = fl.metrics_of_cells(cells, by) if summary else fl.country_metrics(df, by)
        parts.append(_emit(metrics, country, time, _tag_map(("country", "country"))))
    names = []
    if asked(K.M_DETAIL):
        names.append(F.lit(K.M_DETAIL))
    if asked(K.M_FOCUS_DETAIL):
        names.append(F.when(F.col("country") == focus, F.lit(K.M_FOCUS_DETAIL)))
    if names:
        detail = flight_detail(df, extra=by)
        if not asked(K.M_DETAIL):
            detail = detail.where(F.col("country") == focus)
        named = detail.select("*", F.explode(F.array(*names)).alias("_m")).where(F.col("_m").isNotNull())
        tags = _tag_map(*[(t, t) for t in DETAIL_TAGS])
        cells = [_cell(F.col("_m"), f, F.col(f)) for f in DETAIL_NUMBERS]
        cells.append(_cell(F.col("_m"), "squawk", None, F.col("squawk")))
        parts.append(_emit(named, cells, time, tags))
    return reduce(DataFrame.unionAll, parts)


def heartbeat_point(df: DataFrame, time: Column) -> DataFrame:
    """The zero-valued summary point of an empty batch (`df` gives only the session)."""
    spark = df.sparkSession
    zero = spark.range(1).select(*[F.lit(0.0).alias(c) for c in (
        "total_flights", "in_air", "on_ground", "avg_altitude_meters", "avg_velocity_kmh",
        "max_velocity_kmh")], time.alias("time"))
    return to_points(zero, K.M_SUMMARY, [], [c for c in zero.columns if c != "time"])


def _stat_cells(measurement: str, category: str, cols: dict[str, str]) -> list[Column]:
    return [_cell(measurement, "value", F.col(c), tags=_tag_map(("category", F.lit(category)), ("metric", F.lit(m))))
            for m, c in cols.items()]


DETAIL_SERIES = ["icao24", "callsign", "country", "on_ground"]
DETAIL_VALUES = ["altitude_meters", "altitude_feet", "velocity_kmh", "true_track", "vertical_rate", "longitude", "latitude"]


def batch_points(df: DataFrame, time: Column, focus: str = K.FOCUS_COUNTRY, sample: int | None = None,
                 tasks: int | None = None, each: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The ten measurement tables of the batch report as points. Details are of all flights; `sample`
    makes them those of the first so many, as the printed report has them. With `tasks` the details are dealt over so many by their
    series before they become points, so what is grouped by series needs no shuffle of points. `each` is applied to
    the tables of one source, whose measurements no other source has.

    Every one-row statistic comes from one aggregation; the three distributions are rolled up from
    one grouping by their three bands; countries, the two top lists and the details have their own.
    """
    stats, groups = fl.report_stats(df, focus)
    one_row = (_stat_cells("flight_statistics", "general", groups["general"])
               + _stat_cells("egypt_statistics", "egypt", groups["focus"])
               + _stat_cells("flight_statistics", "altitude", groups["altitude"])
               + _stat_cells("flight_statistics", "velocity", groups["velocity"])
               + [_cell("geographic_center", f, F.col(f"geo_center_{f}"), tags=_tag_map()) for f in ("longitude", "latitude")])
    bands = fl.band_counts(df)
    band_tag = F.when(F.col("table") == "vertical_movement", _tag_map(("movement", "band"))).otherwise(
        _tag_map(("category", "band")))
    detail = df if sample is None else fl.sample_rows(df, ["icao24", "cycle", "callsign"], sample)
    detail = detail.withColumns({
        "icao24": F.coalesce("icao24", F.lit("unknown")),
        "callsign": F.coalesce("callsign", F.lit("UNKNOWN")),
        "country": F.coalesce("origin_country", F.lit("Unknown")),
        "on_ground": F.coalesce(X.bool_tag("on_ground"), F.lit("None"))}).select(*DETAIL_SERIES, *DETAIL_VALUES)
    if tasks is not None:
        detail = detail.repartition(tasks, F.to_json(_tag_map(*[(t, t) for t in DETAIL_SERIES])))
    parts = [
        _emit(stats, one_row, time),
        _emit(bands, [_cell(F.col("table"), "count", F.col("count"))], time, band_tag),
        to_points(fl.country_top(df).withColumn("time", time), "country_statistics", ["country"],
                  ["flight_count", "avg_speed_kmh", "avg_altitude_m"]),
        to_points(fl.fastest(df).withColumn("time", time), "fastest_flights", ["callsign", "country"],
                  ["speed_kmh", "altitude_ft"]),
        to_points(fl.highest(df).withColumn("time", time), "highest_flights", ["callsign", "country"],
                  ["altitude_m", "altitude_ft", "speed_kmh"]),
        to_points(detail.withColumn("time", time), K.M_DETAIL, DETAIL_SERIES, DETAIL_VALUES),
    ]
    return reduce(DataFrame.unionAll, parts if each is None else map(each, parts))


POINT_IDENTITY = ["measurement", "series", "field", "time"]


def upsert_view(points: DataFrame, version: str | Sequence[str], ties: Sequence[str] = ("value", "value_str")) -> DataFrame:
    """One row per (measurement, tags, field, time): the row of the highest version, of equal ones
    the greatest by `ties`, so two writes of one identity in a batch give the same winner each time.

    An aggregation, not a ranking: repeated writes of one identity are combined before the
    shuffle, so a hot identity costs one row per task.
    """
    version = [version] if isinstance(version, str) else list(version)
    rest = [c for c in points.columns if c not in POINT_IDENTITY]
    payload = [c for c in rest if c not in version]
    last = F.max_by(F.struct(*payload), F.struct(*version, *[c for c in ties if c in payload])).alias("p")
    return points.groupBy(*POINT_IDENTITY).agg(last).select(
        "measurement", "series", *[f"p.{c}" for c in payload], "field", "time")


def retain(points: DataFrame, days: int, time: str = "time") -> DataFrame:
    """Points no older than `days` before the newest one."""
    newest = points.agg(F.max(time).alias("t")).scalar()
    return points.where(F.col(time) >= newest - F.make_dt_interval(F.lit(days)))

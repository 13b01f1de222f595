"""Look-back queries over measurement points: the dashboard's operators and saved queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometer import constants as K
from aerometer.functions import scalars as X
from aerometer.operators.flights import top_k


def look_back(df: DataFrame, seconds: float, now: Column | None = None, time: str = "time") -> DataFrame:
    """Rows of the last `seconds` before `now` (the clock unless given)."""
    now = F.current_timestamp() if now is None else now
    gap = F.make_dt_interval(secs=F.lit(float(seconds)))
    return df.where((F.col(time) >= now - gap) & (F.col(time) < now))


def select_points(df: DataFrame, measurement: str, fields: Sequence[str] = ()) -> DataFrame:
    out = df.where(F.col("measurement") == measurement)
    return out.where(F.col("field").isin(list(fields))) if fields else out


def last_per(df: DataFrame, keys: Sequence[str], time: str = "time", tie: Sequence[str] = ()) -> DataFrame:
    """The latest row of every key; equal times are settled by `tie`, then by the other columns."""
    rest = [c for c in df.columns if c not in keys]
    simple = [c for c, t in df.dtypes if c in rest and c != time and not t.startswith("map")]
    order = F.struct(time, *tie, *[c for c in simple if c not in tie])
    last = F.max_by(F.struct(*rest), order).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, "last.*")


def pivot_fields(df: DataFrame, keys: Sequence[str], field: str, value: str,
                 fields: Sequence[str]) -> DataFrame:
    """One column per named field, one row per key."""
    cells = [F.max(F.when(F.col(field) == f, F.col(value))).alias(f) for f in fields]
    return df.groupBy(*keys).agg(*cells) if keys else df.agg(*cells)


def relabel(df: DataFrame, col: str, mapping: dict[str, str], default: str | None = None) -> DataFrame:
    """Replace values by their label; others take the default, or stay when there is none."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    other = F.col(col) if default is None else F.lit(default)
    return df.withColumn(col, F.coalesce(F.try_element_at(pairs, F.col(col)), other))


def tag(name: str) -> Column:
    return F.try_element_at(F.col("tags"), F.lit(name)).alias(name)


def spread_tags(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[tag(n) for n in names], "field", "value", "time")


# ---------------------------------------------------------------------------- saved queries

WINDOW_SECONDS = 20


def latest_stat(points: DataFrame, measurement: str, field: str, now: Column | None = None,
                seconds: float = WINDOW_SECONDS, steps: tuple | None = None) -> DataFrame:
    """The latest value of one field, with its colour when steps are given."""
    seen = look_back(select_points(points, measurement, [field]), seconds, now)
    out = last_per(seen.select("field", "value", "time"), ["field"])
    if steps:
        out = out.withColumn("level", X.band("value", steps[0], steps[1]))
    return out


def _live(points: DataFrame, measurement: str, now, seconds) -> DataFrame:
    keys = ["icao24", "callsign", "country", "airline"]
    fields = ["latitude", "longitude", "altitude_m", "velocity_kmh"]
    seen = look_back(select_points(points, measurement, fields), seconds, now)
    last = last_per(spread_tags(seen, keys), [*keys, "field"])
    return pivot_fields(last, keys, "field", "value", fields)


def live_positions(points: DataFrame, now: Column | None = None, seconds: float = WINDOW_SECONDS) -> DataFrame:
    """Last position, height and speed of each aircraft with both coordinates known."""
    return _live(points, K.M_DETAIL, now, seconds).where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull())


def focus_live(points: DataFrame, now: Column | None = None, seconds: float = WINDOW_SECONDS) -> DataFrame:
    """Last values of the focus country's aircraft, unknown speed as 0, fastest first."""
    out = _live(points, K.M_FOCUS_DETAIL, now, seconds)
    speed = X.or_zero("velocity_kmh")
    return (out.withColumn("Speed (km/h)", speed)
            .orderBy(F.desc("Speed (km/h)"), "icao24", "callsign"))


def country_ranking(points: DataFrame, now: Column | None = None, n: int = 10,
                    seconds: float = WINDOW_SECONDS) -> DataFrame:
    """The n countries with the highest latest count, ties by name, and the colour of the count."""
    seen = look_back(select_points(points, K.M_COUNTRY, ["flight_count"]), seconds, now)
    last = last_per(spread_tags(seen, ["country"]).drop("field"), ["country"])
    top = top_k(last.where(F.col("value") > 0), [F.desc("value"), "country"], n, ["time", "country", "value"])
    return top.withColumn("country_level", X.band("value", *K.COUNTRY_STEPS))


def country_ranking_wide(points: DataFrame, countries: Sequence[str], now: Column | None = None,
                         n: int = 10, seconds: float = WINDOW_SECONDS) -> DataFrame:
    """The same ranking with one column per listed country."""
    return pivot_fields(country_ranking(points, now, n, seconds), ["time"], "country", "value", countries)


def split_share(points: DataFrame, measurement: str, mapping: dict[str, str],
                now: Column | None = None, seconds: float = WINDOW_SECONDS) -> DataFrame:
    """Latest value of the mapped fields, under their labels."""
    seen = look_back(select_points(points, measurement, list(mapping)), seconds, now)
    last = last_per(seen.select("field", "value", "time"), ["field"])
    return relabel(last, "field", mapping)


def split_share_wide(points: DataFrame, measurement: str, mapping: dict[str, str],
                     now: Column | None = None, seconds: float = WINDOW_SECONDS) -> DataFrame:
    long = split_share(points, measurement, mapping, now, seconds)
    return pivot_fields(long, ["time"], "field", "value", list(mapping.values()))


def region_table(points: DataFrame, now: Column | None = None, seconds: float = WINDOW_SECONDS) -> DataFrame:
    """Last values per region country, most flights first, with the table's colours."""
    fields = ["flight_count", "in_air", "avg_altitude_meters"]
    seen = look_back(select_points(points, K.M_REGION_COUNTRY), seconds, now)
    last = last_per(spread_tags(seen, ["country"]), ["country", "field"])
    wide = pivot_fields(last, ["country"], "field", "value", fields)
    return wide.withColumns({
        "count_level": X.band("flight_count", *K.REGION_COUNT_STEPS),
        "air_level": X.band("in_air", *K.REGION_AIR_STEPS),
        "altitude_level": X.band("avg_altitude_meters", *K.REGION_ALT_STEPS),
    }).orderBy(F.desc("flight_count"), "country")

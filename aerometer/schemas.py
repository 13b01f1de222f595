"""Input and output schemas."""

from pyspark.sql.types import StructType

# --- fixed values: the flight record on the wire --------------------------------------------
FLIGHT = (
    "icao24 string, callsign string, origin_country string, time_position bigint, "
    "last_contact bigint, longitude double, latitude double, altitude_meters double, "
    "altitude_feet double, on_ground boolean, velocity_ms double, velocity_kmh double, "
    "true_track double, vertical_rate double, geo_altitude_meters double, squawk string, "
    "position_source int, snapshot_timestamp string, ingestion_timestamp string, "
    "processing_time_ms bigint, cycle int"
)

# --- fixed values: slots of a raw state vector ----------------------------------------------
STATE_SLOTS = {
    "icao24": 0, "callsign": 1, "origin_country": 2, "time_position": 3, "last_contact": 4,
    "longitude": 5, "latitude": 6, "baro_altitude": 7, "on_ground": 8, "velocity": 9,
    "true_track": 10, "vertical_rate": 11, "sensors": 12, "geo_altitude": 13, "squawk": 14,
    "spi": 15, "position_source": 16,
}
SNAPSHOT = "time bigint, states array<string>"

# Measurement points in long form; `series` is the tag set as text, the identity of a series.
POINT = (
    "measurement string, series string, tags map<string,string>, field string, "
    "value double, value_str string, time timestamp"
)

METER_DAILY = (
    "meter_id string, date date, energy_median double, energy_mean double, energy_max double, "
    "energy_count int, energy_std double, energy_sum double, energy_min double"
)
METER_HALF_HOUR = "meter_id string, ts timestamp, energy double"
HOUSEHOLD = "meter_id string, tariff string, social_group string"
WEATHER_DAILY = (
    "date date, temperatureMax double, temperatureMin double, temperatureHigh double, "
    "temperatureLow double, humidity double, cloudCover double, pressure double, "
    "windSpeed double, windBearing double, dewPoint double"
)
WEATHER_HOURLY = (
    "time timestamp, temperature double, humidity double, pressure double, windSpeed double, "
    "windBearing double, dewPoint double"
)
HOLIDAY = "date date, name string"


def fields(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a flat schema string."""
    return [tuple(part.strip().split(" ", 1)) for part in ddl.split(", ")]


def fields_of(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a schema string whose types may hold commas."""
    return [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl).fields]


def as_text(ddl: str) -> str:
    """The same flat schema with every field read as text."""
    return ", ".join(f"{name} string" for name, _ in fields(ddl))

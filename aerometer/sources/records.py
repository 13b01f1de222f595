"""Record sources: message streams, JSON text, raw snapshots and JSON-lines files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer import constants as K
from aerometer import schemas as S
from aerometer.functions import scalars as X


def open_stream(spark: SparkSession, source: str, location: str, schema: str = "value string",
                max_per_trigger: int | None = 15000, fmt: str = "text",
                starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                **options: str) -> DataFrame:
    """A bounded-rate stream.

    source='kafka': `location` is the topic and `options` carries the broker list; message bytes
    are decoded to a `value` text column. source='files': `location` is a folder, and
    `max_per_trigger` counts files.
    """
    if source == "kafka":
        reader = (spark.readStream.format("kafka").option("subscribe", location)
                  .option("startingOffsets", starting_offsets)
                  .option("failOnDataLoss", str(fail_on_data_loss).lower()))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return decode_value(reader.options(**options).load())
    if source == "files":
        reader = spark.readStream.format(fmt).schema(schema)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.options(**options).load(location)
    raise ValueError(f"source must be kafka or files, not {source!r}")


def decode_value(df: DataFrame, col: str = "value") -> DataFrame:
    return df.select(F.col(col).cast("string").alias("value"))


def parse_records(df: DataFrame, schema: str = S.FLIGHT, value: str = "value") -> DataFrame:
    """JSON text to typed rows; malformed text and anything but an object is dropped.

    Every field is read as text first and then cast on its own, so one bad field becomes null
    instead of costing the whole record, quoted numbers are accepted and a whole number may be
    written with a fraction of zero. The text is read as a list of one, which tells an object from
    an object with more text behind it; blanks of any kind may stand around it. A text that may close
    that list itself must also parse as a member of an object: what closes one does not close the other.
    """
    member = F.from_json(F.concat(F.lit('{"r":'), F.col(value), F.lit("}")), "r string")["r"]
    alone = ~F.col(value).rlike(r"\}\s*\]") | member.isNotNull()
    rows = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), f"array<struct<{_colons(S.as_text(schema))}>>")
    # `inline` keeps the parse a step of its own; a plain struct column would be parsed again for
    # every field taken from it.
    parsed = (df.where(F.col(value).rlike(r"^\s*\{") & alone).select(rows.alias("_rows"))
              .where((F.size("_rows") == 1) & F.get("_rows", 0).isNotNull()).select(F.inline("_rows")))
    return parsed.select(*[X.number_cast(name, type_).alias(name) for name, type_ in S.fields(schema)])


def _colons(ddl: str) -> str:
    """`a t, b u` as the fields of a struct type."""
    return ", ".join(f"{name}: {type_}" for name, type_ in S.fields(ddl))


def explode_states(df: DataFrame, value: str = "value", cycle: Column | str | None = None,
                   now: Column | None = None) -> DataFrame:
    """Raw snapshots (one JSON text per row) to flight records.

    A state needs at least seven slots and both coordinates; a state that is no list is left out
    without costing the others. `cycle` numbers the snapshot; `now` is the ingest time (defaults to
    the clock).
    """
    now = F.current_timestamp() if now is None else now
    cycle = F.lit(None) if cycle is None else X.as_col(cycle)
    snap = df.select(
        # `inline` keeps the parse a step of its own, as in parse_records
        F.inline(F.array(F.from_json(F.col(value), S.SNAPSHOT))),
        cycle.cast("int").alias("cycle"), now.alias("_now"))
    # what all states of a snapshot share is made once, before they are told apart
    seconds = F.coalesce(F.nullif(F.col("time"), F.lit(0)), F.unix_seconds("_now"))
    states = (snap.select("cycle", "_now", X.epoch_iso(seconds).alias("_time"), "states")
              .select("cycle", "_now", "_time", F.explode("states").alias("state"))
              .where(F.col("state").rlike(r"^\s*\["))
              # `explode` keeps the parse a step of its own; the filter behind it would repeat it for each condition
              .select("cycle", "_now", "_time", F.explode(F.array(F.from_json("state", "array<string>"))).alias("s"))
              .where((F.size("s") >= 7) & F.get("s", 5).isNotNull() & F.get("s", 6).isNotNull()))

    def slot(name: str, type_: str) -> Column:
        return X.safe_cast(F.get("s", S.STATE_SLOTS[name]), type_)

    metres, speed = slot("baro_altitude", "double"), slot("velocity", "double")
    return states.select(
        slot("icao24", "string").alias("icao24"),
        X.normalise_callsign(F.get("s", S.STATE_SLOTS["callsign"])).alias("callsign"),
        slot("origin_country", "string").alias("origin_country"),
        slot("time_position", "bigint").alias("time_position"),
        slot("last_contact", "bigint").alias("last_contact"),
        slot("longitude", "double").alias("longitude"),
        slot("latitude", "double").alias("latitude"),
        metres.alias("altitude_meters"),
        F.round(X.metres_to_feet(metres), 0).alias("altitude_feet"),
        slot("on_ground", "boolean").alias("on_ground"),
        speed.alias("velocity_ms"),
        F.round(X.ms_to_kmh(speed), 1).alias("velocity_kmh"),
        slot("true_track", "double").alias("true_track"),
        slot("vertical_rate", "double").alias("vertical_rate"),
        slot("geo_altitude", "double").alias("geo_altitude_meters"),
        slot("squawk", "string").alias("squawk"),
        slot("position_source", "int").alias("position_source"),
        F.col("_time").alias("snapshot_timestamp"),
        X.utc_text(F.col("_now"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingestion_timestamp"),
        F.unix_millis("_now").alias("processing_time_ms"),
        "cycle")


def read_flight_log(spark: SparkSession, path: str, keep_malformed: bool = True) -> DataFrame:
    """JSON-lines flight log under the fixed schema.

    A bad line becomes an all-null row, which batch totals count; `keep_malformed=False` drops
    bad lines as the streaming path does. An empty input is an error.
    """
    if keep_malformed:
        try:
            df = spark.read.schema(S.FLIGHT).json(path)
        except AnalysisException:
            df = spark.read.json(path)
    else:
        df = parse_records(spark.read.text(path))
    if df.isEmpty():
        raise ValueError(f"no data found in {path}")
    return df


def derive_flags(df: DataFrame, focus: str = K.FOCUS_COUNTRY) -> DataFrame:
    """Kilometres, knots, the three flags and the load time."""
    return df.withColumns({
        "altitude_km": X.metres_to_km("altitude_meters"),
        "velocity_kts": X.ms_to_knots("velocity_ms"),
        "is_high_altitude": F.col("altitude_feet") > K.HIGH_ALTITUDE_FT,
        "is_fast": F.col("velocity_kmh") > K.FAST_KMH,
        "is_focus": F.col("origin_country") == focus,
        "load_time": F.current_timestamp(),
    })

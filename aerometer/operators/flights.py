"""Fleet statistics over flight records.

Every statistic is one aggregation with map-side partials. Conditions sit inside the aggregate
functions, so many statistics share a single pass and a hot country or cycle is combined before
it is shuffled. `by` names grouping columns (for example the cycle); without it the result is one
row for the whole input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from aerometer import constants as K
from aerometer.functions import scalars as X


def count_where(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _agg(df: DataFrame, by: Sequence[str], aggs: list[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


# ---------------------------------------------------------------------------- filters

def with_position(df: DataFrame) -> DataFrame:
    return df.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())


def latest_cycle(df: DataFrame, cycle: str = "cycle") -> DataFrame:
    """Rows of the highest cycle; all rows when no row carries a cycle."""
    top = df.agg(F.max(cycle).alias("top")).scalar()
    return df.where(F.coalesce(F.col(cycle) == top, top.isNull()))


def in_region(df: DataFrame, members: Sequence[str] | DataFrame, col: str = "origin_country") -> DataFrame:
    """Rows whose country is a member; members are a list or a one-column table."""
    if isinstance(members, DataFrame):
        name = members.columns[0]
        return df.join(members, df[col] == members[name], "left_semi")
    return df.where(F.col(col).isin(list(members)))


def in_country(df: DataFrame, country: str, col: str = "origin_country") -> DataFrame:
    return df.where(F.col(col) == country)


# ---------------------------------------------------------------------------- one-row statistics

def general_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals; a null ground flag counts as airborne."""
    grouped = _agg(df, by, [F.count(F.lit(1)).alias("total_flights"),
                            count_where(F.col("on_ground")).alias("flights_on_ground")])
    airborne = F.col("total_flights") - F.col("flights_on_ground")
    return grouped.select(
        *by, "total_flights", airborne.alias("flights_airborne"), "flights_on_ground",
        X.pct(airborne, F.col("total_flights")).alias("airborne_percentage"))


def focus_stats(df: DataFrame, country: str = K.FOCUS_COUNTRY, null_on_ground: str = "air",
                by: Sequence[str] = ()) -> DataFrame:
    """Eight numbers for one country, all zero when it is absent."""
    here = F.col("origin_country") == country
    air = X.in_air("on_ground", null_on_ground)
    alt, vel = F.col("altitude_meters"), F.col("velocity_kmh")
    grouped = _agg(df, by, [
        F.count(F.lit(1)).alias("_all"),
        count_where(here).alias("total_flights"),
        count_where(here & air).alias("flights_airborne"),
        F.avg(F.when(here, alt)).alias("_avg_alt"), F.max(F.when(here, alt)).alias("_max_alt"),
        F.avg(F.when(here, vel)).alias("_avg_vel"), F.max(F.when(here, vel)).alias("_max_vel")])
    return grouped.select(
        *by, "total_flights", "flights_airborne",
        (F.col("total_flights") - F.col("flights_airborne")).alias("flights_on_ground"),
        X.pct("total_flights", "_all").alias("percentage_of_total"),
        F.round(X.or_zero("_avg_alt"), 2).alias("avg_altitude_m"),
        F.round(X.or_zero("_max_alt"), 2).alias("max_altitude_m"),
        F.round(X.or_zero("_avg_vel"), 2).alias("avg_velocity_kmh"),
        F.round(X.or_zero("_max_vel"), 2).alias("max_velocity_kmh"))


def _spread(df: DataFrame, col: str, unit: str, by: Sequence[str]) -> DataFrame:
    grouped = _agg(df, by, [F.avg(col).alias("avg"), F.max(col).alias("max"),
                            F.min(col).alias("min"), F.stddev_samp(col).alias("stddev")])
    return grouped.select(*by, *[F.round(X.or_zero(s), 2).alias(f"{s}_{unit}")
                                 for s in ("avg", "max", "min", "stddev")],
                          X.or_zero("avg").alias("_avg"), X.or_zero("max").alias("_max"))


def altitude_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return (_spread(df, "altitude_meters", "meters", by)
            .withColumns({"avg_feet": F.round(X.metres_to_feet("_avg"), 2),
                          "max_feet": F.round(X.metres_to_feet("_max"), 2)})
            .drop("_avg", "_max"))


def velocity_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _spread(df, "velocity_kmh", "kmh", by).drop("_avg", "_max")


def geographic(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Arithmetic centre and bounding box of the positioned rows."""
    grouped = _agg(with_position(df), by, [
        F.avg("longitude").alias("center_longitude"), F.avg("latitude").alias("center_latitude"),
        F.min("longitude").alias("min_longitude"), F.max("longitude").alias("max_longitude"),
        F.min("latitude").alias("min_latitude"), F.max("latitude").alias("max_latitude")])
    return grouped.select(*by, *[F.round(X.or_zero(c), 4).alias(c)
                                 for c in grouped.columns if c not in by])


def by_country(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "origin_country").agg(
        F.count(F.lit(1)).alias("flight_count"), F.avg("velocity_kmh").alias("avg_speed"),
        F.avg("altitude_meters").alias("avg_altitude"))


def country_top(df: DataFrame, k: int = 10) -> DataFrame:
    """The k countries with most flights, ties by name. A null country is its own group, named
    Unknown only in the result."""
    top = top_k(by_country(df), [F.desc("flight_count"), F.asc_nulls_first("origin_country")], k)
    return top.select(
        F.coalesce(F.nullif("origin_country", F.lit("")), F.lit("Unknown")).alias("country"),
        "flight_count",
        F.round(X.or_zero("avg_speed"), 2).alias("avg_speed_kmh"),
        F.round(X.or_zero("avg_altitude"), 2).alias("avg_altitude_m"))


def distribution(df: DataFrame, label: Column, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Row count per label; rows without a label are left out."""
    return (df.select(*by, label.alias(name)).where(F.col(name).isNotNull())
            .groupBy(*by, name).agg(F.count(F.lit(1)).alias("count")))


def altitude_distribution(df: DataFrame) -> DataFrame:
    return distribution(df, X.band("altitude_feet", K.ALTITUDE_EDGES, K.ALTITUDE_LABELS), "category")


def speed_distribution(df: DataFrame) -> DataFrame:
    return distribution(df, X.band("velocity_kmh", K.SPEED_EDGES, K.SPEED_LABELS), "category")


def vertical_movement(df: DataFrame) -> DataFrame:
    return distribution(df, X.climb_band("vertical_rate"), "movement")


def band_counts(df: DataFrame) -> DataFrame:
    """The three distributions as (table, band, count): rows are first counted per combination of
    bands, so the input is read once and only a few rows are rolled up."""
    combos = df.groupBy(
        X.band("altitude_feet", K.ALTITUDE_EDGES, K.ALTITUDE_LABELS).alias("a"),
        X.band("velocity_kmh", K.SPEED_EDGES, K.SPEED_LABELS).alias("s"),
        X.climb_band("vertical_rate").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    each = combos.select("n", F.inline(F.array(*[
        F.struct(F.lit(t).alias("table"), F.col(c).alias("band")) for t, c in
        (("altitude_distribution", "a"), ("speed_distribution", "s"), ("vertical_movement", "v"))])))
    return (each.where(F.col("band").isNotNull()).groupBy("table", "band").agg(F.sum("n").alias("count")))


def report_stats(df: DataFrame, country: str = K.FOCUS_COUNTRY,
                 null_on_ground: str = "air") -> tuple[DataFrame, dict[str, dict[str, str]]]:
    """Every one-row statistic of the batch report from a single aggregation.

    Returns the row and, per group, the map from metric name to its column.
    """
    here = F.col("origin_country") == country
    air = X.in_air("on_ground", null_on_ground)
    alt, vel = F.col("altitude_meters"), F.col("velocity_kmh")
    placed = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    raw = df.agg(
        F.count(F.lit(1)).alias("n"), count_where(F.col("on_ground")).alias("grounded"),
        count_where(here).alias("f"), count_where(here & air).alias("f_air"),
        F.avg(F.when(here, alt)).alias("f_aa"), F.max(F.when(here, alt)).alias("f_ma"),
        F.avg(F.when(here, vel)).alias("f_av"), F.max(F.when(here, vel)).alias("f_mv"),
        *[fn(c).alias(f"{k}_{name}") for k, c in (("a", alt), ("v", vel))
          for name, fn in (("avg", F.avg), ("max", F.max), ("min", F.min), ("stddev", F.stddev_samp))],
        F.avg(F.when(placed, F.col("longitude"))).alias("lon"), F.avg(F.when(placed, F.col("latitude"))).alias("lat"))
    airborne = F.col("n") - F.col("grounded")
    spread = ("avg", "max", "min", "stddev")
    exprs = {
        "general": {"total_flights": F.col("n"), "flights_airborne": airborne, "flights_on_ground": F.col("grounded"),
                    "airborne_percentage": X.pct(airborne, F.col("n"))},
        "focus": {"total_flights": F.col("f"), "flights_airborne": F.col("f_air"),
                  "flights_on_ground": F.col("f") - F.col("f_air"), "percentage_of_total": X.pct("f", "n"),
                  **{name: F.round(X.or_zero(c), 2) for name, c in (
                      ("avg_altitude_m", "f_aa"), ("max_altitude_m", "f_ma"), ("avg_velocity_kmh", "f_av"),
                      ("max_velocity_kmh", "f_mv"))}},
        "altitude": {**{f"{x}_meters": F.round(X.or_zero(f"a_{x}"), 2) for x in spread},
                     **{f"{x}_feet": F.round(X.metres_to_feet(X.or_zero(f"a_{x}")), 2) for x in ("avg", "max")}},
        "velocity": {f"{x}_kmh": F.round(X.or_zero(f"v_{x}"), 2) for x in spread},
        "geo": {"center_longitude": F.round(X.or_zero("lon"), 4), "center_latitude": F.round(X.or_zero("lat"), 4)},
    }
    row = raw.select(*[c.alias(f"{g}_{m}") for g, ms in exprs.items() for m, c in ms.items()])
    return row, {g: {m: f"{g}_{m}" for m in ms} for g, ms in exprs.items()}


# ---------------------------------------------------------------------------- streaming summary

def batch_summary(df: DataFrame, focus: str = K.FOCUS_COUNTRY,
                  region: Sequence[str] = tuple(K.REGION_COUNTRIES),
                  cap: float | None = K.SPEED_CAP_KMH, airborne_only: bool = True,
                  null_on_ground: str = "air", by: Sequence[str] = ()) -> DataFrame:
    """Every number of the five summary measurements in one aggregation.

    Means cover airborne rows (all rows with airborne_only=False); speeds above `cap` are left
    out (cap=None keeps them). The batch time is the smallest ingest time.
    """
    air = X.in_air("on_ground", null_on_ground)
    country = X.text_or("origin_country", "Unknown")
    used = air if airborne_only else F.lit(True)
    alt = F.when(used, F.col("altitude_meters"))
    vel = F.when(used, F.col("velocity_kmh"))
    if cap is not None:
        vel = F.when(used & (F.col("velocity_kmh") <= cap), F.col("velocity_kmh"))
    here, there = country == focus, country.isin(list(region))
    climb = X.climb_band(F.coalesce("vertical_rate", F.lit(0.0)))
    height = X.band("altitude_feet", K.ALTITUDE_EDGES, K.ALTITUDE_LABELS)
    aggs = [
        F.count(F.lit(1)).alias("total_flights"), count_where(air).alias("in_air"),
        F.avg(alt).alias("avg_altitude_meters"), F.avg(vel).alias("avg_velocity_kmh"),
        F.max(vel).alias("max_velocity_kmh"),
        *[count_where(here & (climb == c)).alias(c) for c in K.CLIMB_LABELS],
        *[count_where(here & (height == b)).alias(b) for b in K.ALTITUDE_LABELS],
        count_where(there).alias("region_total"), count_where(there & air).alias("region_in_air"),
        count_where(here).alias("focus_total"), count_where(here & air).alias("focus_in_air")]
    if "processing_time_ms" in df.columns:
        aggs.append(F.min(F.nullif("processing_time_ms", F.lit(0))).alias("batch_ms"))
    out = _agg(df, by, aggs)
    return out.withColumns({
        "on_ground": F.col("total_flights") - F.col("in_air"),
        **{c: F.round(X.or_zero(c), 1)
           for c in ("avg_altitude_meters", "avg_velocity_kmh", "max_velocity_kmh")}})


def country_cells(df: DataFrame, by: Sequence[str] = (), cap: float | None = K.SPEED_CAP_KMH,
                  null_on_ground: str = "air") -> DataFrame:
    """Counts, sums and maxima per country: one short row from which the summaries and both country
    tables follow, so the flights are read and grouped once."""
    air = X.in_air("on_ground", null_on_ground)
    speed = air if cap is None else air & (F.col("velocity_kmh") <= cap)
    alt, vel = F.when(air, F.col("altitude_meters")), F.when(speed, F.col("velocity_kmh"))
    climb = X.climb_band(F.coalesce("vertical_rate", F.lit(0.0)))
    height = X.band("altitude_feet", K.ALTITUDE_EDGES, K.ALTITUDE_LABELS)
    return df.groupBy(*by, X.text_or("origin_country", "Unknown").alias("country")).agg(
        F.count(F.lit(1)).alias("n"), count_where(air).alias("air"),
        F.sum(alt).alias("alt"), F.count(alt).alias("alt_n"), F.sum(vel).alias("vel"), F.count(vel).alias("vel_n"),
        F.max(vel).alias("vel_max"), F.avg("altitude_meters").alias("all_alt"),
        *[count_where(climb == c).alias(c) for c in K.CLIMB_LABELS],
        *[count_where(height == b).alias(b) for b in K.ALTITUDE_LABELS])


def summary_of_cells(cells: DataFrame, focus: str = K.FOCUS_COUNTRY, region: Sequence[str] = tuple(K.REGION_COUNTRIES),
                     by: Sequence[str] = ()) -> DataFrame:
    """The numbers of batch_summary, added up from country_cells."""
    here, there = F.col("country") == focus, F.col("country").isin(list(region))

    def total(col: str, member: Column | None = None) -> Column:
        c = F.col(f"`{col}`")
        return F.coalesce(F.sum(c if member is None else F.when(member, c)), F.lit(0))

    out = _agg(cells, by, [
        total("n").alias("total_flights"), total("air").alias("in_air"),
        F.try_divide(F.sum("alt"), F.sum("alt_n")).alias("avg_altitude_meters"),
        F.try_divide(F.sum("vel"), F.sum("vel_n")).alias("avg_velocity_kmh"), F.max("vel_max").alias("max_velocity_kmh"),
        *[total(c, here).alias(c) for c in (*K.CLIMB_LABELS, *K.ALTITUDE_LABELS)],
        total("n", there).alias("region_total"), total("air", there).alias("region_in_air"),
        total("n", here).alias("focus_total"), total("air", here).alias("focus_in_air")])
    return out.withColumns({
        "on_ground": F.col("total_flights") - F.col("in_air"),
        **{c: F.round(X.or_zero(c), 1) for c in ("avg_altitude_meters", "avg_velocity_kmh", "max_velocity_kmh")}})


def metrics_of_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows of country_metrics from country_cells."""
    return cells.select(*by, "country", F.col("n").alias("flight_count"), F.col("air").alias("in_air"),
                        F.round(X.or_zero("all_alt"), 1).alias("avg_altitude_meters"))


def pipeline_summary(df: DataFrame, by: Sequence[str] = (), **rules) -> DataFrame:
    return batch_summary(df, by=by, **rules).select(
        *by, "total_flights", "in_air", "on_ground", "avg_altitude_meters", "avg_velocity_kmh",
        "max_velocity_kmh")


def members(df: DataFrame, countries: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The rows of some countries. Grouped summaries keep all rows, as a group without members has zeros."""
    return df if by else df.where(X.text_or("origin_country", "Unknown").isin(list(countries)))


def focus_climb(df: DataFrame, focus: str = K.FOCUS_COUNTRY, by: Sequence[str] = ()) -> DataFrame:
    return batch_summary(members(df, [focus], by), focus=focus, by=by).select(*by, *K.CLIMB_LABELS)


def focus_bands(df: DataFrame, focus: str = K.FOCUS_COUNTRY, by: Sequence[str] = ()) -> DataFrame:
    return batch_summary(members(df, [focus], by), focus=focus, by=by).select(*by, *[f"`{b}`" for b in K.ALTITUDE_LABELS])


def region_summary(df: DataFrame, region: Sequence[str] = tuple(K.REGION_COUNTRIES),
                   by: Sequence[str] = ()) -> DataFrame:
    return batch_summary(members(df, region, by), region=region, by=by).select(
        *by, F.col("region_total").alias("total_flights"), F.col("region_in_air").alias("in_air"))


def focus_summary(df: DataFrame, focus: str = K.FOCUS_COUNTRY, by: Sequence[str] = ()) -> DataFrame:
    return batch_summary(members(df, [focus], by), focus=focus, by=by).select(
        *by, F.col("focus_total").alias("total_flights"), F.col("focus_in_air").alias("in_air"))


def country_metrics(df: DataFrame, by: Sequence[str] = (), null_on_ground: str = "air") -> DataFrame:
    """Per-country count, airborne count and mean altitude over all rows; null is Unknown."""
    named = df.withColumn("country", X.text_or("origin_country", "Unknown"))
    return named.groupBy(*by, "country").agg(
        F.count(F.lit(1)).alias("flight_count"),
        count_where(X.in_air("on_ground", null_on_ground)).alias("in_air"),
        F.round(X.or_zero(F.avg("altitude_meters")), 1).alias("avg_altitude_meters"))


def region_by_country(df: DataFrame, region: Sequence[str] = tuple(K.REGION_COUNTRIES),
                      by: Sequence[str] = ()) -> DataFrame:
    named = df.withColumn("origin_country", X.text_or("origin_country", "Unknown"))
    return country_metrics(in_region(named, region), by)


def country_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return country_metrics(df, by).select(*by, "country", "flight_count")


# ---------------------------------------------------------------------------- top-k

def top_k(df: DataFrame, order: Sequence[Column | str], k: int, cols: Sequence[str] | None = None) -> DataFrame:
    """The first k rows under a total order; each task keeps only k rows."""
    out = df.orderBy(*order).limit(k)
    return out.select(*cols) if cols else out


def fastest(df: DataFrame, k: int = 10) -> DataFrame:
    """Fastest flights; ties by aircraft, then call sign, country and height."""
    top = top_k(df.where(F.col("velocity_kmh").isNotNull()),
                [F.desc("velocity_kmh"), "icao24", "callsign", "origin_country", "altitude_feet"], k,
                ["icao24", "callsign", "origin_country", "velocity_kmh", "altitude_feet"])
    return top.select(
        "icao24", F.coalesce("callsign", F.lit("UNKNOWN")).alias("callsign"),
        F.coalesce("origin_country", F.lit("Unknown")).alias("country"),
        F.round("velocity_kmh", 2).alias("speed_kmh"),
        F.round(X.or_zero("altitude_feet"), 2).alias("altitude_ft"))


def highest(df: DataFrame, k: int = 10) -> DataFrame:
    top = top_k(df.where(F.col("altitude_meters").isNotNull()),
                [F.desc("altitude_meters"), "icao24", "callsign", "origin_country", "velocity_kmh"], k,
                ["icao24", "callsign", "origin_country", "altitude_meters", "velocity_kmh"])
    return top.select(
        "icao24", F.coalesce("callsign", F.lit("UNKNOWN")).alias("callsign"),
        F.coalesce("origin_country", F.lit("Unknown")).alias("country"),
        F.round("altitude_meters", 2).alias("altitude_m"),
        F.round(X.metres_to_feet("altitude_meters"), 2).alias("altitude_ft"),
        F.round(X.or_zero("velocity_kmh"), 2).alias("speed_kmh"))


def sample_rows(df: DataFrame, order: Sequence[Column | str], n: int = 100) -> DataFrame:
    """The first n rows as detail rows, under an order that makes them repeatable."""
    return top_k(df, order, n)


def arg_max(df: DataFrame, value: Column, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The columns of the row with the greatest value, ties by the greatest column values."""
    best = F.max_by(F.struct(*cols), F.struct(value.alias("v"), *cols)).alias("best")
    return _agg(df, by, [best]).select(*by, "best.*")


def batch_timestamp(df: DataFrame, ms_col: str = "processing_time_ms") -> DataFrame:
    """One row: the batch time, the clock when no row carries one."""
    ms = F.min(F.nullif(ms_col, F.lit(0)))
    return df.agg(F.coalesce(F.timestamp_millis(ms), F.current_timestamp()).alias("batch_time"))


# ---------------------------------------------------------------------------- snapshot aggregate

def data_quality(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _agg(df, by, _quality_aggs())


def _quality_aggs() -> list[Column]:
    return [F.count(F.lit(1)).alias("has_position"),
            F.count("altitude_meters").alias("has_altitude"),
            F.count("velocity_ms").alias("has_velocity"),
            count_where(F.coalesce("callsign", F.lit("")) != "UNKNOWN").alias("has_callsign")]


def top_countries(df: DataFrame, k: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The k most frequent countries per group, null and empty ones left out, ties by name.

    Counts are combined before ranking, so a ranked group holds one row per country.
    """
    counts = (df.where(F.col("origin_country") != "").groupBy(*by, "origin_country")
              .agg(F.count(F.lit(1)).alias("count"))
              .withColumnRenamed("origin_country", "country"))
    if not by:
        return top_k(counts, [F.desc("count"), "country"], k)
    order = Window.partitionBy(*by).orderBy(F.desc("count"), "country")
    return (counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(*by, "country", "count"))


def snapshot_aggregate(df: DataFrame, by: Sequence[str] = (), k: int = 5, now: Column | None = None) -> DataFrame:
    """The nested aggregate record of a snapshot: its time (the clock unless given), totals, top countries,
    highest aircraft and data-quality counters. An empty input gives no record."""
    now = F.current_timestamp() if now is None else now
    air = X.in_air("on_ground")
    alt = F.when(air, F.col("altitude_meters"))
    vel = F.when(air, F.col("velocity_kmh"))
    who = F.struct("callsign", "altitude_meters", "altitude_feet",
                   F.col("origin_country").alias("country"))
    rank = F.struct(F.coalesce("altitude_meters", F.lit(-999999.0)), "icao24", "callsign", "origin_country")
    # one grouping by country; its few rows give the totals and the top countries
    cells = df.groupBy(*by, "origin_country").agg(
        F.count(F.lit(1)).alias("n"), count_where(air).alias("air"),
        F.sum(alt).alias("alt"), F.count(alt).alias("alt_n"), F.max(alt).alias("alt_max"),
        F.sum(vel).alias("vel"), F.count(vel).alias("vel_n"), F.max(vel).alias("vel_max"),
        F.max(F.when(air, F.struct(rank.alias("rank"), who.alias("who")))).alias("top"), *_quality_aggs())
    named = F.when(F.col("origin_country") != "", F.struct((-F.col("n")).alias("n"), F.col("origin_country").alias("country")))
    joined = _agg(cells, by, [
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_flights"), F.sum("air").alias("in_air"),
        F.try_divide(F.sum("alt"), F.sum("alt_n")).alias("_avg_alt"), F.max("alt_max").alias("_max_alt"),
        F.try_divide(F.sum("vel"), F.sum("vel_n")).alias("_avg_vel"), F.max("vel_max").alias("_max_vel"),
        F.max("top")["who"].alias("_highest"), F.slice(F.sort_array(F.collect_list(named)), 1, k).alias("_t"),
        *[F.sum(c).alias(c) for c in ("has_position", "has_altitude", "has_velocity", "has_callsign")]]).where(
        F.col("total_flights") > 0)
    return joined.select(
        *by, X.utc_text(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"), "total_flights", "in_air",
        (F.col("total_flights") - F.col("in_air")).alias("on_ground"),
        F.round(X.or_zero("_avg_alt"), 0).alias("avg_altitude_meters"),
        F.round(X.metres_to_feet(X.or_zero("_avg_alt")), 0).alias("avg_altitude_feet"),
        F.round(X.or_zero("_max_alt"), 0).alias("max_altitude_meters"),
        F.round(X.or_zero("_avg_vel"), 1).alias("avg_velocity_kmh"),
        F.round(X.or_zero("_max_vel"), 1).alias("max_velocity_kmh"),
        F.coalesce(F.transform("_t", lambda t: F.struct(
            t["country"].alias("country"), (-t["n"]).alias("count"))),
            F.expr("array()").cast("array<struct<country:string,count:bigint>>")).alias("top_countries"),
        F.when(F.col("_max_alt").isNotNull(), F.col("_highest")).alias("highest_aircraft"),
        F.struct("has_position", "has_altitude", "has_velocity", "has_callsign").alias("data_quality"))


def probe_summary(states: DataFrame, k: int = 5) -> DataFrame:
    """Totals of a source check: rows, rows with a position and their share, airborne rows, and the k countries
    with most rows, ties by name; rows without a country count as Unknown. One grouping by country."""
    both = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    cells = states.groupBy(X.text_or("origin_country", "Unknown").alias("country")).agg(
        F.count(F.lit(1)).alias("n"), count_where(both).alias("placed"), count_where(X.in_air("on_ground")).alias("air"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "country")))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = cells.agg(total("n").alias("total"), total("placed").alias("with_position"), total("air").alias("in_air"),
                    F.transform(F.slice(order, 1, k), lambda t: F.struct(t["country"].alias("country"), (-t["n"]).alias("count")))
                    .alias("top_countries"))
    return out.select("total", "with_position",
                      X.pct("with_position", "total", 1).alias("position_share"), "in_air",
                      (F.col("total") - F.col("in_air")).alias("on_ground"), "top_countries")


def max_cycle(df: DataFrame, cycle: str = "cycle", by: Sequence[str] = ()) -> DataFrame:
    """The latest cycle seen, per store when grouped; 0 when none."""
    return _agg(df, by, [F.coalesce(F.max(cycle), F.lit(0)).alias("max_cycle")])

"""Anomaly flags on the daily table, their combination and summaries.

A meter's statistics are one row per meter, computed with partial aggregation and joined back; the
meter's rows are never gathered for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometer.functions import scalars as X
from aerometer.operators.flights import count_where, top_k
from aerometer.operators.quantiles import exact_quantiles, fit_quantiles


def _join_back(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Statistics of a row's series; rows without a key belong to no series and get none. A plain
    equality lets the join use the partitioning the statistics were grouped by."""
    return df.join(stats, key, "left").select(*df.columns, *[c for c in stats.columns if c != key])


def min_readings(df: DataFrame, n: int, count: str = "energy_count") -> DataFrame:
    return df.where(F.col(count) >= n)


def _moments(df: DataFrame, key: str, col: str, *more: Column) -> DataFrame:
    return df.groupBy(key).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("_sd"), *more)


def _z_columns(df: DataFrame, col: str, k: float) -> DataFrame:
    z = F.try_divide(F.col(col) - F.col("mean"), F.col("_sd"))
    return (df.withColumn("z_score", z).drop("_sd")
            .withColumn("z_anom", F.coalesce(F.abs("z_score") > k, F.lit(False))))


def _fence_column(df: DataFrame, col: str, q1: Column, q3: Column, k: float) -> DataFrame:
    reach = (q3 - q1) * k
    out = (q3 > q1) & ((F.col(col) < q1 - reach) | (F.col(col) > q3 + reach))
    return df.withColumn("iqr_anom", F.coalesce(out, F.lit(False)))


def zscore_flags(df: DataFrame, key: str, col: str, k: float = 3.0) -> DataFrame:
    """Adds mean, z_score and z_anom (|z| > k); a constant series has no score and no flag."""
    return _z_columns(_join_back(df, _moments(df, key, col), key), col, k)


QUARTILES = {"q1": 0.25, "q3": 0.75}


def iqr_flags(df: DataFrame, key: str, col: str, k: float = 1.5, scope: str = "meter") -> DataFrame:
    """Adds iqr_anom: strictly outside the k-IQR fences of the meter (or of all rows with
    scope='global'); a zero-width range flags nothing. Groups may be of any size."""
    if scope == "meter":
        fenced = _join_back(df, exact_quantiles(df, [key], col, QUARTILES), key)
        return _fence_column(fenced, col, F.col("q1"), F.col("q3"), k).drop("q1", "q3")
    if scope == "global":
        cut = fit_quantiles(df, [col], QUARTILES)[col]
        return _fence_column(df, col, F.lit(cut["q1"]), F.lit(cut["q3"]), k)
    raise ValueError(f"scope must be meter or global, not {scope!r}")


def combine_flags(df: DataFrame) -> DataFrame:
    z, iqr = F.col("z_anom"), F.col("iqr_anom")
    return df.withColumns({"z_and_iqr": z & iqr, "anomaly": z | iqr, "z_only": z & ~iqr, "iqr_only": iqr & ~z})


def anomaly_flags(daily: DataFrame, key: str = "meter_id", col: str = "energy_sum", k_z: float = 3.0,
                  k_iqr: float = 1.5, scope: str = "meter") -> DataFrame:
    """Both flags and their combination on a daily table.

    A daily table has one row per meter and day, so a meter's group is no longer than the calendar
    and its quartiles are taken by the built-in percentile in the same aggregation as its mean.
    For series without that bound use zscore_flags and iqr_flags.
    """
    if scope != "meter":
        return combine_flags(iqr_flags(zscore_flags(daily, key, col, k_z), key, col, k_iqr, scope))
    quartiles = F.percentile(col, F.array(*[F.lit(p) for p in QUARTILES.values()])).alias("_q")
    both = _z_columns(_join_back(daily, _moments(daily, key, col, quartiles), key), col, k_z)
    return combine_flags(_fence_column(both, col, F.col("_q")[0], F.col("_q")[1], k_iqr).drop("_q"))


def extreme_values(df: DataFrame, col: str, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Rows strictly outside the exact lo-hi quantile range of all rows."""
    cut = fit_quantiles(df, [col], {"lo": lo, "hi": hi})[col]
    return df.where((F.col(col) < F.lit(cut["lo"])) | (F.col(col) > F.lit(cut["hi"])))


def anomaly_summary(flagged: DataFrame, key: str = "meter_id") -> DataFrame:
    """Counts and shares of every flag, and the meters concerned.

    Meters are folded to one row each first, so counting them needs no distinct over all rows.
    """
    per_meter = flagged.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(c) for c in
                                        ("z_anom", "iqr_anom", "z_and_iqr", "anomaly", "z_only", "iqr_only")])
    total = per_meter.agg(
        F.sum("n").alias("records"), F.sum("z_anom").alias("z_anomalies"),
        F.sum("iqr_anom").alias("iqr_anomalies"), F.sum("z_and_iqr").alias("overlap"),
        F.sum("anomaly").alias("combined"), F.sum("z_only").alias("z_only"),
        F.sum("iqr_only").alias("iqr_only"), F.count(F.lit(1)).alias("meters"),
        count_where(F.col("anomaly") > 0).alias("affected_meters"))
    return total.withColumns({
        "combined_share": X.pct("combined", "records"), "z_share": X.pct("z_anomalies", "records"),
        "iqr_share": X.pct("iqr_anomalies", "records"), "overlap_share": X.pct("overlap", "records"),
        "affected_share": X.pct("affected_meters", "meters")})


def anomaly_frequency(flagged: DataFrame, key: str = "meter_id") -> DataFrame:
    out = flagged.groupBy(key).agg(F.count_if("anomaly").alias("flagged_days"),
                                   F.count(F.lit(1)).alias("days"))
    return out.withColumn("share", X.pct("flagged_days", "days", 1))


def top_anomalies(flagged: DataFrame, key: str = "meter_id", date: str = "date", k: int = 10,
                  cols: Sequence[str] | None = None) -> DataFrame:
    """The k rows with the largest |z|, ties by meter and date."""
    seen = flagged.where(F.col("z_score").isNotNull())
    return top_k(seen, [F.desc(F.abs("z_score")), key, date], k, cols)


def top_households(flagged: DataFrame, key: str = "meter_id", k: int = 10) -> DataFrame:
    return top_k(anomaly_frequency(flagged, key), [F.desc(F.try_divide("flagged_days", "days")),
                                                   F.desc("days"), key], k)

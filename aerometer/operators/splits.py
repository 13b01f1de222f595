"""Repeatable train / validation / test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometer.functions import scalars as X
from aerometer.operators.quantiles import fit_quantiles

SPLITS = ("train", "val", "test")


def hash_split(df: DataFrame, key: str | Sequence[str], cuts: Sequence[int] = (70, 85),
               names: Sequence[str] = SPLITS) -> DataFrame:
    """Adds `split` from a stable hash of the key: a row keeps its split in every run and engine."""
    cols = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return df.withColumn("split", X.band(X.hash_percent(text), list(cuts), list(names)[:len(cuts) + 1]))


def temporal_split(df: DataFrame, date_col: str, cuts: Sequence[float] = (0.70, 0.85),
                   names: Sequence[str] = SPLITS) -> DataFrame:
    """Adds `split` by date: rows up to the cut quantiles of the row dates, in order. The cut dates
    are found first and enter the plan as constants."""
    day = F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date"))
    probs = {f"c{i}": c for i, c in enumerate(cuts)}
    edges = fit_quantiles(df.select(day.alias("day")), ["day"], probs)["day"]
    return df.withColumn("split", X.band(day, [edges[c] for c in probs], list(names)[:len(cuts) + 1], closed="right"))


def cap_rows(df: DataFrame, key: str | Sequence[str], n: int) -> DataFrame:
    """Adds `sampled`: whether a repeatable training sample of at most n rows takes the row, those
    with the smallest key hash. No row is dropped; keys are expected to be unique."""
    cols = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    hashed = df.withColumn("_hash", F.struct(F.md5(text).alias("h"), *cols))
    last = hashed.select("_hash").orderBy("_hash").limit(n).agg(F.max("_hash").alias("m")).scalar()
    return hashed.withColumn("sampled", F.coalesce(F.col("_hash") <= last, F.lit(False))).drop("_hash")


def split_summary(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and share of every split."""
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("t")).scalar()
    return counts.withColumn("share", X.pct(F.col("rows"), total, 1))

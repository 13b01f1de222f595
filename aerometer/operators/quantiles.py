"""Exact quantiles whose work spreads over the cluster whatever the group sizes.

The built-in exact percentile holds a whole group's distinct values in one task. Here values are
first counted per (group, value), then laid into buckets by a monotone function of the value. The
bucket counts tell which buckets hold the wanted ranks, and only those buckets are ranked, each on
its own. No group is ever gathered, and one hot group spreads over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_E = 16384  # buckets per factor e of magnitude: each is about 0.006 % wide
FINEST = 1e-6          # below this magnitude buckets are evenly spaced


def value_bucket(v: Column) -> Column:
    """A monotone integer of a number; log-scaled, so it needs no statistics of the data. NaN sorts
    last, as Spark orders it."""
    size = F.log1p(F.least(F.abs(v), F.lit(1e300)) / F.lit(FINEST))
    return F.when(F.isnan(v), F.lit(2 ** 62)).otherwise(
        F.floor(F.signum(v) * size * F.lit(float(BUCKETS_PER_E))).cast("bigint"))


def exact_quantiles(df: DataFrame, keys: Sequence[str], col: str, probs: dict[str, float]) -> DataFrame:
    """One row per key with a column per probability, linearly interpolated between the two
    neighbouring values; nulls are ignored. Without keys the result is a single row.

    `probs` maps result names to probabilities.
    """
    keys = list(keys)
    ks = [f"_k{i}" for i in range(len(keys))]
    vals = (df.select(*[F.col(k).alias(a) for k, a in zip(keys, ks)],
                      F.col(col).cast("double").alias("_v"))
            .where(F.col("_v").isNotNull()))
    bucketed = vals.withColumn("_b", value_bucket(F.col("_v")))

    # Bucket table: a bounded number of rows per key, counted before the shuffle.
    whole = Window.partitionBy(*ks) if ks else Window.partitionBy(F.lit(0))
    upto = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = (bucketed.groupBy(*ks, "_b").agg(F.count(F.lit(1)).alias("_n"))
            .withColumns({"_end": F.sum("_n").over(upto), "_total": F.sum("_n").over(whole)})
            .withColumn("_start", F.col("_end") - F.col("_n")))

    def ranks(p: float) -> tuple[Column, Column, Column]:
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        return F.floor(pos), F.ceil(pos), pos

    wanted = F.lit(False)
    for p in probs.values():
        lo, hi, _ = ranks(p)
        for r in (lo, hi):
            wanted = wanted | ((r >= F.col("_start")) & (r < F.col("_end")))
    # Only values of the wanted buckets are joined back, counted and ranked inside.
    targets = hist.where(wanted).select(
        *[F.col(k).alias(f"{k}_t") for k in ks], F.col("_b").alias("_bt"), "_start", "_total")
    on = F.col("_b") == F.col("_bt")
    for k in ks:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}_t"))
    inside = (Window.partitionBy(*ks, "_b").orderBy("_v")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (bucketed.join(targets, on).groupBy(*ks, "_b", "_v", "_start", "_total").agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_last", F.col("_start") + F.sum("_c").over(inside) - 1)
              .withColumn("_first", F.col("_last") - F.col("_c") + 1))

    aggs, outs = [], []
    for i, (name, p) in enumerate(probs.items()):
        lo, hi, pos = ranks(p)
        for side, r in (("lo", lo), ("hi", hi)):
            hit = (r >= F.col("_first")) & (r <= F.col("_last"))
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{side}{i}"))
        aggs.append(F.max(pos - lo).alias(f"_f{i}"))
        outs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}"))
                    .alias(name))
    found = ranked.groupBy(*ks).agg(*aggs) if ks else ranked.agg(*aggs)
    return found.select(*[F.col(a).alias(k) for k, a in zip(keys, ks)], *outs)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Quantiles of several columns at once: one row per column name, in a single pass."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])))
    return exact_quantiles(long, ["column"], "v", probs)


def fit_quantiles(df: DataFrame, cols: Sequence[str], probs: dict[str, float]) -> dict[str, dict[str, float | None]]:
    """The same computed now: {column: {name: value}}, a handful of numbers per column.

    As fitting a transformer does: the cuts then enter the plan as constants, so filters on them
    reach the scan. A column without any value has None.
    """
    found = {r["column"]: {n: r[n] for n in probs} for r in column_quantiles(df, cols, probs).collect()}
    return {c: found.get(c, dict.fromkeys(probs)) for c in cols}

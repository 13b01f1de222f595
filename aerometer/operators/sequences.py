"""Ordered-neighbour operators: lag, lead and trailing windows per key.

Two forms. The plain form partitions by key; it suits series whose length is bounded by the
calendar (one row per meter and day). The block form is for series of any length: rows are numbered
per key through time chunks, cut into blocks of equal depth, and each block carries a copy of the
few rows before it. A hot key then spreads over its blocks and the results are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def number_rows(df: DataFrame, key: Sequence[str], order: Sequence[str], chunk: Column) -> DataFrame:
    """Add `_idx`, the 0-based position of each row within its key.

    `chunk` must not decrease along `order` (for example the day of a timestamp): rows are ranked
    inside a (key, chunk) and shifted by the sizes of the earlier chunks. The order must be total.
    """
    key = list(key)
    cut = df.withColumn("_chunk", chunk)
    sizes = cut.groupBy(*key, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"_o_{k}") for k in key], F.col("_chunk").alias("_oc"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    on = F.col("_chunk").eqNullSafe(F.col("_oc"))
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    inside = Window.partitionBy(*key, "_chunk").orderBy(*order)
    return (cut.withColumn("_pos", F.row_number().over(inside) - 1).join(offsets, on)
            .withColumn("_idx", F.col("_offset") + F.col("_pos"))
            .drop("_oc", "_offset", "_pos", "_chunk", *[f"_o_{k}" for k in key]))


def with_halo(df: DataFrame, block_rows: int, back: int, ahead: int = 0) -> DataFrame:
    """Cut numbered rows into blocks; each block also gets the `back` rows before it and the
    `ahead` rows after it, marked by `_halo`."""
    if block_rows < max(back, ahead):
        raise ValueError("a block must be at least as deep as its halo")
    own = F.floor(F.col("_idx") / block_rows).cast("bigint")
    place = F.col("_idx") % block_rows
    copies = [F.struct(own.alias("_block"), F.lit(False).alias("_halo"))]
    if back:
        copies.append(F.when(place >= block_rows - back,
                             F.struct((own + 1).alias("_block"), F.lit(True).alias("_halo"))))
    if ahead:
        copies.append(F.when(place < ahead,
                             F.struct((own - 1).alias("_block"), F.lit(True).alias("_halo"))))
    return df.select("*", F.inline(F.filter(F.array(*copies), lambda c: c.isNotNull())))


class Part(NamedTuple):
    """Columns to compute over a key's order, and how many rows they reach back and ahead."""

    exprs: Callable[[WindowSpec], dict[str, Column]]
    back: int
    ahead: int


def lags(cols: dict[str, list[int]], names: dict[str, str] | None = None) -> Part:
    """`lag_<name>_<k>`: the value k rows earlier."""
    label = _lag_names(cols, names)
    return Part(lambda w: {n: F.lag(c, k).over(w) for (c, k), n in label.items()}, max(k for _, k in label), 0)


def lead(col: str, k: int = 1, name: str = "next") -> Part:
    return Part(lambda w: {name: F.lead(col, k).over(w)}, 0, k)


def rolling(col: str, windows: dict[str, list[int]], include_current: bool = False, suffix: str = "d") -> Part:
    """`rolling_<stat>_<n>d`: 'mean' or 'std' over the n rows before the current one (or ending
    with it)."""
    stats = {"mean": F.avg, "std": F.stddev_samp}

    def exprs(w: WindowSpec) -> dict[str, Column]:
        out = {}
        for stat, depths in windows.items():
            for n in depths:
                frame = w.rowsBetween(1 - n, 0) if include_current else w.rowsBetween(-n, -1)
                out[f"rolling_{stat}_{n}{suffix}"] = stats[stat](col).over(frame)
        return out

    return Part(exprs, max(n for ns in windows.values() for n in ns), 0)


def _lag_names(cols: dict[str, list[int]], names: dict[str, str] | None) -> dict[tuple[str, int], str]:
    names = names or {}
    return {(c, k): f"lag_{names.get(c, c)}_{k}" for c, ks in cols.items() for k in ks}


def add_sequences(df: DataFrame, key: Sequence[str], order: Sequence[str], parts: Sequence[Part],
                  block_rows: int | None = None, chunk: Column | None = None) -> DataFrame:
    """All parts over one ordering of each key, plain or (with block_rows and chunk) in blocks."""

    def columns(w: WindowSpec) -> dict[str, Column]:
        return {n: c for part in parts for n, c in part.exprs(w).items()}

    if block_rows is None:
        return df.withColumns(columns(Window.partitionBy(*key).orderBy(*order)))
    if chunk is None:
        raise ValueError("the block form needs a chunk column")
    blocks = with_halo(number_rows(df, key, order, chunk), block_rows, max(p.back for p in parts),
                       max(p.ahead for p in parts))
    w = Window.partitionBy(*key, "_block").orderBy("_idx")
    return blocks.withColumns(columns(w)).where(~F.col("_halo")).drop("_idx", "_block", "_halo")


def add_lags(df: DataFrame, key: Sequence[str], order: str, cols: dict[str, list[int]],
             names: dict[str, str] | None = None, calendar: bool = False, **blocks) -> DataFrame:
    """Earlier values per key. Rows are counted by default; `calendar=True` counts days instead, so
    gaps give null (the order column is a date, one row per key and date)."""
    if not calendar:
        return add_sequences(df, key, [order], [lags(cols, names)], **blocks)
    # Each row is handed to the later dates that look back at it, then gathered per key and date:
    # one aggregation instead of a self join per lag.
    label = _lag_names(cols, names)
    steps = sorted({k for ks in cols.values() for k in ks})
    have = F.struct(*df.columns)
    copies = [F.struct(F.col(order).alias("_on"), F.lit(0).alias("_k"), have.alias("_row"))]
    copies += [F.struct(F.date_add(F.col(order), k).alias("_on"), F.lit(k).alias("_k"),
                        have.alias("_row")) for k in steps]
    sent = df.select(*key, F.inline(F.array(*copies)))
    own = F.max(F.when(F.col("_k") == 0, F.col("_row"))).alias("_own")
    seen = [F.max(F.when(F.col("_k") == k, F.col(f"_row.{c}"))).alias(n) for (c, k), n in label.items()]
    met = sent.groupBy(*key, "_on").agg(own, *seen).where(F.col("_own").isNotNull())
    return met.select("_own.*", *label.values())


def add_lead(df: DataFrame, key: Sequence[str], order: str, col: str, k: int = 1, name: str = "next",
             **blocks) -> DataFrame:
    return add_sequences(df, key, [order], [lead(col, k, name)], **blocks)


def add_rolling(df: DataFrame, key: Sequence[str], order: str, col: str, windows: dict[str, list[int]],
                include_current: bool = False, suffix: str = "d", **blocks) -> DataFrame:
    return add_sequences(df, key, [order], [rolling(col, windows, include_current, suffix)], **blocks)


def write_gaps(log: DataFrame, threshold_s: float = 60, time: str = "write_time",
               key: Sequence[str] = ()) -> DataFrame:
    """Pauses of more than `threshold_s` seconds between consecutive writes (per key).

    Writes inside a time chunk no longer than the threshold have no pause between them, so each chunk
    is reduced to its first and last write before the shuffle, and only chunks are put in order.
    """
    key = list(key)
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    chunk = max(1, int(threshold_s * 1_000_000))
    ends = log.select(*key, micros.alias("_us")).where("_us IS NOT NULL").groupBy(
        *key, (F.col("_us") - F.pmod("_us", F.lit(chunk))).alias("_chunk")).agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    return pauses(ends, threshold_s, key)


def pauses(stretches: DataFrame, threshold_s: float, key: Sequence[str] = ()) -> DataFrame:
    """Pauses of more than `threshold_s` seconds between the stretches (_first, _last, in microseconds) of a key."""
    inside = Window.partitionBy(*(key or [F.lit(0)])).orderBy("_first")
    pairs = stretches.select(*key, F.col("_first").alias("_us"), F.lag("_last").over(inside).alias("_prev"))
    gap = (F.col("_us") - F.col("_prev")) / F.lit(1_000_000.0)
    return (pairs.withColumn("gap_s", gap).where(F.col("gap_s") > threshold_s)
            .select(*key, F.timestamp_micros("_prev").alias("previous_write"),
                    F.timestamp_micros("_us").alias("next_write"), "gap_s"))

"""Mixing sources to target weights by Pfair scheduling.

A source's documents form blocks of about equal size. In the ideal mix every source that still has
blocks grows at a rate proportional to its exact weight; when one ends the others grow faster, so
every document is placed once. The kth block of a source is released at the whole slot at or before
the ideal begins it and due at the one at or after the ideal ends it. Earliest-deadline-first among
released blocks then keeps every source within one block of the ideal at every slot, however many
there are, as no weight is rounded. One task runs through the slots: it holds a heap of the sources
and hands on a row for each block.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerometer.llm.common import blocks_for, free_names, sortable, written

#: Slots that the schedule hands on at a time.
PERIOD = 1024
#: Characters of a block, about.
BLOCK = 1 << 16
#: What a sum of floating-point shares may be off, in slots.
ROUNDING = 1e-6
#: Rows that one task orders at a time, about.
ORDERED = 20_000


def apportion(weights: dict, period: int) -> dict:
    """Whole slots of a period for each source, at least one each, by largest remainder (mix rounds no weight)."""
    total = sum(weights.values())
    names = sorted(weights, key=lambda s: (s is None, s))
    if len(names) > period:
        raise ValueError(f"{len(names)} sources need a period of as many slots at least")
    free = period - len(names)
    share = {s: weights[s] / total * period - 1 for s in names}
    over = sum(max(x, 0.0) for x in share.values()) or 1.0
    exact = {s: max(share[s], 0.0) * free / over for s in names}
    slots = {s: 1 + int(exact[s]) for s in names}
    for s in sorted(names, key=lambda s: (int(exact[s]) - exact[s], s is None, s))[:period - sum(slots.values())]:
        slots[s] += 1
    return slots


def turns(blocks: dict, weights: dict) -> Iterator[tuple]:
    """(source, block from 0) of every slot: earliest deadline first among released blocks."""
    names = sorted((s for s, n in blocks.items() if n > 0), key=lambda s: (s is None, s))
    # at virtual time v the ideal has filled the sum of min(blocks, weight * v) slots
    ends = sorted((blocks[s] / weights[s], blocks[s], weights[s]) for s in names)
    times = [e[0] for e in ends]
    full = list(accumulate((e[1] for e in ends), initial=0))
    rate = list(accumulate((e[2] for e in reversed(ends)), initial=0.0))[::-1]

    def filled(v: float) -> float:
        j = bisect_left(times, v)
        return full[j] + v * rate[j]

    waiting = [(0, i, 0) for i in range(len(names))]
    ready: list[tuple[int, int, int]] = []
    for t in range(full[-1]):
        while waiting and (waiting[0][0] <= t or not ready):
            _, i, k = heapq.heappop(waiting)
            due = math.ceil(filled((k + 1) / weights[names[i]]) - ROUNDING)
            heapq.heappush(ready, (due, i, k))
        _, i, k = heapq.heappop(ready)
        s = names[i]
        yield s, k
        if k + 1 < blocks[s]:
            heapq.heappush(waiting, (math.floor(filled((k + 1) / weights[s]) + ROUNDING), i, k + 1))


def one_period(slots: dict) -> list:
    """The source of every slot of a period."""
    return [s for s, _ in turns(slots, slots)]


def schedule(blocks: dict, weights: dict, period: int = PERIOD) -> list[tuple]:
    """Rows (source, phase, first block, last block, slots a period, nth, slot of the nth), one for each block.

    blocks: blocks of each source. Blocks and slots are numbered from 0. No order repeats, so every
    slot is a phase of its own, of one block.
    """
    return [(s, t, k, k, 1, 0, t) for t, (s, k) in enumerate(turns(blocks, weights))]


def _scheduled(block: int, weights: dict | None, power: float, period: int):
    """Rows (source, block, slot) from all rows (source, size) in one task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = {}
        for pdf in batches:
            sizes |= {None if s is None else str(s): int(n) for s, n in zip(pdf.iloc[:, 0].astype(object), pdf.iloc[:, 1])}
        wanted = {s: n ** power if weights is None else float(weights.get(s, 0)) for s, n in sizes.items()}
        if lacking := [s for s, w in wanted.items() if not w > 0]:
            raise ValueError(f"sources without a positive weight: {lacking[:10]}")
        dealt, at = turns({s: (n - 1) // block + 1 for s, n in sizes.items()}, wanted), 0
        while some := list(islice(dealt, period)):
            yield pd.DataFrame({"source": pd.Series([s for s, _ in some], dtype=object), "block": [k for _, k in some],
                                "slot": range(at, at + len(some))})
            at += len(some)

    return run


def mix(docs: DataFrame, weights: dict | None = None, power: float = 0.5, block: int = BLOCK, period: int = PERIOD,
        source: str = "source", size: Column | None = None) -> DataFrame:
    """docs with mix_block (number within the source), mix_slot and mix_place (order within the slot).

    Sorted by the slot and place, the sources interleave by weight. weights: target share by source,
    positive, for every source in docs; None takes each source's size to a power, which favours small
    sources below 1. size: what a block is measured in, characters of text unless given. Sizes below
    one count as one, a null text is empty, a null source is a source of its own; the order inside a
    source is a fixed shuffle by id, ties by text and the other columns; repeated rows are all placed.
    A row longer than a block also takes the slots of the blocks it fills, which then begin no row of
    their own. An empty table gives no rows. The names given are
    lengthened by _ where docs has them already.
    """
    spark = docs.sparkSession
    b, slot, place, measure, part, base, run, src, seg, of, lo, src2, nth, first, slots = free_names(
        docs, "mix_block", "mix_slot", "mix_place", "_size", "_part", "_base", "_run", "_s", "_p", "_n",
        "_lo", "_s2", "_nth", "_at", "_slots")
    sized = docs.withColumn(measure, F.greatest(F.lit(1), F.coalesce(
        size if size is not None else F.length("text"), F.lit(0))).cast("long"))
    rows = sized.count()
    parts = blocks_for(rows, ORDERED)
    salted = sized.withColumn(part, F.pmod(F.xxhash64("doc_id", measure), F.lit(parts)))
    counts = written(salted.groupBy(F.col(source).cast("string").alias(src), F.col(part).alias(seg)).agg(
        F.sum(measure).alias(of)), "mix-parts")
    before = Window.partitionBy(src).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy(src).agg(F.sum(of).alias(of))
    dealt = written(totals.repartition(1).mapInPandas(
        _scheduled(block, weights, power, period), "source string, block long, slot long").toDF(src2, nth, first), "mix-slots")
    # for every part of a source the slots of the blocks that it reaches into, in their order
    bases = counts.select(src, seg, of, F.coalesce(F.sum(of).over(before), F.lit(0)).alias(base))
    first_block, last_block = F.floor(F.col(base) / block), F.floor((F.col(base) + F.col(of) - 1) / block)
    bases = (bases.select(src, seg, base, first_block.alias(lo), F.explode(F.sequence(first_block, last_block)).alias(b))
             .join(dealt, F.col(src).eqNullSafe(F.col(src2)) & (F.col(b) == F.col(nth)))
             .groupBy(src, seg, base, lo).agg(F.sort_array(F.collect_list(F.struct(nth, first))).alias(slots)))
    inside = Window.partitionBy(source, part).orderBy(
        F.xxhash64("doc_id"), "doc_id", measure, *([F.xxhash64("text")] if "text" in docs.columns else []),
        *sortable(docs, [c for c in docs.columns if c not in ("doc_id", "text")])).rowsBetween(Window.unboundedPreceding, -1)
    placed = (salted.withColumn(run, F.coalesce(F.sum(measure).over(inside), F.lit(0)))
              .join(bases, F.col(source).cast("string").eqNullSafe(F.col(src)) & (F.col(part) == F.col(seg))))
    at = F.col(base) + F.col(run)
    placed = placed.withColumn(b, F.floor(at / block).cast("long")).withColumn(place, (at - F.col(b) * block).cast("long"))
    at_slot = F.get(F.col(slots), (F.col(b) - F.col(lo)).cast("int"))[first]
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], b, at_slot.cast("long").alias(slot), place)


def in_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs in mixed order, range-partitioned: the files of a written copy follow the schedule."""
    mixed = mix(docs, **options)
    slot, place = mixed.columns[-2:]
    return mixed.orderBy(slot, place).select(*docs.columns)

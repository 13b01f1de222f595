import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from aerometer.llm import mixing
from tests.llm.helpers import documents

WEIGHTS = st.dictionaries(st.text("abcdef", max_size=3), st.floats(0.01, 100), min_size=1, max_size=12)


@settings(max_examples=150, deadline=None)
@given(WEIGHTS, st.integers(12, 300))
def test_a_period_keeps_within_one_block(weights, period):
    slots = mixing.apportion(weights, period)
    assert sum(slots.values()) == period and min(slots.values()) >= 1
    got = dict.fromkeys(slots, 0)
    for t, s in enumerate(mixing.one_period(slots), 1):
        got[s] += 1
        for name, n in slots.items():
            assert abs(got[name] * period - n * t) < period


@settings(max_examples=100, deadline=None)
@given(WEIGHTS, st.data())
def test_schedule_places_every_block_once(weights, data):
    blocks = {s: data.draw(st.integers(0, 400)) for s in weights}
    period = 32
    seen, by_slot, phases = {}, {}, {}
    for s, phase, lo, hi, slots, nth, at in mixing.schedule(blocks, weights, period):
        for k in range(lo + nth, hi + 1, slots):
            slot = at + (k - lo) // slots * period
            assert (s, k) not in seen and slot not in by_slot
            seen[s, k], by_slot[slot] = slot, (s, phase)
            phases.setdefault(phase, {})[s] = slots
    assert set(seen) == {(s, k) for s, n in blocks.items() for k in range(n)}
    assert sorted(by_slot) == list(range(len(seen)))
    for s, n in blocks.items():
        assert [seen[s, k] for k in range(n)] == sorted(seen[s, k] for k in range(n))
    got, at, last = {}, 0, None
    for slot in range(len(by_slot)):
        s, phase = by_slot[slot]
        if phase != last:
            got, at, last = dict.fromkeys(phases[phase], 0), 0, phase
        at += 1
        got[s] += 1
        for name, n in phases[phase].items():
            assert abs(got[name] * period - n * at) < period


def rows():
    rnd = random.Random(8)
    out = [(i, "x" * rnd.randint(0, 300), rnd.choice("aaaabc") if i % 9 else None) for i in range(600)]
    return out + [(3, out[3][1], out[3][2]), (None, None, "a"), (None, "y", None), (900, "z" * 5000, "c"), (901, "", "only")]


@pytest.mark.parametrize("part", [20_000, 25])
def test_rows_keep_to_the_schedule(spark, monkeypatch, part):
    monkeypatch.setattr(mixing, "ORDERED", part)
    docs, block = documents(spark, rows()), 1000
    mixed = mixing.mix(docs, block=block, period=16)
    assert mixed.columns == [*docs.columns, "mix_block", "mix_slot", "mix_place"]
    got = mixed.collect()
    key = lambda r: repr((r.doc_id, r.text, r.source))
    assert sorted(map(key, got)) == sorted(map(key, docs.collect()))
    blocks, weights = {}, {}
    for r in got:
        blocks.setdefault(r.source, []).append(r)
    for s, rs in blocks.items():
        at = 0
        for r in sorted(rs, key=lambda r: (r.mix_block, r.mix_place)):
            assert r.mix_block == at // block and r.mix_place == at % block
            at += max(1, len(r.text or ""))
        weights[s] = at
    want = {}
    for s, _, lo, hi, slots, nth, at in mixing.schedule({s: (n - 1) // block + 1 for s, n in weights.items()},
                                                        {s: n ** 0.5 for s, n in weights.items()}, 16):
        for k in range(lo + nth, hi + 1, slots):
            want[s, k] = at + (k - lo) // slots * 16
    assert all(want[r.source, r.mix_block] == r.mix_slot for r in got)


def test_order_of_the_written_rows(spark):
    docs = documents(spark, rows()).withColumn("mix_slot", F.lit("clash"))
    kept = mixing.in_order(docs, block=1000, period=16, weights={"a": 5.0, "b": 1.0, "c": 1.0, "only": 1.0, None: 2.0})
    assert kept.columns == docs.columns and kept.count() == docs.count()
    first = [r.source for r in kept.limit(60).collect()]
    assert {"a", "b", "c", None} <= set(first)


def test_empty_table(spark):
    assert mixing.mix(documents(spark, [])).collect() == []


def ideal(blocks, weights, t):
    """Blocks of each source after t slots of the ideal mix, by bisection of its virtual time."""
    lo, hi = 0.0, max(n / weights[s] for s, n in blocks.items())
    for _ in range(100):
        v = (lo + hi) / 2
        lo, hi = (v, hi) if sum(min(n, weights[s] * v) for s, n in blocks.items()) < t else (lo, v)
    return {s: min(n, weights[s] * hi) for s, n in blocks.items()}


def held_to_the_weights(order, blocks, weights, every):
    got = dict.fromkeys(blocks, 0)
    for t, s in enumerate(order, 1):
        got[s] += 1
        if t % every == 0:
            for name, x in ideal(blocks, weights, t).items():
                assert abs(got[name] - x) < 1 + 1e-4
    assert got == blocks


@settings(max_examples=60, deadline=None)
@given(WEIGHTS, st.data())
def test_schedule_keeps_within_one_block_of_the_exact_weights(weights, data):
    blocks = {s: data.draw(st.integers(1, 60)) for s in weights}
    held_to_the_weights([r[0] for r in sorted(mixing.schedule(blocks, weights, 32), key=lambda r: r[6])], blocks, weights, 1)


def test_errors_do_not_grow_with_the_periods():
    blocks = {"hot": 20000, "rare": 30, **{f"s{i:02}": 1000 for i in range(40)}}
    weights = {s: n ** 0.5 for s, n in blocks.items()} | {"rare": 0.1}
    held_to_the_weights([r[0] for r in mixing.schedule(blocks, weights)], blocks, weights, 97)


def test_any_number_of_sources(spark):
    data = [(i, "x" * (50 + i % 7 * 30), f"domain{i % 2500}") for i in range(6000)]
    got = mixing.mix(documents(spark, data), block=100, period=16).collect()
    assert sorted(r.doc_id for r in got) == list(range(6000))
    sizes, slots = {}, {}
    for i, t, s in data:
        sizes[s] = sizes.get(s, 0) + len(t)
    for r in got:
        assert slots.setdefault(r.mix_slot, (r.source, r.mix_block)) == (r.source, r.mix_block)
    blocks = {s: (n - 1) // 100 + 1 for s, n in sizes.items()}
    order = [r[0] for r in mixing.schedule(blocks, {s: n ** 0.5 for s, n in sizes.items()})]
    assert len(sizes) == 2500 and all(order[t] == s for t, (s, _) in slots.items())

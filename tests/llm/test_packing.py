import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from aerometer.llm import packing
from aerometer.llm.queries import vocabulary
from tests.llm.helpers import documents

WINDOW = 2048


@pytest.fixture(scope="module")
def model():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def plain_ids(model, text):
    return [*model.encode(text or "", add_special_tokens=False).ids, 1]


PARTS = st.sampled_from(["the", "The.", "a,", "it's.", "x.,", "é.", "ñ", " ", "\n", "\t\x0b", "\x85", " ", "5.", "<|endoftext|>", "<|ENDOFTEXT|>",
                         "́", "é", "İ", "ΑΣ", "...", ".", "'S", "don't,", "日本", "😀."])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=12), st.text(max_size=30))
def test_ids_are_those_of_the_whole_text(model, parts, more):
    text = "".join(parts) + more
    ids = packing.encoder_of(vocabulary()).ids(text)
    assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_nnls_meets_an_exact_solution():
    columns = packing.shallow(32)
    rnd = np.random.default_rng(1)
    true = np.where(rnd.random(len(columns)) < 0.05, rnd.integers(1, 50, len(columns)), 0)
    goal = np.zeros(32)
    for c, x in zip(columns, true):
        for r in c:
            if r >= 0:
                goal[r] += x
    found = packing.nnls(columns, goal, np.ones(32))
    back = np.zeros(32)
    for j, x in found.items():
        assert x >= 0
        for r in columns[j]:
            if r >= 0:
                back[r] += x
    assert len(found) <= 32 and np.abs(back - goal).max() < 1e-4


def check_plan(histogram):
    places, windows = packing.plan(histogram)
    seen = {n: [] for n in histogram}
    fill = np.zeros(windows, np.int64)
    slots = set()
    for n, lo, hi, first, slot in places:
        seen[n].append((lo, hi))
        if slot >= 0:
            for i in range(hi - lo + 1):
                fill[first + i] += n
                assert (first + i, slot) not in slots
                slots.add((first + i, slot))
    for n, c in histogram.items():
        at = 0
        for lo, hi in sorted(seen[n]):
            assert lo == at
            at = hi + 1
        assert at == c
    _, tokens = packing.power_bases(places)
    assert not len(fill) or (fill.max() <= WINDOW and fill.min() > 0)
    return int((WINDOW - fill).sum()) + (-tokens) % WINDOW, sum(n * c for n, c in histogram.items())


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.integers(1, WINDOW - 1), st.integers(1, 60), max_size=60))
def test_plan_places_every_piece_once(histogram):
    check_plan(histogram)


@pytest.mark.parametrize("kind", ["even", "hot", "long"])
def test_plan_wastes_little(kind):
    rnd = random.Random(2)
    draw = {"even": lambda: rnd.randint(1, 2047), "hot": lambda: 1500 if rnd.random() < 0.4 else rnd.randint(1, 2047),
            "long": lambda: rnd.randint(1100, 1900)}[kind]
    histogram = {}
    for _ in range(20000):
        n = draw()
        histogram[n] = histogram.get(n, 0) + 1
    padding, tokens = check_plan(histogram)
    assert padding < 0.015 * tokens


def check_packed(model, rows, got):
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(plain_ids(model, t))
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
        assert 0 < r.length <= WINDOW and r.offset + r.length <= WINDOW
    assert sorted(sequences) == list(range(len(sequences)))
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
    assert pieces.keys() == ids.keys()
    for i, texts in ids.items():
        want = sorted(len(x) for x in texts)
        assert sum(r.length for r in pieces[i]) == sum(want)
        assert {r.doc_tokens for r in pieces[i]} == set(want)
        if len(texts) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r.start):
                assert r.start == at
                assert zlib.crc32(np.array(texts[0][at:at + r.length], "<u4").tobytes()) == r.ids_crc32
                at += r.length
    return sequences


def test_documents_round_trip(spark, model):
    rnd = random.Random(4)
    rows = [(1, None), (2, ""), (3, "one"), (4, "very long text, again. " * 9000), (5, "same"), (5, "same"), (None, "no id")]
    rows += [(100 + i, " ".join(rnd.choice(["word", "other", "Mixed.", "ñandú"]) for _ in range(rnd.randint(1, 3000)))) for i in range(150)]
    rows += [(1000 + i, "copy of one text " * 300) for i in range(120)]
    got = packing.pack(documents(spark, rows), vocabulary()).collect()
    sequences = check_packed(model, rows, got)
    padding = 0
    for rs in sequences.values():
        n = sum(r.length for r in rs)
        padding += 0 if n & (n - 1) == 0 else WINDOW - n
    assert padding < 0.02 * sum(r.length for r in got)


def test_hot_lengths_are_ranked_in_parts(spark, model, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 20)
    rows = [(i, "one hot text " * (40 if i % 3 else 900)) for i in range(200)]
    check_packed(model, rows, packing.pack(documents(spark, rows), vocabulary()).collect())


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), vocabulary()).collect() == []


@pytest.mark.parametrize("chunk", [2, 3, 4096])
def test_sums_before(spark, monkeypatch, chunk):
    monkeypatch.setattr(packing, "CHUNK", chunk)
    keys = random.Random(chunk).sample(range(-40, 300), 90)
    rows = spark.createDataFrame([(k, k % 7) for k in keys], "k long, n long")
    got = {r.k: r.ahead for r in packing.sums_before(rows, "k", "n", "ahead").collect()}
    assert got == {k: sum(x % 7 for x in keys if x < k) for k in keys}
    assert packing.sums_before(rows.limit(0), "k", "n", "ahead").collect() == []


def test_ordered_packing_over_many_segments(spark, monkeypatch):
    monkeypatch.setattr(packing, "SEGMENT", 7)
    monkeypatch.setattr(packing, "CHUNK", 3)
    rnd = random.Random(12)
    data = [(i, " ".join(rnd.choice(["alpha", "river", "stone"]) for _ in range(rnd.randint(0, 400)))) for i in range(120)]
    slots = [(i, None if i == 5 else i // 9 * 1000, i % 9) for i in range(120)]
    docs = documents(spark, data).join(spark.createDataFrame(slots, "doc_id long, at long, nth long"), "doc_id")
    got = packing.pack(docs, vocabulary(), window=256, order=("at", "nth")).collect()
    pieces, places = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(range(120))
    for ps in pieces.values():
        assert [s for s, _, _ in sorted(ps)] == [sum(n for _, n, _ in sorted(ps)[:i]) for i in range(len(ps))]
        assert sum(n for _, n, _ in ps) == ps[0][2]
    assert sorted(places) == list(range(len(places)))
    for ps in places.values():
        assert [o for o, _ in sorted(ps)] == [sum(n for _, n in sorted(ps)[:i]) for i in range(len(ps))]
        assert sum(n for _, n in ps) <= 256
    # sequences follow the slots: ranges of slots do not overlap but by what one segment holds
    slot = {i: -1 if s is None else s for i, s, _ in slots}
    lows, highs = [min(slot[r.doc_id] for r in got if r.sequence_id == q) for q in sorted(places)], []
    for q in sorted(places):
        highs.append(max(slot[r.doc_id] for r in got if r.sequence_id <= q))
    assert all(low >= high - 1000 for low, high in zip(lows, highs))

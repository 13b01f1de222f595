import random

import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from aerometer.llm import simhash
from tests.llm.helpers import documents, lowered_words


def plain_mark(text, n=3):
    w = lowered_words(text)
    if not w:
        return 0
    shingles = [b" ".join(w)] if len(w) < n else [b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(marks, radius):
    """Component of each value by brute force over all pairs."""
    values, root = sorted(set(marks)), {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[find(b)] = find(a)
    return {v: find(v) for v in values}


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.integers(1, 6))
def test_fingerprint(text, n):
    assert simhash.fingerprint(text, n) % 2**64 == plain_mark(text, n)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover(radius):
    masks, rnd = simhash.covering_masks(radius), random.Random(1)
    for _ in range(2000):
        bits = sum(1 << b for b in rnd.sample(range(64), radius))
        assert any(bits & m % 2**64 == 0 for m in masks)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_connect_what_brute_force_connects(spark, radius):
    rnd, values = random.Random(radius), []
    for _ in range(25):
        x = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 12)):
            values.append(x)
            for b in rnd.sample(range(64), rnd.randint(1, radius + 1)):
                x ^= 1 << b
    signed = lambda x: x - 2**64 if x >> 63 else x
    marks = spark.createDataFrame([(signed(v),) for v in set(values)], "mark long")
    found = [(r.u % 2**64, r.v % 2**64) for r in simhash.links(marks, radius).collect()]
    assert all((u ^ v).bit_count() <= radius for u, v in found)
    want = plain_classes(values, radius)
    root = {v: v for v in want}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in found:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    groups = lambda f: {frozenset(v for v in want if f(v) == r) for r in map(f, want)}
    assert groups(find) == groups(lambda v: want[v])


def hard_rows():
    rnd = random.Random(3)
    base = " ".join(rnd.choice("alpha beta gamma delta eps zeta eta".split()) + str(rnd.randint(0, 9)) for _ in range(400))
    words = base.split()
    near = [" ".join(words[:i] + ["changed"] + words[i + 1:]) for i in (10, 200, 390)]
    return [(7, base), (3, near[0]), (9, near[1]), (11, near[2]), (1, None), (2, ""), (4, " \n\t"), (5, "One"), (6, "oNE"),
            (7, base), (None, base), (12, "long " * 30000), (13, "ÀB c d"), (13, "other text of the same id")]


def test_rows_match_brute_force(spark):
    rows = hard_rows()
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    marks = [plain_mark(t) for _, t in rows]
    root = plain_classes(marks, 2)
    least = {}
    for (i, _), m in zip(rows, marks):
        if i is not None:
            least[root[m]] = min(i, least.get(root[m], i))
    want = sorted((i is None, i or 0, f"{m:016x}", least.get(root[m])) for (i, _), m in zip(rows, marks))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got) == want


def test_one_row_of_each_component_stays(spark):
    rows = hard_rows()
    docs = documents(spark, rows)
    kept = simhash.keep_one(docs, 3, 2)
    assert kept.columns == docs.columns
    marks = [plain_mark(t) for _, t in rows]
    root = plain_classes(marks, 2)
    assert kept.count() == len(set(root.values()))
    assert 1 in {r.doc_id for r in kept.collect()}


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.keep_one(documents(spark, []), 3, 2).collect() == []

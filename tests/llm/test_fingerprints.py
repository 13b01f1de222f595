import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aerometer.llm import fingerprints as fp
from tests.llm.helpers import documents, lowered_words


def jaccard(a, b):
    a, b = Counter(lowered_words(a)), Counter(lowered_words(b))
    return sum((a & b).values()) / (sum((a | b).values()) or 1)


def rows():
    rnd = random.Random(6)
    text = lambda n: " ".join(rnd.choice("abcdefghijklmnop") * rnd.randint(1, 3) for _ in range(n))
    out = [(i * 7 % 101, text(rnd.randint(1, 60))) for i in range(101)]
    return out + [(200, None), (201, ""), (202, "odd é😀 text"), (203, "x"), (203, "w"), (None, "no id"), (300, "long text " * 20000), (-5, out[0][1])]


def plain(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        h = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[:len(t) - h] + nxt[:h]).encode()).hexdigest(), t, t[:len(t) - h] + nxt[:h], nxt))
    return out


@pytest.mark.parametrize("ordered", [1 << 24, 300])
def test_report(spark, monkeypatch, ordered):
    monkeypatch.setattr(fp, "ORDERED", ordered)
    data = rows()
    got = fp.edit_report(documents(spark, data)).collect()
    want = plain(data)
    assert sorted((repr(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted((repr(w[0]), *w[1:3]) for w in want)
    prints = {}
    by = {(w[0], w[2]): w for w in want}
    for r in got:
        _, _, _, text, changed, nxt = by[r.doc_id, r.edited_sha256]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(changed, r.edited_fingerprint) == r.edited_fingerprint
    for r in got:
        _, _, _, text, changed, nxt = by[r.doc_id, r.edited_sha256]
        same = lambda a, b: sum(a[8 * i:8 * i + 8] == b[8 * i:8 * i + 8] for i in range(16)) / 16
        assert r.near_edited == same(prints[text], prints[changed])
        assert r.near_next == same(prints[text], prints[nxt])


def test_collisions_estimate_the_generalised_jaccard_similarity(spark):
    texts = ["a a a b c d d e", "a b b b c d e f", "a a a a a a a a b", "x y z", "a " * 50 + "b", "a " * 40 + "b b"]
    prints = {r.doc_id: r.fingerprint for r in fp.of_documents(documents(spark, list(enumerate(texts))), samples=400).collect()}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            rate = sum(x == y for x, y in zip(prints[i], prints[j])) / 400
            assert abs(rate - jaccard(a, b)) < 0.09


def test_weights_are_counts(spark):
    df = spark.createDataFrame([("B a b  b",), ("",)], "text string")
    got = fp.with_terms(df, F.col("text"), "t").select("t").collect()
    assert sorted(x.weight for x in got[0].t) == [1, 3] and got[1].t == []


def test_empty_table(spark):
    assert fp.edit_report(documents(spark, [])).collect() == []
    assert fp.of_documents(documents(spark, [])).collect() == []


def test_a_single_row_is_its_own_next(spark):
    r = fp.edit_report(documents(spark, [(1, "ab cd")])).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()

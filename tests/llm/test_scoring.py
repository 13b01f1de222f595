import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aerometer.llm import scoring
from tests.llm.helpers import crc, documents, lowered_words


def rows():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice(["an", "be", "co", "du", "é", "Th"]) for _ in range(rnd.randint(1, 4)))
    out = [(i, " ".join(word() for _ in range(rnd.randint(0, 40)))) for i in range(120)]
    return out + [(200, None), (201, ""), (202, " \n"), (203, "zq \0 \x7f new 日本"), (204, "zq new 日本"), (204, "zq new 日本"),
                  (None, "an be"), (205, "long text " * 3000)]


def plain(data, order, held):
    trie, c, n, ends = scoring.PpmTrie(order), Counter(), 0, 0
    for i, t in data:
        if not held(i):
            b, context = (t or "").encode().lower(), (256,) * order
            for s in (*b, 256):
                trie.learn(context, s)
                context = (*context, s)[1:]
            c.update(lowered_words(t))
            n, ends = n + len(lowered_words(t)) + 1, ends + 1
    v = len(c) + (ends > 0)
    out = []
    for i, t in data:
        w = lowered_words(t)
        base = sum(math.log10((x + 1) / (n + v + 1)) for x in [*(c[x] for x in w), ends])
        out.append((i, held(i), len(w) + 1, sum(c[x] > 0 for x in w) + (ends > 0), n, base, trie.walk((t or "").encode().lower(), False)))
    return out


@pytest.mark.parametrize("order,block", [(2, 1 << 25), (4, 400), (5, 1 << 25)])
def test_scores_match_the_trie(spark, monkeypatch, order, block):
    monkeypatch.setattr(scoring, "BLOCK", block)
    monkeypatch.setattr(scoring, "CHUNK", 500)
    data = rows()
    held = lambda i: i is not None and crc(i) % 7 == 2
    docs = documents(spark, data).repartition(3, "doc_id")
    got = sorted(map(tuple, scoring.scores(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, order).collect()), key=repr)
    want = sorted(plain(data, order, held), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_probabilities_add_up_to_one():
    trie, rnd = scoring.PpmTrie(3), random.Random(2)
    for _ in range(30):
        trie.walk(bytes(rnd.choice(b"abc") for _ in range(20)), True)
    for context in [(256, 256, 256), (97, 98, 99), (97, 97, 97), (1, 2, 97)]:
        assert sum(10 ** trie.cost(context, s) for s in range(257)) == pytest.approx(1)


def test_adaptive_scores_fall_with_repetition(spark):
    got = {r.doc_id: r.score for r in scoring.adaptive_scores(documents(spark, [(1, "abc" * 50), (2, "".join(chr(97 + i % 26) * (i % 3) for i in range(150))), (3, None)])).collect()}
    assert got[1] == pytest.approx(scoring.PpmTrie(3).walk(b"abc" * 50, True)) and got[1] > got[2]
    assert got[3] == pytest.approx(-math.log10(257))


def test_no_training_rows_and_empty_table(spark):
    r = scoring.scores(documents(spark, [(1, "ab")]), F.lit(True)).first()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0) and r.score == pytest.approx(-3 * math.log10(257))
    assert scoring.scores(documents(spark, []), F.lit(True)).collect() == []

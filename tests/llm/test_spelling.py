import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from aerometer.llm import spelling as sp
from tests.llm.helpers import documents

AZ = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain(rows, length=6, times=5, ratio=5):
    """The contract, word by word and pair by pair."""
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = "".join(c for i, c in enumerate(run) if i != h % len(run))
            seen[run] += 1
    words = {w: n for w, n in seen.items() if len(w) >= length and n >= times}

    def one_off(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out, form = {}, {}
    for w, n in words.items():
        near = sorted((-m, o) for o, m in words.items() if one_off(w, o))
        form[w] = near[0][1] if near and -near[0][0] >= ratio * n else None
        out[w] = (n, len(near), form[w], -near[0][0] if form[w] else None)
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w] += (root,)
    return out


def made(seed=3):
    rnd = random.Random(seed)
    stems = ["colour", "grüßen", "straße", "señora", "letters", "banana", "éclairs", "aaaaaa", "mississippi", "×÷àÿøþ"]
    words = []
    for s in stems:
        words += [s] * rnd.choice([6, 40, 300])
        for _ in range(4):
            i = rnd.randrange(len(s))
            v = rnd.choice([s[:i] + s[i + 1:], s[:i] + rnd.choice("aeiöß") + s[i + 1:], s[:i] + rnd.choice("aeiöß") + s[i:]])
            words += [v.upper() if v.isascii() and rnd.random() < 0.3 else v] * rnd.choice([4, 5, 7, 30])
    words += ["colour", "colours", "ncolour"] * 5 + ["oculor"] * 9  # an anagram is not near
    rnd.shuffle(words)
    rows = [(i, " ".join(words[i * 20:i * 20 + 20]) + rnd.choice(["", ".", "\n", " 12x"])) for i in range(len(words) // 20 + 1)]
    return rows + [(None, "colour colour"), (7001, None), (7002, ""), (7003, "x, 1 ÀÀ"), (7004, "ßtraße " * 50_000), (7005, "letters"), (7005, "letters"),
                   (7006, "a" * 100_000)]


@pytest.mark.parametrize("block", [sp.BLOCK, 3])
def test_variants_as_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(sp, "BLOCK", block)
    rows = made()
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in sp.variants(documents(spark, rows)).collect()}
    assert got == plain(rows)
    assert sum(v[2] is not None for v in got.values()) > 5


def test_chains_of_forms_end_at_their_root(spark):
    chain = {"aaaaaaa": 5, "aaaaaab": 25, "aaaaabb": 125, "aaaabbb": 625, "aaabbbb": 3125}
    rows = [(i, (w + " ") * n) for i, (w, n) in enumerate(chain.items())]
    want = plain(rows)
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in sp.variants(documents(spark, rows)).collect()}
    assert got == want and got["aaaaaaa"][-1] == "aaabbbb"


def test_a_run_that_is_damaged(spark):
    doc_id = next(i for i in range(10_000) if zlib.crc32(f"{i}:wonderful".encode()) % 199 == 0)
    h = zlib.crc32(f"{doc_id}:wonderful".encode())
    at = h % 9
    got = sp.variants(documents(spark, [(doc_id, "Wonderful " * 5)])).collect()
    assert [r.word for r in got] == ["wonderful"[:at] + "wonderful"[at + 1:]]


def test_no_words(spark):
    assert sp.variants(documents(spark, [])).collect() == []
    assert sp.variants(documents(spark, [(1, None), (2, "few words here")])).collect() == []


def test_gram_keeps_every_near_pair():
    rnd = np.random.default_rng(5)
    for la, lb in ((6, 6), (6, 7), (9, 10)):
        a, b = rnd.integers(97, 100, (60, la)).astype(np.uint8), rnd.integers(97, 100, (50, lb)).astype(np.uint8)
        i, j = sp.gram(a, b)
        dist = lambda x, y: sum((int((x == c).sum()) - int((y == c).sum())) ** 2 for c in range(97, 100))
        assert set(zip(i.tolist(), j.tolist())) == {(p, q) for p in range(60) for q in range(50) if dist(a[p], b[q]) <= 2}


def test_near_words_share_a_partner_cell():
    rnd = random.Random(2)
    for _ in range(300):
        w = "".join(rnd.choice("abcdefgéü") for _ in range(rnd.randint(6, 9)))
        i = rnd.randrange(len(w))
        v = rnd.choice([w[:i] + rnd.choice("xyzàé") + w[i + 1:], w[:i] + rnd.choice("xyzàé") + w[i:]])
        met = [(x, y) for x, y in ((w, v), (v, w)) if sp.cell(y) in sp.partners(sp.cell(x))]
        assert len({(sp.cell(x), sp.cell(y)) for x, y in met}) == 1

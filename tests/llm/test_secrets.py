import hashlib
import random
import re

from aerometer.llm import secrets as sc
from tests.llm.helpers import documents

WORD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    """Base spans as the contract words them."""
    text, out = text or "", []
    for order, (kind, pattern, least, group) in enumerate((
            ("assign", re.compile(WORD, re.I | re.A), 12, 2), ("access", re.compile("AKIA[A-Z0-9]+"), 18, 0), ("hex", re.compile("[0-9a-f]+"), 16, 0))):
        at = 0
        while m := pattern.search(text, at):
            at = m.end()
            if len(m.group(group)) >= least:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


HARD = [
    (1, None), (2, ""), (3, "token = token: abcdefghijklmnop"), (4, "TOKEN='ABCDEFGHIJKL' api_key:abcdefghijkl apikey =\"x\" passwd=short"),
    (5, "AKIAAKIA AKIAABCDEFGHIJKLMN akiaabcdefghijklmn"), (6, "0123456789abcdef 0123456789abcde x0123456789ABCDEF0123456789abcdef"),
    (7, "é ü \U0001f600 secret: 0123456789abcdef0123"), (8, "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop token=Kabcdefghijkl"),
    (9, "words " * 60_000 + "password: hunter2hunter2"), (10, "secret=secret=aaaaaaaaaaaa"), (10, "secret=secret=aaaaaaaaaaaa"), (None, "a" * 16),
    (11, "token  : \"abcdefghijkl\" and secret'='abcdefghijkl"), (12, "f" * 100_000),
]


def made(n=300):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice(["ka", "lo", "mi", "nu", "pe", "strat"]) for _ in range(rnd.randint(1, 6)))
    key = lambda signs, k: "".join(rnd.choice(signs) for _ in range(k))
    rows, bare = [], {}
    for i in range(n):
        words = [word() for _ in range(60)] + ["mail7.example.com", f"{rnd.randint(10, 250)}.{rnd.randint(10, 250)}.{rnd.randint(10, 250)}.17", "https://www.example.org/a/page.html"]
        if i % 3 == 0:
            words.insert(rnd.randrange(60), f'token = "{key("GHIJKLMNOPQRSTUVWXYZ0123456789", 24)}"')
        if i % 10 == 1:
            bare[i] = key("GHIJKLMNOPQRSTUVWXYZ0123456789", 24)
            words.insert(rnd.randrange(60), bare[i])
        rows.append((1000 + i, " ".join(words)))
    return rows, {1000 + i: v for i, v in bare.items()}


def test_base_spans_stay(spark):
    rows = HARD + made()[0]
    got = sc.digests(sc.scan(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    texts = sorted(rows, key=repr)
    for r, (doc_id, text) in zip(sorted(got, key=lambda r: repr((r.doc_id, dict(rows).get(r.doc_id)))), texts):
        want = plain(text)
        assert r.doc_id == doc_id and r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), doc_id
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("format")] == want
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_bare_credentials_are_found_by_their_format(spark):
    rows, bare = made()
    got = {r.doc_id: r.spans for r in sc.scan(documents(spark, rows)).collect()}
    texts = dict(rows)
    found = {i: [texts[i][s.start:s.end] for s in spans if s.kind == sc.LEARNED] for i, spans in got.items()}
    assert all(bare[i] in found[i] for i in bare)
    assert sum(map(len, found.values())) == len(bare)


def test_held_out_credentials_and_words():
    rnd = random.Random(7)
    key = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(32))
    words = ["".join(rnd.choice(["ing", "tion", "the", "re", "mo"]) for _ in range(6)) for _ in range(1500)]
    model = sc.learned({"hex": [sc.skeleton(key()) for _ in range(500)], sc.LEARNED: [sc.skeleton(w) for w in [key(), key(), *words[:1000]]]})
    assert all(model.log_odds(sc.skeleton(key())) >= sc.ODDS for _ in range(200))
    assert not any(model.log_odds(sc.skeleton(w)) >= sc.ODDS for w in words[1000:])


def test_inference_recovers_a_small_automaton():
    rnd, words = random.Random(5), []
    for _ in range(3000):  # a then b, again with probability one half
        w = "a0"
        while rnd.random() < 0.5:
            w += "a0"
        words.append(w)
    got = sc.infer(words)
    assert len(got.visits) <= 4
    assert got.log_likelihood("a0a0") > got.log_likelihood("a0aa") + 3 and abs(got.log_likelihood("a0") - got.log_likelihood("a0a0") - 0.69) < 0.2
    tree = sc.prefix_tree(words)
    assert tree.visits[0] == 3000 and sum(tree.ends) == 3000 and sum(got.ends) == 3000


def test_nothing_to_learn_from(spark):
    assert sc.scan(documents(spark, [])).collect() == []
    got = sc.digests(sc.scan(documents(spark, [(1, "plain words only"), (2, None)]))).collect()
    assert {(r.n_assign, r.n_access, r.n_hex, r.spans) for r in got} == {(0, 0, 0, "")}


def test_samples_are_bounded_and_the_same_for_any_partitions(spark):
    rows, _ = made()
    one, many = (sc.samples(documents(spark, rows).repartition(n), size=20) for n in (1, 7))
    assert one == many and len(one[sc.LEARNED]) == 20 and all(len(v) <= 20 for v in one.values())

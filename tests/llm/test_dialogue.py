import hashlib
import random
import re
import zlib
from itertools import groupby

import pytest

from aerometer.llm import dialogue as dg

ROWS = "conv_id long, turn long, role string, text string, mark string, at long, seg int"
LEGAL = re.compile("(s?(ua)+)?")


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(c, t, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def plain(rows):
    """Dynamic programming over the rows of one conversation: all states, all cheapest and least edits."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    marks, seen = [], set()
    for _, _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        marks.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    states = {"": (0, "", ())}  # what was put out so far, reduced to what matters

    def after(said, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((said, initial))

    def keep(new, state, way):
        if state is not None and (state not in new or way < new[state]):
            new[state] = way

    def inserted(states):
        new = dict(states)
        for _ in range(3):
            for s, (cost, audit, out) in list(new.items()):
                for role in ("user", "assistant"):
                    keep(new, after(s, role[0]), (cost + 5, audit + "I", (*out, f"{role}:")))
        return new

    for (_, _, role, text), mark in zip(rows, marks):
        new = {}
        for s, (cost, audit, out) in inserted(states).items():
            keep(new, s, (cost + 2, audit + "D", out))
            if mark in ("blank", "duplicate"):
                continue
            more = 5 if mark == "truncated" else 0
            keep(new, after(s, role[:1]), (cost + more, audit + "K", (*out, f"{role}:{text}")))
            for to in ("user", "assistant"):
                keep(new, after(s, to[0]), (cost + 1 + more, audit + "R", (*out, f"{to}:{text}")))
        states = new
    cost, audit, out = min(v for s, v in inserted(states).items() if s in ("", "a"))
    turns = {r[1] for r in rows if r[1] is not None}
    firsts = [r[2][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def wanted(rows):
    hurt = damaged(rows)
    return {c: plain([r for r in hurt if r[0] == c]) for c in {r[0] for r in rows}}


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], ROWS)


def reported(spark, rows, segment=dg.SEGMENT):
    df = frame(spark, rows)
    got = dg.report(dg.damage(df), df, segment).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}


def made(seed=8):
    rnd, rows = random.Random(seed), []
    text = lambda: rnd.choice(["yes.", "No!", "well", " ", "", "a?\n", "Ünd so.", "same.", "same.", None, " "])
    for c in range(120):
        for t in range(rnd.randint(1, 9)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "s"])
            rows.append((c, t if rnd.random() < 0.9 else rnd.choice([None, 3, 50]), role, text()))
            if rnd.random() < 0.1:
                rows.append(rows[-1])
    rows += [(None, 1, "user", "hi."), (None, 2, "assistant", "ho."), (500, None, "user", "a."), (500, None, None, None)]
    rows += [(600, t, ("user", "assistant")[t % 2], f"line {t}" + rnd.choice([".", ".", "", "!"])) for t in range(700)]
    rows += [(601, 5, "user", "long text " * 60_000 + "."), (601, 6, "assistant", "ok.")]
    rows += [(602, 3, "user", "the same.")] * 400 + [(602, 4, "assistant", "b.")] * 3
    gone = next(i for i in range(700, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return rows + [(gone, 0, "user", "x.")]


@pytest.mark.parametrize("segment", [dg.SEGMENT, 4])
def test_report_as_by_brute_force(spark, segment):
    rows = made()
    want, got = wanted(rows), reported(spark, rows, segment)
    assert got.keys() == want.keys()
    assert {c: (got[c], want[c]) for c in want if got[c] != want[c]} == {}
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got.values()


def test_repaired_rows_are_legal_and_hash_alike(spark):
    rows = made(9)
    df = frame(spark, rows)
    out = dg.repaired(dg.edits(dg.damage(df), segment=16)).orderBy("conv_id", "at", "place").collect()
    want = wanted(rows)
    for c, group in groupby(out, key=lambda r: r.conv_id):
        group = list(group)
        assert LEGAL.fullmatch("".join(r.role[:1] for r in group))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in group).encode()).hexdigest() == want[c][-1]


def test_empty_table(spark):
    df = frame(spark, [])
    assert dg.report(dg.damage(df), df).collect() == []
    assert dg.edits(df).collect() == []


def test_search_finds_the_least_of_the_cheapest():
    rnd = random.Random(4)
    faults = {"": dg.SOUND, "truncated": dg.CUT, "blank": dg.BAD}
    for _ in range(400):
        rows = [(0, i, rnd.choice(["user", "assistant", "system", "tool"]), rnd.choice([f"t{i}.", f"t{i}", " "])) for i in range(rnd.randint(0, 10))]
        mark = lambda t: "blank" if t == " " else "" if t.endswith(".") else "truncated"
        cost, audit = dg.repair([(r[2][0], faults[mark(r[3])]) for r in rows])
        assert (cost, audit) == plain(rows)[5:7]
    assert dg.repair([("u", 0)], dg.USER, (dg.START,)) is None

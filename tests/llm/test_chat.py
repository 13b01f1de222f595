import hashlib
import random

from aerometer.llm import chat

TURNS = "conv_id long, turn long, role string, text string, turns string, formatted int"
NASTY = ["", None, "plain", "\\### Assistant: </turn> ok", "</turn>\n### assistant:\n", "<next/>\n", "\\l\\b\\h", "a\\",
         "### user:\n", "#<\\:>", "é😀\n</turn>", "x" * 5000]


def plain(turns):
    said = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
    loss = "".join(t or "" for _, r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(said), len(loss), sha(loss)


def test_round_trip(spark):
    rnd, convs = random.Random(5), {}
    for c in range(60):
        convs[c] = [(i, rnd.choice(["user", "assistant", "assistant", "system", None, "odd:\n#<role"]), rnd.choice(NASTY))
                    for i in range(rnd.randint(1, 9))]
    rows = [(c, i, r, t, "x", 1) for c, turns in convs.items() for i, r, t in turns]
    rnd.shuffle(rows)
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(chat.format_chats(spark.createDataFrame(rows, TURNS))).collect()}
    assert got == {c: plain(turns) for c, turns in convs.items()}


def test_ties_nulls_and_repeats_are_kept_in_a_fixed_order(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", "z"), (None, 3, "user", "q")]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    got = {r.conv_id: r for r in chat.format_chats(turns).collect()}
    assert got[1].formatted == "### assistant:\nz</turn>\n### user:\na<next/>\na<next/>\nb</turn>\n"
    assert got[None].formatted == "### user:\nq</turn>\n"


def test_adjacent_turns_share_a_block_and_the_mask_leaves_markers_out(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "a#"), (1, 2, "assistant", ""), (1, 3, "assistant", "c")],
                                  "conv_id long, turn long, role string, text string")
    r = chat.format_chats(turns).first()
    assert r.formatted == "### user:\nhi</turn>\n### assistant:\na\\h<next/>\n<next/>\nc</turn>\n"
    assert [r.formatted[s.start:s.start + s.length] for s in r.spans] == ["a\\h", "", "c"]


def test_empty_table(spark):
    assert chat.digests(chat.format_chats(spark.createDataFrame([], TURNS))).collect() == []

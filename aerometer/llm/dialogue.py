"""Conversation structure repair by iterative-deepening A*.

The cheapest edits that turn the roles of a conversation into `(s?(ua)+)?` are searched depth first,
in ASCII order of the edits' letters, under a cost bound that rises to the least cost that went over
it. States from which a budget is known not to suffice are kept in a transposition table, which stays
valid under later bounds. So the first path that accepts is the cheapest and of the cheapest the
least in ASCII order.

Rows are ordered by one range partitioning, so a conversation of any length is spread over tasks; it is
cut into segments of bounded length, each searched for every way through it, and the ways are then
linked. Only linking and hashing walk along a conversation, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometer.llm.common import free_names, written

#: Costs of the edits, by their letters, and of a truncated row that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows of a segment.
SEGMENT = 512
#: What a mark is made of: no fault, truncated, to be deleted.
SOUND, CUT, BAD = 0, 1, 2
#: The automaton: nothing yet, after system, after user, after assistant. Next state by role initial.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: What an inserted or newly assigned role must be in each state, and the states that may end a conversation.
OWED, ENDS = "uuau", (START, ASSISTANT)
ROLE = {"u": "user", "a": "assistant"}
BLANK = r"[\x20\x09-\x0D]"
#: Characters of a text that decide between ranges; ties beyond them share one.
RANGED = 64


def key_of(conv_id: Column, turn: Column) -> Column:
    """The damage number of a row; a null part of the key is one space."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    return F.crc32(F.concat(part(conv_id), F.lit(":"), part(turn)).cast("binary")) % 20


def damage(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) with faults put in by the row's key; a null role or text is one space."""
    how = key_of(F.col("conv_id"), F.col("turn"))
    plain = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                         F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")).withColumn("how", how)
    text = F.when(F.col("how") == 1, F.lit("")).when(F.col("how") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return plain.where("how <> 0").withColumns({
        "text": text, "role": F.when(F.col("how") == 4, F.lit("user")).otherwise(F.col("role")),
        "times": F.when(F.col("how") == 3, 2).otherwise(1)}).select(
        "conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("one")).drop("one")


def least_cost(initial: str, fault: int) -> int:
    """What a row costs at least."""
    if fault == BAD or fault == CUT:
        return DELETE
    return KEEP if initial in ("s", "u", "a") else REROLE


def reachable(rows: list[tuple[str, int]], entry: int, goal: int) -> bool:
    """Whether some edits lead from one state to another."""
    if goal == entry or goal in (USER, ASSISTANT):
        return True
    return entry == START and goal == SYSTEM and any(c == "s" and f != BAD for c, f in rows)


def repair(rows: list[tuple[str, int]], entry: int = START, goals: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest edits of rows (role initial, fault) that lead from entry to a goal, of
    equal cost the least in ASCII order; None where there are none."""
    goals = tuple(g for g in goals if reachable(rows, entry, g))
    if not goals:
        return None
    n = len(rows)
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + least_cost(*rows[i])
    failed: dict[tuple[int, int], int] = {}
    bound = rest[0]
    while True:
        over = None
        # a frame: row, state, cost so far, the moves left to try (letter, row, state, cost), last first
        path: list[str] = []
        stack = [(0, entry, 0, None)]
        while stack:
            i, state, cost, moves = stack.pop()
            if moves is None:
                if i == n and state in goals:
                    return cost, "".join(path)
                moves = []
                owed = OWED[state]
                if i < n:
                    initial, fault = rows[i]
                    if fault != BAD:
                        more = TRUNCATED if fault == CUT else 0
                        moves.append(("R", i + 1, NEXT[state][owed], cost + REROLE + more))
                        if initial in NEXT[state]:
                            moves.append(("K", i + 1, NEXT[state][initial], cost + KEEP + more))
                if i == n or rows[i][1] != BAD:  # an insertion goes behind what must be deleted
                    moves.append(("I", i, NEXT[state][owed], cost + INSERT))
                if i < n:
                    moves.append(("D", i + 1, state, cost + DELETE))
            stack.append((i, state, cost, moves))
            while moves:
                letter, j, to, spent = moves.pop()
                least = spent + rest[j]
                if least > bound:
                    over = least if over is None else min(over, least)
                elif failed.get((j, to), -1) < bound - spent:
                    path.append(letter)
                    stack.append((j, to, spent, None))
                    break
                else:  # failed before with as much to spend; what it lacked is at least one more
                    over = bound + 1
            else:
                stack.pop()
                failed[(i, state)] = max(failed.get((i, state), -1), bound - cost)
                if stack:
                    path.pop()
        bound = bound + 1 if over is None else over


def ordered(turns: DataFrame) -> DataFrame:
    """Distinct rows of turns (conv_id, turn, role, text) with copies (how often each occurs) and at, a number
    that follows conv_id, turn, role and text, nulls first. Written."""
    ways = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role")]
    ranged = ways.repartitionByRange(*order, F.substring("text", 1, RANGED)).sortWithinPartitions(*order, "text")
    return written(ranged.withColumn("at", F.monotonically_increasing_id()), "dialogue-rows")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, at, initial (of the role) and fault of rows (of ordered): blank, duplicate (role and text seen earlier in
    the conversation), truncated or null. Written, without the texts.

    The fault is that of a row's first copy; all further copies are duplicates, blank ones blank.
    """
    bare = F.regexp_replace("text", BLANK, "")
    seen = written(rows.select(
        "conv_id", "at", F.substring("role", 1, 1).alias("initial"), (F.length(bare) == 0).alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text").cast("binary"), 256).alias("said")), "dialogue-seen")
    first = seen.groupBy("conv_id", "said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("truncated"), "truncated")
    return written(seen.join(first, "at", "left").select("conv_id", "at", "initial", fault.alias("fault")), "dialogue-faults")


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every way through each segment; a whole conversation has one."""
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            rows = [(x["initial"], int(x["mark"])) for x in r.rows]
            starts = (START,) if r.first else range(4)
            goals = [ENDS] if r.last else [(g,) for g in range(4)]
            for a in starts:
                for g in goals:
                    if found := repair(rows, a, g):
                        out.append((r.seg, a, g[0] if not r.last else ASSISTANT, *found))
        yield pd.DataFrame(out, columns=["seg", "entry", "goal", "cost", "edits"], dtype=object)


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The chosen entry and goal of every segment, from all ways sorted by conversation and segment. Held are the four
    best ways so far and the states they went through."""
    group, seg, best, here = None, None, {}, {}

    def step(best: dict, here: dict, seg: int) -> dict:
        new: dict = {}
        for (a, g), (cost, edits) in here.items():
            if a in best:
                spent, done, trail = best[a]
                way = (spent + cost, done + edits)
                if g not in new or way < new[g][:2]:
                    new[g] = (*way, (trail, seg, a, g))
        return new

    def finish(best: dict) -> pd.DataFrame:
        _, _, trail = best[ASSISTANT]
        rows = []
        while trail:
            trail, s, a, g = trail
            rows.append((s, a, g))
        return pd.DataFrame(rows, columns=["seg", "entry", "goal"], dtype=object)

    for pdf in batches:
        for r in pdf.itertuples(index=False):
            conv = (r.none, r.conv)
            if (conv, r.seg) != (group, seg):
                if seg is not None:
                    best = step(best, here, seg)
                if conv != group:
                    if group is not None:
                        yield finish(best)
                    best = {START: (0, "", None)}
                group, seg, here = conv, r.seg, {}
            here[(r.entry, r.goal)] = (r.cost, r.edits)
    if group is not None:
        yield finish(step(best, here, seg))


def _dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each row's inserts before it, edit and new role, and the inserts after the last row, from a segment's edits."""
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            state, i, before = r.entry, 0, ""
            for letter in r.edits:
                owed = OWED[state]
                if letter == "I":
                    before, state = before + owed, NEXT[state][owed]
                    continue
                x = r.rows[i]
                if letter == "K":
                    state = NEXT[state][x["initial"]]
                elif letter == "R":
                    state = NEXT[state][owed]
                out.append([x["at"], before, letter, ROLE[owed] if letter == "R" else None, ""])
                before, i = "", i + 1
            out[-1][4] = before
        yield pd.DataFrame(out, columns=["at", "before", "edit", "new_role", "after"], dtype=object)


def edits(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The cheapest edits of every conversation of turns (conv_id, turn, role, text), a row for each distinct row.

    Returns conv_id, turn, role, text, copies, at (order), fault (of the first copy), before (role initials
    inserted before it), edit (K, R or D, of the first copy; further copies are deleted), new_role (of R) and
    after (initials inserted behind the last row). Rows are ordered by turn, nulls first, ties by role and
    text; a null role or text is an empty one; a null conv_id is a conversation of its own; blank, empty and
    repeated rows are deleted. An empty table gives no rows.
    """
    texts = ordered(turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    rows = faults(texts)
    cut = F.struct(F.shiftright("at", 33), F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / segment))
    mark = F.when(F.col("fault").isin("blank", "duplicate"), BAD).when(F.col("fault") == "truncated", CUT).otherwise(SOUND)
    segs = rows.groupBy("conv_id", cut.alias("cut")).agg(
        F.min("at").alias("seg"), F.sort_array(F.collect_list(F.struct(
            "at", "initial", mark.alias("mark")))).alias("rows")).drop("cut")
    segs = written(segs, "dialogue-segments")
    none, conv = F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).alias("conv")
    ends = segs.groupBy(none, conv).agg(F.min("seg").alias("lo"), F.max("seg").alias("hi"))
    placed = segs.select("seg", "rows", none, conv).join(ends, ["none", "conv"]).select(
        "none", "conv", "seg", "rows", (F.col("seg") == F.col("lo")).alias("first"), (F.col("seg") == F.col("hi")).alias("last"))
    found = placed.select("seg", "rows", "first", "last").mapInPandas(
        _search, "seg long, entry int, goal int, cost long, edits string")
    ways = written(found.join(placed.select("seg", "none", "conv", "first", "last"), "seg"), "dialogue-ways")
    whole = ways.where("first AND last").select("seg", "entry", "edits")
    linked = (ways.where("NOT (first AND last)").repartition("none", "conv").sortWithinPartitions("none", "conv", "seg")
              .select("none", "conv", "seg", "entry", "goal", "cost", "edits").mapInPandas(_linked, "seg long, entry int, goal int"))
    parts = linked.join(ways, ["seg", "entry", "goal"]).select("seg", "entry", "edits")
    dealt = segs.select("seg", "rows").join(whole.union(parts), "seg").select("rows", "entry", "edits").mapInPandas(
        _dealt, "at long, before string, edit string, new_role string, after string")
    return texts.join(rows.select("at", "fault").join(dealt, "at"), "at")


def repaired(edited: DataFrame) -> DataFrame:
    """The rows that edits leave: conv_id, at, place (order within at), role and text; inserted texts are empty."""
    put = lambda initials: F.transform(F.split(initials, ""), lambda c: F.struct(
        F.when(c == "u", ROLE["u"]).otherwise(ROLE["a"]).alias("role"), F.lit("").alias("text")))
    none = F.array().cast("array<struct<role:string,text:string>>")
    own = F.array(F.struct(F.coalesce("new_role", "role").alias("role"), F.col("text").alias("text")))
    all_rows = F.concat(F.when(F.col("before") == "", none).otherwise(put(F.col("before"))),
                        F.when(F.col("edit") == "D", none).otherwise(own),
                        F.when(F.col("after") == "", none).otherwise(put(F.col("after"))))
    return edited.select("conv_id", "at", F.posexplode(all_rows).alias("place", "r")).select("conv_id", "at", "place", "r.role", "r.text")


def _walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from its edited rows in order; held is a running digest, not the rows."""
    columns = ["none", "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    group = None

    def end() -> tuple:
        gaps = int(turns[-1] - turns[0] + 1 - distinct) if turns else 0
        return (*group, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, "".join(audit), sha.hexdigest())

    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            if (r.none, r.conv) != group:
                if group is not None:
                    out.append(end())
                group, counts, illegal, cost, audit = (r.none, r.conv), {"blank": 0, "duplicate": 0, "truncated": 0}, 0, 0, []
                turns, distinct, sha, initial, empty = [], 0, hashlib.sha256(), None, True
            if r.turn and (not turns or turns[-1] != int(r.turn)):
                turns, distinct = [turns[0] if turns else int(r.turn), int(r.turn)], distinct + 1
            more = int(r.copies) - 1
            if r.fault:
                counts[r.fault] += 1
            counts["blank" if r.fault == "blank" else "duplicate"] += more
            mine = r.role[:1]
            illegal += (initial is not None and initial + mine not in ("su", "ua", "au")) + more
            initial = mine
            audit.append("I" * len(r.before) + r.edit + "D" * more + "I" * len(r.after))
            cost += INSERT * (len(r.before) + len(r.after)) + DELETE * more
            cost += DELETE if r.edit == "D" else (REROLE if r.edit == "R" else KEEP) + (TRUNCATED if r.fault == "truncated" else 0)
            kept = [(r.new_role or r.role, r.text)] if r.edit != "D" else []
            for role, text in [*((ROLE[c], "") for c in r.before), *kept, *((ROLE[c], "") for c in r.after)]:
                sha.update((("" if empty else "\n") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                empty = False
        yield pd.DataFrame(out, columns=columns, dtype=object)
    if group is not None:
        yield pd.DataFrame([end()], columns=columns, dtype=object)


def report(turns: DataFrame, originals: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Faults, cost, edits and the digest of the repaired rows for every conv_id of originals.

    turns: the rows to repair, as for edits. A conversation of originals that has none gives zeros, an empty
    audit and the digest of nothing. gaps counts the numbers missing between the least and the largest turn,
    nulls left out.
    """
    done = edits(turns, segment)
    none, conv = free_names(originals, "none", "conv")
    key = lambda df: df.withColumns({none: F.col("conv_id").isNull(), conv: F.coalesce(F.col("conv_id").cast("long"), F.lit(0))})
    walked = (key(done).withColumnsRenamed({none: "none", conv: "conv"})
              .select("none", "conv", "at", "role", "text", "copies", "before", "edit", "after", *(
                  F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("turn", "fault", "new_role")))
              .repartition("none", "conv").sortWithinPartitions("none", "conv", "at")
              .mapInPandas(_walked, "none boolean, conv long, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                    "cost long, audit string, repaired_sha256 string"))
    ids = key(originals.select("conv_id")).select(F.col(none).alias("none"), F.col(conv).alias("conv")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return ids.join(walked, ["none", "conv"], "left").select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"),
        *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))

"""Chat formatting with Spark expressions only.

Each conversation becomes one string. Adjacent turns of one role share a block:

    ### role:
    text<next/>
    text</turn>

Inside roles and texts the characters that control strings are made of are written as two-letter
codes, so no text can open, part or close a block, and reading back gives the same turns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
OPEN, NAMED, NEXT, CLOSE = "### ", ":\n", "<next/>\n", "</turn>\n"
#: Written forms; the backslash first when writing and last when reading.
CODES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_CODES = (*CODES, (":", "\\c"))


def escape(text: Column, codes=CODES) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c[0]), F.lit(c[1])), codes, text)


def unescape(text: Column, codes=CODES) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c[1]), F.lit(c[0])), reversed(codes), text)


def format_chats(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conv_id: formatted (the whole string) and spans, the loss mask.

    turns: conv_id, turn, role, text. Turns are ordered by turn, then role and text, nulls first, so
    ties and repeated rows have a fixed place and are all kept; a null role or text is an empty one;
    a null conv_id is a conversation of its own. spans are (start, length) in code points, from 0, of
    every text of the trained role, in order, markers left out; a text of no length has an empty span.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    # a turn opens a block unless the turn before has the same role, and closes it unless the next has
    def piece(t: Column, i: Column) -> Column:
        before = F.get("turns", i - 1)["role"]
        after = F.get("turns", i + 1)["role"]
        head = F.when(before == t["role"], F.lit(NEXT)).otherwise(
            F.concat(F.lit(OPEN), escape(t["role"], ROLE_CODES), F.lit(NAMED)))
        tail = F.when(after == t["role"], F.lit("")).otherwise(F.lit(CLOSE))
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), tail.alias("tail"),
                        (t["role"] == trained_role).alias("trained"))

    pieces = ordered.select("conv_id", F.transform("turns", piece).alias("pieces"))
    size = lambda p: F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans"))

    def step(done: Column, p: Column) -> Column:
        span = F.struct((done["at"] + F.length(p["head"])).cast("long").alias("start"),
                        F.length(p["body"]).cast("long").alias("length"))
        return F.struct((done["at"] + size(p)).cast("long").alias("at"),
                        F.when(p["trained"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"])), "").alias("formatted"),
        F.aggregate("pieces", start, step)["spans"].alias("spans"))


def read_back(formatted: str = "formatted") -> Column:
    """The turns (role, text) that a formatted string holds."""
    blocks = F.slice(F.split(F.col(formatted), CLOSE), 1, F.size(F.split(F.col(formatted), CLOSE)) - 1)

    def turns_of(block: Column) -> Column:
        role = unescape(F.substring_index(F.substr(block, F.lit(len(OPEN) + 1)), NAMED, 1), ROLE_CODES)
        body = F.substr(block, F.position(F.lit(NAMED), block) + F.lit(len(NAMED)))
        return F.transform(F.split(body, NEXT), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns_of))


def masked_text(formatted: str = "formatted", spans: str = "spans") -> Column:
    """What the loss mask covers, unescaped, nothing between."""
    cut = lambda s: F.substr(F.col(formatted), s["start"].cast("int") + 1, s["length"].cast("int"))
    return F.array_join(F.transform(spans, lambda s: unescape(cut(s))), "")


def digests(chats: DataFrame) -> DataFrame:
    """conv_id and the digest columns, all read back from the formatted string and its mask."""
    seen = chats.withColumns({"_turns": read_back(), "_loss": masked_text()})
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return seen.select(
        "conv_id", F.size("_turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))

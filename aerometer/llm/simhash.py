"""SimHash near-dedup with covering locality-sensitive hashing.

Tables are the non-zero vectors v of {0,1}^(r+1): bit i of the fingerprint is in the mask of v when
the parity of phi(i) AND v is one, phi a fixed map of bits to non-zero vectors. Two fingerprints that differ
in at most r bits leave some v orthogonal to all phi of those bits, so they agree on that mask: every
link within the radius meets in some table, with certainty.

Inside a bucket links are found without pairing its members: two fingerprints at distance up to 2k
or 2k-1 share a value that each reaches by k flips, so members write the values they reach through
bits outside the mask, and members that reach one value join its least member.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometer.llm.common import text_of, winning_rows, written
from aerometer.llm.components import components

BITS, SEED = 64, 42
#: Shingles whose bits are counted at a time; bounds memory for very long texts.
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int) -> int:
    """Signed 64-bit SimHash of a text's word shingles; zero where it has no word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    hashed = xxhash.xxh64_digest
    if len(words) < shingle:
        marks = [hashed(b" ".join(words), SEED)]
    else:
        marks = [hashed(b" ".join(s), SEED) for s in zip(*(words[i:] for i in range(shingle)))]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(marks), CHUNK):
        part = np.frombuffer(b"".join(marks[at:at + CHUNK]), np.uint8).reshape(-1, BITS // 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(marks)).tobytes(), "big", signed=True)


def simhash(text: Column, shingle: int) -> Column:
    @F.pandas_udf("long")
    def marked(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return marked(text)


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1)-1 masks, as signed longs. phi deals the bits out evenly over all vectors."""
    size = 1 << (radius + 1)
    phi = [1 + i % (size - 1) for i in range(BITS)]
    masks = [sum(1 << i for i in range(BITS) if (phi[i] & v).bit_count() & 1) for v in range(1, size)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _flips(mask: int, radius: int) -> list[int]:
    """Patterns of up to ceil(radius/2) bits outside a mask, as signed longs; the empty one first."""
    free = [i for i in range(BITS) if not (mask >> i) & 1]
    most = (radius + 1) // 2
    found = [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(free, k)]
    return [x - (1 << BITS) if x >> (BITS - 1) else x for x in found]


def links(marks: DataFrame, radius: int) -> DataFrame:
    """(u, v) links between distinct fingerprints mark: enough to connect all within the radius.

    Every link is within the radius: an even one joins members that reach a value by radius/2 flips
    each, an odd one those at (radius+1)/2 flips with those at one less.
    """
    masks = covering_masks(radius)
    tables = marks.select("mark", F.posexplode(F.array(*[F.col("mark").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"))
    crowded = tables.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").select("t", "key")
    members = tables.join(crowded, ["t", "key"])
    flips = [F.array(*[F.lit(x).cast("long") for x in _flips(m, radius)]) for m in masks]
    reached = members.select("t", "mark", F.explode(F.get(F.array(*flips), F.col("t"))).alias("flip")).select(
        "t", "mark", F.col("mark").bitwiseXOR(F.col("flip")).alias("value"), F.bit_count("flip").alias("far"))
    if radius % 2:
        # an odd radius: values reached by all k flips join only members at fewer flips
        near = reached.where(F.col("far") < (radius + 1) // 2)
        hub = near.groupBy("t", "value").agg(F.min("mark").alias("v"))
        found = reached.join(hub, ["t", "value"])
    else:
        hub = reached.groupBy("t", "value").agg(F.min("mark").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
        found = reached.join(hub, ["t", "value"])
    return found.where("mark <> v").select(F.col("mark").alias("u"), "v").distinct()


def classes(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """doc_id, mark, text_hash, component_id and root (the least mark of the component) of every row."""
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), simhash(text_of(), shingle).alias("mark"),
        F.xxhash64(text_of()).alias("text_hash")), "simhash")
    marks = written(rows.groupBy("mark").agg(F.min("doc_id").alias("least")), "simhash-marks")
    roots = components(links(marks.select("mark"), radius), "simhash-links")
    of_mark = marks.join(roots.withColumnRenamed("node", "mark"), "mark", "left").select(
        "mark", "least", F.coalesce("root", "mark").alias("root"))
    of_root = of_mark.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(written(of_mark.join(of_root, "root").select("mark", "component_id", "root"), "simhash-classes"), "mark")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row of docs.

    component_id is the smallest doc_id reachable over links of at most radius differing bits, the
    row itself included; null only where all rows reached have a null doc_id. A null text is empty; a
    text without words has fingerprint zero and links like any other; fewer words than a shingle form
    one shingle. Equal rows stay as many rows. An empty table gives none.
    """
    return classes(docs, shingle, radius).select(
        "doc_id", F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of docs that stay, all columns: of each component the row with the smallest doc_id
    (null doc_ids last); of rows that share it the one whose text hash is smallest."""
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = classes(docs, shingle, radius).groupBy("root").agg(F.min(rank).alias("w"))
    return winning_rows(docs, F.xxhash64(text_of()), first.select("w.doc_id", "w.text_hash"))

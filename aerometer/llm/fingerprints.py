"""Document fingerprints by consistent weighted sampling, in Spark expressions only.

A text is the weighted set of its words, weights being their counts. For sample s every term has
r, c ~ Gamma(2, 1) and b ~ U(0, 1), drawn from hashes of term and s alone. With
t = floor(ln w / r + b) and ln a = ln c - r (t - b) - r the sample is the (term, t) of least a; two
texts agree on a sample with the probability of their generalised Jaccard similarity.

ln a and the identity of (term, t) are packed into one long, so a sample is the minimum of longs and
a fingerprint one grouped aggregation: rows of terms are aggregated where they are made and only one
row per text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerometer.llm.common import blocks_for, text_of, words, written

SAMPLES = 16
#: Characters of text that one task orders at a time, about.
ORDERED = 1 << 24
#: Ranges of ids by quantiles, and equal widths of each, at most.
CUTS, SPLITS = 64, 128


def with_terms(df: DataFrame, body: Column, name: str) -> DataFrame:
    """df with the array name of (term, weight): every distinct word of body, term its 64-bit hash.

    Weights are the lengths of runs among the sorted hashes. The steps are columns of their own, as
    an expression that a lambda refers to would be computed again for every element.
    """
    df = df.withColumn("_hashes", F.sort_array(F.transform(words(body), lambda w: F.xxhash64(w))))
    h = F.col("_hashes")
    df = df.withColumn("_starts", F.filter(F.transform(h, lambda x, i: F.when(
        (i == 0) | (x != F.get(h, i - 1)), i)), lambda i: i.isNotNull()))
    at = F.col("_starts")
    return df.withColumn(name, F.transform(at, lambda i, j: F.struct(
        F.get(h, i).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(h)) - i).alias("weight")))).drop("_hashes", "_starts")


def _uniform(bits: Column, shift: int) -> Column:
    """A value in (0, 1) from 32 of the 64 bits."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit(0xFFFFFFFF)) + F.lit(0.5)) / F.lit(4294967296.0)


def sample_key(term: Column, log_weight: Column, s: int) -> Column:
    """The packed sample of one term: its low 31 bits name (term, t), the bits above order by a."""
    h1, h2, h3 = (F.xxhash64(term, F.lit(3 * s + i)) for i in range(3))
    r = -F.log(_uniform(h1, 0) * _uniform(h1, 32))
    log_c = F.log(-F.log(_uniform(h2, 0) * _uniform(h2, 32)))
    b = _uniform(h3, 0)
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t - b) - r
    # ln a lies within +-200 for weights below 2^63, so 33 bits hold it in steps of 2^-24
    level = F.floor((log_a + 200.0) * float(1 << 23)).cast("long")
    name = F.pmod(F.xxhash64(term, t), F.lit(1 << 31))
    return F.shiftleft(level, 31).bitwiseOR(name)


def fingerprint(rows: DataFrame, keys: list[str], term: Column, weight: Column, samples: int = SAMPLES) -> DataFrame:
    """keys and the array fingerprint, from one row per text and distinct term (weight null: no term)."""
    lined = rows.select(*keys, term.alias("_term"), F.log(weight.cast("double")).alias("_weight"))
    mins = [F.min(F.when(F.col("_weight").isNotNull(), sample_key(F.col("_term"), F.col("_weight"), s))).alias(f"_s{s}")
            for s in range(samples)]
    low = [F.coalesce(F.col(f"_s{s}").bitwiseAND(F.lit((1 << 31) - 1)), F.lit(-1).cast("long")) for s in range(samples)]
    return lined.groupBy(*keys).agg(*mins).select(*keys, F.array(*low).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of samples on which two fingerprints agree: an estimate of the generalised Jaccard similarity.

    Two texts without words are alike (1), one of them and any other are not (0).
    """
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x) / F.size(a)


def as_text(fingerprint: Column) -> Column:
    """Eight hex digits per sample."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def of_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and fingerprint (array<long>) of every row; equal texts have equal ones, no words all -1."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    listed = with_terms(rows, F.col("text"), "terms").select("row", "doc_id", F.explode_outer("terms").alias("t"))
    return fingerprint(listed, ["row", "doc_id"], F.col("t.term"), F.col("t.weight"), samples).drop("row")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text, the text of the next row by descending doc_id (after the last: the first).

    Ties are ordered by text, null ids come last. Rows are cut into ranges of doc_id of about ORDERED
    characters, CUTS by quantiles and each of those in equal widths, SPLITS at most; each range is
    ordered by itself and also holds the first row of the next one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    seen = rows.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0)).alias("chars"), F.min("doc_id").alias("lo"),
                    F.max("doc_id").alias("hi")).first()
    n = blocks_for(seen.chars, ORDERED)
    wide, deep = min(n, CUTS), min(SPLITS, blocks_for(n, CUTS))
    cuts: list[int] = []
    if wide > 1 and seen.lo is not None:
        cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", [i / wide for i in range(1, wide)])).first()[0]))
    # range i holds ids from ends[i]; ranges are numbered downwards, as the order is
    ends = [seen.lo or 0, *cuts, (seen.hi or 0) + 1]
    ends = [e for i, e in enumerate(ends) if i == 0 or e > ends[i - 1]]
    long_array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    steps = [max(1, -(-(b - a) // deep)) for a, b in zip(ends, ends[1:])]
    at = F.aggregate(long_array(ends[1:-1]), F.lit(0), lambda k, c: k + (c <= F.col("doc_id")).cast("int"))
    rows = rows.withColumn("range", at)
    inner = F.floor((F.col("doc_id") - F.get(long_array(ends), F.col("range"))) / F.get(long_array(steps), F.col("range")))
    last = len(steps) * deep
    rows = rows.select("doc_id", "text", F.coalesce(F.lit(last) - (F.col("range") * deep + inner), F.lit(last + 1)).cast("int").alias("part"))
    firsts = {r.part: r.top for r in rows.groupBy("part").agg(F.max("doc_id").alias("top")).collect()}
    full = sorted(firsts)
    if not full:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    # a row for each range, CUTS * SPLITS at most
    tops = F.broadcast(docs.sparkSession.createDataFrame(
        [(p, firsts[p], full[i - 1]) for i, p in enumerate(full)], "part int, top long, guest_of int"))
    guests = rows.join(tops, "part").where(F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("guest_of").agg(
        F.first("doc_id").alias("doc_id"), F.min("text").alias("text")).select(
        "doc_id", "text", F.col("guest_of").alias("part"), F.lit(True).alias("guest"))
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests)
    nearby = Window.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    return both.withColumn("next_text", F.lead("text").over(nearby)).where(~F.col("guest")).select("doc_id", "text", "next_text")


def edited(text: Column, other: Column) -> Column:
    """text with its last floor(n/2) code points replaced by the first as many (or all) of other."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(other, F.lit(1), half))


def edit_report(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, and how near they and the next one's are.

    A null text is empty. An empty table gives no rows; a single row is its own next.
    """
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text"))).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.sha2(F.col("next_text").cast("binary"), 256).alias("next_sha"), "text", "edited")
    keys = ["row", "doc_id", "n_chars", "sha", "edited_sha256", "next_sha", "is_edited"]
    both = rows.select("*", F.explode(F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text").alias("body")),
                                              F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("body")))).alias("e"))
    listed = with_terms(both.select(*keys[:-1], "e.is_edited", "e.body"), F.col("body"), "terms").select(
        *keys, F.explode_outer("terms").alias("t"))
    prints = written(fingerprint(listed, keys, F.col("t.term"), F.col("t.weight"), samples), "fingerprints")
    own = prints.where("NOT is_edited")
    changed = prints.where("is_edited").select("row", F.col("fingerprint").alias("edited_fingerprint"))
    known = own.groupBy(F.col("sha").alias("next_sha")).agg(F.first("fingerprint").alias("next_fingerprint"))
    met = own.join(changed, "row").join(known, "next_sha")
    return met.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fingerprint")).alias("fingerprint"),
                      as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"),
                      likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                      likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))

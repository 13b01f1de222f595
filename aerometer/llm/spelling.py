"""Spelling variants by blocked Gram matrices of letter counts.

Words that differ by one code point have letter-count vectors at a squared distance of one (adjacent
lengths) or two (equal lengths). Words are dealt into cells by how many letters of each of a few
letter classes they have, which fixes the length too; near words lie in one cell, in two that differ
by one letter moved between classes, or in two of adjacent lengths. Cells are cut into blocks of
bounded size. For each pair of blocks one matrix product gives all squared distances; pairs at most
two apart are verified letter by letter, and only these leave the task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerometer.llm.common import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: A run whose hash this divides loses a code point.
DAMAGE = 199
#: Words are at least so long and occur at least so often.
LENGTH, TIMES = 6, 5
#: A form occurs at least so many times as often as the word.
RATIO = 5
#: Letter classes that cells are counted in, and words of a block, about.
CLASSES, BLOCK = 5, 2000
#: Distinct words that a counting task holds at a time.
HELD = 100_000


def damaged(run: str, doc_id: str) -> str:
    """A lower-cased run, without one code point where its hash says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode("utf-8", "surrogatepass"))
    if h % DAMAGE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def runs_of(text: str) -> Counter:
    """How often each lower-cased run (A-Z only) occurs in a text."""
    return Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))


def word_counts(docs: DataFrame, length: int = LENGTH, times: int = TIMES) -> DataFrame:
    """(word, n) of all words of docs (doc_id, text) with at least so many code points and occurrences.

    A null text has no words; a null doc_id is written as nothing before the colon of the hash.
    """
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter = Counter()
        flush = lambda: pd.DataFrame({"word": pd.Series(list(found), dtype=object), "n": list(found.values())})
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                for run, n in runs_of(text).items():
                    if len(run) >= length and len(word := damaged(run, doc_id)) >= length:
                        found[word] += n
                if len(found) > HELD:
                    yield flush()
                    found.clear()
        yield flush()

    rows = docs.where("text IS NOT NULL").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def letters(text: str, length: int) -> np.ndarray:
    """The code points of words of one length, written one after the other, a row for each word."""
    return np.frombuffer(text.encode("latin-1"), np.uint8).reshape(-1, length)


def cell(word: str) -> str:
    """How many letters of each class a word has."""
    return ",".join(map(str, np.bincount(np.frombuffer(word.encode("latin-1"), np.uint8) % CLASSES, minlength=CLASSES)))


def partners(key: str) -> list[str]:
    """The cell itself and those that hold near words, each pair of cells from one side only: a letter moved
    from a later class to an earlier one, or a letter more."""
    counts = list(map(int, key.split(",")))

    def moved(*steps: tuple[int, int]) -> str:
        new = list(counts)
        for i, by in steps:
            new[i] += by
        return ",".join(map(str, new))

    same = [moved((i, 1), (j, -1)) for i in range(CLASSES) for j in range(i + 1, CLASSES) if counts[j]]
    return [key, *same, *(moved((i, 1)) for i in range(CLASSES))]


def gram(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the rows of a and b whose letter counts are at a squared distance of two or less."""
    used = np.unique(np.concatenate([np.unique(a), np.unique(b)]))
    column = np.zeros(256, np.intp)
    column[used] = np.arange(len(used))

    def counts(x: np.ndarray) -> np.ndarray:
        places = column[x] + np.arange(len(x))[:, None] * len(used)
        return np.bincount(places.ravel(), minlength=len(x) * len(used)).reshape(len(x), -1).astype(np.float32)

    ca, cb = counts(a), counts(b)
    half = lambda c: -(c * c).sum(axis=1, keepdims=True) / 2
    one = lambda c: np.ones((len(c), 1), np.float32)
    # minus half the squared distance
    return np.nonzero(np.hstack([ca, half(ca), one(ca)]) @ np.hstack([cb, one(cb), half(cb)]).T >= -1)


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each word of a becomes the word of b in its row by one replaced or one inserted code point."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    begins = np.cumprod(a == b[:, :-1], axis=1).sum(axis=1)
    ends = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return begins + ends >= a.shape[1]


def _cells(words: Column) -> Column:
    @F.pandas_udf("string")
    def of(series: pd.Series) -> pd.Series:
        return series.map(cell)

    return of(words)


def _partners(keys: Column) -> Column:
    @F.pandas_udf("array<string>")
    def of(series: pd.Series) -> pd.Series:
        return series.map(partners)

    return of(keys)


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Both directions of every near pair of a pair of blocks."""
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            a, b = letters(r.words, r.length), letters(r.words2, r.length2)
            i, j = gram(a, b)
            if r.same:
                i, j = i[i < j], j[i < j]
            true = near(a[i], b[j])
            i, j = i[true], j[true]
            if not len(i):
                continue
            wa = [r.words[k * r.length:(k + 1) * r.length] for k in i]
            wb = [r.words2[k * r.length2:(k + 1) * r.length2] for k in j]
            yield pd.DataFrame({"word": pd.Series(wa + wb, dtype=object), "other": pd.Series(wb + wa, dtype=object),
                                "other_n": np.concatenate([np.asarray(r.ns2)[j], np.asarray(r.ns)[i]])})


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, other_n) for every ordered pair of words (word, n) that differ by one code point."""
    celled = words.withColumn("key", _cells(F.col("word")))
    sizes = written(celled.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), "spelling-cells")
    blocks = written(
        celled.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
        .groupBy("key", "part").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("w"))
        .select("key", "part", F.length(F.col("w")[0]["word"]).alias("length"), F.array_join("w.word", "").alias("words"),
                F.col("w.n").alias("ns")), "spelling-blocks")
    wanted = (blocks.withColumn("key2", F.explode(_partners(F.col("key"))))
              .join(sizes.select(F.col("key").alias("key2"), "parts"), "key2")
              .withColumn("part2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .where("key <> key2 OR part <= part2"))
    pairs = wanted.join(blocks.select(*(F.col(c).alias(c + "2") for c in blocks.columns)), ["key2", "part2"]).select(
        "length", "words", "ns", "length2", "words2", "ns2", ((F.col("key") == F.col("key2")) & (F.col("part") == F.col("part2"))).alias("same"))
    return pairs.mapInPandas(_compared, "word string, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form), root being the last of the chain of forms that begins with word.

    Chains are halved with every round, each a written table; a form is RATIO times as frequent as its
    word, so a chain has few steps and the rounds are fewer still.
    """
    steps = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        after = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = written(steps.join(after, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not steps.where("moved").limit(1).count():
            return steps.select("word", "root")
        steps = steps.drop("moved")


def variants(docs: DataFrame, length: int = LENGTH, times: int = TIMES, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of docs (doc_id, text).

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. form is
    the near word of largest n, of equal ones the first in code-point order, if that is at least
    ratio times the word's n, else null; root is the last of the forms that follow, the word itself
    without one. Null and empty texts have no words; repeated rows count as often as they occur; texts
    of any length are read whole; an empty table, or one without frequent words, gives no rows.
    """
    words = written(word_counts(docs, length, times), "spelling-words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("first"))
    enough = -F.col("first.less") >= ratio * F.col("n")
    judged = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("first.other")).alias("form"),
        F.when(enough, -F.col("first.less")).alias("form_n")), "spelling-forms")
    last = roots(judged.where("form IS NOT NULL"))
    return judged.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))

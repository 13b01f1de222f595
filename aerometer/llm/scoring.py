"""Language-model scoring by prediction by partial matching (PPM) over bytes.

The model is a trie of byte contexts up to a fixed order. A symbol is coded in the longest context
that has seen it; on the way down every context that has not pays its escape (method C: distinct
symbols over occurrences plus distinct symbols), and symbols that a longer context has seen are
excluded from the shorter ones. As shorter contexts see all that longer ones see, what is excluded
at one depth is exactly what the child has seen.

Pretrained scores are computed on Spark: the trie is one table of counts per depth, keyed by packed
symbols. Documents are read in blocks; each block gathers its distinct grams and words, the tables
give each distinct gram its code length once, and every block gets back the values of its own grams
and words only. So no table is broadcast, and memory is that of a block whatever the corpus holds.
`adaptive_scores` learns along each document instead.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerometer.llm.common import blocks_for, text_of, written

#: Bytes of context.
ORDER = 4
#: Bits of a symbol: bytes, and 256 for the end of a text and what lies before its start.
BITS, EDGE = 9, 256
#: Bytes of text of a block, about, and of what is turned into grams at a time.
BLOCK, CHUNK = 1 << 25, 1 << 21
GRAM, WORD = 0, 1
_GATHERED = "block long, kind int, key long, n long"
_SCORED = "doc_id long, held_out boolean, n_words long, n_known long, logs double, score double, new_words long"


class PpmTrie:
    """The model itself, small: a dictionary of symbol counts for each context."""

    def __init__(self, order: int = ORDER):
        self.order, self.seen = order, {}

    def learn(self, context: tuple, symbol: int) -> None:
        for j in range(self.order + 1):
            counts = self.seen.setdefault(context[len(context) - j:], {})
            counts[symbol] = counts.get(symbol, 0) + 1

    def cost(self, context: tuple, symbol: int) -> float:
        """log10 probability of a symbol."""
        total, excluded = 0.0, {}
        for j in range(self.order, -1, -1):
            counts = self.seen.get(context[len(context) - j:])
            if not counts:
                continue
            left = {s: c for s, c in counts.items() if s not in excluded}
            n, d = sum(left.values()), len(left)
            if symbol in left:
                return total + math.log10(left[symbol] / (n + d))
            if d:
                total += math.log10(d / (n + d))
            excluded = counts
        return total - math.log10(EDGE + 1 - len(excluded))

    def walk(self, data: bytes, adapt: bool) -> float:
        """log10 probability of a text and its end, learning on the way if asked."""
        context, total = (EDGE,) * self.order, 0.0
        for symbol in (*data, EDGE):
            total += self.cost(context, symbol)
            if adapt:
                self.learn(context, symbol)
            context = (*context, symbol)[1:] if self.order else ()
        return total


def adaptive_scores(docs: DataFrame, order: int = 3) -> DataFrame:
    """doc_id and score of every row, each document coded by a model that starts empty and learns along it.

    The trie of a document grows with its distinct contexts alone; null texts are empty.
    """
    @F.pandas_udf("double")
    def cost(texts: pd.Series) -> pd.Series:
        return pd.Series([PpmTrie(order).walk(t.encode().lower(), True) for t in texts], dtype="float64")

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), cost(text_of()).alias("score"))


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed (order + 1)-grams that end at each symbol of the texts and their ends; where each text begins."""
    gap = b"\0" * order
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    starts = np.cumsum(sizes + order) - sizes - order
    symbols = np.frombuffer(b"".join(x for t in texts for x in (gap, t, b"\0")), np.uint8).astype(np.int64)
    pads = (starts[:, None] + np.arange(order)).ravel()
    symbols[pads] = EDGE
    symbols[starts + order + sizes - 1] = EDGE
    packed = symbols.copy()
    for i in range(1, order + 1):
        packed[i:] |= symbols[:-i] << (BITS * i)
    real = np.ones(len(symbols), bool)
    real[pads] = False
    return packed[real], np.cumsum(sizes) - sizes


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes; a longer text is a range of its own."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, back = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(back, np.concatenate(counts), len(found)).astype(np.int64)


class Gatherer:
    """Distinct grams and words of one block with their counts in training documents."""

    def __init__(self, order: int):
        self.order, self.words, self.other = order, Counter(), set()
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, texts: list[bytes], trained: bool) -> None:
        for t in texts:
            (self.words if trained else self.other).update(t.split())
        for a, b in chunks(texts):
            found, n = np.unique(grams(texts[a:b], self.order)[0], return_counts=True)
            self.keys.append(found)
            self.counts.append(n if trained else np.zeros(len(found), np.int64))
        if len(self.keys) > 8:
            k, n = _merged(self.keys, self.counts)
            self.keys, self.counts = [k], [n]

    def rows(self, block: int) -> Iterator[pd.DataFrame]:
        if self.keys:
            k, n = _merged(self.keys, self.counts)
            yield pd.DataFrame({"block": block, "kind": GRAM, "key": k, "n": n})
        names = [*self.words, *(w for w in self.other if w not in self.words)]
        if names:
            key = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names)).view(np.int64)
            n = np.fromiter((self.words.get(w, 0) for w in names), np.int64, len(names))
            yield pd.DataFrame({"block": block, "kind": WORD, "key": key, "n": n})


class Lookup:
    """Values by 64-bit key, found for whole arrays at a time (open addressing)."""

    FREE = np.int64(-1)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.table = np.full(1 << self.bits, self.FREE)
        self.values = np.zeros(1 << self.bits)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.table[at] == self.FREE
            self.table[at[free]] = keys[left[free]]
            won = self.table[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            at, left = (at[~won] + 1) & ((1 << self.bits) - 1), left[~won]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        left = np.flatnonzero(self.table[at] != keys)
        while len(left):
            if (self.table[at[left]] == self.FREE).any():
                raise LookupError("a document holds what its block did not gather: its rows moved between two reads")
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            left = left[self.table[at[left]] != keys[left]]
        return self.values[at]


def _gather(order: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks: dict[int, Gatherer] = {}
        for pdf in batches:
            for (block, held), rows in pdf.groupby(["block", "held_out"]):
                blocks.setdefault(block, Gatherer(order)).add([t.encode().lower() for t in rows.text], not held)
        for block, gatherer in blocks.items():
            yield from gatherer.rows(block)

    return run


def _score(order: int):
    def run(key: tuple, docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            raise LookupError("a block lost its documents: its rows moved between two reads")
        is_gram = known.kind.to_numpy() == GRAM
        keys, values = known.key.to_numpy(), known.value.to_numpy()
        codes = Lookup(keys[is_gram], values[is_gram])
        by_hash = dict(zip(keys[~is_gram].tolist(), values[~is_gram].tolist()))
        mask = (1 << 64) - 1
        logs: dict[bytes, float] = {}
        texts = [t.encode().lower() for t in docs.text]
        out = []
        for t in texts:
            found = t.split()
            for w in set(found):
                if w not in logs:
                    h = xxhash.xxh64_intdigest(w) & mask
                    logs[w] = math.log10(by_hash[h - (1 << 64) if h >> 63 else h] + 1.0)
            got = np.fromiter(map(logs.__getitem__, found), float, len(found))
            out.append((len(found), int(np.count_nonzero(got)), float(got.sum())))
        score = np.zeros(len(texts))
        for a, b in chunks(texts):
            packed, starts = grams(texts[a:b], order)
            score[a:b] = np.add.reduceat(codes(packed), starts)
        rows = pd.DataFrame(out, columns=["n_words", "n_known", "logs"])
        rows.insert(0, "doc_id", docs.doc_id.to_numpy())
        rows.insert(1, "held_out", docs.held_out.to_numpy())
        rows["score"], rows["new_words"] = score, 0
        # words that no earlier block counted, added up over all blocks, are the vocabulary
        rows.loc[0, "new_words"] = int(known.is_new[~is_gram].sum())
        return rows

    return run


def code_lengths(counts: DataFrame, order: int) -> DataFrame:
    """(key, value): log10 probability of the last symbol of every gram of counts (key, n), n its training count.

    Grams with n = 0 are scored, not learned.
    """
    mask = lambda j: (1 << (BITS * (j + 1))) - 1  # noqa: E731  the last j + 1 symbols
    counts = written(counts, "ppm-grams")
    level = counts.where("n > 0").select(F.col("key").alias("g"), F.col("n").alias("c"))
    tables, contexts = {order: written(level, "ppm-counts")}, {}
    for j in range(order - 1, -1, -1):
        tables[j] = written(tables[j + 1].groupBy(F.col("g").bitwiseAND(F.lit(mask(j))).alias("g")).agg(F.sum("c").alias("c")), "ppm-counts")
    # of each context: occurrences, distinct symbols, and how often its shorter context saw those symbols
    for j in range(order, -1, -1):
        rows = tables[j].withColumn("x", F.lit(0).cast("long"))
        if j:
            shorter = tables[j - 1].select(F.col("g").alias("tail"), F.col("c").alias("x"))
            rows = tables[j].withColumn("tail", F.col("g").bitwiseAND(F.lit(mask(j - 1)))).join(shorter, "tail")
        contexts[j] = written(rows.groupBy(F.shiftright("g", BITS).alias("ctx")).agg(
            F.sum("c").alias("n"), F.count("*").alias("d"), F.sum("x").alias("x")), "ppm-contexts")
    top = contexts[order].select("ctx", F.col("n").alias("total"), "d")
    known = tables[order].withColumn("ctx", F.shiftright("g", BITS)).join(top, "ctx").select(
        F.col("g").alias("key"), F.log10(F.col("c") / (F.col("total") + F.col("d"))).alias("value"))

    new = counts.where("n = 0").select("key")
    for j in range(order, -1, -1):
        c = contexts[j].select(F.col("ctx").alias("ctx_"), *[F.col(x).alias(f"{x}{j}") for x in "ndx"])
        t = tables[j].select(F.col("g").alias("g_"), F.col("c").alias(f"c{j}"))
        new = new.join(c, F.shiftright(F.col("key").bitwiseAND(F.lit(mask(j))), BITS) == F.col("ctx_"), "left").drop("ctx_")
        new = new.join(t, F.col("key").bitwiseAND(F.lit(mask(j))) == F.col("g_"), "left").drop("g_")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    value = -F.log10(F.lit(EDGE + 1.0) - zero("d0"))
    for j in range(order + 1):
        n, d = zero(f"n{j}"), zero(f"d{j}")
        if j < order:
            n, d = n - zero(f"x{j + 1}"), d - zero(f"d{j + 1}")
        escape = F.when(d > 0, F.log10(d / (n + d))).otherwise(F.lit(0.0))
        value = F.when(F.col(f"c{j}").isNotNull(), F.log10(F.col(f"c{j}") / (n + d))).otherwise(escape + value)
    return known.unionByName(new.select("key", value.alias("value")))


def scores(docs: DataFrame, held_out: Column, order: int = ORDER) -> DataFrame:
    """Every row of docs scored by a model of the rows that are not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (unigrams of words with one
    added) and score (PPM), both log10. Texts are lower-cased in A-Z; null is empty; words and an end
    are tokens. Repeated rows are learned and scored as often as they occur; a null held_out is false;
    an empty table gives no rows; without training rows every symbol costs log10 257.

    Blocks are the partitions docs is read in, cut by id where those are large, so docs has to be a
    stored table or anything else that gives the same partitions twice; if not, scoring stops.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"), F.spark_partition_id().cast("long").alias("part"))
    largest = rows.groupBy("part").agg(F.sum(F.octet_length("text")).alias("n")).agg(F.max("n")).first()[0] or 0
    cuts = blocks_for(largest, 2 * BLOCK)
    rows = rows.withColumn("block", F.col("part") * cuts + F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(cuts))).drop("part")
    gathered = written(rows.mapInPandas(_gather(order), _GATHERED), "ppm-gathered")
    counts = gathered.where(F.col("kind") == GRAM).groupBy("key").agg(F.sum("n").alias("n"))
    values = code_lengths(counts, order)
    codes = gathered.where(F.col("kind") == GRAM).select("block", "kind", "key").join(values, "key").select(
        "block", "kind", "key", "value", F.lit(False).alias("is_new"))
    same = Window.partitionBy("key")
    total = F.sum("n").over(same)
    words = gathered.where(F.col("kind") == WORD).select(
        "block", "kind", "key", total.cast("double").alias("value"),
        ((total > 0) & (F.row_number().over(same.orderBy("block")) == 1)).alias("is_new"))
    known = codes.unionByName(words)
    scored = written(rows.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(_score(order), _SCORED), "ppm-scored")
    s = scored.agg(F.coalesce(F.sum("new_words"), F.lit(0)).alias("v"), F.count_if(~F.col("held_out")).alias("ends"),
                   F.coalesce(F.sum(F.when(~F.col("held_out"), F.col("n_words") + 1)), F.lit(0)).alias("n")).first()
    vocabulary = s.v + (s.ends > 0)
    size = math.log10(s.n + vocabulary + 1)
    return scored.select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"), (F.col("n_known") + F.lit(int(s.ends > 0))).alias("n_known"),
        F.lit(s.n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.lit(math.log10(s.ends + 1)) - (F.col("n_words") + 1) * F.lit(size)).alias("base_score"), "score")

"""Toxicity by gradient-boosted trees over dense text features, with isotonic calibration.

The labelled training rows are dealt into folds, class by class, equal texts together. A row's
features use the lexicon (words and word beginnings that mark the positive class) of the other folds,
and the calibration is fitted on scores that trees of the other folds give, so no row is judged by what
it taught and all rows serve both. The lexicon and trees that score documents come from all rows.
Scoring is one pass over the documents: the features are an Arrow batch function of the text, trees
and calibration are JVM transforms.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerometer.llm.common import free_names, text_of, written

#: Words of abuse that need no training rows.
ABUSE = frozenset("""idiot moron loser pathetic scum worthless trash clown disgusting stupid dumb imbecile fool
    garbage filth filthy vermin pig ugly hate shut bastard jerk creep freak coward liar lunatic""".split())
#: Second person in the languages of the corpus.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine sie ihr tu te toi ton ta vous votre usted ustedes tus ti".split())
#: Signs read as letters inside a word; a one is read either way.
SIGNS = tuple(str.maketrans("013457@$!", letters) for letters in ("oieastasi", "oleastasi"))
#: Words between a lexicon word and a second person that count as near.
NEAR = 5
#: Lengths of word beginnings that the lexicon may hold.
STEMS = (4, 5, 6, 7, 8, 9)
#: Terms of the learned lexicon at most, by weight.
LEXICON = 2000
#: Labelled rows used for training, about; a uniform share by hash where there are more.
TRAIN_ROWS = 20_000
TOXIC_DF, LOG_ODDS = 3, 3.0
#: Terms that a worker holds at a time, about.
HELD_TERMS = 50_000
#: Folds of the training rows, depth of the trees, rows of a leaf at least, parts of the feature table.
FOLDS, DEPTH, LEAF, PARTS = 3, 4, 2, 6

FEATURES = ("abuse_rate", "abuse_any", "abuse_log", "learned_rate", "learned_any", "learned_log", "stem_rate", "stem_log",
            "near_you", "you_rate", "capitals", "shouted", "exclaims", "punctuation", "symbols", "masked_rate",
            "masked_hits", "repeats", "spelled_out", "mean_word", "log_words")

_WORD = re.compile(r"[^\W_]+(?:[*@$!'’-][^\W_]+)*[@$]?")
_SPELLED = re.compile(r"(?<![^\W_])(?:[^\W_][ .*_-]){2,}[^\W_](?![^\W_])")
_REPEATED = re.compile(r"([^\W\d_])\1{2,}")
_MASKED = re.compile(r"[0-9*@$!]+[^\W\d_]")
_SHOUTED = re.compile(r"\b[A-Z]{3,}\b")
_GAPS = re.compile(r"[ .*_-]")
_NO_LETTER = re.compile(r"[^a-zß-ÿ]")
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def readings(word: str) -> set[str]:
    """A word with masked letters read: signs as letters, marks dropped, long runs of a letter shortened to one."""
    return {_REPEATED.sub(r"\1", _NO_LETTER.sub("", word.translate(signs))) for signs in SIGNS}


def terms(text: str) -> set[str]:
    """Distinct words (=word) and word beginnings (word~) that a lexicon may hold."""
    words = set(_WORD.findall(text.lower()))
    return {"=" + w for w in words} | {w[:n] + "~" for w in words for n in STEMS if len(w) >= n}


def features(text: str, learned: frozenset[str], stems: frozenset[str], heads: frozenset[str]) -> list[float]:
    """The values of FEATURES; all zero for a text without words. heads: the shortest beginnings of stems."""
    low = text.lower()
    words = _WORD.findall(low)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(words)
    of = lambda found: sum(counts[w] for w in found)
    mask = [w for w in counts if _MASKED.search(w)] if _MASKED.search(low) else []
    drawn = [w for w in counts if _REPEATED.search(w)] if _REPEATED.search(low) else []
    reads = {w: readings(w) for w in (*mask, *drawn)}
    abusive = {w for w in reads if reads[w] & ABUSE} | (counts.keys() & ABUSE)
    known = {w for w in reads if reads[w] & learned} | (counts.keys() & learned)
    started = {w for w in counts if w[:STEMS[0]] in heads and any(w[:k] in stems for k in STEMS)}
    hits, at_whom = abusive | known | started, counts.keys() & YOU
    near = 0
    if hits and at_whom:
        last = -NEAR - 1
        pending: list[int] = []
        for i, w in enumerate(words):
            if w in at_whom:
                near += sum(i - p <= NEAR for p in pending)
                last, pending = i, []
            elif w in hits:
                if i - last <= NEAR:
                    near += 1
                else:
                    pending.append(i)
    spelled = _SPELLED.findall(text)
    spelled_hits = sum(bool(readings(_GAPS.sub("", m.lower())) & ABUSE) for m in spelled)
    chars, data = len(text), text.encode("utf-8", "replace")
    signs = lambda which: len(data) - len(data.translate(None, which))
    abuse, learn, stem, masked = of(abusive) + spelled_hits, of(known), of(started), of(mask)
    return [abuse / n, float(abuse > 0), math.log1p(abuse), learn / n, float(learn > 0), math.log1p(learn), stem / n,
            math.log1p(stem), near / n, of(at_whom) / n, signs(_CAPITALS) / chars, len(_SHOUTED.findall(text)) / n,
            data.count(b"!") / n, signs(b".,;:?!") / chars, signs(b"@#$%&*|~^<>") / chars, masked / n,
            float(of(w for w in mask if w in abusive or w in known) + spelled_hits),
            of(drawn) / n, len(spelled) / n, sum(map(len, words)) / n, math.log1p(n)]


def feature_column(text: Column, lexicons: list[tuple[list[str], list[str]]], which: Column | None = None) -> Column:
    """FEATURES of a text by the lexicon (words, word beginnings) that which numbers, the only one without it."""
    kept = [(frozenset(words), frozenset(stems), frozenset(x[:STEMS[0]] for x in stems)) for words, stems in lexicons]

    @F.pandas_udf("array<double>")
    def dense(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        return pd.Series([features(t, *kept[k]) for t, k in zip(texts, numbers)])

    return array_to_vector(dense(text, which if which is not None else F.lit(0)))


def term_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """toxic, fold and term of rows (text, toxic, fold), about HELD_TERMS at a time."""
    for pdf in batches:
        out, size = [], 0
        for text, toxic, fold in zip(pdf.text, pdf.toxic, pdf.fold):
            out.append(pd.DataFrame({"toxic": toxic, "fold": fold, "term": list(terms(text))}))
            size += len(out[-1])
            if size > HELD_TERMS:
                yield pd.concat(out)
                out, size = [], 0
        if out:
            yield pd.concat(out)


def learn_lexicons(rows: DataFrame) -> list[tuple[list[str], list[str]]]:
    """Words and word beginnings of rows (text, toxic, fold) that mark the positive class, heaviest first: for each
    fold those of the other folds, and last those of all.

    A term needs TOXIC_DF positive rows and smoothed log odds of LOG_ODDS; LEXICON terms at most.
    """
    def counts() -> dict[str, Column]:
        of = lambda k: F.when((F.col("fold") != k) if k < FOLDS else F.lit(True), 1)
        return {f"{c}{k}": F.count(F.when(F.col("toxic") == v, of(k))) for k in range(FOLDS + 1) for c, v in (("t", 1), ("c", 0))}

    totals = rows.agg(*(v.alias(k) for k, v in counts().items())).first()
    found = written(rows.select("text", "toxic", "fold").mapInPandas(term_rows, "toxic int, fold int, term string").groupBy("term").agg(
        *(v.alias(k) for k, v in counts().items())).where(F.col(f"t{FOLDS}") >= TOXIC_DF), "toxic-terms")
    out = []
    for k in range(FOLDS + 1):
        t, c = F.col(f"t{k}"), F.col(f"c{k}")
        odds = F.log((t + 0.5) / (totals[f"t{k}"] + 1.0)) - F.log((c + 0.5) / (totals[f"c{k}"] + 1.0))
        best = (found.where(t >= TOXIC_DF).withColumn("odds", odds).where(F.col("odds") >= LOG_ODDS)
                .orderBy(F.desc(F.col("odds") * F.sqrt(t)), "term").limit(LEXICON).collect())
        out.append(([r.term[1:] for r in best if r.term[0] == "="], [r.term[:-1] for r in best if r.term[0] != "="]))
    return out


@dataclass
class ToxicityModel:
    """What training gave; trees are None where a class had fewer rows than there are folds."""

    words: list[str]
    stems: list[str]
    trees: GBTClassificationModel | None
    steps: list[tuple[float, float]]
    rate: float

    def scored(self, docs: DataFrame, out: str, text: Column) -> DataFrame:
        """docs with the score (0 to 1) in column out, a name that docs lacks; no shuffle."""
        if self.trees is None:
            return docs.withColumn(out, F.lit(self.rate))
        vec, raw, prob, pred = free_names(docs, *(out + x for x in ("_vec", "_raw", "_prob", "_pred")))
        trees = self.trees.copy().setFeaturesCol(vec).setRawPredictionCol(raw).setProbabilityCol(prob).setPredictionCol(pred)
        df = trees.transform(docs.withColumn(vec, feature_column(text, [(self.words, self.stems)])))
        return df.withColumn(out, self.calibrated(vector_to_array(prob)[1])).drop(vec, raw, prob, pred)

    def calibrated(self, p: Column) -> Column:
        """The isotonic step function, linear between its points, flat outside them."""
        points = self.steps
        case = F.when(p <= points[0][0], F.lit(points[0][1]))
        for (x0, y0), (x1, y1) in zip(points, points[1:]):
            case = case.when(p <= x1, F.lit(y0) + (p - x0) * ((y1 - y0) / (x1 - x0) if x1 > x0 else 0.0))
        return case.otherwise(F.lit(points[-1][1]))


def training_rows(docs: DataFrame, labels: DataFrame, held_out: Column | None, seed: int) -> DataFrame:
    """text, toxic and fold of the rows to learn from, written: TRAIN_ROWS at most, about."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id IS NOT NULL AND toxic IS NOT NULL")
    ids = ids.where(~held_out) if held_out is not None else ids
    n = ids.count()
    if n > TRAIN_ROWS:
        ids = ids.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < int((1 << 20) * TRAIN_ROWS / n))
    # ids is bounded by TRAIN_ROWS, so it may be broadcast and the texts stay where they are
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = written(texts.join(F.broadcast(ids), "doc_id").select("text", "toxic", F.xxhash64("text", F.lit(seed)).alias("deal")), "toxic-rows")
    folds = rows.groupBy("toxic", "deal").agg(F.count("*").alias("n")).select("toxic", "deal", F.pmod(
        F.row_number().over(Window.partitionBy("toxic").orderBy("deal")), F.lit(FOLDS)).alias("fold"))
    return written(rows.join(F.broadcast(folds), ["toxic", "deal"]).select("text", "toxic", "fold"), "toxic-train")


def fit(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, seed: int = 7) -> ToxicityModel:
    """A model from labels (doc_id, toxic) of the rows of docs (doc_id, text).

    held_out names rows never learned from. Rows with a null id or label and ids that are not in docs are
    left out; repeated rows count as often as they occur. At most about TRAIN_ROWS rows. Where a class has
    no row in some fold (always with fewer than FOLDS different texts) there is nothing to hold trees
    against: every text then scores the share of positive rows, zero without rows.
    """
    rows = training_rows(docs, labels, held_out, seed)
    seen = rows.groupBy("toxic", "fold").count().collect()
    total = sum(r["count"] for r in seen)
    rate = sum(r["count"] for r in seen if r.toxic) / total if total else 0.0
    if len(seen) < 2 * FOLDS:
        return ToxicityModel([], [], None, [], rate)
    lexicons = learn_lexicons(rows)
    taught = written(rows.repartition(PARTS, "text").select(
        "fold", F.col("toxic").cast("double").alias("label"),
        feature_column(F.col("text"), lexicons, F.col("fold")).alias("features")), "toxic-features").cache()
    learner = GBTClassifier(maxIter=15, maxDepth=DEPTH, stepSize=0.3, maxBins=64, seed=seed, subsamplingRate=1.0,
                            minInstancesPerNode=LEAF, cacheNodeIds=False)
    trees = learner.fit(taught)
    judged = [learner.fit(taught.where(F.col("fold") != k)).transform(taught.where(F.col("fold") == k)) for k in range(FOLDS)]
    scores = reduce(DataFrame.union, (j.select("label", vector_to_array("probability")[1].alias("p")) for j in judged))
    iso = IsotonicRegression(featuresCol="p", labelCol="label").fit(written(scores, "toxic-scores"))
    # the largest score seen of class 1 stays below 1, the smallest of class 0 above 0
    steps = [(float(x), min(max(float(y), 0.001), 0.999)) for x, y in zip(iso.boundaries, iso.predictions)]
    taught.unpersist()
    return ToxicityModel(*lexicons[FOLDS], trees, steps, rate)


def score(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs.

    A null text is empty, scored like any text without words; texts of any length are read whole; ids may
    be null (held_out false) or repeated; further columns are not read; an empty table gives no rows; with
    too few training rows every score is the share of positive ones, without any 0 (see fit).
    """
    model = fit(docs, labels, held_out)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return model.scored(rows, "score", F.col("text")).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("score").cast("double").alias("score"),
        (F.col("score") >= 0.5).cast("int").alias("predicted"))

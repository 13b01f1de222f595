"""A forecaster with one input branch per feature group and embedded categories, trained where the rows are.

Each branch is a dense layer over its own scaled features, each category an embedding; joined, they
feed one more dense layer and the output, the log of the target. In a round every task goes through
its rows in mini-batches from the shared weights; the weights that tasks end with are averaged, by
their rows, as one aggregation on Spark. Rounds end when the validation error has not fallen for a while.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometer.operators.models import SEED, assembler

#: Mini-batch, passes over each block of rows, step size and its decay per round, and the decays of Adam's running means.
BATCH, PASSES, RATE, FADE, BETA1, BETA2 = 64, 4, 0.01, 0.95, 0.9, 0.999


@dataclass
class Network:
    """The shape of the net; weights are one flat vector."""

    branches: tuple[int, ...]
    categories: tuple[int, ...]
    hidden: int = 12
    embedded: int = 3
    top: int = 24
    parts: list[tuple[str, tuple[int, ...], int]] = field(init=False)
    size: int = field(init=False)
    places: list[tuple[str, tuple[int, ...], slice]] = field(init=False, repr=False)

    def __post_init__(self):
        joined = self.hidden * len(self.branches) + self.embedded * len(self.categories)
        shapes = [(f"w{i}", (n, self.hidden)) for i, n in enumerate(self.branches)]
        shapes += [(f"b{i}", (self.hidden,)) for i in range(len(self.branches))]
        shapes += [(f"e{i}", (n, self.embedded)) for i, n in enumerate(self.categories)]
        shapes += [("w", (joined, self.top)), ("b", (self.top,)), ("v", (self.top,)), ("c", (1,))]
        self.parts, at = [], 0
        for name, shape in shapes:
            self.parts.append((name, shape, at))
            at += int(np.prod(shape))
        self.size = at
        # worked out once: views are taken several times in every step
        self.places = [(name, shape, slice(at, at + int(np.prod(shape)))) for name, shape, at in self.parts]

    def views(self, weights: np.ndarray) -> dict[str, np.ndarray]:
        return {name: weights[place].reshape(shape) for name, shape, place in self.places}

    def start(self, seed: int = SEED) -> np.ndarray:
        rng = np.random.default_rng(seed)
        weights = np.zeros(self.size)
        for name, part in self.views(weights).items():
            if part.ndim == 2:
                part[:] = rng.normal(0, (0.1 if name[0] == "e" else np.sqrt(2 / part.shape[0])), part.shape)
        self.views(weights)["v"][:] = rng.normal(0, np.sqrt(1 / self.top), self.top)
        return weights

    def forward(self, weights: np.ndarray, xs: Sequence[np.ndarray], cs: Sequence[np.ndarray]):
        p = self.views(weights)
        first = [np.maximum(x @ p[f"w{i}"] + p[f"b{i}"], 0) for i, x in enumerate(xs)]
        joined = np.hstack([*first, *(p[f"e{i}"][c] for i, c in enumerate(cs))])
        second = np.maximum(joined @ p["w"] + p["b"], 0)
        return second @ p["v"] + p["c"][0], joined, second

    def gradient(self, weights: np.ndarray, xs: Sequence[np.ndarray], cs: Sequence[np.ndarray], y: np.ndarray):
        """Half the mean squared error and its gradient."""
        p, out = self.views(weights), np.zeros(self.size)
        g = self.views(out)
        guess, joined, second = self.forward(weights, xs, cs)
        off = (guess - y) / len(y)
        g["v"][:], g["c"][0] = second.T @ off, off.sum()
        back = np.outer(off, p["v"]) * (second > 0)
        g["w"][:], g["b"][:] = joined.T @ back, back.sum(axis=0)
        back = (back @ p["w"].T)
        for i, x in enumerate(xs):
            at = slice(i * self.hidden, (i + 1) * self.hidden)
            part = back[:, at] * (joined[:, at] > 0)
            g[f"w{i}"][:], g[f"b{i}"][:] = x.T @ part, part.sum(axis=0)
        begin = len(xs) * self.hidden
        for i, c in enumerate(cs):
            np.add.at(g[f"e{i}"], c, back[:, begin + i * self.embedded:begin + (i + 1) * self.embedded])
        return float(((guess - y) ** 2).mean() / 2), out


def _inputs(net: Network, pdf: pd.DataFrame):
    xs = [np.stack(pdf[f"x{i}"].to_numpy()) for i in range(len(net.branches))]
    return xs, [pdf[f"c{i}"].to_numpy().astype(np.intp) for i in range(len(net.categories))]


def local_pass(net: Network, weights: np.ndarray, rate: float):
    """What a task does in a round: Adam over its rows, then rows and rows times weights by place."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, m, v, step, seen = weights.copy(), np.zeros(net.size), np.zeros(net.size), 0, 0
        rng = np.random.default_rng(SEED)
        for pdf in batches:
            xs, cs = _inputs(net, pdf)
            y = pdf["y"].to_numpy()
            order = np.concatenate([rng.permutation(len(y)) for _ in range(PASSES)])
            # the rows of all passes are laid out in order once, so that a mini-batch is a slice
            xs, cs, dealt = [x[order] for x in xs], [c[order] for c in cs], y[order]
            for at in range(0, len(order), BATCH):
                some = slice(at, at + BATCH)
                _, g = net.gradient(own, [x[some] for x in xs], [c[some] for c in cs], dealt[some])
                step += 1
                m, v = BETA1 * m + (1 - BETA1) * g, BETA2 * v + (1 - BETA2) * g * g
                own = own - rate * (m / (1 - BETA1 ** step)) / (np.sqrt(v / (1 - BETA2 ** step)) + 1e-8)
            seen += len(y)
        if seen:
            yield pd.DataFrame({"place": np.arange(-1, net.size), "part": np.concatenate([[float(seen)], own * seen])})

    return run


@dataclass
class BranchedModel:
    """Fitted preparation, weights, and the target's mean and spread on the log scale."""

    prepare: PipelineModel
    net: Network
    weights: np.ndarray
    centre: float
    spread: float
    history: list[float]

    def inputs(self, df: DataFrame) -> DataFrame:
        out = self.prepare.transform(df)
        return out.select(df["*"], *[vector_to_array(f"branch_{i}").alias(f"x{i}") for i in range(len(self.net.branches))],
                          *[F.col(f"cat_{i}").cast("int").alias(f"c{i}") for i in range(len(self.net.categories))])

    def predict(self, df: DataFrame) -> DataFrame:
        """df with prediction, on the target's own scale; rows of df stay where they are."""
        return self.scored(self.inputs(df))

    def scored(self, inputs: DataFrame) -> DataFrame:
        """The same for rows that inputs has prepared."""
        net, weights, centre, spread = self.net, self.weights, self.centre, self.spread
        names = [*(f"x{i}" for i in range(len(net.branches))), *(f"c{i}" for i in range(len(net.categories)))]

        @F.pandas_udf("double")
        def guess(*columns: pd.Series) -> pd.Series:
            xs, cs = _inputs(net, pd.DataFrame(dict(zip(names, columns))))
            return pd.Series(np.expm1(net.forward(weights, xs, cs)[0] * spread + centre))

        return inputs.withColumn("prediction", guess(*names)).drop(*names)


def fit(train: DataFrame, val: DataFrame, branches: dict[str, list[str]], cats: Sequence[str], target: str = "target",
        rounds: int = 40, patience: int = 5, written=None) -> BranchedModel:
    """Trains on rows of train until the error on val has not fallen for `patience` rounds; the best weights stay.

    Features must not be null; a category not seen in train has an embedding of its own. written stores the
    prepared rows, of train and of val, for the rounds to read (the identity unless given). Per round, the driver gets one row for each weight.
    """
    keep = written or (lambda df, name: df.persist())
    stages = [s for i, cols in enumerate(branches.values()) for s in assembler(cols, True, f"branch_{i}")]
    stages.append(StringIndexer(inputCols=list(cats), outputCols=[f"cat_{i}" for i in range(len(cats))],
                                stringOrderType="alphabetAsc", handleInvalid="keep"))
    prepare = Pipeline(stages=stages).fit(train)
    sizes = tuple(len(labels) + 1 for labels in prepare.stages[-1].labelsArray)
    net = Network(tuple(len(cols) for cols in branches.values()), sizes)
    of = train.agg(F.avg(F.log1p(target)), F.stddev_samp(F.log1p(target))).first()
    model = BranchedModel(prepare, net, net.start(), float(of[0] or 0.0), float(of[1] or 1.0) or 1.0, [])
    y = (F.log1p(target) - model.centre) / model.spread
    data = keep(model.inputs(train.withColumn("y", y)).select(
        "y", *[f"x{i}" for i in range(len(net.branches))], *[f"c{i}" for i in range(len(net.categories))]), "branched-train")
    used = dict.fromkeys([target, *(c for cols in branches.values() for c in cols), *cats])
    held = keep(model.inputs(val.where(F.col(target).isNotNull()).select(*used)).select(
        target, *[f"x{i}" for i in range(len(net.branches))], *[f"c{i}" for i in range(len(net.categories))]), "branched-val")
    best, since, rate = model.weights, 0, RATE
    for _ in range(rounds):
        got = data.mapInPandas(local_pass(net, model.weights, rate), "place long, part double").groupBy("place").agg(
            F.sum("part").alias("part")).orderBy("place").collect()
        if not got:
            break
        model.weights = np.array([r.part for r in got[1:]]) / got[0].part
        error = model.scored(held).agg(F.sqrt(F.avg((F.log1p("prediction") - F.log1p(target)) ** 2)).alias("e")).first()["e"]
        if error is None:
            best = model.weights
            break
        if not model.history or error < min(model.history):
            best, since = model.weights, 0
        else:
            since += 1
        model.history.append(error)
        rate *= FADE
        if since >= patience:
            break
    model.weights = best
    return model

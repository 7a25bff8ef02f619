"""Quality scores learnt from preference pairs (Bradley and Terry).

A document has a strength, a weighted sum of features of its text. The chance
that it is preferred to another is the logistic function of the difference of
their strengths, so the weights are fitted by logistic loss on differences of
features, over pairs of a good and a bad labelled document. The strength at a
quantile of the labelled documents is the threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from colloquy.llm.common import BINS, Stored

C = F.col
#: Bounds of what the driver fits on: labelled documents of each label, and pairs.
LABELLED, PAIRS = 10_000, 100_000
KEEP = 0.7  # the score at the threshold
RIDGE, ROUNDS = 1e-3, 50
WINDOW = 64  # words
PLAIN = b".,;:'\"-()?"

_kinds = np.zeros((8, 256))
_kinds[0, [*range(65, 91), *range(97, 123), *range(128, 256)]] = 1  # letters, and bytes of letters beyond ASCII
_kinds[1, list(range(65, 91))] = 1  # upper case
_kinds[2, list(range(48, 58))] = 1  # digits
_kinds[3, list(PLAIN)] = 1
_kinds[4, [b for b in range(33, 127) if not chr(b).isalnum() and b not in PLAIN]] = 1  # other signs
_kinds[5, [9, 10, 11, 12, 13, 32]] = 1
_kinds[6, [10]] = 1
_kinds[7, [*range(9), *range(14, 32), 127]] = 1  # control characters
NAMES = (
    "letters", "upper", "digits", "plain signs", "other signs", "white space", "lines", "control", "word length",
    "short words", "long words", "repeated words", "distinct words", "distinct triples", "distinct lines", "length",
)


def features(text: str | None) -> np.ndarray:
    """Numbers near 0 to 1 about the whole text; all zero if it has no words."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return np.zeros(len(NAMES))
    octets = np.frombuffer(data, np.uint8)
    counts = np.zeros(256)
    for at in range(0, len(octets), 1 << 20):
        counts += np.bincount(octets[at : at + (1 << 20)], minlength=256)
    share = _kinds @ counts / len(data)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct = triples = 0
    for at in range(0, n, WINDOW):
        run = words[at : at + WINDOW]
        distinct += len(set(run))
        triples += len(set(zip(run, run[1:], run[2:])))
    possible = sum(max(0, min(WINDOW, n - at) - 2) for at in range(0, n, WINDOW))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return np.array(
        [
            share[0], share[1] / max(share[0], 1e-9), *share[2:8], min(2.0, lengths.mean() / 10),
            (lengths <= 1).mean(), (lengths > 20).mean(), sum(map(eq, words, words[1:])) / n,
            distinct / n, triples / possible if possible else 1.0, len(set(lines)) / len(lines), np.log1p(n) / 10,
        ]
    )


@dataclass(frozen=True)
class Model:
    """Weights of the features, and the strength at which the score is ``KEEP``."""

    weights: tuple[float, ...]
    threshold: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        above = strengths(rows, np.array(self.weights)) - self.threshold
        score = 1 / (1 + np.exp(-np.clip(above + np.log(KEEP / (1 - KEEP)), -500, 500)))
        return np.where(above >= 0, np.maximum(score, KEEP), score)  # rounding must not take one at the threshold below it


def strengths(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Strength of each row, the same to the last bit in any batch."""
    return np.array([math.fsum(row) for row in (rows * weights).tolist()])


def known_labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """``k, label`` of the keys that have one label, 0 or 1."""
    known = labels.select(C(key).alias("k"), C(label).cast("int").alias("label")).where("k IS NOT NULL AND label IN (0, 1)")
    return known.groupBy("k").agg(F.max("label").alias("label"), F.min("label").alias("least")).where("label = least").select("k", "label")


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int) -> pd.DataFrame:
    """Features of at most ``most`` labelled documents of each label, chosen by a hash of the key."""
    known = known_labels(labels, key, label)
    chosen = None
    for value in (0, 1):
        some = known.where(C("label") == value).orderBy(F.xxhash64("k"), "k").limit(most).select("k", "label")
        chosen = some if chosen is None else chosen.unionByName(some)
    found = docs.select(C(key).alias("k"), C(text).alias("text")).join(F.broadcast(chosen), "k")  # bounded above

    @pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    rows = found.select("k", "label", F.xxhash64("text").alias("tie"), of(C("text")).alias("x"))
    return rows.toPandas().sort_values(["k", "tie"], ignore_index=True)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        reject: float | None = None, most: int = LABELLED, pairs: int = PAIRS) -> Model:
    """Learn the weights and the threshold from labelled documents.

    Weights are fitted on at most ``most`` documents of each label and ``pairs``
    pairs of a good (1) and a bad (0) one; both bounds are the driver's memory,
    and hold at any size of the tables. ``reject`` is the quantile of strengths,
    over all labelled documents, that is the threshold: by default the share of
    label 0 among them. It is exact at any size.
    Rows without a key or label, keys with both labels and labels without a
    document are passed over. Without documents of both labels there is no pair,
    and every document scores ``KEEP``.
    """
    held = labelled(docs, labels, key, text, label, most)
    good, bad = (np.array(held.x[held.label == v].tolist()) for v in (1, 0))
    if not len(good) or not len(bad):
        return Model((0.0,) * len(NAMES), 0.0)
    chance = np.random.default_rng(0)
    count = min(pairs, 20 * (len(good) + len(bad)))
    preferred = np.concatenate([np.arange(len(good)), chance.integers(len(good), size=count)])
    other = np.concatenate([chance.integers(len(bad), size=len(good)), chance.integers(len(bad), size=count)])
    spread = np.vstack([good, bad]).std(axis=0)
    spread[spread < 1e-9] = np.inf
    difference = (good[preferred] - bad[other]) / spread
    weights = np.zeros(difference.shape[1])
    for _ in range(ROUNDS):  # Newton's method
        chance_of = 1 / (1 + np.exp(-np.clip(difference @ weights, -500, 500)))
        slope = difference.T @ (chance_of - 1) / len(difference) + RIDGE * weights
        curve = (difference * (chance_of * (1 - chance_of))[:, None]).T @ difference / len(difference)
        step = np.linalg.solve(curve + RIDGE * np.eye(len(weights)), slope)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = np.where(np.isinf(spread), 0.0, weights / spread)
    store = Stored(docs.sparkSession, "quality")
    # strengths before the join, so that no text is shuffled
    every = docs.select(C(key).alias("k"), strength(C(text), weights).alias("v"))
    held = store.put(every.join(known_labels(labels, key, label), "k").select("v", "label"))
    at = held.agg(F.avg(1 - C("label"))).first()[0] if reject is None else reject
    threshold = quantile_of(held, at)
    store.drop(held)
    return Model(tuple(weights.tolist()), threshold)


def strength(text: Column, weights: np.ndarray) -> Column:
    @pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([strengths(features(t)[None, :], weights)[0] for t in texts], dtype="float64")

    return of(text)


def ranked(values: DataFrame, n: int) -> float:
    """The value at place ``n``, from 0, of the column ``v`` in ascending order: counts per bin, refined."""
    low, high = values.agg(F.min("v"), F.max("v")).first()
    while low < high:
        inside = values.where(C("v").between(low, high))
        step = F.floor((C("v") - low) / (high - low) * BINS)
        bins = inside.groupBy(step.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        for b in sorted(bins.collect(), key=lambda b: b["bin"]):
            if n < b["n"]:
                low, high = b["low"], b["high"]
                break
            n -= b["n"]
    return low


def quantile_of(values: DataFrame, at: float) -> float:
    """``quantile`` of the column ``v``, all rows of one weight, without bringing them to the driver."""
    count = values.count()
    if at <= 0:
        return ranked(values, 0) - 1.0
    n = max(0, math.ceil(at * (1 - 1e-9) * count) - 1)
    if n + 1 >= count:
        return ranked(values, count - 1) + 1.0
    return (ranked(values, n) + ranked(values, n + 1)) / 2


def quantile(values: np.ndarray, weight: np.ndarray, at: float) -> float:
    """Midway between the values on both sides of a weighted quantile."""
    order = np.argsort(values, kind="stable")
    values, upto = values[order], np.cumsum(weight[order]) / weight.sum()
    n = int(np.searchsorted(upto, at * (1 - 1e-9), side="left"))
    if at <= 0:
        return float(values[0]) - 1.0
    return float(values[n] + values[n + 1]) / 2 if n + 1 < len(values) else float(values[-1]) + 1.0


def score(text: Column, model: Model) -> Column:
    """Score of a text from 0 to 1; at least ``KEEP`` from the threshold on. A null text scores as an empty one."""

    @pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.scores(np.array([features(t) for t in texts])))

    return of(text)

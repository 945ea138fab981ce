"""Quality scores by positive-unlabelled learning.

A small network on measured properties of a text (signs, capitals, repetition, word lengths) minimises the non-negative unbiased risk

    prior * E_pos[loss(f)] + max(0, E_unlabelled[loss(-f)] - prior * E_pos[loss(-f)])

over trusted positives and unlabelled web text. The class prior is estimated as the share of positives among labelled training rows.
With the logistic loss the sigmoid of f estimates the probability that a text is good.

Both sets are bounded samples chosen by hash (``POSITIVES``, ``UNLABELLED`` rows); every text is scored whole. Rules: null counts as empty,
and an empty text is scored like any other. A text's label, language, source and id are never inputs. Without any positive
label every score is 0.5. Rows that repeat an id repeat its label. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.llm.common import fold_of, sample_of, strings
from loreweave.llm.queries import query, table

POSITIVES = 6_000
UNLABELLED = 15_000
THRESHOLD = 0.3
HIDDEN = 16
EPOCHS = 60
BATCHES = 12
RATE = 0.01
DECAY = 1e-4
SEED = 5
SIGNS = "|!%&$*#?:;,.\"'()[]{}<>/=_-@"


def capitals(text: str) -> int:
    """Characters of a whole text, of any length, that lower-casing changes."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found, times = np.unique(codes[codes >= 128], return_counts=True)
    other = sum(n for c, n in zip(found.tolist(), times.tolist()) if chr(c).lower() != chr(c))
    return int(np.count_nonzero(codes - np.uint32(65) < 26)) + other  # A-Z, and what lies beyond ASCII


def measures(text: str) -> list[float]:
    """Properties of one whole text; all are shares or logarithms, so length hardly matters."""
    n = max(1, len(text))
    words = text.split()
    m = max(1, len(words))
    lines = text.split("\n")
    sentences = text.replace("!", ".").replace("?", ".").split(".")
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    commonest = max(counts.values(), default=0)
    out = [text.count(c) / m for c in SIGNS]
    out += [
        math.log1p(len(words)),
        capitals(text) / n,
        sum(map(str.isupper, words)) / m,
        sum(map(str.isalpha, words)) / m,
        sum(map(str.isdigit, words)) / m,
        len(counts) / m,
        len(counts) / math.sqrt(m),
        commonest / m,
        len(set(lines)) / len(lines),
        len(set(sentences)) / len(sentences),
        math.log1p(n / len(sentences)),
        math.log1p(m / len(lines)),
        float(lengths.mean()) if len(words) else 0.0,
        float(lengths.std()) if len(words) else 0.0,
        float((lengths > 20).mean()) if len(words) else 0.0,
        len(text.replace(" ", "").encode("ascii", "ignore")) / n,
    ]
    return out


class Network:
    """One hidden layer; weights are plain arrays."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: list[np.ndarray]) -> None:
        self.mean, self.scale, self.weights = mean, scale, weights

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, d = self.weights
        hidden = np.tanh(x @ a + b)
        return hidden, hidden @ c + d[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.forward(np.clip((x - self.mean) / self.scale, -8, 8))[1])


def sigmoid(f: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * f))


def slopes(f: np.ndarray, prior: float, positive: np.ndarray) -> np.ndarray:
    """Slope of the non-negative risk for a batch. Where the negative part would fall below zero, only that part is pushed back up."""
    n_pos, n_unl = max(1, positive.sum()), max(1, (~positive).sum())
    good, bad = np.logaddexp(0, -f), np.logaddexp(0, f)
    negative = bad[~positive].sum() / n_unl - prior * bad[positive].sum() / n_pos
    rise = sigmoid(f)
    on_negative = np.where(positive, -prior * rise / n_pos, rise / n_unl)
    if negative < 0:
        return -on_negative
    return np.where(positive, prior * (rise - 1) / n_pos, 0.0) + on_negative


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = SEED) -> Network:
    """Train on measured rows with Adam; deterministic for given rows."""
    rng = np.random.default_rng(seed)
    every = np.concatenate([positive, unlabelled])
    mean, scale = every.mean(0), every.std(0) + 1e-6
    x = np.clip((every - mean) / scale, -8, 8)
    is_positive = np.arange(len(x)) < len(positive)
    size = x.shape[1]
    weights = [rng.normal(size=(size, HIDDEN)) / math.sqrt(size), np.zeros(HIDDEN), rng.normal(size=HIDDEN) / math.sqrt(HIDDEN), np.zeros(1)]
    net = Network(mean, scale, weights)
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    kept = [np.zeros_like(w) for w in weights]
    for epoch in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(x)), min(BATCHES, len(x))):
            hidden, f = net.forward(x[rows])
            s = slopes(f, prior, is_positive[rows])
            back = np.outer(s, weights[2]) * (1 - hidden**2)
            grads = [x[rows].T @ back, back.sum(0), hidden.T @ s, s.sum(keepdims=True)]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for w, g, a, b in zip(weights, grads, first, second):
                g = g + DECAY * w
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        if epoch >= EPOCHS // 2:
            for k, w in zip(kept, weights):
                k += w / (EPOCHS - EPOCHS // 2)
    net.weights = kept  # averaged over the later epochs
    return net


def measured(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def each(texts: pa.Array) -> pa.Array:
        return pa.array([measures(t) for t in strings(texts)], pa.list_(pa.float64()))

    return each(text)


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, folds: int, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Network | None:
    """Fit on the rows outside fold 0: a bounded sample of positives and one of all texts, whose labels stay unseen."""
    known = labels.filter((fold_of(key, folds) != 0) & F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(label).alias("label"))
    counts = known.groupBy((F.col("label") == 1).alias("good")).count().collect()
    good = sum(r["count"] for r in counts if r["good"])
    if not good:
        return None
    prior = good / sum(r["count"] for r in counts)
    trusted = sample_of(known.filter("label = 1").select("key").distinct(), F.col("key"), positives)
    rows = docs.filter(fold_of(key, folds) != 0).select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    # trusted has about `positives` rows at most
    p = rows.join(F.broadcast(trusted), "key", "left_semi").select(measured(F.col("text")).alias("m"))
    u = sample_of(rows, F.xxhash64("key", "text"), unlabelled).select(measured(F.col("text")).alias("m"))
    p, u = (np.array(x.toArrow()["m"].to_pylist(), float) for x in (p, u))
    return fit(p, u, prior) if len(p) and len(u) else None


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row, ``doc_id`` being the column ``key``."""
    net = train(docs, labels, key, text, label, folds)
    if net is None:
        score = F.lit(0.5)
    else:
        shared = docs.sparkSession.sparkContext.broadcast((net.mean, net.scale, net.weights))

        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            x = np.array([measures(t) for t in strings(texts)], float)
            return pa.array(Network(*shared.value).score(x) if len(x) else [], pa.float64())

        score = scored(F.col(text).cast("string"))
    rows = docs.select(F.col(key).alias("doc_id"), (fold_of(key, folds) == 0).alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query("op1_quality")
def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))

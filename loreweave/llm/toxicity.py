"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat, target, negation, report, other) with the weight that the lexicon gives them. Three small
transducers rewrite the symbols of a clause one after the other: negation weakens what it governs, reported speech weakens what it
reports, a target strengthens the insult it meets and completes a threat. They are composed into one machine, whose transitions are
made when first met. Its output weights add up to the score of a clause; the scores of matched clauses, not isolated words, are
the inputs of a calibrated logistic score.

The lexicon is a short fixed list of words plus the stems that labelled training texts prove in any language (see ``learn_stems``): a stem
matches every word that begins with it. Stems are learned and the score is calibrated on a bounded sample of labelled rows; every text is scored whole. Rules: null counts as empty; a text without any match
gets the calibrated score of no match. Without labels of both kinds the calibration is a fixed one. Rows that repeat an id repeat its
label. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.llm.common import fold_of, sample_of, strings
from loreweave.llm.queries import query, table

THRESHOLD = 0.7
# labelled rows that stems are learned and the score is calibrated on; stems that may be learned, and their lengths
FIT_ROWS = 12_000
LEARNED_STEMS = 200
STEM = range(3, 10)
# evidence that a stem must have: toxic texts with it times the log of its precision over the base rate
EVIDENCE = 18.0
PRECISION = 0.85
# log-odds of the precision that give a learned stem the weight of a listed insult
FULL_WEIGHT = 4.0

INSULTS = "idiot moron stupid scum trash loser pathetic worthless disgusting clown vermin imbecile".split()
THREATS = "kill hurt destroy beat murder attack".split()
TARGETS = "you your yours u he she they them him her his their these those".split()
NEGATIONS = "not no never neither nor without isn't aren't wasn't don't doesn't didn't won't can't cannot".split()
REPORTS = "said says say called calls wrote writes claimed claims alleged reported reports quoted quote accused".split()

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")
CLAUSE_END = re.compile(r"[.!?;:,\n]+")
# words that a negation governs, words between a target and what it meets
GOVERNED = 4
NEAR = 4
NEGATED, REPORTED, AIMED, ALONE_THREAT = 0.15, 0.3, 1.5, 0.1

Arc = tuple[tuple, str, float]


def negation(state: tuple, symbol: str) -> Arc:
    """State: words left under a negation."""
    (left,) = state
    if symbol == "negation":
        return (GOVERNED,), "other", 1.0
    if left and symbol in ("insult", "threat"):
        return (left - 1,), symbol, NEGATED
    return (max(0, left - 1),), symbol, 1.0


def reported(state: tuple, symbol: str) -> Arc:
    """State: whether the clause reports somebody's words."""
    (on,) = state
    if symbol == "report":
        return (True,), "other", 1.0
    return state, symbol, REPORTED if on and symbol in ("insult", "threat") else 1.0


def aimed(state: tuple, symbol: str) -> Arc:
    """State: words since a target, words since an unaimed threat. A threat counts in full where its target is met."""
    target, threat = state
    since = lambda n: n + 1 if n < NEAR else NEAR
    if symbol == "target":
        return (0, NEAR), "aimed threat" if threat < NEAR else "other", 1.0
    if symbol == "insult":
        return (since(target), since(threat)), "insult", AIMED if target < NEAR else 1.0
    if symbol == "threat":
        return (since(target), 0), "threat", ALONE_THREAT
    return (since(target), since(threat)), symbol, 1.0


class Grammar:
    """The composed machine over a lexicon ``word -> (symbol, weight)`` and insulting stems ``beginning -> weight``."""

    MACHINES = (negation, reported, aimed)
    START = ((0,), (False,), (NEAR, NEAR))

    def __init__(self, lexicon: dict[str, tuple[str, float]], stems: dict[str, float]) -> None:
        self.lexicon, self.stems = lexicon, stems
        self.arcs: dict[tuple, tuple] = {}
        words = sorted((w for w, (symbol, _) in lexicon.items() if symbol in ("insult", "threat")), key=len, reverse=True)
        begin, end = r"(?<![^\W\d_])(?:", r"(?![^\W\d_])"
        self.find = re.compile("|".join([*(re.escape(x) for x in stems), *(re.escape(w) + end for w in words)]).join([begin, ")"]))

    def symbol(self, word: str) -> tuple[str, float]:
        if word not in self.lexicon:
            weight = next((self.stems[word[:k]] for k in STEM if word[:k] in self.stems), 0.0)
            self.lexicon[word] = ("insult", weight) if weight else ("other", 0.0)
        return self.lexicon[word]

    def step(self, state: tuple, symbol: str) -> tuple[tuple, str, float]:
        """One arc of the composition: the output of each machine is the input of the next, weights multiply."""
        key = (state, symbol)
        if key not in self.arcs:
            after, out, weight = [], symbol, 1.0
            for machine, own in zip(self.MACHINES, state):
                own, out, w = machine(own, out)
                after.append(own)
                weight *= w
            self.arcs[key] = tuple(after), out, weight
        return self.arcs[key]

    def clause(self, clause: str) -> float:
        state, total, threat = self.START, 0.0, 0.0
        for m in WORD.finditer(clause):
            symbol, weight = self.symbol(m.group())
            state, out, factor = self.step(state, symbol)
            if out in ("insult", "threat"):
                total += weight * factor
                threat = weight * factor / ALONE_THREAT if out == "threat" else threat
            elif out == "aimed threat":
                total += threat
        return total

    def features(self, text: str) -> list[float]:
        """Largest clause score, sum of clause scores, matched clauses: the latter two as logarithms."""
        low = text.lower().replace("’", "'")
        scores, end = [], 0
        for m in self.find.finditer(low):
            if m.start() < end:
                continue  # its clause has been scored
            # the mark that closed the last clause is at `end`, so no character is looked at more than once for each mark
            begin = max(max(low.rfind(c, end, m.start()) for c in ".!?;:,\n") + 1, end)
            close = CLAUSE_END.search(low, m.end())
            end = close.start() if close else len(low)
            scores.append(self.clause(low[begin:end]))
        scores = [s for s in scores if s > 0]
        return [min(4.0, max(scores, default=0.0)), math.log1p(sum(scores)), math.log1p(len(scores))]


def seed_lexicon() -> dict[str, tuple[str, float]]:
    lists = (("other", ()), ("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS), ("threat", THREATS), ("insult", INSULTS))
    return {w: (symbol, 1.0) for symbol, words in lists for w in words}


def count_stems(batches):
    """Arrow batches ``(text, label)`` to ``(stem, hits, n)``: texts that have a word with this beginning, summed within the task."""
    n: Counter = Counter()
    hits: Counter = Counter()
    for batch in batches:
        for text, label in zip(strings(batch.column(0)), batch.column(1).to_pylist()):
            words = set(WORD.findall(text.lower().replace("’", "'")))
            stems = {w[:k] for w in words for k in STEM if len(w) >= k}
            n.update(stems)
            if label:
                hits.update(stems)
    stems = list(n)
    for i in range(0, len(stems), 50_000):
        part = stems[i : i + 50_000]
        counts = [pa.array([c[x] for x in part], pa.int64()) for c in (hits, n)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *counts], ["stem", "hits", "n"])


def learn_stems(rows: DataFrame, most: int = LEARNED_STEMS) -> dict[str, float]:
    """Word beginnings that labelled texts ``(text, label)`` prove toxic, with their weights: ``most`` strongest at most.

    Of beginnings with the same evidence the longest counts; one that continues a stronger one adds nothing.
    """
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, every = counts.get(1, 0), sum(counts.values())
    if not toxic or toxic == every:
        return {}
    found = rows.select("text", "label").repartition(8).mapInArrow(count_stems, "stem string, hits long, n long")
    found = found.groupBy("stem").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).withColumn("precision", F.col("hits") / F.col("n"))
    strength = F.round(F.col("hits") * F.log(F.col("precision") * F.lit(every / toxic)), 6)
    strong = found.filter((F.col("precision") >= PRECISION) & (strength >= EVIDENCE))
    stems: dict[str, float] = {}
    for r in strong.orderBy(strength.desc(), F.length("stem").desc(), "stem").limit(most * len(STEM)).collect():
        if len(stems) < most and not any(r["stem"].startswith(x) or x.startswith(r["stem"]) for x in stems):
            p = (r["hits"] + 0.5) / (r["n"] + 1)
            stems[r["stem"]] = min(1.0, math.log(p / (1 - p)) / FULL_WEIGHT)
    return stems


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic score with a little shrinkage, by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 0.5 * (1 + np.tanh(0.5 * (a @ w)))
        pull = np.diag([0.05] * x.shape[1] + [1e-6])
        w += np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + pull, a.T @ (y - p) - pull @ w)
    return w


# of a text whose only match is one plain insult: 0.73
FIXED_CALIBRATION = np.array([3.0, 1.0, 0.0, -2.7])


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, folds: int, held: int, fit_rows: int = FIT_ROWS) -> tuple[dict, np.ndarray]:
    """Stems and calibration from the labelled rows outside the held-out fold."""
    known = labels.filter((fold_of(key, folds) != held) & F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
    known = sample_of(known, F.col("key"), fit_rows)  # about fit_rows rows at most
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(known), "key").select("text", "label").persist()
    stems = learn_stems(rows)

    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        grammar = Grammar(seed_lexicon(), stems)
        return pa.array([grammar.features(t) for t in strings(texts)], pa.list_(pa.float64()))

    found = rows.select("label", features("text").alias("x")).toArrow()
    rows.unpersist()
    x, y = np.array(found["x"].to_pylist(), float).reshape(-1, 3), np.array(found["label"].to_pylist(), float)
    return stems, calibrate(x, y) if 0 < y.sum() < len(y) else FIXED_CALIBRATION


def score_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: int = 3, held: int = 1, threshold: float = THRESHOLD
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row, ``doc_id`` being the column ``key``."""
    stems, weights = train(docs, labels, key, text, label, folds, held)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        grammar = Grammar(seed_lexicon(), stems)
        x = np.array([grammar.features(t) for t in strings(texts)], float).reshape(-1, 3)
        return pa.array(0.5 * (1 + np.tanh(0.5 * (x @ weights[:3] + weights[3]))), pa.float64())

    rows = docs.select(F.col(key).alias("doc_id"), (fold_of(key, folds) == held).alias("held_out"), scored(F.col(text).cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query("op3_toxicity")
def toxicity_query(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))

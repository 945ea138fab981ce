"""Language identification: multinomial naive Bayes over hashed character n-grams.

Rules: a text that is null or has no letter is ``und`` with score 0; so is every text if nothing could be learned.
Rows with a null text or a null language teach nothing; every other language is learned, however rare. Ties go to the language that sorts first. Other columns,
whatever their names, are neither read nor changed.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loreweave.llm.common import fold_of, place, plain_names, row_slices, slices, strings
from loreweave.llm.queries import query, table
from loreweave.session import written

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
# distinct texts that the model is fitted on: each label gets an equal part, but LEAST_ROWS at least; a label with fewer gives all
FIT_ROWS = 12_000
LEAST_ROWS = 100
# more labels are an error, never dropped: LABELS x BUCKETS counts reach the driver (16 bytes each, 268 MB, and as many
# numbers of 8 bytes, 134 MB), a task holds 134 MB of counts, and 67 MB of weights are broadcast
LABELS = 512
SMOOTHING = 0.5
# a filter rejects texts whose language is told with less, and corrects a label that the prediction contradicts with as much
LEAST_SCORE, RELABEL_SCORE = 0.5, 0.99
LETTER = re.compile(r"[^\W\d_]")


class LanguageModel(NamedTuple):
    labels: list[str]
    prior: np.ndarray  # log share of each label
    weights: np.ndarray  # (labels, buckets) log-probabilities


def ngram_buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each position (the last ``order - 1`` positions start none)."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.empty(0, np.uint32)
    h = np.full(n, np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF))
    for k in range(order):
        h ^= codes[k : k + n]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
    return h & np.uint32(BUCKETS - 1)


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts in one array, and where each text begins (with the end as last)."""
    low = [t.lower() for t in texts]
    ends = np.cumsum([0, *map(len, low)])
    return np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32), ends


def count_ngrams(batches):
    """Arrow batches ``(label, text)`` to ``(label, bucket, n)``, summed within the task; labels are numbers."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        labels, texts = batch.column(0).to_pylist(), strings(batch.column(1))
        for a, b in slices(texts):
            for i in range(a, b):
                codes, _ = codes_of([texts[i]])
                into = held.setdefault(labels[i], np.zeros(BUCKETS, np.int64))
                for order in ORDERS:
                    into += np.bincount(ngram_buckets(codes, order), minlength=BUCKETS)
    for label, counts in held.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), label), pa.int32()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
            ["label", "bucket", "n"],
        )


def sampled_texts(rows: DataFrame, fit_rows: int) -> tuple[list, DataFrame]:
    """Rows ``(label, texts, rows)`` of all labels, sorted, and ``(label number, text)``: about an equal number of distinct texts of each
    label chosen by hash, and at least one."""
    mark = F.xxhash64(F.col("text"), F.lit(17))
    marked = written(rows.select("label", mark.alias("mark")).groupBy("label", "mark").agg(F.count("*").alias("n")), "marks")
    found = marked.groupBy("label").agg(F.count("*").alias("texts"), F.sum("n").alias("rows"), F.min("mark").alias("first"))
    shares = sorted(found.limit(LABELS + 1).collect(), key=lambda r: r["label"])
    if len(shares) > LABELS:
        raise ValueError(f"more than {LABELS} languages in the label column: their counts would not fit the driver")
    each = max(LEAST_ROWS, fit_rows // max(1, len(shares)))
    limits = []
    for i, r in enumerate(shares):
        # marks are spread evenly, so those up to a border are a share of them
        border = round((each / r["texts"] - 0.5) * (1 << 64)) if each < r["texts"] else (1 << 63) - 1
        limits.append((r["label"], i, max(r["first"], border)))
    borders = rows.sparkSession.createDataFrame(limits, "label string, place int, border long")
    taken = rows.withColumn("mark", mark).join(F.broadcast(borders), "label").filter("mark <= border")  # LABELS rows at most
    return shares, taken.dropDuplicates(["place", "mark"]).select(F.col("place").alias("label"), "text")


def fit(df: DataFrame, text: str, label: str, fit_rows: int = FIT_ROWS) -> LanguageModel | None:
    """Learn from the rows of ``df``: label shares from all of them, n-grams from a bounded sample of each label chosen by hash."""
    rows = df.select(F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text")).filter("label IS NOT NULL AND text IS NOT NULL")
    shares, taken = sampled_texts(rows, fit_rows)
    if not shares:
        return None
    labels = [r["label"] for r in shares]
    counted = taken.repartition(8).mapInArrow(count_ngrams, "label int, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(labels), BUCKETS))
    found = counted.toArrow()  # at most LABELS x BUCKETS rows
    counts[found["label"].to_numpy(), found["bucket"].to_numpy()] = found["n"].to_numpy()
    counts += SMOOTHING
    weights = np.empty(counts.shape, np.float32)
    for k, row in enumerate(counts):
        weights[k] = np.log(row / row.sum())
    totals = np.array([r["rows"] for r in shares], float)
    return LanguageModel(labels, np.log(totals / totals.sum()), weights)


def log_scores(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """(texts, labels): log prior plus summed log-probabilities, several texts and all n-grams at a time."""
    out = np.tile(model.prior, (len(texts), 1))
    for a, b in slices(texts):
        codes, ends = codes_of(texts[a:b])
        for order in ORDERS:
            at = ngram_buckets(codes, order)
            if not len(at):
                continue
            first = np.minimum(ends[:-1], len(at))
            last = np.minimum(np.maximum(ends[1:] - order + 1, ends[:-1]), len(at))
            for k in range(len(model.labels)):
                run = np.concatenate(([0.0], np.cumsum(model.weights[k][at], dtype=np.float64)))
                out[a:b, k] += run[last] - run[first]
    return out


def predict(model: LanguageModel, texts: list[str]) -> tuple[list[str], list[float]]:
    logs = log_scores(model, texts)
    logs -= logs.max(1, keepdims=True)
    best = logs.argmax(1)
    score = 1.0 / np.exp(logs).sum(1)
    known = [LETTER.search(t) is not None for t in texts]
    return [model.labels[k] if ok else UNKNOWN for k, ok in zip(best, known)], [float(s) if ok else 0.0 for s, ok in zip(score, known)]


def language_of(spark: SparkSession, model: LanguageModel | None, text: Column) -> Column:
    """Struct ``(lang_pred, score)`` of a text column; the matrix is broadcast (LABELS x BUCKETS floats at most)."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(tuple(model))  # plain: workers need not have this module

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def score(column: pa.Array) -> pa.Array:
        langs, scores = predict(LanguageModel(*shared.value), strings(column))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return score(text)


def identify(df: DataFrame, key: str, text: str, label: str, folds: int = 5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``(key, held_out, lang_pred, score)`` for every row; rows whose key falls into fold 0 teach nothing."""
    model = fit(df.filter(fold_of(key, folds) != 0), text, label, fit_rows)
    return df.select(
        F.col(key), (fold_of(key, folds) == 0).alias("held_out"), language_of(df.sparkSession, model, F.col(text)).alias("found")
    ).select(F.col(key), "held_out", "found.lang_pred", "found.score")


def keep_identified(
    df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", least: float = LEAST_SCORE, relabel: float = RELABEL_SCORE
) -> DataFrame:
    """The rows of ``df`` whose text has a language that is told with a score of ``least`` or more.

    A null label becomes the language found, and so does another label if the score is ``relabel`` or more; nothing else changes. If
    nothing can be learned, all rows with a letter stay as they are. Repeated rows are judged alike; an empty table stays empty.
    """
    model = fit(df.filter(fold_of(key, 5) != 0), text, label)
    if model is None:
        return df.filter(F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    shared = df.sparkSession.sparkContext.broadcast(tuple(model))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def found(column: pa.Array) -> pa.Array:
        langs, scores = [], []
        for piece in row_slices(column):
            for into, values in zip((langs, scores), predict(LanguageModel(*shared.value), strings(piece))):
                into += values
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    names = df.columns
    plain = plain_names(df)
    given = F.col(f"c{place(df, label)}")
    # not deterministic to the planner: it would run the function once for the filter and once for the labels
    judged = found.asNondeterministic()(F.col(f"c{place(df, text)}"))
    kept = plain.withColumn("found", judged).filter((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= least))
    changed = F.when(given.isNull() | (F.col("found.score") >= relabel), F.col("found.lang_pred")).otherwise(given)
    at = place(df, label)
    return kept.select(*[changed.alias(f"c{i}") if i == at else F.col(f"c{i}") for i in range(len(names))]).toDF(*names)


@query("op7_langid")
def langid_query(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"), "doc_id", "text", "lang")

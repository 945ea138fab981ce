"""Retrieval by words: the k best texts of every question by BM25.

A bounded set of question terms is broadcast. The texts are read twice: once to count how many hold each asked term, once to be scored where
they are, in numpy; each task keeps its k best texts of every question, so neither postings nor pairs of texts and questions are written or
shuffled. A larger set of questions meets the postings ``(term, id, weight)`` on the term; the postings of a frequent term are spread over
several salts with its few question rows copied to each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.functions.vectors import tokens
from loreweave.operators.search import DIGITS, topk_per_query
from loreweave.session import SMALL_ROWS, written

SATURATION, LENGTH_WEIGHT = 1.2, 0.75
SALT_ROWS = 1 << 20  # postings of a term that one salt holds, about
SLICE_ROWS = 1 << 10  # texts whose terms are numbered at a time
PAIRS = 1 << 20  # pairs of a text and a question, or of a posting and a question, that are scored at a time, about


def words(text: Column) -> Column:
    return tokens(F.lower(text))


@F.arrow_udf(T.MapType(T.StringType(), T.IntegerType()))
def counts(lists: pa.Array) -> pa.Array:
    """How often each word of a list occurs."""
    found = [Counter(words) for words in lists.to_pylist()]
    ends = np.cumsum([0, *map(len, found)])
    keys, times = (pa.array([x for c in found for x in part(c)], kind) for part, kind in ((dict.keys, pa.string()), (dict.values, pa.int32())))
    return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), keys, times)


@dataclass(frozen=True)
class Index:
    """Texts ``(id, text)`` and how their words are weighed.

    A term in ``n`` of ``N`` texts counts ln(1 + (N - n + 0.5) / (n + 0.5)). Null and empty texts have no terms but are among ``N``.
    """

    texts: DataFrame
    saturation: float
    length_weight: float

    def terms(self) -> DataFrame:
        return self.texts.select("id", words(F.col("text")).alias("terms"))

    def postings(self) -> DataFrame:
        """``(term, id, weight, texts_with)``: one row for each distinct term of a text."""
        held = self.terms().where(F.size("terms") > 0)
        # a text is one row, so its words are counted where they are found, without a shuffle
        found = held.select("id", F.size("terms").alias("length"), F.explode(counts("terms")).alias("term", "times"))
        counted = found.select("id", "length", "term", F.col("times").cast("long").alias("times"))
        # words are found once: everything below reads the written counts
        each = written(counted, "terms")
        n = self.texts.agg(F.count(F.lit(1)).alias("n")).scalar()
        mean = each.agg(F.sum("times").alias("all")).scalar() / n
        # one short row for each distinct term
        spread = each.groupBy("term").agg(F.count(F.lit(1)).alias("texts_with"))
        rarity = F.log(1 + (n - F.col("texts_with") + 0.5) / (F.col("texts_with") + 0.5))
        damped = F.col("times") + self.saturation * (1 - self.length_weight + self.length_weight * F.col("length") / mean)
        return each.join(spread, "term").select("term", "id", (rarity * F.col("times") * (self.saturation + 1) / damped).alias("weight"), "texts_with")


def postings(texts: DataFrame, saturation: float = SATURATION, length_weight: float = LENGTH_WEIGHT) -> Index:
    """What ``bm25_topk`` searches: the texts ``(id, text)``."""
    return Index(texts, saturation, length_weight)


def _found(lists: pa.Array, asked: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, term, times, lengths)``: the distinct asked terms of each list, by row and number of the term, and the lengths of all lists."""
    held = lists.fill_null([]) if lists.null_count else lists
    lengths = held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    every = held.flatten().dictionary_encode()
    number = pc.fill_null(pc.index_in(every.dictionary, value_set=asked), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    code = number[every.indices.to_numpy(zero_copy_only=False)] if len(every) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(held)), lengths)
    pairs, times = np.unique((row * len(asked) + code)[code >= 0], return_counts=True)
    return pairs // max(len(asked), 1), pairs % max(len(asked), 1), times, lengths


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _counted(index: Index, terms: pa.Array) -> tuple[int, int, np.ndarray]:
    """How many texts there are, how many words they have, and how many texts hold each of ``terms``: one pass, one row of each task."""
    held = index.texts.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = held.value
        texts, length, spread = 0, 0, np.zeros(len(asked), np.int64)
        for part in _slices(batches, SLICE_ROWS):
            _, term, _, lengths = _found(part.column("terms"), asked)
            texts, length = texts + len(lengths), length + int(lengths.sum())
            spread += np.bincount(term, minlength=len(asked))
        # the totals are numbered -1 and -2
        some = np.flatnonzero(spread)
        numbers, values = np.concatenate([[-1, -2], some]), np.concatenate([[texts, length], spread[some]])
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(values, pa.int64())], ["number", "value"])

    sums = index.terms().select("terms").mapInArrow(run, "number long, value long").groupBy("number").agg(F.sum("value").alias("value"))
    found = {r["number"]: r["value"] for r in sums.collect()}  # at most one row for each asked term
    return found.get(-1, 0), found.get(-2, 0), np.array([found.get(i, 0) for i in range(len(terms))], np.float64)


def _scored(index: Index, asked: pa.Table, qid: T.DataType, k: int) -> DataFrame:
    """``(qid, id, score)``: the k best texts of each task for every question, from the question terms ``(qid, term)``."""
    words_of, questions = (asked[c].combine_chunks().dictionary_encode() for c in ("term", "qid"))
    terms, qids = words_of.dictionary, questions.dictionary
    n, length, spread = _counted(index, terms)
    rarity = np.log(1 + (n - spread + 0.5) / (spread + 0.5))
    # the questions of each term, one term after another
    term, question = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (words_of, questions))
    order = np.argsort(term, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
    held = index.texts.sparkSession.sparkContext.broadcast((terms, qids, rarity, ends, question[order]))
    mean, saturation, length_weight = length / max(n, 1), index.saturation, index.length_weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, qids, rarity, ends, question = held.value
        many, best, least = len(qids), None, np.zeros(len(qids))
        for part in _slices(batches, max(1, min(SLICE_ROWS, PAIRS // max(many, 1)))):
            row, term, times, lengths = _found(part.column("terms"), terms)
            if not len(row):
                continue
            damped = times + saturation * (1 - length_weight + length_weight * lengths[row] / mean)
            weight = rarity[term] * times * (saturation + 1) / damped
            scores, upto = np.zeros(part.num_rows * many), np.concatenate([[0], np.cumsum(ends[term + 1] - ends[term])])
            at = 0
            while at < len(row):
                to = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS, side="right")) - 1)
                sizes = upto[at + 1 : to + 1] - upto[at:to]
                of = np.arange(upto[to] - upto[at]) + np.repeat(ends[term[at:to]] - (upto[at:to] - upto[at]), sizes)
                first, last = int(row[at]) * many, (int(row[to - 1]) + 1) * many
                place = np.repeat(row[at:to] * many - first, sizes) + question[of]
                scores[first:last] += np.bincount(place, np.repeat(weight[at:to], sizes), minlength=last - first)
                at = to
            scores = scores.reshape(part.num_rows, many)
            rounded = np.round(scores, DIGITS)
            # a score is above 0 where a word is shared; what is below the k-th best so far can't be among the best
            texts, of = np.nonzero((scores > 0) & (rounded >= least))
            found = [pa.array(of, pa.int64()), part.column("id").take(pa.array(texts)), pa.array(rounded[texts, of], pa.float64())]
            best = _best(pa.Table.from_arrays(found, ["q", "id", "score"]), best, k)
            q, score = (best[c].to_numpy() for c in ("q", "score"))
            last = np.flatnonzero(np.append(q[1:] != q[:-1], True))
            full = last[np.diff(last, prepend=-1) == k]
            least[q[full]] = score[full]
        if best is not None and best.num_rows:
            best = best.combine_chunks()
            columns = [qids.take(best["q"].combine_chunks()), best["id"].combine_chunks(), best["score"].combine_chunks()]
            yield pa.RecordBatch.from_arrays(columns, ["qid", "id", "score"])

    types = [T.StructField("id", index.texts.schema["id"].dataType), T.StructField("score", T.DoubleType())]
    return index.terms().mapInArrow(run, T.StructType([T.StructField("qid", qid), *types]))


def _best(found: pa.Table, best: pa.Table | None, k: int) -> pa.Table:
    """The k best rows ``(q, id, score)`` of every question, by question and rank."""
    both = found if best is None else pa.concat_tables([best, found])
    both = both.take(pc.sort_indices(both, sort_keys=[("q", "ascending"), ("score", "descending"), ("id", "ascending")]))
    q = both["q"].to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])[: len(q)])
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return both.filter(pa.array(rank < k))


def bm25_topk(index: Index, questions: DataFrame, k: int, limit: int = SMALL_ROWS, salt_rows: int = SALT_ROWS) -> DataFrame:
    """``(qid, id, score, rank)`` of ``questions (qid, question)``: the k best texts that share a word with the question.

    Scores are rounded before ranking; ties go to the smaller id. A word that a question repeats counts once.
    """
    asked = questions.select("qid", F.explode(F.array_distinct(words(F.col("question")))).alias("term"))
    order = [F.desc("score"), F.col("id")]
    few = asked.limit(limit + 1).toArrow()
    if few.num_rows <= limit:
        return topk_per_query(_scored(index, few, asked.schema["qid"].dataType, k), k, order=order)
    weighed = index.postings()
    salts = F.ceil(F.col("texts_with") / F.lit(salt_rows)).cast("int")
    parts = weighed.groupBy("term").agg(F.max(salts).alias("salts"))
    copied = asked.join(parts, "term").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    met = weighed.withColumn("salt", F.pmod(F.xxhash64("id"), salts).cast("int")).join(copied, ["term", "salt"])
    scored = met.groupBy("qid", "id").agg((F.round(F.sum("weight"), DIGITS) + F.lit(0.0)).alias("score"))
    return topk_per_query(scored, k, order=order)

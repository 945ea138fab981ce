"""Vocabulary tables ``(id, piece, ...)``: merge, statistics, greedy segmentation, fertility."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.functions.vectors import tokens
from loreweave.operators.ordered import Segments, totals_before
from loreweave.operators.training import SPECIAL_PIECES
from loreweave.operators.trie import Trie, piece_counts, piece_lists, word_bytes
from loreweave.session import bounded_rows

VOCAB_LIMIT = 1 << 20


def vocab_new_pieces(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of vocabulary ``b`` whose piece ``a`` lacks."""
    return b.join(a.select("piece").distinct(), "piece", "left_anti").select(*b.columns)


def vocab_merge(a: DataFrame, b: DataFrame, dedup_b: bool = False) -> DataFrame:
    """``a`` unchanged, then the new pieces of ``b`` in their order with score 0: ``(id, piece, score)``.

    A piece that ``b`` repeats is appended each time unless ``dedup_b``.
    """
    new = vocab_new_pieces(a, b).select("id", "piece")
    if dedup_b:
        new = new.groupBy("piece").agg(F.min("id").alias("id"))
    base = a.agg(F.count(F.lit(1))).scalar()
    new = totals_before(new.withColumn("_all", F.lit(0)), ["_all"], ["id"], Segments(), {"_rank": F.lit(1)})
    score = F.col("score") if "score" in a.columns else F.lit(0.0)
    return a.select(F.col("id").cast("int").alias("id"), "piece", score.cast("float").alias("score")).unionByName(
        new.select(
            (base + F.col("_rank")).cast("int").alias("id"),
            "piece",
            F.lit(0.0).cast("float").alias("score"),
        )
    )


def vocab_stats(before: DataFrame, after: DataFrame, special: Sequence[str] = SPECIAL_PIECES) -> DataFrame:
    """Pieces, distinct pieces and special pieces of a vocabulary before and after a merge."""

    def stats(df: DataFrame, stage: str) -> DataFrame:
        return df.agg(
            F.lit(stage).alias("stage"),
            F.count(F.lit(1)).alias("pieces"),
            F.countDistinct("piece").alias("distinct_pieces"),
            F.sum(F.col("piece").isin(*special).cast("long")).alias("special_pieces"),
        )

    return stats(before, "before").unionByName(stats(after, "after"))


def broadcast_trie(spark: SparkSession, vocabs: Sequence[DataFrame]) -> Broadcast[Trie]:
    """The pieces of vocabularies of at most ``VOCAB_LIMIT`` rows each, as one trie on every executor."""
    return spark.sparkContext.broadcast(
        Trie([[r["piece"] for r in bounded_rows(v.select("piece"), "vocabulary", VOCAB_LIMIT)] for v in vocabs])
    )


def encode_greedy(df: DataFrame, word: str, vocab: DataFrame, name: str = "pieces") -> DataFrame:
    """Split each word from the left into the longest vocabulary pieces; a lost character stands alone.

    ``df`` should hold distinct words, so that each is segmented once.  A null word has null pieces, an empty one none.
    """
    trie = broadcast_trie(df.sparkSession, [vocab])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, piece_lists(batch.column(word), trie.value)], [*batch.schema.names, name]
            )

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.ArrayType(T.StringType()))]))


def greedy_counts(df: DataFrame, word: str, vocabs: dict[str, DataFrame]) -> DataFrame:
    """How many pieces each word has under each of the vocabularies, a long column for each name.

    Words are segmented under all vocabularies in one pass.  A null or empty word has 0 pieces.
    """
    trie, names = broadcast_trie(df.sparkSession, list(vocabs.values())), list(vocabs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = word_bytes(batch.column(word))
            counts = [pa.array(np.diff(piece_counts(m, offsets))) for m in trie.value.piece_starts(data, offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts], [*batch.schema.names, *names])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *[T.StructField(k, T.LongType()) for k in names]]))


def vocab_fertility(df: DataFrame, text: Column, group: str, vocabs: dict[str, DataFrame]) -> DataFrame:
    """Pieces per character of the words of a corpus, per group, under several vocabularies.

    Words are counted first (combined before the shuffle), so every distinct word is segmented once, under all
    vocabularies together.
    """
    counts = {f"_k{i}": vocab for i, vocab in enumerate(vocabs.values())}
    words = (
        df.select(group, F.explode(tokens(text)).alias("word"))
        .groupBy(group, "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    words = greedy_counts(words, "word", counts)
    per_vocab = F.array(*[F.struct(F.lit(name).alias("vocab"), F.col(k).alias("k")) for k, name in zip(counts, vocabs, strict=True)])
    sums = (
        words.select(group, "n", F.length("word").alias("_chars"), F.inline(per_vocab))
        .groupBy(group, "vocab")
        .agg(F.sum(F.col("k") * F.col("n")).alias("pieces"), F.sum(F.col("_chars") * F.col("n")).alias("chars"))
    )
    return sums.withColumn("fertility", F.round(F.col("pieces") / F.col("chars"), 6))

"""Side-by-side answers of several systems, their ratings, and flagged exchanges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loreweave.functions.text import parse_rating
from loreweave.operators.chat import last_exchange
from loreweave.session import bounded_rows

MODEL_ROWS = 1024


def model_names(models: DataFrame) -> list[str]:
    """Names in the registry, at most ``MODEL_ROWS``."""
    return sorted(r["name"] for r in bounded_rows(models.select("name").distinct(), "model registry", MODEL_ROWS))


def answer_matrix(questions: DataFrame, models: DataFrame) -> DataFrame:
    """One row per question and model, ready for the answer hook; the registry becomes one literal array."""
    names = F.array(*[F.lit(n) for n in model_names(models)])
    return questions.withColumn("model", F.explode(names))


def ratings_by_model(rated: DataFrame, rating_text: Column, by: str = "model") -> DataFrame:
    """Parsed ratings per model: count, how many were no whole number, and the average."""
    return (
        rated.select(by, parse_rating(rating_text).alias("_r"))
        .groupBy(by)
        .agg(
            F.count("_r").alias("ratings"),
            F.count_if(F.col("_r").isNull()).alias("unparsed"),
            F.round(F.avg("_r"), 6).alias("avg_rating"),
        )
    )


def answers_wide(answers: DataFrame, names: Sequence[str], question: str = "qid", answer: str = "answer") -> DataFrame:
    """One column per model."""
    return answers.groupBy(question).pivot("model", list(names)).agg(F.first(answer))


def flag_filter(exchanges: DataFrame, flag_input: DataFrame) -> DataFrame:
    """Rows to flag: a non-empty input, with the last answers of a conversation that has any.

    ``exchanges`` is ``(conv_id, turn, answer_a, answer_b)``, ``flag_input`` is ``(conv_id, input, ...)``.
    """
    last = last_exchange(exchanges, ["answer_a", "answer_b"]).drop("turn")
    return flag_input.where(F.length("input") > 0).join(last, "conv_id")

"""Every question to every model, rated and tabulated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.functions.hooks import answered, generate_text
from loreweave.functions.templates import RATING_TEMPLATE, fill_template
from loreweave.operators.compare import answer_matrix, answers_wide, model_names, ratings_by_model


def rated_answers(
    questions: DataFrame, models: DataFrame, answer_client: Callable, rating_client: Callable
) -> tuple[DataFrame, DataFrame]:
    """``(qid, model, answer, rating_text)`` of the calls that gave an answer and a rating, and the rejected
    ``(qid, model, step, error)`` of those that failed: a failed answer is never rated."""
    asked = answer_matrix(questions, models).withColumn("_prompt", F.concat_ws("\n", "model", "question"))
    # both are read twice: the models must not be asked again
    answers = generate_text(asked, "_prompt", "answer", answer_client, keep=True)
    prompts = answered(answers).drop("error").withColumn("_rate", fill_template(RATING_TEMPLATE, {"answer": F.col("answer")}))
    rated = generate_text(prompts, "_rate", "rating_text", rating_client, keep=True)

    def failed(df: DataFrame, step: str) -> DataFrame:
        return df.where(F.col("error").isNotNull()).select("qid", "model", F.lit(step).alias("step"), "error")

    return answered(rated).select("qid", "model", "answer", "rating_text"), failed(answers, "answer").unionByName(failed(rated, "rating"))


def model_bakeoff(
    questions: DataFrame, models: DataFrame, answer_client: Callable, rating_client: Callable
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Answers with one column per model, ratings per model, and rejected calls."""
    rated, rejected = rated_answers(questions, models, answer_client, rating_client)
    return answers_wide(rated, model_names(models)), ratings_by_model(rated, F.col("rating_text")), rejected

"""The model call: prompts in, texts out, batch-wise and with errors kept in a column."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.session import written

Client = Callable[[Sequence[str]], Sequence[str]]


def echo_client() -> Client:
    """Answers with the prompt; for tests and dry runs."""
    return lambda prompts: list(prompts)


def prompt_key(prompt: Column) -> Column:
    """Key under which the answer to a prompt can be stored and reused."""
    return F.sha2(prompt, 256)


def generate_text(
    df: DataFrame,
    prompt: str,
    answer: str = "answer",
    make_client: Callable[[], Client] = echo_client,
    *,
    batch: int = 256,
    keep: bool = False,
) -> DataFrame:
    """Add ``answer`` and ``error``.  ``make_client`` is called once per task; a failing batch is tried
    prompt by prompt, and a prompt that still fails gets a null answer and its error.

    With ``keep`` the result is written to the shared folder, so that later use does not ask again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()

        def one(text: str) -> tuple[str | None, str | None]:
            try:
                return client([text])[0], None
            except Exception as e:  # noqa: BLE001 - the error is data
                return None, f"{type(e).__name__}: {e}"

        def several(texts: list[str]) -> list[tuple[str | None, str | None]]:
            try:
                answers = list(client(texts))
                if len(answers) != len(texts):
                    raise ValueError("client returned another number of answers")
                return [(a, None) for a in answers]
            except Exception:  # noqa: BLE001
                return [one(t) for t in texts]

        for pdf in batches:
            texts = pdf[prompt].tolist()
            pairs = [p for at in range(0, len(texts), batch) for p in several(texts[at : at + batch])]
            yield pdf.assign(**{answer: [a for a, _ in pairs], "error": [e for _, e in pairs]})

    schema = T.StructType(
        [*df.schema.fields, T.StructField(answer, T.StringType()), T.StructField("error", T.StringType())]
    )
    out = df.mapInPandas(run, schema)
    return written(out, "answers") if keep else out


def answered(df: DataFrame) -> DataFrame:
    """Rows whose model call succeeded; only these may enter a history."""
    return df.where(F.col("error").isNull())

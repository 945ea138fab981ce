"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# characters that a task turns into number arrays at a time; longer texts are cut by the callers that need it
SLICE_CHARS = 1 << 20
# rows that a task turns into Python objects at a time
SLICE_ROWS = 256


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Borders ``[a, b)`` of runs of texts with about ``most`` characters together; one text is never cut."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def strings(column: pa.Array) -> list[str]:
    """The texts of an Arrow column; null counts as empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


def row_slices(batch, rows: int = SLICE_ROWS) -> Iterator:
    """Runs of rows of an Arrow batch or array, so that a task never holds a whole batch as Python objects."""
    for a in range(0, len(batch), rows):
        yield batch.slice(a, rows)


def fold_of(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as an empty one."""
    return (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(folds)).cast("int")


def sample_of(df: DataFrame, by: Column, most: int) -> DataFrame:
    """About ``most`` rows, chosen by a hash of ``by``, the same ones on every run; all rows if there are fewer."""
    n = df.count()
    if n <= most:
        return df
    share = most / n
    return df.filter((F.pmod(F.xxhash64(by, F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))) < F.lit(share))


def plain_names(df: DataFrame) -> DataFrame:
    """The same rows with columns ``c0, c1, ...``: safe for names that clash with those used inside an operator."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place(df: DataFrame, name: str) -> int:
    """Position of the first column of that name."""
    return df.columns.index(name)

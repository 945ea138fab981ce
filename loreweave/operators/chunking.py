"""Cut documents into chunks."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.functions.vectors import token_slices

SEPARATORS = ("\n\n", "\n", " ", "")
SLICE_BYTES = 1 << 20  # bytes of the texts that a task cuts at a time, about; one text is never divided


def chunk_key(doc: str, chunk_no: str) -> Column:
    """One id per chunk: document id and chunk number as digits of fixed length, so that ids of documents from 0 up sort like numbers.

    Any two chunks differ, whatever 64-bit document ids there are.
    """
    number, part = (F.lpad(F.col(c).cast("string"), n, "0") for c, n in ((doc, 20), (chunk_no, 10)))
    return F.concat(number, F.lit("-"), part)


def chunk_fixed(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """Windows of ``size`` characters that share ``overlap``; adds ``chunk_no`` and replaces the text."""
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be below size")
    more = F.ceil(F.greatest(F.length(text) - F.lit(size), F.lit(0)) / F.lit(step)).cast("int")
    others = [c for c in df.columns if c != text]
    return df.select(*others, text, F.explode(F.sequence(F.lit(0), more)).alias("chunk_no")).select(
        *others, "chunk_no", F.col(text).substr(F.col("chunk_no") * step + 1, F.lit(size)).alias(text)
    )


def merge_parts(parts: Iterable[str], sep: str, size: int, overlap: int, measure: Callable[[str], int] = len) -> Iterator[str]:
    """Join parts greedily up to ``size``; a new chunk starts with the last parts that fit into ``overlap``.

    A part longer than ``size`` is a chunk of its own.
    """
    held: deque[tuple[str, int]] = deque()
    gap, total = measure(sep), 0
    for part in parts:
        n = measure(part)
        if held and total + gap + n > size:
            yield sep.join(p for p, _ in held)
            while held and (total > overlap or total + gap + n > size):
                total -= held.popleft()[1] + (gap if held else 0)
        total += n + (gap if held else 0)
        held.append((part, n))
    if held:
        yield sep.join(p for p, _ in held)


def split_recursive(
    text: str, size: int, overlap: int, separators: Sequence[str] = SEPARATORS, measure: Callable[[str], int] = len
) -> Iterator[str]:
    """Split on the first separator present; parts above ``size`` are split again with the later ones."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    sep, later = separators[at], separators[at + 1 :]
    parts = [p for p in (text.split(sep) if sep else text) if p]
    run: list[str] = []
    for part in parts:
        if measure(part) <= size or not later:
            run.append(part)
            continue
        yield from merge_parts(run, sep, size, overlap, measure)
        run = []
        yield from split_recursive(part, size, overlap, later, measure)
    yield from merge_parts(run, sep, size, overlap, measure)


def _chunked(df: DataFrame, text: str, size: int, cut: Callable[[str], Iterator[str]]) -> DataFrame:
    """Apply ``cut`` to some texts of a batch at a time, one row in and n rows out; blank chunks go, the others are stripped."""
    others = [c for c in df.columns if c != text]
    schema = T.StructType(
        [
            *[df.schema[c] for c in others],
            T.StructField("chunk_no", T.IntegerType()),
            T.StructField(text, T.StringType()),
            T.StructField("too_long", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in token_slices(lengths, SLICE_BYTES):
                rows = batch.slice(a, b - a)
                chunks = [[c for c in (raw.strip() for raw in cut(t or "")) if c] for t in rows.column(text).to_pylist()]
                row = pa.array(np.repeat(np.arange(len(chunks)), [len(c) for c in chunks]))
                number = pa.array([i for c in chunks for i in range(len(c))], pa.int32())
                texts = [x for c in chunks for x in c]
                long = pa.array([len(x) > size for x in texts], pa.bool_())
                columns = [*[rows.column(c).take(row) for c in others], number, pa.array(texts, rows.column(text).type), long]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(*others, text).mapInArrow(run, schema)


def chunk_separator(
    df: DataFrame, text: str, sep: str = "\n", size: int = 1000, overlap: int = 200, measure: Callable[[str], int] = len
) -> DataFrame:
    """Split on one separator and merge up to ``size``: adds ``chunk_no`` and ``too_long``."""
    return _chunked(
        df, text, size, lambda t: merge_parts((p for p in t.split(sep) if p), sep, size, overlap, measure)
    )


def chunk_recursive(
    df: DataFrame,
    text: str,
    size: int = 600,
    overlap: int = 100,
    separators: Sequence[str] = SEPARATORS,
    measure: Callable[[str], int] = len,
) -> DataFrame:
    """Split by paragraph, line, word and character as needed: adds ``chunk_no`` and ``too_long``."""
    return _chunked(df, text, size, lambda t: split_recursive(t, size, overlap, separators, measure))

"""Hashed text vectors and 4-bit packed vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as one token everywhere in this package.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
DIMS = 64
SLICE_TOKENS = 1 << 17  # tokens whose places a task holds as numbers at a time


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def token_slices(lengths: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Borders ``[a, b)`` of runs of lists with about ``most`` tokens together; one list is never cut."""
    upto = np.concatenate([[0], np.cumsum(lengths + 1)])
    at = 0
    while at < len(lengths):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + (most or SLICE_TOKENS), side="right")) - 1)
        yield at, to
        at = to


def embed_hashed(text: Column, dims: int = DIMS) -> Column:
    """Signed feature hashing of the tokens, L2-normalised; a text without tokens gives zeros.

    Token ``t`` with ``h = md5(t)`` adds +1 or -1 (by the parity of hex digit 16) to component
    ``int(h[:15], 16) % dims``.  Every distinct token of a batch is hashed once.
    """

    @F.arrow_udf("array<float>")
    def embedded(batch: pa.Array) -> pa.Array:
        held = batch.fill_null([]) if batch.null_count else batch
        words = held.flatten().dictionary_encode()
        hashes = [hashlib.md5(t.encode()).hexdigest() for t in words.dictionary.to_pylist()]
        dim = np.array([int(h[:15], 16) % dims for h in hashes], dtype=np.int64)
        sign = np.array([1.0 - 2.0 * (int(h[15], 16) % 2) for h in hashes])
        code = words.indices.to_numpy(zero_copy_only=False)
        lengths = held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        vec = np.zeros((len(held), dims), np.float32)
        for a, b in token_slices(lengths):
            part = code[ends[a] : ends[b]]
            if not len(part):
                continue
            row = np.repeat(np.arange(b - a), lengths[a:b])
            sums = np.bincount(row * dims + dim[part], weights=sign[part], minlength=(b - a) * dims).reshape(b - a, dims)
            norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
            vec[a:b] = sums / np.where(norm == 0, 1.0, norm)
        return pa.ListArray.from_arrays(np.arange(len(held) + 1, dtype=np.int32) * dims, vec.ravel())

    return embedded(tokens(F.replace(text, F.lit("\n"), F.lit(" "))))


def embed_text(text: Column, fn: Callable[[pd.Series], pd.Series] | None = None) -> Column:
    """Hook for an embedding model: ``fn`` maps a batch of texts to a batch of float lists.

    Newlines become spaces first.  Without ``fn`` the texts are hashed.
    """
    if fn is None:
        return embed_hashed(text)
    return F.pandas_udf(fn, "array<float>")(F.replace(text, F.lit("\n"), F.lit(" ")))


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two vectors of one length, in double."""
    parts = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


# 4-bit vectors: eight values per 32-bit integer, lowest four bits first; every `group` values share
# a scale and, optionally, an addend.


def vec_quant_q4(vec: Column, group: int = 32, addends: bool = False) -> Column:
    """Struct ``(q, scales, addends)`` whose ``vec_dequant_q4`` is within half a step of ``vec``.

    All vectors have one length, a multiple of 8 and of ``group``.
    """

    @F.arrow_udf("struct<q: array<int>, scales: array<double>, addends: array<double>>")
    def packed(batch: pa.Array) -> pa.Array:
        rows = len(batch)
        dims = len(batch[0]) if rows else group
        x = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, dims // group, group)
        if addends:
            low = x.min(axis=2, keepdims=True)
            scale, zero = (x.max(axis=2, keepdims=True) - low) / 15.0, 0
        else:
            low = np.zeros((rows, dims // group, 1))
            scale, zero = np.abs(x).max(axis=2, keepdims=True) / 7.0, 8
        steps = np.floor((x - low) / np.where(scale == 0, 1.0, scale) + 0.5) + zero
        levels = np.clip(steps, 0, 15).astype(np.uint32).reshape(rows, dims // 8, 8)
        words = (levels << (4 * np.arange(8, dtype=np.uint32))).sum(axis=2, dtype=np.uint32).view(np.int32)

        def lists(values: np.ndarray) -> pa.Array:
            ends = np.arange(rows + 1, dtype=np.int32) * values.shape[1]
            return pa.ListArray.from_arrays(ends, values.ravel())

        no_addends = pa.nulls(rows, pa.list_(pa.float64()))
        return pa.StructArray.from_arrays(
            [lists(words), lists(scale[:, :, 0]), lists(low[:, :, 0]) if addends else no_addends],
            names=["q", "scales", "addends"],
        )

    return packed(vec)


def vec_dequant_q4(q: Column, scales: Column, addends: Column | None = None) -> Column:
    """Values ``scale * level + addend``; without addends ``scale * (level - 8)``."""
    levels = F.flatten(
        F.transform(
            q,
            lambda word: F.array(*[F.shiftrightunsigned(word, 4 * b).bitwiseAND(F.lit(15)) for b in range(8)]),
        )
    )
    group = F.floor(F.size(q) * 8 / F.size(scales)).cast("int")

    def value(level: Column, i: Column) -> Column:
        g = F.floor(i / group).cast("int")
        plain = F.get(scales, g) * (level - F.lit(8))
        if addends is None:
            return plain
        return F.when(addends.isNull(), plain).otherwise(F.get(scales, g) * level + F.get(addends, g))

    return F.transform(levels, value)


def vec_regroup(per_group: Column, factor: int) -> Column:
    """Repeat each scale (or addend) for ``factor`` smaller groups."""
    return F.flatten(F.transform(per_group, lambda s: F.array_repeat(s, factor)))


def distance(a: Column, b: Column, metric: str = "l2") -> Column:
    """Distance of two vectors in double: ``l2``, ``l2sq``, ``cosine`` or ``ip``."""

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)

    if metric in ("l2", "l2sq"):
        squares = F.zip_with(a, b, lambda u, v: F.pow(u.cast("double") - v.cast("double"), F.lit(2.0)))
        total = F.aggregate(squares, F.lit(0.0), lambda acc, p: acc + p)
        return F.sqrt(total) if metric == "l2" else total
    if metric == "ip":
        return F.lit(1.0) - dot(a, b)
    if metric == "cosine":
        norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
        return F.when(norms == 0, F.lit(1.0)).otherwise(F.lit(1.0) - dot(a, b) / norms)
    raise ValueError(f"unknown metric {metric!r}")

"""Recency and relevance scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours_passed(now: Column, then: Column) -> Column:
    """Hours between two times as double; ISO strings are accepted, unreadable ones give null."""

    def micros(x: Column) -> Column:
        return F.unix_micros(x.try_cast("timestamp"))

    return (micros(now) - micros(then)).cast("double") / F.lit(3.6e9)


def logistic_relevance(distance: Column, mode: str = "reference") -> Column:
    """Relevance from a distance.

    ``reference`` grows with the distance, from 0 towards 0.5; ``inverse`` is ``1 / (1 + d)``.
    """
    if mode == "inverse":
        return F.lit(1.0) / (F.lit(1.0) + distance)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-distance / F.lit(100000.0))) - F.lit(0.5)


def relevance(distance: Column, fn: Callable[[Column], Column] | None = logistic_relevance) -> Column:
    if fn is None:
        raise ValueError("a relevance function is required")
    return fn(distance)


def memory_score(
    now: Column,
    last_accessed: Column,
    decay: float = 0.01,
    other_scores: Sequence[Column] = (),
    relevance: Column | None = None,
) -> Column:
    """``(1 - decay) ** hours`` plus every other score that is present."""
    score = F.pow(F.lit(1.0 - decay), hours_passed(now, last_accessed))
    for other in [*other_scores, *([relevance] if relevance is not None else [])]:
        score = score + F.coalesce(other.cast("double"), F.lit(0.0))
    return score

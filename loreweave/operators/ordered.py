"""Order-dependent work per key that stays bounded when one key holds a large share of the rows.

A plain window over ``partitionBy(key)`` puts a whole key into one task.  That is fine for ordinary keys, so only
long ones are cut into segments of neighbouring rows: windows run inside a segment, and what a segment must know about its
neighbours (a running total, the next row) is aggregated per segment, carried over the short list of segments, and
joined back on ``(key, segment)``.  Strings that span a key are returned in parts of at most ``part_chars`` characters;
an ordinary key is a single part 0.

Keys must not be null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loreweave.session import small_rows, written

SEG = "_seg"
# values of a counted order column, or rows of a long key, that one segment holds
SEGMENT_VALUES = 4096
SEGMENT_ROWS = 1 << 18
HOT_ROWS = 1 << 20
PART_CHARS = 1 << 20
WHOLE_CELL = 1 << 30


@dataclass
class Segments:
    """Keys with more than ``hot_rows`` rows, by a count of the keys alone, are cut into segments of at most ``rows`` rows."""

    rows: int = SEGMENT_ROWS
    hot_rows: int = HOT_ROWS

    def cut(self, df: DataFrame, keys: Sequence[str]) -> Cut:
        found = hot_counts(df, keys, self.hot_rows)
        return Cut(list(keys), self.rows, key_table(df, keys, found), None if found is None else sum(r["_n"] for r in found))


@dataclass
class Cut:
    """Segments of a table whose long keys are known.

    ``hot`` is a small table of them, an empty list if there are none, ``None`` if every key counts as long; they have ``total`` rows.
    """

    keys: list[str]
    rows: int
    hot: DataFrame | list | None
    total: int | None = None

    def cut(self, df: DataFrame, keys: Sequence[str]) -> Cut:
        return self

    def mark(self, df: DataFrame, order: Sequence[str]) -> DataFrame:
        """Add the segment, if it is not there yet; ordinary keys are one segment.

        The rows of long keys are range-partitioned by key and order; a partition is a segment. Sampled borders are uneven, so
        twice the partitions needed are made. The rows are written with their segment, so that every later use sees the same borders.
        """
        if SEG in df.columns:
            return df
        if isinstance(self.hot, list):
            return df.withColumn(SEG, F.lit(None).cast("long"))
        hot = None if self.hot is None else F.broadcast(self.hot)
        long = df if hot is None else df.join(hot, self.keys, "left_semi")
        total = long.count() if self.total is None else self.total
        ranged = long.repartitionByRange(max(1, -(-2 * total // self.rows)), *self.keys, *order)
        placed = written(ranged.withColumn(SEG, F.spark_partition_id().cast("long")), "segments")
        if hot is None:
            return placed
        rest = df.join(hot, self.keys, "left_anti").withColumn(SEG, F.lit(None).cast("long"))
        return rest.unionByName(placed)

    def carried(self, marked: DataFrame) -> DataFrame | None:
        """The rows of the long keys, whose segments need a carry; ``None`` if there are no long keys."""
        if isinstance(self.hot, list):
            return None
        return marked if self.hot is None else marked.where(F.col(SEG).isNotNull())


@dataclass
class CountedCut:
    """Segments by the value of an order column that counts up from about 0 in every key; long keys have a row that meets ``beyond``."""

    number: Column
    beyond: Column

    def cut(self, df: DataFrame, keys: Sequence[str]) -> CountedCut:
        self.keys = list(keys)
        return self

    def mark(self, df: DataFrame, order: Sequence[str]) -> DataFrame:
        return df if SEG in df.columns else df.withColumn(SEG, self.number)

    def carried(self, marked: DataFrame) -> DataFrame | None:
        # the filter reaches the scan: without long keys this branch skips every row group and ends there
        return marked.join(marked.where(self.beyond).select(*self.keys).distinct(), self.keys, "left_semi")


def hot_counts(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> list | None:
    """Keys with more than ``rows`` rows and their counts ``_n``; ``None`` if there are too many to list.

    Reads the key columns only, and counts before the shuffle.
    """
    return small_rows(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows))


def key_table(df: DataFrame, keys: Sequence[str], found: list | None) -> DataFrame | list | None:
    if not found:
        return found
    return df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in found], df.select(*keys).schema)


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame | list | None:
    """Keys with more than ``rows`` rows: a small table, an empty list if there are none, ``None`` if there are too many."""
    return key_table(df, keys, hot_counts(df, keys, rows))


def counted_segments(order: str, length: int = SEGMENT_VALUES) -> CountedCut:
    """By an integer that counts up from about 0 in every key, so that long keys show by its value."""
    beyond = (F.col(order) >= F.lit(length)) | (F.col(order) <= F.lit(-length))
    return CountedCut(F.expr(f"`{order}` div {int(length)}"), beyond)


def totals_before(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    segments: Segments | Cut | CountedCut,
    values: Mapping[str, Column],
    *,
    descending: bool = False,
) -> DataFrame:
    """Add, for each name, the sum of its value over all earlier rows of the key (later, if descending)."""
    keys = list(keys)
    cut = segments.cut(df, keys)
    held = cut.mark(df, order)
    for name, value in values.items():
        held = held.withColumn(f"_v_{name}", value.cast("long"))
    inside = (
        W.partitionBy(*keys, SEG)
        .orderBy(*[F.desc(c) if descending else F.asc(c) for c in order])
        .rowsBetween(W.unboundedPreceding, -1)
    )
    here = {n: F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)) for n in values}
    rows = cut.carried(held)
    if rows is None:
        return held.select(*df.columns, *[c.alias(n) for n, c in here.items()])
    totals = rows.groupBy(*keys, SEG).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    seg_order = F.desc(SEG) if descending else F.asc(SEG)
    over_segments = W.partitionBy(*keys).orderBy(seg_order).rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(*keys, SEG, *[F.sum(f"_t_{n}").over(over_segments).alias(f"_c_{n}") for n in values])
    return held.join(carry, [*keys, SEG], "left").select(
        *df.columns, *[(F.coalesce(F.col(f"_c_{n}"), F.lit(0)) + c).alias(n) for n, c in here.items()]
    )


def with_next_row(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], segments: Segments | Cut | CountedCut
) -> DataFrame:
    """Add ``next_<column>``: the value in the following row of the key, across segment borders."""
    keys = list(keys)
    cut = segments.cut(df, keys)
    held = cut.mark(df, [order])
    # one window function per column, so that columns nobody asks for are pruned down to the scan
    inside = W.partitionBy(*keys, SEG).orderBy(order)
    after = {c: F.lead(c).over(inside) for c in columns}
    rows = cut.carried(held)
    if rows is None:
        return held.select(*df.columns, *[x.alias(f"next_{c}") for c, x in after.items()])
    heads = rows.groupBy(*keys, SEG).agg(*[F.min_by(c, order).alias(f"_h_{c}") for c in columns])
    over_segments = W.partitionBy(*keys).orderBy(SEG)
    carry = heads.select(*keys, SEG, *[F.lead(f"_h_{c}").over(over_segments).alias(f"_c_{c}") for c in columns])
    here = F.lead(F.lit(True)).over(inside).isNotNull()
    return held.join(carry, [*keys, SEG], "left").select(
        *df.columns, *[F.when(here, x).otherwise(F.col(f"_c_{c}")).alias(f"next_{c}") for c, x in after.items()]
    )


def text_spans(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: Column,
    sep: str,
    segments: Segments | Cut | CountedCut,
) -> DataFrame:
    """Place each row's text in the joined string of its key.

    Adds ``_piece`` (the text with the separator before it, except in the first row), ``_start`` (its
    character offset) and ``_before`` (how many characters the earlier rows make when joined).
    """
    width = len(sep)
    placed = totals_before(
        df.withColumn("_text", F.coalesce(text, F.lit(""))),
        keys,
        order,
        segments,
        {"_cum": F.length("_text") + F.lit(width), "_rows": F.lit(1)},
    )
    first = F.col("_rows") == 0
    before = F.when(first, F.lit(0)).otherwise(F.col("_cum") - F.lit(width)).cast("long")
    piece = F.when(first, F.col("_text")).otherwise(F.concat(F.lit(sep), F.col("_text")))
    return placed.select(*df.columns, piece.alias("_piece"), before.alias("_start"), before.alias("_before"))


def join_spans(spans: DataFrame, keys: Sequence[str], part_chars: int, *, overlap: bool = False) -> DataFrame:
    """Joined string of each key as rows ``(keys, part, text)``, at most ``part_chars`` characters each.

    With ``overlap`` part ``p`` holds parts ``p - 1`` and ``p``, so any ``part_chars`` characters that end
    inside part ``p`` are found in one row.
    """
    p = F.lit(int(part_chars)).cast("long")
    end = F.col("_start") + F.length("_piece")
    last = F.greatest(end - 1, F.col("_start"))
    pieces = spans.select(
        *keys,
        "_piece",
        "_start",
        end.alias("_end"),
        F.explode(
            F.sequence(F.expr(f"_start div {int(part_chars)}"), last_part(last, part_chars))
        ).alias("part"),
    )
    lo = F.greatest(F.col("_start"), F.col("part") * p)
    hi = F.least(F.col("_end"), (F.col("part") + 1) * p)
    pieces = pieces.select(
        *keys,
        "part",
        lo.alias("_lo"),
        F.col("_piece").substr((lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int")).alias("_slice"),
    )
    if overlap:
        pieces = pieces.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    # collect_list skips nulls, so a group never holds more rows than characters
    held = F.collect_list(F.when(F.length("_slice") > 0, F.struct("_lo", "_slice")))
    return pieces.groupBy(*keys, "part").agg(
        F.array_join(F.transform(F.array_sort(held), lambda x: x["_slice"]), "").alias("text")
    )


def last_part(position: Column, part_chars: int) -> Column:
    return F.floor(position / F.lit(int(part_chars))).cast("long")


def join_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text: Column,
    sep: str,
    segments: Segments | Cut | CountedCut,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """All texts of a key joined in order: ``(keys, part, text)``."""
    spans = text_spans(df, keys, order, text, sep, segments)
    return join_spans(spans, keys, part_chars)

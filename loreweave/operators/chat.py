"""Conversations: turn pairs, histories, prompts over whole tables, and event folding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loreweave.functions.templates import fill_template
from loreweave.operators.ordered import (
    PART_CHARS,
    SEG,
    WHOLE_CELL,
    Cut,
    Segments,
    counted_segments,
    join_ordered,
    join_spans,
    last_part,
    text_spans,
    totals_before,
    with_next_row,
)
from loreweave.session import written

TAIL_CHARS = 4096


def turn_pairs(df: DataFrame, asker: str = "user", answerer: str = "assistant") -> DataFrame:
    """Each asker turn with the answer that follows it: ``(conv_id, turn, input, output)``."""
    followed = with_next_row(df, ["conv_id"], "turn", ["role", "text"], counted_segments("turn"))
    return followed.where((F.col("role") == asker) & (F.col("next_role") == answerer)).select(
        "conv_id", "turn", F.col("text").alias("input"), F.col("next_text").alias("output")
    )


def labelled(asker: str, answerer: str) -> Column:
    """One exchange as the labels, the input and the output."""
    return F.concat(F.lit(asker), F.col("input"), F.lit("\n" + answerer), F.col("output"))


def history_text(pairs: DataFrame, line: Column, sep: str = "\n", part_chars: int = PART_CHARS) -> DataFrame:
    """The whole history of each conversation as ``(conv_id, part, text)``."""
    return join_ordered(pairs, ["conv_id"], ["turn"], line, sep, counted_segments("turn"), part_chars)


def _placed(pairs: DataFrame, line: Column, sep: str) -> DataFrame:
    """The lines with their places in the history, written once: the parts and the turns that read them are made of the same rows."""
    return written(text_spans(pairs, ["conv_id"], ["turn"], line, sep, counted_segments("turn")), "spans")


def history_before_turn(
    pairs: DataFrame, line: Column, sep: str = "\n", drop_last: int = 0, part_chars: int = PART_CHARS
) -> DataFrame:
    """The history available at each turn, without its last ``drop_last`` characters.

    One row per turn and part; part 0 is always there.  The history of a conversation is joined once
    and each turn takes its prefix, so the work does not grow with the square of the turns.
    """
    spans = _placed(pairs, line, sep)
    parts = join_spans(spans, ["conv_id"], part_chars)
    size = F.greatest(F.col("_before") - F.lit(drop_last), F.lit(0)).cast("long")
    wanted = spans.select("conv_id", "turn", size.alias("_size")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), last_part(F.greatest(F.col("_size") - 1, F.lit(0)), part_chars)))
    )
    keep = F.least(F.col("_size") - F.col("part") * F.lit(part_chars), F.lit(part_chars)).cast("int")
    return wanted.join(parts, ["conv_id", "part"], "left").select(
        "conv_id", "turn", "part", F.coalesce(F.col("text").substr(F.lit(1), keep), F.lit("")).alias("history")
    )


def history_tail(pairs: DataFrame, line: Column, sep: str, chars: Column, max_chars: int, name: str = "tail") -> DataFrame:
    """Add the last ``chars`` (at most ``max_chars``) characters of the history before each turn.

    Every turn reads one bounded part of its conversation's history.
    """
    # short parts: every turn copies from one
    size = max(int(max_chars), TAIL_CHARS)
    spans = _placed(pairs, line, sep)
    parts = join_spans(spans, ["conv_id"], size, overlap=True)
    wanted = spans.withColumn("part", last_part(F.col("_before"), size)).withColumn(
        "_take", F.greatest(F.least(chars, F.col("_before"), F.lit(int(max_chars))), F.lit(0))
    )
    base = F.greatest((F.col("part") - 1) * F.lit(size), F.lit(0))
    start = (F.col("_before") - F.col("_take") - base + 1).cast("int")
    return wanted.join(parts, ["conv_id", "part"], "left").select(
        *pairs.columns,
        F.coalesce(F.col("text").substr(start, F.col("_take").cast("int")), F.lit("")).alias(name),
    )


def ends_of_histories(lines: DataFrame, chars: int, sep: str = "\n") -> DataFrame:
    """``(conv_id, tail)``: the last ``chars`` characters of all lines ``(conv_id, turn, line)`` of a conversation, joined by ``sep``.

    A line with its separator has a character at least, so the last ``chars`` lines hold the tail; the limit on the rank is
    applied before the shuffle, and a line takes part with its last ``chars`` characters. Null lines are left out.
    """
    newest = W.partitionBy("conv_id").orderBy(F.desc("turn"))
    ends = lines.where(F.col("line").isNotNull()).select("conv_id", "turn", F.right("line", F.lit(chars)).alias("line"))
    last = ends.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= chars + 1)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda x: x["line"])
    return last.groupBy("conv_id").agg(F.right(F.array_join(ordered, sep), F.lit(chars)).alias("tail"))


def _prompt(pairs: DataFrame, line: Column, sep: str, opening: Column, max_chars: int, template: str) -> DataFrame:
    """Keep the last ``max_chars`` characters of history and opening (0 keeps all) and fill the template."""
    most = max_chars or WHOLE_CELL
    held = history_tail(pairs, line, sep, F.lit(most) - F.length(opening), most)
    kept = F.concat(F.col("tail"), F.right(opening, F.lit(most)))
    return held.select("conv_id", "turn", fill_template(template, {"input": kept}).alias("prompt"))


def chat_prompt_labeled(pairs: DataFrame, player: str, npc: str, max_chars: int, template: str) -> DataFrame:
    """Labelled history, the new input and an open label, cut to the last ``max_chars`` characters."""
    opening = F.concat(F.lit(f"\n{player}:"), F.col("input"), F.lit(f"\n{npc}:"))
    return _prompt(pairs, labelled(f"{player}:", f"{npc}:"), "\n", opening, max_chars, template)


def chat_prompt_plain(pairs: DataFrame, max_chars: int, template: str) -> DataFrame:
    """The same without labels: every exchange ends in a newline, the new input stands between two."""
    line = F.concat(F.col("input"), F.lit("\n"), F.col("output"), F.lit("\n"))
    opening = F.concat(F.lit("\n"), F.col("input"), F.lit("\n"))
    return _prompt(pairs, line, "", opening, max_chars, template)


def chat_prompt_budgeted(persona: Column, history: Column, question: Column, budget: int) -> Column:
    """Struct ``(prompt_ids, too_long)`` from three id arrays: the end of the history fills the budget."""
    rest = F.lit(budget) - F.size(persona) - F.size(question)
    keep = F.greatest(F.least(rest, F.size(history)), F.lit(0))
    tail = F.slice(history, F.size(history) - keep + 1, keep)
    return F.struct(
        F.when(rest >= 0, F.concat(persona, tail, question)).alias("prompt_ids"), (rest < 0).alias("too_long")
    )


def last_exchange(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values of each conversation's last turn."""
    last = F.max_by(F.struct("turn", *columns), "turn")
    return df.groupBy("conv_id").agg(last.alias("_last")).select("conv_id", "_last.*")


def fold_conversation_events(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], segments: Segments | Cut
) -> DataFrame:
    """What is left of each conversation after its submits, cancels and clears, with its position.

    ``events`` has ``action`` (``submit``, ``cancel``, ``clear``).  A clear removes everything before
    it; a cancel removes the last submit still standing, if any.  With +1 per submit and -1 per cancel, a submit
    stands exactly if the running sum never falls below its value later on, so sums and minima suffice.
    """
    keys, order = list(keys), list(order)
    cut = segments.cut(events, keys)
    step = F.when(F.col("action") == "submit", 1).when(F.col("action") == "cancel", -1).otherwise(0)
    cleared = (
        events.where(F.col("action") == "clear").groupBy(*keys).agg(F.max(F.struct(*order)).alias("_cleared"))
    )
    live = (
        events.join(cleared, keys, "left")
        .where(F.col("_cleared").isNull() | (F.struct(*order) > F.col("_cleared")))
        .drop("_cleared")
    )
    # marked once: all windows below share the segments
    live = cut.mark(live, order)
    marked = totals_before(live, keys, order, cut, {"_before": step}).withColumn("_sum", F.col("_before") + step)
    # later rows first: a growing frame costs one pass, one that shrinks would be quadratic
    later = W.partitionBy(*keys, SEG).orderBy(*map(F.desc, order)).rowsBetween(W.unboundedPreceding, -1)
    low = F.min("_sum").over(later)
    rows = cut.carried(marked)
    if rows is not None:
        lows = rows.groupBy(*keys, SEG).agg(F.min("_sum").alias("_low"))
        later_segments = W.partitionBy(*keys).orderBy(F.desc(SEG)).rowsBetween(W.unboundedPreceding, -1)
        lows = lows.select(*keys, SEG, F.min("_low").over(later_segments).alias("_later_low"))
        marked = marked.join(lows, [*keys, SEG], "left")
        # least ignores nulls
        low = F.least(low, F.col("_later_low"))
    standing = (
        marked.withColumn("_lowest", F.coalesce(low, F.col("_sum")))
        .where((F.col("action") == "submit") & (F.col("_lowest") >= F.col("_sum")))
        .select(*events.columns, SEG)
    )
    return totals_before(standing, keys, order, cut, {"position": F.lit(1)}).drop(SEG)

"""Column expressions over reply, prompt and memory texts."""

from __future__ import annotations

import textwrap

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

RESPONSE_MARK = "### Response:"


def strip(x: Column) -> Column:
    """Remove whitespace of any kind at both ends (``trim`` removes only spaces)."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def _split(x: Column, mark: str) -> Column:
    return F.split(x, r"\Q" + mark + r"\E", -1)


def clean_reply_plain(text: Column, mark: str = RESPONSE_MARK) -> Column:
    """Text between the first and second mark, stripped; null without a mark."""
    return strip(F.get(_split(text, mark), 1))


def clean_reply(text: Column, npc: str, player: str, mark: str = RESPONSE_MARK) -> Column:
    """``clean_reply_plain``, then drop ``npc: `` and cut at ``###`` and at the player's label."""
    out = F.replace(clean_reply_plain(text, mark), F.lit(f"{npc}: "), F.lit(""))
    return F.get(_split(F.get(_split(out, "###"), 0), player), 0)


def strip_speaker_a(answer: Column, npc_mark: str, player_mark: str) -> Column:
    """Remove the speaker mark if it occurs before the player's mark; remove every colon."""
    first = F.get(_split(answer, player_mark), 0)
    out = F.when(F.instr(first, npc_mark) > 0, F.replace(answer, F.lit(npc_mark), F.lit(""))).otherwise(answer)
    return F.replace(out, F.lit(":"), F.lit(""))


def strip_speaker_b(answer: Column, cleaned_a: Column, npc_mark: str, mode: str = "reference") -> Column:
    """Remove the speaker mark; colons go only if the tested answer has one.

    ``reference`` tests the cleaned answer A, which has lost its colons, so B keeps its own;
    ``fixed`` tests B.
    """
    out = F.replace(answer, F.lit(npc_mark), F.lit(""))
    tested = cleaned_a if mode == "reference" else out
    return F.when(F.instr(tested, ":") > 0, F.replace(out, F.lit(":"), F.lit(""))).otherwise(out)


def trim_history(text: Column, n: int, mode: str = "reference") -> Column:
    """``reference`` drops the last ``n`` characters; ``keep_tail`` keeps only them."""
    if mode == "keep_tail":
        return F.right(text, F.lit(n))
    return text.substr(F.lit(1), F.greatest(F.length(text) - n, F.lit(0)))


def keep_last(text: Column, n: int) -> Column:
    """Last ``n`` characters; 0 keeps everything."""
    return text if n == 0 else F.right(text, F.lit(n))


def parse_importance(score: Column, weight: float = 1.0, mode: str = "reference") -> Column:
    """Importance 0..1 times ``weight`` from a model's rating text; 0 without a number.

    ``reference`` reads only the first character (``"10"`` gives 0.1; null where it is no digit);
    ``fixed`` reads the first number, held within 1..10.
    """
    text = strip(score)
    found = F.regexp_extract(text, r"^\D*([0-9]+)", 1)
    if mode == "reference":
        value = text.substr(1, 1).try_cast("double")
    else:
        value = F.least(F.greatest(found.try_cast("double"), F.lit(1.0)), F.lit(10.0))
    return F.when(found == "", F.lit(0.0)).otherwise(value / 10 * F.lit(weight))


def parse_rating(text: Column) -> Column:
    """A whole number, or null."""
    clean = strip(text)
    return F.when(clean.rlike(r"^[+-]?[0-9]+$"), clean.try_cast("int"))


def parse_dialogue(result: Column, name: Column) -> Column:
    """Struct ``(goes_on, said, reply)`` from the first line of a model's dialogue text."""
    line = F.get(F.split(strip(result), "\n", -1), 0)

    def said(mark: str) -> Column:
        text = strip(F.substring_index(line, mark, -1))
        own = F.concat(name, F.lit(" "))
        text = F.when(F.startswith(text, own), text.substr(F.length(own) + 1, F.length(text))).otherwise(text)
        return strip(text)

    ends, speaks = F.instr(line, "GOODBYE:") > 0, F.instr(line, "SAY:") > 0
    words = F.when(ends, said("GOODBYE:")).when(speaks, said("SAY:"))
    return F.struct(
        (speaks & ~ends).alias("goes_on"),
        F.coalesce(words, line).alias("said"),
        F.when(words.isNull(), line).otherwise(F.concat(name, F.lit(" said "), words)).alias("reply"),
    )


def observed_memory(name: Column, observation: Column, said: Column) -> Column:
    return F.concat(name, F.lit(" observed "), observation, F.lit(" and said "), said)


def flatten_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def mask_secret(secret: Column) -> Column:
    """First three and last three characters around twelve stars."""
    return F.concat(F.left(secret, F.lit(3)), F.lit("*" * 12), F.right(secret, F.lit(3)))


def wrap_text(text: Column, width: int = 80) -> Column:
    """Word wrap joined by newlines, batch-wise over whole columns."""

    @F.arrow_udf("string")
    def wrapped(batch: pa.Array) -> pa.Array:
        return pa.array(
            [None if t is None else "\n".join(textwrap.wrap(t, width=width)) for t in batch.to_pylist()], pa.string()
        )

    return wrapped(text)


def piece_to_bytes(piece: Column, kind: Column) -> Column:
    """Bytes of a vocabulary piece; a malformed byte piece gives null.

    ``kind`` is ``unknown``, ``control``, ``byte`` or anything else for ordinary text.
    """
    byte = F.when(F.length(piece) == 6, F.unhex(piece.substr(4, 2)))
    # The printed form of the unknown piece, and the mark that stands for a space.
    return (
        F.when(kind == "unknown", F.encode(F.lit(" ⁇ "), "UTF-8"))
        .when(kind == "control", F.encode(F.lit(""), "UTF-8"))
        .when(kind == "byte", byte)
        .otherwise(F.encode(F.replace(piece, F.lit("▁"), F.lit(" ")), "UTF-8"))
    )


ADDED_TOKEN_SCORE = -1000.0

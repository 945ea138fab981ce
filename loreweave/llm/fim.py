"""Fill-in-middle documents, cut at line boundaries that a learned rank index finds.

A text is a row of lines. Prefix, middle and suffix are cut at two line numbers drawn from a hash of the key. Where a line
ends is looked up in an index over the boundary offsets of all texts of a slice: a piecewise-linear model, fitted so that no
offset lies further than ``ERROR`` bytes from its segment, predicts the offset from the rank of the boundary, and the
residual stored for that rank (two bytes) corrects it, so every cut is exact.

Rules: a null or empty text is plain, and so is a text that holds one of the three marks; a plain output is the text itself. A null
key draws as an empty one. Texts are read whole, however long; one text is never split over tasks, and an endless line is one
unit. Repeated rows give equal rows, rows are independent, and ties do not occur. Other columns stay as they are, whatever their
names; the new ones come last. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.llm.queries import query, table

SEED = "7"
PLAIN, PSM, SPM = "plain", "psm", "spm"
MARKS = ("<P>", "<S>", "<M>")
RATE = 100  # of 100 documents, those that are transformed
SPM_RATE = 50  # of 100 transformed documents, those with the suffix first
ERROR = 4096  # bytes that a prediction may be off; residuals fit 16 bits
FIRST_WINDOW = 1 << 10  # boundaries that a segment tries to cover at first; doubled while they fit
SLICE_BYTES = 1 << 22  # bytes of text that share one index; a longer text has its own


class RankIndex:
    """Offset of the boundary of every rank: linear segments, and what each offset differs from its segment."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR) -> None:
        self.error = error
        starts, slopes = [], []
        at = 0
        while at < len(offsets):
            end, slope = self.segment(offsets, at)
            starts.append(at)
            slopes.append(slope)
            at = end
        self.starts = np.array(starts, np.int64)
        self.slopes = np.array(slopes, np.float64)
        self.bases = offsets[self.starts] if len(starts) else np.empty(0, np.int64)
        self.residuals = np.empty(0, np.int16)
        off = offsets - self.predict(np.arange(len(offsets)))
        if len(off) and np.abs(off).max() > np.iinfo(np.int16).max:
            raise ValueError("a segment misses an offset by more than a residual can hold")
        self.residuals = off.astype(np.int16)

    def segment(self, offsets: np.ndarray, at: int) -> tuple[int, float]:
        """End and slope of the longest segment from ``at``: the cone of slopes that meet every offset within the error."""
        low, high = -np.inf, np.inf
        done, window = at + 1, FIRST_WINDOW
        while done < len(offsets):
            y = (offsets[done : done + window] - offsets[at]).astype(np.float64)
            x = np.arange(done - at, done - at + len(y), dtype=np.float64)
            highs = np.minimum(np.minimum.accumulate((y + self.error) / x), high)
            lows = np.maximum(np.maximum.accumulate((y - self.error) / x), low)
            fits = lows <= highs
            if not fits.all():
                n = int(fits.argmin())
                if n:
                    low, high = lows[n - 1], highs[n - 1]
                done += n
                break
            low, high = lows[-1], highs[-1]
            done += len(y)
            window *= 2
        return done, 0.0 if done == at + 1 else (low + high) / 2

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        if not len(self.starts):
            return np.empty(0, np.int64)
        s = np.searchsorted(self.starts, ranks, "right") - 1
        return self.bases[s] + np.rint(self.slopes[s] * (ranks - self.starts[s])).astype(np.int64)

    def lookup(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets of the boundaries of these ranks."""
        return self.predict(ranks) + self.residuals[ranks]


def text_slices(starts: np.ndarray, ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs ``[a, b)`` of texts with about ``most`` bytes together; one text is never cut."""
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + most, "right")))
        yield a, b
        a = b


def boundaries(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all boundaries of adjacent texts in order (the start of a text, then the end of each line) and where each text's begin."""
    first, last = int(starts[0]), int(ends[-1])
    breaks = np.concatenate([np.flatnonzero(data[x : min(x + step, last)] == 10) + x + 1 for x in range(first, last, step)] or [np.empty(0, np.int64)])
    seen = np.searchsorted(breaks, starts, "right")
    lines = np.searchsorted(breaks, ends, "right") - seen
    unended = ends > starts
    unended[unended] = data[ends[unended] - 1] != 10
    begins = np.concatenate(([0], np.cumsum(lines + 1 + unended)))
    out = np.empty(int(begins[-1]), np.int64)
    fixed = np.ones(len(out), bool)
    out[begins[:-1]] = starts
    fixed[begins[:-1]] = False
    tails = begins[1:][unended] - 1
    out[tails] = ends[unended]
    fixed[tails] = False
    out[fixed] = breaks
    return out, begins


def count_chars(data: np.ndarray, a: int, b: int) -> int:
    """Code points in UTF-8 bytes: those that are no continuation."""
    return int(np.count_nonzero((data[a:b] & 0xC0) != 0x80))


def transform_slice(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, forms: list[str], draws: np.ndarray, error: int) -> tuple[list, list, list, list]:
    """Lines, prefix and middle lengths, and output bytes of adjacent texts; ``draws`` holds two numbers for each."""
    offsets, begins = boundaries(data, starts, ends)
    index = RankIndex(offsets, error)
    lines = np.diff(begins) - 1
    picked = np.sort(draws % (lines + 1)[:, None], axis=1)
    cuts = index.lookup((begins[:-1, None] + picked).ravel()).reshape(-1, 2)
    prefixes: list[int | None] = []
    middles: list[int | None] = []
    outputs = []
    mark = dict(zip("psm", (m.encode() for m in MARKS)))
    for i, form in enumerate(forms):
        s, e = int(starts[i]), int(ends[i])
        p, m = map(int, cuts[i])
        if form == PLAIN:
            prefixes.append(None)
            middles.append(None)
            outputs.append(data[s:e].tobytes())
            continue
        prefixes.append(count_chars(data, s, p))
        middles.append(count_chars(data, p, m))
        prefix, middle, suffix = data[s:p].tobytes(), data[p:m].tobytes(), data[m:e].tobytes()
        head = (mark["p"], prefix, mark["s"], suffix) if form == PSM else (mark["s"], suffix, mark["p"], prefix)
        outputs.append(b"".join((*head, mark["m"], middle)))
    return lines.tolist(), prefixes, middles, outputs


def string_array(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.StringArray.from_buffers(len(parts), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(b"".join(parts)))


def transformer(names: list[str], kept: int, error: int, most: int) -> Callable:
    """Arrow batches of ``kept`` columns, text, form and two draws to the kept columns and the results, slice by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(kept).cast(pa.large_string())
            _, ends, held = texts.buffers()
            ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
            forms = batch.column(kept + 1).to_pylist()
            draws = np.stack([batch.column(kept + 2 + j).to_numpy(zero_copy_only=False) for j in range(2)], axis=1)
            for a, b in text_slices(ends[:-1], ends[1:], most):
                lines, prefixes, middles, outputs = transform_slice(data, ends[a:b], ends[a + 1 : b + 1], forms[a:b], draws[a:b], error)
                found = [pa.array(lines, pa.int64()), pa.array(forms[a:b], pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), string_array(outputs)]
                own = [batch.column(j).slice(a, b - a) for j in range(kept)]
                yield pa.RecordBatch.from_arrays([*own, *found], names)

    return run


def draw(key: Column, part: int, seed: str) -> Column:
    """The ``part``-th group of eight hex digits of the key's hash, as a number."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 8 * part + 1, 8), 16, 10).cast("long")


def form_of(key: Column, text: Column, seed: str, rate: int, spm_rate: int) -> Column:
    marked = [F.contains(text, F.lit(m)) for m in MARKS]
    plain = (text == "") | marked[0] | marked[1] | marked[2] | (draw(key, 2, seed) % 100 >= rate)
    return F.when(plain, PLAIN).when(draw(key, 3, seed) % 100 < spm_rate, SPM).otherwise(PSM)


NEW = (("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()), ("output", T.StringType()))


def fill_in_middle(
    df: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, error: int = ERROR, most: int = SLICE_BYTES
) -> DataFrame:
    """``df`` with ``n, form, prefix_chars, middle_chars, output`` at its end (lengths are null if the form is plain).

    ``error`` must leave room in 16 bits. Columns keep their names, also where those repeat the new ones or each other.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    key_column = F.col(f"c{names.index(key)}")
    whole = F.coalesce(F.col(f"c{names.index(text)}").cast("string"), F.lit(""))
    asked = plain.select("*", whole.alias("t"), form_of(key_column, whole, seed, rate, spm_rate).alias("f"), *[draw(key_column, j, seed).alias(f"d{j}") for j in range(2)])
    schema = T.StructType([*plain.schema.fields, *[T.StructField(f"x{i}", t) for i, (_, t) in enumerate(NEW)]])
    found = asked.mapInArrow(transformer(schema.names, len(names), error, most), schema)
    return found.toDF(*names, *[n for n, _ in NEW])


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. Its text holds no mark, so the three marks are where it splits."""
    parts = F.split(output, "|".join(MARKS))
    prefix, suffix = [F.when(form == PSM, F.get(parts, F.lit(a))).otherwise(F.get(parts, F.lit(b))) for a, b in ((1, 2), (2, 1))]
    return F.when(form == PLAIN, output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))


SQL = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || doc_id) AS h FROM documents),
l AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS ls, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
  ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(ls) AS n, least(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS a, greatest(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (SELECT *, array_to_string(ls[1:a], '') AS pre, array_to_string(ls[a + 1:b], '') AS mid, array_to_string(ls[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p"""


@query("op12_fim", SQL)
def fim_query(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_in_middle(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)

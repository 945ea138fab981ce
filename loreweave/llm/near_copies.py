"""Near copies by the shingles two texts share: SimHash and banded MinHash find candidates, an exact Jaccard check decides.

A text is the set of its shingles of ``WORDS`` words (a shorter text is one shingle, a text without words one fixed
shingle). Texts are linked if the Jaccard similarity of their sets is at least ``LEAST``; the check is on whole sets,
so nothing is merged on a sketch alone. Candidates are what SimHash groups (``simhash``, fingerprints of these shingles), and what shares one
of ``BANDS`` keys, each of ``ROWS`` MinHash values: a pair at similarity s meets under none of these with probability (1 - s^ROWS)^BANDS, 3 in a
million at 0.8 and less above it. SimHash alone would miss most pairs near 0.8, whose fingerprints differ in more bits than it links.

Texts with the same set are one node. Under a key, nodes are compared in chunks bounded by nodes and by shingles; a key
with more becomes all pairs of its chunks, so no pair is lost. Each list of nodes returns a spanning forest of its links, and
equal lists are compared once. Groups are the connected components of all links.

Rules: words are split at ASCII blanks and A-Z is lower-cased, as in ``simhash``. A null id is never the smallest of a
group unless the group has no other. Repeated rows stay together. Empty tables give empty results; columns are unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.llm.common import row_slices
from loreweave.llm.simhash import PIECE, components, fingerprint_links, majority
from loreweave.session import written

WORDS = 5
LEAST = (4, 5)  # similarity as a fraction, so that the check is in whole numbers
BANDS, ROWS = 32, 5
CHUNK, CHUNK_SHINGLES = 1_024, 1 << 18  # nodes and shingles of a chunk, about
SEED = 42
SLICE = 256  # shingles that are multiplied at a time
BATCH_SHINGLES = 1 << 17  # shingles that a task gives out at a time
FILTER_BITS = 26  # a bitmap of 8 MB tells which texts may be candidates; with very many it lets all pass
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 32, BANDS * ROWS, np.uint32) | np.uint32(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text; never empty."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(1, np.uint64)
    each = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64, len(parts))
    size = min(words, len(each))
    n = len(each) - size + 1
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = mixed(out * MIX + each[k : k + n])
    return np.unique(out)


def band_keys(held: np.ndarray) -> np.ndarray:
    """One key for each band of the MinHash values of a set."""
    low = (held >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, np.uint32(0xFFFFFFFF))
    for a in range(0, len(low), SLICE):
        np.minimum(least, (low[a : a + SLICE, None] * FACTORS).min(0), out=least)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = mixed(keys * MIX + column)
    return keys


SKETCH = "doc_id {key}, mark long, fp long, sim long, size int, keys array<long>"


def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(doc_id, mark, text)`` to ``(doc_id, mark, fp, sim, size, keys)``; a text is dropped as soon as its sketch is made."""
    for batch in batches:
        for rows in row_slices(batch):
            fps, sims = np.empty((2, len(rows)), np.uint64)
            sizes, keys = np.empty(len(rows), np.int32), np.empty((len(rows), BANDS), np.uint64)
            for i, t in enumerate(rows.column(2)):
                held = shingles(t.as_py())
                fps[i] = xxhash.xxh64_intdigest(held.tobytes(), SEED)
                sims[i] = majority(held[a : a + PIECE] for a in range(0, len(held), PIECE))
                sizes[i] = len(held)
                keys[i] = band_keys(held)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * BANDS, pa.int32()), pa.array(keys.ravel().view(np.int64)))
            numbers = [pa.array(fps.view(np.int64)), pa.array(sims.view(np.int64)), pa.array(sizes)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *numbers, lists], ["doc_id", "mark", "fp", "sim", "size", "keys"])


def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(fp, text)`` to ``(fp, set)``, in batches of about ``BATCH_SHINGLES`` shingles."""

    def made(fps: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, sets)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), lists], ["fp", "set"])

    for batch in batches:
        fps, sets, held = [], [], 0
        for fp, t in zip(batch.column(0), batch.column(1)):
            fps.append(fp.as_py())
            sets.append(shingles(t.as_py()))
            held += len(sets[-1])
            if held >= BATCH_SHINGLES:
                yield made(fps, sets)
                fps, sets, held = [], [], 0
        if fps:
            yield made(fps, sets)


def among(values: DataFrame, bits: int = FILTER_BITS):
    """A condition on the column ``values`` has: false only if no row of ``values`` holds it. A bitmap of ``2^bits`` bits is broadcast."""
    (name,) = values.columns
    place = F.pmod(F.col(name), F.lit(1 << bits))
    parts = values.select(place.alias("at")).groupBy((F.col("at") / 32768).cast("int").alias("part"))
    rows = parts.agg(F.bitmap_construct_agg(F.pmod("at", F.lit(32768))).alias("bits")).toArrow()  # 2^bits / 8 bytes at most
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    for part, found in zip(rows["part"].to_pylist(), rows["bits"]):
        piece = np.frombuffer(found.as_buffer(), np.uint8)
        bitmap[part * 4096 : part * 4096 + len(piece)] = piece
    shared = values.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf("boolean")
    def held(at: pa.Array) -> pa.Array:
        x = at.to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.array(shared.value[x >> 3] >> (x & 7).astype(np.uint8) & 1 == 1)

    return held(place)


def forest(sets: list[np.ndarray], least: tuple[int, int] = LEAST) -> list[tuple[int, int]]:
    """Links that span the components of ``sets`` (each distinct) under the similarity: breadth first."""
    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    own = np.zeros(int(flat.max()) + 1, np.int64)
    links: list[tuple[int, int]] = []
    left = np.ones(len(sets), bool)
    while left.any():
        first = int(left.argmax())
        left[first] = False
        todo = [first]
        while todo and left.any():
            at = todo.pop()
            mine = flat[starts[at] : starts[at + 1]]
            own[mine] = 1
            both = np.add.reduceat(own[flat], starts[:-1])
            own[mine] = 0
            near = left & (both * least[1] >= (sizes + sizes[at] - both) * least[0])
            found = np.flatnonzero(near).tolist()
            left[found] = False
            links += [(at, x) for x in found]
            todo += found
    return links


def links_in_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(list, fp, set)`` in the order of ``list`` to links ``(a, b)``."""

    def linked(fps: list[int], sets: list[np.ndarray]) -> pa.RecordBatch | None:
        pairs = forest(sets) if len(sets) > 1 else []
        if not pairs:
            return None
        ends = [[min(fps[x], fps[y]) for x, y in pairs], [max(fps[x], fps[y]) for x, y in pairs]]
        return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

    current, fps, sets = None, [], []
    for batch in batches:
        offsets, values = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
        for i, (name, fp) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if name != current:
                if out := linked(fps, sets):
                    yield out
                current, fps, sets = name, [], []
            fps.append(fp)
            sets.append(values[offsets[i] : offsets[i + 1]].copy())
    if out := linked(fps, sets):
        yield out


def simhash_keys(nodes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(fp, size, key)``: nodes whose SimHash fingerprints ``sim`` are linked have one key."""
    roots = components(fingerprint_links(nodes.select(F.col("sim").alias("fp")).distinct(), chunk)).select(F.col("node").alias("sim"), "root")
    return nodes.join(roots, "sim", "left").select("fp", "size", F.xxhash64(F.coalesce("root", "sim"), F.lit(BANDS + 1)).alias("key"))


def candidate_lists(nodes: DataFrame, chunk: int = CHUNK, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """``(list, fp)``: lists of nodes to compare, from distinct ``(fp, sim, size, keys)``."""
    keyed = nodes.select("fp", "size", F.explode("keys").alias("key")).unionByName(simhash_keys(nodes, chunk))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("held")).filter("n > 1")
    parts = F.ceil(F.greatest(F.col("n") / chunk, F.col("held") / chunk_shingles)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    chunked = keyed.join(shared, "key").select("key", "fp", parts.alias("parts")).select("key", "fp", "parts", own.alias("own"))
    # a node goes to every pair of chunks that has its own chunk
    met = chunked.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    lists = (
        met.groupBy("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
        .filter(F.size("fps") > 1)
        .select("fps")
        .distinct()
    )
    return lists.select(F.xxhash64("fps").alias("list"), F.explode("fps").alias("fp"))


def near_links(nodes: DataFrame, texts: DataFrame, chunk: int = CHUNK, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """Links ``(a, b)`` of nodes ``(fp, mark, sim, size, keys)`` that are similar enough; ``texts (mark, text)`` are read for candidates only."""
    lists = written(candidate_lists(nodes, chunk, chunk_shingles), "lists")
    wanted = written(lists.select("fp").distinct().join(nodes.select("fp", "mark"), "fp"), "candidates")
    # texts of no candidate are left out before the shuffle, but for those that share a bit with one
    found = texts.filter(among(wanted.select("mark"))).join(wanted, "mark").dropDuplicates(["fp"])
    sets = written(found.select("fp", "text").mapInArrow(shingled, "fp long, set array<long>"), "sets")
    rows = lists.join(sets, "fp").select("list", "fp", "set").repartition("list").sortWithinPartitions("list", "fp")
    return rows.mapInArrow(links_in_lists, "a long, b long").distinct()


def near_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """One row of each group: the one with the smallest id; columns unchanged. Rows that repeat id and text stay together."""
    texts = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    marked = texts.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    sketches = marked.mapInArrow(sketched, SKETCH.format(key=marked.schema["doc_id"].dataType.simpleString()))
    # the first row of every distinct set
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", "sim", "size", "keys")).alias("f")
    nodes = written(sketches.groupBy("fp").agg(first).select("fp", "f.none", "f.doc_id", "f.mark", "f.sim", "f.size", "f.keys"), "nodes")
    links = near_links(nodes, texts.select(F.xxhash64("text").alias("mark"), "text"), chunk, chunk_shingles)
    roots = components(links).select(F.col("node").alias("fp"), "root")
    rooted = nodes.select("fp", F.struct("none", "doc_id", "mark").alias("first")).join(roots, "fp", "left")
    stay = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first")).select("first.doc_id", "first.mark")
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    key_column, text_column = F.col(f"c{names.index(key)}"), F.col(f"c{names.index(text)}")
    return plain.join(
        stay, key_column.eqNullSafe(F.col("doc_id")) & (F.xxhash64(text_column.cast("string")) == F.col("mark")), "left_semi"
    ).toDF(*names)

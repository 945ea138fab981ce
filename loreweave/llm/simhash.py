"""Near-duplicate groups by SimHash: 64-bit fingerprints, pigeonhole blocks, verified Hamming distance, components.

A fingerprint of 64 bits is cut into ``DISTANCE + SHARED`` blocks. Two fingerprints that differ in at most ``DISTANCE``
bits agree in at least ``SHARED`` whole blocks, so they meet under at least one of the keys made of ``SHARED`` blocks.
Rows with the same fingerprint are one node. Under a key, nodes are compared in chunks of at most about ``CHUNK``; a key
with more nodes becomes all pairs of its chunks, so no pair is lost and no task gets more than two chunks. Each chunk
pair returns a spanning forest of its links, at most one link per node, so a group of copies never gives all its
pairs. Groups are the connected components of all forests together.

Rules: a text without words (null, empty, blank) has fingerprint zero and links like any other. A null id is never the
smallest of a group unless the group has no other. Repeated rows share a fingerprint and so a group. Empty tables give
empty results; other columns are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.llm.queries import query, table
from loreweave.session import written

SHINGLE_WORDS = 4
SEED = 42
DISTANCE = 4
# keys per fingerprint: 6 blocks in pairs, 15 keys of 21 bits or more. For far more than 10^8 different texts raise SHARED:
# 3 gives 35 keys of 27 bits, 4 gives 70 keys of 32 bits; the result is the same
SHARED = 2
CHUNK = 1_024
PIECE = 1 << 16  # shingles whose bits are counted at a time


def shingle_hashes(text: str) -> Iterator[list[int]]:
    """XXH64 of the word shingles of a text, some at a time."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    n = max(1, len(words) - SHINGLE_WORDS + 1)
    last = ends[min(SHINGLE_WORDS, len(words)) - 1 :].tolist()
    starts = starts[:n].tolist()
    h = xxhash.xxh64_intdigest
    for a in range(0, n, PIECE):
        yield [h(joined[x:y], SEED) for x, y in zip(starts[a : a + PIECE], last[a : a + PIECE])]


def majority(parts: Iterable[np.ndarray]) -> int:
    """The bits that are set in over half of the 64-bit hashes of all parts, as an unsigned number."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in parts:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def fingerprint(text: str | None) -> int:
    """The fingerprint as an unsigned number."""
    return majority(np.array(hashes, "<u8") for hashes in shingle_hashes(text or ""))


@F.arrow_udf(T.LongType())
def fingerprint_of(texts: pa.Array) -> pa.Array:
    found = np.fromiter((fingerprint(t) for t in texts.to_pylist()), np.uint64, len(texts))
    return pa.array(found.view(np.int64))


def block_keys(fp: Column) -> Column:
    """Array of keys: number of the block combination above the bits of its blocks."""
    n = DISTANCE + SHARED
    borders = [64 * i // n for i in range(n + 1)]
    width = -(-64 // n)

    def block(i: int) -> Column:
        return F.shiftrightunsigned(fp, borders[i]).bitwiseAND(F.lit((1 << (borders[i + 1] - borders[i])) - 1).cast("long"))

    keys = []
    for c, chosen in enumerate(combinations(range(n), SHARED)):
        if width * SHARED <= 56:
            key = F.lit(c).cast("long")
            for i in chosen:
                key = F.shiftleft(key, width).bitwiseOR(block(i))
        else:
            key = F.xxhash64(F.lit(c), *[block(i) for i in chosen])  # only groups nodes; every pair is verified
        keys.append(key)
    return F.array(*keys)


def forest(nodes: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that span the components of ``nodes`` (unsigned fingerprints) under the distance: breadth first."""
    if len(nodes) == 2:
        return [(0, 1)] if int(nodes[0] ^ nodes[1]).bit_count() <= distance else []
    links: list[tuple[int, int]] = []
    left = np.arange(len(nodes))
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(nodes[left] ^ nodes[at]) <= distance
            found = left[near]
            if len(found):
                left = left[~near]
                links += [(int(at), int(x)) for x in found]
                todo += list(found)
    return links


def links_in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of fingerprints to links ``(a, b)``."""
    for batch in batches:
        lists = batch.column(0)
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        for x, y in zip(offsets[:-1], offsets[1:]):
            nodes = values[x:y]
            if links := forest(nodes):
                pairs = np.array(links)
                a.append(nodes[pairs[:, 0]])
                b.append(nodes[pairs[:, 1]])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(s).view(np.int64)) for s in (a, b)], ["a", "b"])


def fingerprint_links(nodes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links ``(a, b)`` that connect what is within the distance, from distinct fingerprints ``fp``."""
    keyed = nodes.select("fp", F.explode(block_keys(F.col("fp"))).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    chunked = keyed.join(shared, "key").select("key", "fp", parts.alias("parts")).select("key", "fp", "parts", own.alias("own"))
    # a node goes to every pair of chunks that has its own chunk
    met = chunked.select("key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    lists = (
        met.groupBy("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        .agg(F.collect_list("fp").alias("fps"))
        .filter(F.size("fps") > 1)
        .select("fps")
    )
    return lists.mapInArrow(links_in_chunks, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links: equal roots for connected nodes.

    Each round points every node at its smallest neighbour, twice, and contracts the links; the tables shrink by a
    factor each round and are written to the shared folder, so that a lost executor costs one round at most.
    """
    links = written(links, "links")
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        both = links.select("a", "b").union(links.select("b", "a"))
        parent = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        parent = written(parent, "parents")
        upper = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        parent = written(parent.join(upper, "up").select("node", F.col("top").alias("up")), "parents")
        rounds.append(parent)
        a = parent.select(F.col("node").alias("a"), F.col("up").alias("x"))
        b = parent.select(F.col("node").alias("b"), F.col("up").alias("y"))
        shrunk = links.join(a, "a").join(b, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        links = written(shrunk, "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[-1].select("node", F.col("up").alias("root"))
    for parent in reversed(rounds[:-1]):
        above = roots.select(F.col("node").alias("up"), "root")
        roots = parent.join(above, "up", "left").select("node", F.coalesce("root", "up").alias("root"))
    return roots


def grouped(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(fp, component_id, first)`` for each distinct fingerprint of ``rows (doc_id, fp, mark)``.

    ``first`` is the smallest ``(doc_id, fp, mark)`` of the component; a null id counts as larger than any other.
    """
    nodes = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "mark")).alias("first"))
    nodes = written(nodes, "nodes")
    roots = components(fingerprint_links(nodes.select("fp"), chunk)).select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.select("fp", "root").join(best, "root").select("fp", F.col("least.doc_id").alias("component_id"), F.col("least").alias("first"))


def fingerprints(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(doc_id, fp, mark)`` for every row, written once; ``mark`` tells texts of equal id and fingerprint apart."""
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return written(rows.select("doc_id", fingerprint_of("text").alias("fp"), F.xxhash64("text").alias("mark")), "fingerprints")


def near_duplicates(df: DataFrame, key: str, text: str, chunk: int = CHUNK) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row, ``doc_id`` being the column ``key``."""
    rows = fingerprints(df, key, text)
    groups = grouped(rows, chunk).select("fp", "component_id")
    return rows.join(groups, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row of each group: the one with the smallest id; columns unchanged. Rows that repeat id and text stay together."""
    rows = fingerprints(df, key, text)
    groups = grouped(rows, chunk)
    stay = groups.select("component_id", F.col("first.mark").alias("mark")).distinct()
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    key_column, text_column = F.col(f"c{names.index(key)}"), F.col(f"c{names.index(text)}")
    return plain.join(
        stay, key_column.eqNullSafe(F.col("component_id")) & (F.xxhash64(text_column.cast("string")) == F.col("mark")), "left_semi"
    ).toDF(*names)


@query("op10_simhash")
def simhash_query(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), "doc_id", "text")

"""Exact deduplication by Grace hashing.

Each task first folds the copies of its own split, so a text with any number of copies reaches the shuffle once per
split. After the shuffle by digest, a task fills an open-addressing table that compares digests and then complete
texts. If its texts outgrow the memory limit, all its records are partitioned by the next digits of the digest into
spill files, and each file is treated the same way, again if need be. Spill files are the task's own scratch, like
those of a sort: they go with the task, and a retried task makes its own.

Rules: texts are equal when identical; null counts as empty. Of equal texts the row with the largest id stays; a null
id is smaller than any other. Of rows that repeat both text and id exactly one stays. Empty tables give empty results.
Other columns are neither read nor changed, whatever their names.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loreweave.llm.common import place, plain_names, row_slices
from loreweave.llm.queries import query, table
from loreweave.session import written

# bytes of texts and ids that one table holds before it spills, spill files made at each level, rows per output batch
TABLE_BYTES = 64 << 20
FANOUT = 16
BATCH = 2_000


def id_order(value) -> tuple:
    """Sort key of an id: null first."""
    return (value is not None, value if value is not None else 0)


class TextTable:
    """Open addressing with linear probing: digest first, then the complete text. Each text keeps a list of members."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.entries: list[tuple[bytes, str, list]] = []
        self.bytes = 0

    def _slot(self, digest: bytes, text: str) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (e := self.slots[at]) >= 0:
            if self.entries[e][0] == digest and self.entries[e][1] == text:
                return at
            at = (at + 1) & mask
        return at

    def members(self, digest: bytes, text: str) -> list:
        at = self._slot(digest, text)
        if self.slots[at] < 0:
            self.slots[at] = len(self.entries)
            self.entries.append((digest, text, []))
            self.bytes += 4 * len(text) + 200
            if 2 * len(self.entries) > len(self.slots):
                self.slots = [-1] * (2 * len(self.slots))
                for e, (d, t, _) in enumerate(self.entries):
                    self.slots[self._slot(d, t)] = e
                return self.entries[-1][2]
        return self.entries[self.slots[at]][2]


Fold = Callable[[list, tuple], None]


def grace(records: Iterable[tuple[bytes, str, tuple]], fold: Fold, limit: int, level: int = 0) -> Iterator[tuple[bytes, str, list]]:
    """Every distinct text with the members that ``fold`` has put into its list; at most ``limit`` bytes of texts at a time."""
    held, rest = TextTable(), iter(records)
    for digest, text, member in rest:
        fold(held.members(digest, text), member)
        if held.bytes > limit and len(held.entries) > 1 and level < len(sha256().digest()):
            break
    else:
        yield from held.entries
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        files = [open(f"{folder}/{k}", "w+b") for k in range(FANOUT)]  # noqa: SIM115
        try:
            for digest, text, members in held.entries:
                for m in members:
                    pickle.dump((digest, text, m), files[digest[level] % FANOUT])
            held = None
            for record in rest:
                pickle.dump(record, files[record[0][level] % FANOUT])
            for f in files:
                f.seek(0)
                yield from grace(_records(f), fold, limit, level + 1)
                f.truncate(0)
        finally:
            for f in files:
                f.close()


def _records(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def append(members: list, m: tuple) -> None:
    members.append(m)


def keep_largest(members: list, m: tuple) -> None:
    """Members are ``(id, row)``: only the row with the largest id, the first one on a tie."""
    if not members:
        members.append(m)
    elif id_order(m[0]) > id_order(members[0][0]):
        members[0] = m


def local_tables(records: Iterable[tuple[bytes, str, tuple]], fold: Fold, limit: int) -> Iterator[list[tuple[bytes, str, list]]]:
    """The copies of a split, folded table by table: a full table is handed on and a new one begun."""
    held = TextTable()
    for digest, text, member in records:
        fold(held.members(digest, text), member)
        held.bytes += 48
        if held.bytes > limit:
            yield held.entries
            held = TextTable()
    if held.entries:
        yield held.entries


def digest_of(text: str) -> bytes:
    return sha256(text.encode("utf-8", "surrogatepass")).digest()


def batched(rows: Iterable, schema: pa.Schema, to_arrays: Callable[[list], list]) -> Iterator[pa.RecordBatch]:
    held: list = []
    size = 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r if isinstance(x, (str, bytes, list)))
        if len(held) >= BATCH or size > 16 << 20:
            yield pa.RecordBatch.from_arrays(to_arrays(held), schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(to_arrays(held), schema=schema)


def columns_of(schema: pa.Schema) -> Callable[[list], list]:
    return lambda rows: [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)]


def duplicate_classes(df: DataFrame, key: str, text: str, limit: int = TABLE_BYTES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row, ``doc_id`` being the column ``key``."""
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    local_schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("seq", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("text", T.StringType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("top", kind),
        ]
    )
    merged_schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("seq", T.LongType()),
            T.StructField("keep_id", kind),
            T.StructField("group_size", T.LongType()),
            T.StructField("winner", T.BooleanType()),
        ]
    )
    local_arrow, merged_arrow = to_arrow_schema(local_schema), to_arrow_schema(merged_schema)

    def fold_split(batches):
        def records():
            for b in batches:
                for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    t = t or ""
                    yield digest_of(t), t, i

        def out():
            part, seq = TaskContext.get().partitionId(), 0
            for entries in local_tables(records(), append, limit):
                for digest, t, ids in entries:
                    yield part, seq, digest, t, ids, max(ids, key=id_order)
                    seq += 1

        yield from batched(out(), local_arrow, columns_of(local_arrow))

    def merge(batches):
        def records():
            for b in batches:
                for part, seq, digest, t, n, top in zip(*(c.to_pylist() for c in b.columns)):
                    yield digest, t, (part, seq, n, top)

        def out():
            for _, _, members in grace(records(), append, limit):
                keep = max((m[3] for m in members), key=id_order)
                size = sum(m[2] for m in members)
                first = min(m[:2] for m in members if m[3] == keep)
                for m in members:
                    yield m[0], m[1], keep, size, m[:2] == first

        yield from batched(out(), merged_arrow, columns_of(merged_arrow))

    # written once: the texts go to the shuffle, the ids wait for their class
    local = written(rows.mapInArrow(fold_split, local_schema), "copies")
    merged = (
        local.select("part", "seq", "digest", "text", F.size("ids").cast("long").alias("n"), "top").repartition(F.col("digest")).mapInArrow(merge, merged_schema)
    )
    joined = local.select("part", "seq", "digest", "ids", "top").join(merged, ["part", "seq"])
    # the row that stays: in the winning list, at the first place of the largest id
    first = F.when(F.col("top").isNull(), F.lit(0)).otherwise(F.array_position("ids", F.col("top")) - 1)
    return joined.select("*", first.alias("first"), F.posexplode("ids").alias("at", "doc_id")).select(
        "doc_id", "keep_id", "group_size", (F.col("winner") & (F.col("at") == F.col("first"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``df`` that stay, all columns unchanged, after one shuffle of texts."""
    names, plain = df.columns, plain_names(df)
    at_key, at_text = place(df, key), place(df, text)
    out_schema = plain.schema
    local_schema = T.StructType([T.StructField("digest", T.BinaryType()), *out_schema.fields])
    local_arrow, out_arrow = to_arrow_schema(local_schema), to_arrow_schema(out_schema)

    def fold_split(batches):
        def records():
            for b in batches:
                for row in (r for piece in row_slices(b) for r in zip(*(c.to_pylist() for c in piece.columns))):
                    t = row[at_text] or ""
                    yield digest_of(t), t, (row[at_key], row)

        def out():
            for entries in local_tables(records(), keep_largest, limit):
                for digest, _, members in entries:
                    yield (digest, *members[0][1])

        yield from batched(out(), local_arrow, columns_of(local_arrow))

    def merge(batches):
        def records():
            for b in batches:
                for digest, *row in (r for piece in row_slices(b) for r in zip(*(c.to_pylist() for c in piece.columns))):
                    yield digest, row[at_text] or "", (row[at_key], tuple(row))

        yield from batched((members[0][1] for _, _, members in grace(records(), keep_largest, limit)), out_arrow, columns_of(out_arrow))

    return plain.mapInArrow(fold_split, local_schema).repartition(F.col("digest")).mapInArrow(merge, out_schema).toDF(*names)


@query(
    "op6_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
)
def exact_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_classes(table(spark, folder, "documents"), "doc_id", "text")

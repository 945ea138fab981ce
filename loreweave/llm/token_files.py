"""Token ids as binary files: documents in ascending order of their key, each ended by one id, in blocks of a range coder.

A file is a run of blocks (``range_coder``), a line feed after each. A block keeps, beside its ids, the number of the file, its own
number in it, and the documents that its ids belong to: key, ids in this block, and whether the document begins here. So a
file can be read without any other, and a document may go on over many blocks. Documents are range-partitioned by key; one
partition is one file, and the number of files follows the bytes of text.

Rules: null texts count as empty and give the end id alone. Null keys come first. Rows that repeat a key are documents of their own,
ordered by a hash of the text and then the text; rows that repeat both are alike, so their order does not matter. A text is
never split over tasks, however long, but over blocks. Files are written and committed by Spark, so a lost task leaves none
behind. Other columns are not read, whatever their names. An empty table gives no block and no row.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loreweave.llm import range_coder
from loreweave.llm.bpe import Bpe
from loreweave.llm.queries import query, table
from loreweave.session import scratch_path, written

END = 0
FILE_BYTES = 16 << 20  # bytes of text in a file, about
LEAST_BYTES = 1 << 20  # files are not made smaller than this to use more cores
BATCH = 4_096
BEGINS, NULL_KEY = 1, 2
EXTRA = "<III"  # file, block, documents
EXTRA_BYTES = struct.calcsize(EXTRA)


def packed(ids: np.ndarray, file_no: int, block_no: int, keys: list, counts: list[int], begins: list[bool]) -> bytes:
    marks = [BEGINS * b | NULL_KEY * (k is None) for k, b in zip(keys, begins)]
    held = [np.array([k or 0 for k in keys], "<i8"), np.array(counts, "<u4"), np.array(marks, "u1")]
    return range_coder.pack(ids, struct.pack(EXTRA, file_no, block_no, len(keys)) + b"".join(a.tobytes() for a in held))


def documents_of(extra: bytes) -> tuple[int, int, list, list[int], list[bool]]:
    file_no, block_no, n = struct.unpack_from(EXTRA, extra)
    keys = np.frombuffer(extra, "<i8", n, EXTRA_BYTES)
    counts = np.frombuffer(extra, "<u4", n, EXTRA_BYTES + 8 * n)
    marks = np.frombuffer(extra, "u1", n, EXTRA_BYTES + 12 * n)
    return file_no, block_no, [None if m & NULL_KEY else k for k, m in zip(keys.tolist(), marks)], counts.tolist(), (marks & BEGINS > 0).tolist()


class BlockWriter:
    """Cuts the ids of documents into blocks of one file."""

    def __init__(self, file_no: int, block: int = range_coder.BLOCK) -> None:
        self.file_no, self.block, self.number = file_no, block, 0
        self.clear()

    def clear(self) -> None:
        self.ids: list[np.ndarray] = []
        self.keys: list = []
        self.counts: list[int] = []
        self.begins: list[bool] = []
        self.held = 0

    def add(self, key: int | None, ids: np.ndarray) -> Iterator[bytes]:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.block - self.held)
            self.ids.append(ids[at : at + n])
            self.keys.append(key)
            self.counts.append(n)
            self.begins.append(at == 0)
            self.held += n
            at += n
            if self.held == self.block:
                yield self.flush()

    def flush(self) -> bytes:
        made = packed(np.concatenate(self.ids), self.file_no, self.number, self.keys, self.counts, self.begins)
        self.number += 1
        self.clear()
        return made


def write_token_files(df: DataFrame, folder: str, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = END, file_bytes: int = FILE_BYTES, block: int = range_coder.BLOCK) -> None:
    """Encode every text and write the files below ``folder``."""
    spark = df.sparkSession
    codec = Bpe(spark, path).codec
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    files = max(1, -(-total // file_bytes), min(spark.sparkContext.defaultParallelism, total // LEAST_BYTES))
    order = ["key", "mark", "text"]
    ranged = rows.withColumn("mark", F.xxhash64("text")).repartitionByRange(files, "key", "mark").sortWithinPartitions(*order)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = codec()
        writer = BlockWriter(TaskContext.get().partitionId(), block)
        last = np.array([end], np.uint32)
        for batch in batches:
            for k, ids in zip(batch.column(0), bpe.arrays(batch.column(1))):
                for made in writer.add(k.as_py(), np.concatenate([ids, last])):
                    yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["block"])
        if writer.held:
            yield pa.RecordBatch.from_arrays([pa.array([writer.flush()], pa.binary())], ["block"])

    blocks = ranged.select("key", "text").mapInArrow(encode, "block binary")
    # the text writer puts out the bytes of a string as they are; blocks know their lengths
    blocks.select(F.col("block").cast("string").alias("value")).write.option("lineSep", "\n").text(folder)


def blocks_in(content: bytes) -> Iterator[range_coder.Block]:
    """The blocks of a file in order; those of a damaged file raise ``BlockError`` where the damage begins."""
    data = memoryview(content)
    at = 0
    while at < len(data):
        block, at = range_coder.unpack(data, at)
        if bytes(data[at : at + 1]) != b"\n":
            raise range_coder.BlockError(f"no line feed at byte {at}")
        yield block
        at += 1


def documents_in(content: bytes) -> Iterator[tuple[int, int | None, int, int, int]]:
    """``(file, key, start in the file, ids, crc32 of the ids)`` of every document of a file."""
    start = length = crc = 0
    key, open_, file_no = None, False, 0
    for number, block in enumerate(blocks_in(content)):
        file_no, block_no, keys, counts, begins = documents_of(block.extra)
        if block_no != number:
            raise range_coder.BlockError(f"block {block_no} stands in place {number}")
        raw, at = block.ids.astype("<u4").tobytes(), 0
        for k, n, first in zip(keys, counts, begins):
            if first and open_:
                yield file_no, key, start, length, crc
                start += length
            if first:
                key, length, crc, open_ = k, 0, 0, True
            crc = zlib.crc32(raw[4 * at : 4 * (at + n)], crc)
            length += n
            at += n
    if open_:
        yield file_no, key, start, length, crc


FOUND = "file long, doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, doc_id, start, n_tokens, ids_crc32)`` of every document below ``folder``; ``start`` counts in its file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in FOUND.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                for row in documents_in(content.as_py()):
                    rows.append(row)
                    if len(rows) >= BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)

    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    return stored.select("content").mapInArrow(read, FOUND)


def with_starts(found: DataFrame) -> DataFrame:
    """``start`` over all files: one short row for each file is summed up in order."""
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("file", before.alias("before"))
    return found.join(offsets, "file").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def ids_of(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, block, ids)``: the ids themselves, for whoever trains on them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for block in blocks_in(content.as_py()):
                    file_no, block_no, *_ = documents_of(block.extra)
                    ids = pa.ListArray.from_arrays(pa.array([0, len(block.ids)], pa.int32()), pa.array(block.ids.astype(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array([file_no], pa.int64()), pa.array([block_no], pa.int64()), ids], ["file", "block", "ids"])

    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    return stored.select("content").mapInArrow(read, "file long, block long, ids array<long>")


def token_files(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, **sizes: int) -> DataFrame:
    """Write all documents, read the files back: ``(doc_id, start, n_tokens, ids_crc32)``."""
    spark = df.sparkSession
    folder = scratch_path(spark, "token-files")
    write_token_files(df, folder, key, text, path, **sizes)
    # the files are decoded once; their totals are taken from what that gave
    return with_starts(written(read_token_files(spark, folder), "token-rows"))


@query("op13_token_files")
def token_files_query(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(table(spark, folder, "documents"))

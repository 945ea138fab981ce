"""File listings: kinds, preferred formats, checksums, shard sets."""

from __future__ import annotations

import hashlib

from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds of model files by name, anchored at the start only, first match wins.
KIND_PATTERNS = (
    ("text", r"^.*\.(txt|json|py|md)"),
    ("text", r"^(tokenizer|ice).*\.model"),
    ("safetensors", r"^.*\.safetensors"),
    ("pytorch", r"^(pytorch|adapter)_model.*\.bin"),
    ("pt", r"^.*\.pt"),
    ("ggml", r"^.*ggml.*\.bin"),
)
ADAPTER_FILES = ("adapter_config.json", "adapter_model.bin")
# files from this size on do not fit a cell and are streamed in blocks
MAX_FILE_BYTES = 2_000_000_000
BLOCK_BYTES = 8 << 20


def file_kind(path: Column) -> Column:
    """Kind of a file, or null for one of no interest."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KIND_PATTERNS):
        kind = F.when(path.rlike(pattern), name).otherwise(kind)
    return kind


def classify_files(listing: DataFrame) -> DataFrame:
    """Add ``class``, and ``is_lora``: whether the model has an adapter file.

    ``listing`` is ``(model, path, ...)``; files of no known class are left out.
    """
    adapter = F.lit(False)
    for name in ADAPTER_FILES:
        adapter = adapter | F.endswith(F.col("path"), F.lit(name))
    lora = listing.where(adapter).select("model").distinct().withColumn("is_lora", F.lit(True))
    return (
        listing.withColumn("class", file_kind(F.col("path")))
        .where(F.col("class").isNotNull())
        .join(lora, "model", "left")
        .withColumn("is_lora", F.coalesce(F.col("is_lora"), F.lit(False)))
    )


def prefer_format(classified: DataFrame) -> DataFrame:
    """Leave out pytorch and pt files of models that have safetensors."""
    safe = classified.where(F.col("class") == "safetensors").select("model").distinct().withColumn("_safe", F.lit(True))
    return (
        classified.join(safe, "model", "left")
        .where(F.col("_safe").isNull() | ~F.col("class").isin("pytorch", "pt"))
        .drop("_safe")
    )


def hash_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, size, sha256)`` of every file of any size.

    A file that fits a cell is hashed by Spark; a larger one is streamed block by block through its file system.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    fits = files.where(F.col("length") < MAX_FILE_BYTES).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") >= MAX_FILE_BYTES).select("path", F.col("length").alias("size"))

    def stream(batches):
        for pdf in batches:
            yield pdf.assign(sha256=[streamed_sha256(p) for p in pdf["path"]])

    return fits.unionByName(large.mapInPandas(stream, "path string, size long, sha256 string"))


def streamed_sha256(uri: str, block: int = BLOCK_BYTES) -> str:
    """Checksum of a file, one block in memory at a time."""
    held, path = FileSystem.from_uri(uri)
    found = hashlib.sha256()
    with held.open_input_stream(path) as f:
        while data := f.read(block):
            found.update(data)
    return found.hexdigest()


def verify_manifest(manifest: DataFrame, observed: DataFrame) -> DataFrame:
    """Status of every manifest row: ``missing``, ``failed``, ``too_large`` or ``ok``."""
    seen = observed.select("path", F.col("sha256").alias("_seen"), F.lit(True).alias("_there"))
    status = (
        F.when(F.col("_there").isNull(), "missing")
        .when(F.col("_seen").isNull(), "too_large")
        .when(F.col("_seen") == F.col("sha256"), "ok")
        .otherwise("failed")
    )
    return manifest.join(seen, "path", "left").withColumn("status", status).drop("_seen", "_there")


def manifest_summary(verified: DataFrame, by: str = "model") -> DataFrame:
    """Counts per status; a model is validated only if every file is ok."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in ("ok", "failed", "missing", "too_large")]
    return verified.groupBy(by).agg(
        F.count(F.lit(1)).alias("files"), *counts, F.bool_and(F.col("status") == "ok").alias("validated")
    )


# Names of files that belong to one set, with the number its first member has.
SHARD_PATTERNS = (
    (r"^(.*)\.([0-9]{2})()\.pth$", 0),
    (r"^(.*)-([0-9]{5})-of-([0-9]{5})\..*$", 1),
    (r"^(.*)\.([0-9]+)()$", 0),
)


def shard_sets(files: DataFrame) -> DataFrame:
    """Sets of sibling files: ``(stem, present, contiguous_prefix, expected, complete)``.

    A file of plain name is member 0 of its set.  The first gap is found by an equi-join of every member
    with its successor, so a set of any size is spread over the cluster.
    """
    path = F.col("path")
    stem, index, total, start = path, F.lit(0), F.lit(None).cast("int"), F.lit(0)
    for pattern, first in reversed(SHARD_PATTERNS):
        hit = path.rlike(pattern)
        part = lambda i: F.regexp_extract(path, pattern, i)
        suffix = F.regexp_extract(path, r"(\.pth|-of-[0-9]{5}\..*)$", 1)
        stem = F.when(hit, F.concat(part(1), suffix)).otherwise(stem)
        index = F.when(hit, part(2).try_cast("int")).otherwise(index)
        total = F.when(hit, part(3).try_cast("int")).otherwise(total)
        start = F.when(hit, F.lit(first)).otherwise(start)
    members = (
        files.select(stem.alias("stem"), index.alias("idx"), total.alias("total"), start.alias("start"))
        .groupBy("stem", "idx")
        .agg(F.max("total").alias("total"), F.min("start").alias("start"))
    )
    following = members.select("stem", (F.col("idx") - 1).alias("idx"), F.lit(True).alias("_followed"))
    gap = F.min(F.when(F.col("_followed").isNull(), F.col("idx") + 1))
    sets = (
        members.join(following, ["stem", "idx"], "left")
        .groupBy("stem")
        .agg(
            F.count(F.lit(1)).alias("present"),
            F.max("total").alias("expected"),
            F.min("idx").alias("_first"),
            F.min("start").alias("_start"),
            gap.alias("_gap"),
        )
    )
    prefix = F.when(F.col("_first") == F.col("_start"), F.col("_gap") - F.col("_start")).otherwise(0)
    return sets.withColumn("contiguous_prefix", prefix.cast("long")).select(
        "stem",
        "present",
        "contiguous_prefix",
        "expected",
        (
            (F.col("contiguous_prefix") == F.col("present"))
            & (F.col("expected").isNull() | (F.col("expected") == F.col("present")))
        ).alias("complete"),
    )

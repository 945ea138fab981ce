"""Readers for instruction records, documents, templates, registries and stored indexes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loreweave.operators.ordered import PART_CHARS, Segments, join_ordered

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("instruction", "input", "output")])
CORRUPT = "_corrupt_record"


def read_instructions(spark: SparkSession, path: str, *, array_file: bool = False) -> DataFrame:
    """Instruction records from JSON lines, with ``_corrupt_record`` set where a line is no record.

    ``array_file`` reads a file that is one JSON array; such a file is one task, so large inputs should be lines.
    """
    schema = T.StructType([*RECORD.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).json(
        path, multiLine=array_file, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )


def good_records(records: DataFrame) -> DataFrame:
    return records.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text)``: every file as one document."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def concat_pages(pages: DataFrame, doc: str, page: str, text: str, part_chars: int = PART_CHARS) -> DataFrame:
    """Page texts of each document in page order, no separator: ``(doc, part, text)``."""
    return join_ordered(pages.select(doc, page, text), [doc], [page], F.col(text), "", Segments(), part_chars)


def load_template(spark: SparkSession, path: str, fallback: str | None = None) -> str:
    """Text of a template file; a missing file gives ``fallback``, or an error without one."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    if row is not None:
        return row["value"]
    if fallback is None:
        raise FileNotFoundError(path)
    return fallback


def read_model_registry(spark: SparkSession, path: str) -> DataFrame:
    """``(name, model_id, lora_id)`` from JSON arrays, with the default name where none is given."""
    schema = "name string, model_id string, lora_id string"
    models = spark.read.schema(schema).json(path, multiLine=True)
    return models.withColumn("name", F.coalesce("name", F.lit("model_rating")))


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether a finished table lies at ``path``; a write that broke off leaves no success mark."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def index_build_or_load(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The index at ``path``, built and stored there first if it is missing.

    Each index is decided on its own.
    """
    if not is_stored(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def parse_generated_records(texts: DataFrame, text: Column, instruction: str, size: int = 10) -> DataFrame:
    """Records from model-written JSON arrays: the columns of ``texts`` plus the record and ``reason``.

    An accepted row has a null reason; a text that is no array, or not of exactly ``size`` records, is one rejected row,
    and so is each record with a missing field or another instruction.
    """
    parsed = F.from_json(text, T.ArrayType(RECORD))
    held = texts.withColumn("_records", parsed)
    bad = F.when(F.col("_records").isNull(), "not a JSON array").when(F.size("_records") != size, "wrong size")
    held = held.withColumn("_bad", bad)
    none = F.lit(None).cast(T.ArrayType(RECORD))
    rows = held.select(
        *texts.columns, "_bad", F.posexplode_outer(F.when(F.col("_bad").isNull(), F.col("_records")).otherwise(none))
    )
    fields = [F.col(f"col.{n}").alias(n) for n in RECORD.names]
    missing = F.col("instruction").isNull() | F.col("input").isNull() | F.col("output").isNull()
    reason = (
        F.when(F.col("_bad").isNotNull(), F.col("_bad"))
        .when(missing, "missing field")
        .when(F.col("instruction") != instruction, "other instruction")
    )
    return rows.select(*texts.columns, "_bad", F.col("pos").alias("record_no"), *fields).withColumn("reason", reason).drop("_bad")

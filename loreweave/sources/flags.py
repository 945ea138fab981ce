"""The log of flagged exchanges, a CSV table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# The columns of the log and how they are quoted, so that answers of several lines survive.
LOG_SCHEMA = "Input string, ggml string, chatgpt string, flag string, username string, timestamp timestamp_ntz"
CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "quoteAll": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def log_rows(flagged: DataFrame) -> DataFrame:
    """Log columns from ``(input, answer_a, answer_b, flag, username, ts)``."""
    return flagged.select(
        F.col("input").alias("Input"),
        F.col("answer_a").alias("ggml"),
        F.col("answer_b").alias("chatgpt"),
        "flag",
        "username",
        F.col("ts").alias("timestamp"),
    )


def flag_log_append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").options(**CSV).csv(path)


def flag_log_read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).options(**CSV).option("multiLine", "true").csv(path)


def stream_flag_log(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of flagged exchanges to the log and stop when what is there has been read."""
    return (
        rows.writeStream.format("csv")
        .options(**CSV)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

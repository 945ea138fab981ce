"""Session helpers: the shared scratch folder, and size checks before anything is broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Largest row count we are willing to hold on the driver or ship to every executor.
SMALL_ROWS = 65_536


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only on one machine (master ``local[...]``) a temporary folder is made and set where none is named; executors elsewhere
    would not see it, so any other master without a named folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        need_one_machine(spark.sparkContext.master)
        folder = tempfile.mkdtemp(prefix="loreweave-")
        spark.sparkContext.setCheckpointDir(folder)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def need_one_machine(master: str) -> None:
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"master {master}: name a folder that all executors share in spark.checkpoint.dir")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan of few splits over all cores, for work that is heavy on the processor.

    Only where half of the cores or more would stand idle; a large input has splits enough and is not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() * 2 <= cores else df


def small_rows(df: DataFrame, limit: int = SMALL_ROWS) -> list | None:
    """The rows of ``df`` if there are at most ``limit`` of them, else ``None``.

    At most ``limit + 1`` rows ever reach the driver.
    """
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def bounded_rows(df: DataFrame, what: str, limit: int = SMALL_ROWS) -> list:
    """Like ``small_rows`` for tables that are small by definition; a larger one is an error."""
    rows = small_rows(df, limit)
    if rows is None:
        raise ValueError(f"{what} has more than {limit} rows; raise the limit if that is intended")
    return rows

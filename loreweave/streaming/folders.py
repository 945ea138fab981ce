"""Folders that the batches of a stream write, merged level by level, so that a batch reads few of them.

Folder ``number`` of level j holds the rows of ``merged ** j`` batches; batch n writes folder n of level 0. A batch reads folders of
earlier batches alone, and which ones follows from its number, so a batch that is run again reads and writes the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MERGED = 8


def folders_before(batch_id: int, merged: int = MERGED) -> Iterator[tuple[int, int]]:
    """Level and number of the folders that hold what the batches before this one wrote, each batch once.

    There are at most ``merged - 1`` of each level, so the list grows with the logarithm of the batches.
    """
    level = 0
    while batch_id:
        last = batch_id % merged
        yield from ((level, number) for number in range(batch_id - last, batch_id))
        batch_id, level = batch_id // merged, level + 1


def merges_before(batch_id: int, merged: int = MERGED) -> Iterator[tuple[int, int]]:
    """Level and number of the folders that become complete with the batch before this one, lowest level first."""
    level = 0
    while batch_id and batch_id % merged == 0:
        batch_id, level = batch_id // merged, level + 1
        yield level, batch_id - 1


def same(df: DataFrame) -> DataFrame:
    return df


@dataclass
class BatchFolders:
    """The folders of one stream below ``path``; ``combine`` reduces the rows of several folders to those worth keeping."""

    spark: SparkSession
    path: str
    schema: T.StructType | str
    combine: Callable[[DataFrame], DataFrame] = same
    merged: int = MERGED

    def _read(self, folders: list[tuple[int, int]]) -> DataFrame:
        return self.combine(self.spark.read.schema(self.schema).parquet(*[self._folder(*at) for at in folders]))

    def _folder(self, level: int, number: int) -> str:
        return f"{self.path}/level={level}/number={number}"

    def before(self, batch_id: int) -> DataFrame | None:
        """What the batches before this one wrote, combined; ``None`` for the first. Merges the folders that have become complete."""
        for level, number in merges_before(batch_id, self.merged):
            parts = [(level - 1, number * self.merged + i) for i in range(self.merged)]
            self._read(parts).write.mode("overwrite").parquet(self._folder(level, number))
        return self._read(list(folders_before(batch_id, self.merged))) if batch_id else None

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        """Write the rows of a batch, in place of those of an earlier run of it, and read them back."""
        df.write.mode("overwrite").parquet(self._folder(0, batch_id))
        return self.spark.read.schema(df.schema).parquet(self._folder(0, batch_id))


def batch_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows that the batches of a stream wrote below ``path``."""
    return spark.read.schema(schema).parquet(f"{path}/level=0")

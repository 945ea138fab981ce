"""Stateful flows over event streams, each with a batch twin.

Rows of one micro-batch are applied per key in the order of ``(ts, event_id)``.  A row older than one
applied in an earlier batch is applied on arrival and flagged ``late``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loreweave.operators.memory import UNITS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(spark: SparkSession, folder: str, table: str, max_files: int) -> DataFrame:
    """A table, one file or a folder of files, as a stream of its files, at most ``max_files`` in a micro-batch."""
    path = f"{folder}/{table}.parquet"
    # as a plain path the stream takes folders alone; a pattern that fits this one name may find a file
    return read_arrivals(spark, f"{path[:-1]}[{path[-1]}]", spark.read.parquet(path).schema, max_files)


def read_arrivals(spark: SparkSession, folder: str, schema: T.StructType, max_files: int) -> DataFrame:
    """The files that arrive in a folder, as a stream, at most ``max_files`` in a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _sorted(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of one key in one micro-batch; how many that can be is set by the stream's trigger limits."""
    return pd.concat(list(rows)).sort_values(["ts", "event_id"], kind="stable")


class _Conversation(StatefulProcessor):
    """Standing inputs of a conversation by position, beside a head that counts them.

    A batch writes the inputs that it adds and removes those that it cancels; what stood before and still stands is neither read nor
    written, so the state touched by an event does not grow with the conversation. An input is removed once, by its cancel or by a clear.
    """

    def __init__(self, idle_ms: int | None) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.standing = handle.getMapState("standing", "position long", "event_id long, input string")
        self.head = handle.getValueState("head", "depth long, ts timestamp, event_id long, expires long")

    def _event_at(self, position: int) -> int | None:
        return self.standing.getValue((position,))[0] if position >= 0 else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        depth, ts, event_id, expires = self.head.get() if self.head.exists() else (0, None, None, None)
        last = newest = None if ts is None else (pd.Timestamp(ts), event_id)
        # the first `kept` stored inputs still stand, then come the fresh ones
        kept, fresh, top = depth, [], self._event_at(depth - 1)
        out = []
        for e in _sorted(rows).itertuples(index=False):
            at = (pd.Timestamp(e.ts), int(e.event_id))
            if e.action == "submit":
                if e.reply:
                    fresh.append((at[1], e.input))
            elif e.action == "cancel":
                if fresh:
                    fresh.pop()
                elif kept:
                    kept -= 1
                    top = self._event_at(kept - 1)
            elif e.action == "clear":
                kept, fresh, top = 0, [], None
            out.append((key[0], at[1], kept + len(fresh), fresh[-1][0] if fresh else top, last is not None and at < last))
            newest = at if newest is None else max(newest, at)
        if not kept and depth:
            self.standing.clear()
        else:
            for position in range(kept + len(fresh), depth):
                self.standing.removeKey((position,))
        for position, entry in enumerate(fresh, kept):
            self.standing.updateValue((position,), entry)
        if self.idle_ms is not None:
            if expires is not None:
                self.handle.deleteTimer(expires)
            expires = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
            self.handle.registerTimer(expires)
        self.head.update((kept + len(fresh), newest[0].to_pydatetime(), newest[1], expires))
        yield pd.DataFrame(out, columns=["conv_id", "event_id", "depth", "top_event_id", "late"]).astype(
            {"top_event_id": "Int64"}
        )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.standing.clear()
        self.head.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_conversation_state(events: DataFrame, idle_seconds: int | None = None) -> DataFrame:
    """After every event of a conversation: how many inputs stand and which is the last.

    ``events`` is a stream of ``(conv_id, ts, event_id, action, input, reply)``; a submit whose reply is
    empty is not kept.  The rows of a conversation in one micro-batch are sorted in one task; the trigger limit of the stream bounds them.
    With ``idle_seconds`` a conversation without events for that long (processing time) is forgotten as a whole, and starts anew if it goes on;
    such a stream goes on making batches for its timers, so it needs a processing-time trigger (``availableNow`` would not end).
    """
    use_rocksdb(events.sparkSession)
    return (
        events.select("conv_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "action", "input", "reply")
        .groupBy("conv_id")
        .transformWithStateInPandas(
            _Conversation(None if idle_seconds is None else idle_seconds * 1000),
            "conv_id long, event_id long, depth long, top_event_id long, late boolean",
            "Append",
            "None" if idle_seconds is None else "ProcessingTime",
        )
    )


class _Reflection(StatefulProcessor):
    """Importance an agent has gathered since its last reflection, in millionths."""

    def __init__(self, limit: int) -> None:
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.gathered = handle.getValueState("gathered", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        total = self.gathered.get()[0] if self.gathered.exists() else 0
        out = []
        for e in _sorted(rows).itertuples(index=False):
            total += int(e.units)
            if total > self.limit:
                out.append((key[0], e.ts, int(e.event_id), total / UNITS))
                total = 0
        self.gathered.update((total,))
        yield pd.DataFrame(out, columns=["agent", "ts", "event_id", "reached"]).astype(
            {"agent": "int64", "ts": "datetime64[ns]", "event_id": "int64", "reached": "float64"}
        )

    def close(self) -> None:
        pass


def stream_reflection(memories: DataFrame, threshold: float) -> DataFrame:
    """Events at which an agent reflects; equals ``reflection_trigger`` for events in order."""
    from loreweave.operators.memory import units

    use_rocksdb(memories.sparkSession)
    return (
        memories.select(
            "agent", F.col("ts").cast("timestamp").alias("ts"), "event_id", units(F.col("importance")).alias("units")
        )
        .groupBy("agent")
        .transformWithStateInPandas(
            _Reflection(round(threshold * UNITS)),
            "agent long, ts timestamp, event_id long, reached double",
            "Append",
            "None",
        )
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        .withColumn("reached", F.round("reached", 6))
    )


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is there now, and return what it wrote."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)

"""Fine-tuning examples: exact split, reproducible shuffle, batches, vocabulary, token ids, masks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loreweave.functions.vectors import token_slices, tokens

UNK, BOS, EOS, PAD = 0, 1, 2, 0
SPECIAL_PIECES = ("<unk>", "<s>", "</s>")
# the pieces of single bytes, as vocabularies write them
BYTE_PIECES = [f"<0x{b:02X}>" for b in range(256)]
IGNORED = -100


def order_hash(id_column: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), id_column.cast("string")))


def global_index(
    df: DataFrame, order: str, id_column: str, name: str = "global_index", by: Sequence[str] = (), digits: int = 4
) -> DataFrame:
    """Dense row number 0.. over the whole table, or per ``by``, in the order of ``(order, id_column)``.

    ``order`` is a hex hash of a unique id, so its first ``digits`` characters cut the table into even
    buckets: 65,536 by default.  Only the bucket counts are ranked globally.
    """
    keys = [*by, "_bucket"]
    held = df.withColumn("_bucket", F.substring(order, 1, digits))
    counts = held.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # one row per bucket: bounded by 16 ** digits (per split) whatever the table holds
    earlier = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = W.partitionBy(*keys).orderBy(order, id_column)
    return (
        held.join(F.broadcast(starts), keys)
        .withColumn(name, F.col("_start") + F.row_number().over(inside) - 1)
        .drop("_bucket", "_start")
    )


def seeded_shuffle(df: DataFrame, id_column: str, seed: int, name: str = "position") -> DataFrame:
    """Position of each row in a shuffle that depends only on the seed and the unique id."""
    return global_index(df.withColumn("_h", order_hash(F.col(id_column), seed)), "_h", id_column, name).drop("_h")


def exact_split(df: DataFrame, id_column: str, ratio: float, seed: int = 42) -> DataFrame:
    """Add ``split``: exactly ``int(n * ratio)`` rows are ``test``, the rest ``train``."""
    ranked = seeded_shuffle(df, id_column, seed, "_rank")
    size = df.agg(F.floor(F.count(F.lit(1)) * F.lit(float(ratio)))).scalar()
    return ranked.withColumn("split", F.when(F.col("_rank") < size, "test").otherwise("train")).drop("_rank")


def assign_batches(df: DataFrame, position: str, micro_batch: int, batch: int) -> DataFrame:
    """Micro batch and optimizer step of each row, from its position in the shuffle."""
    return df.withColumn("micro_batch", F.expr(f"{position} div {int(micro_batch)}")).withColumn(
        "step", F.expr(f"{position} div {int(batch)}")
    )


def training_plan(df: DataFrame, ratio: float, batch: int, micro_batch: int, epochs: int, world_size: int = 1) -> DataFrame:
    """Sizes, optimizer steps and accumulation for a table of examples, one row."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    sized = n.withColumn("test", F.floor(F.col("n") * F.lit(float(ratio)))).withColumn("train", F.expr("n - test"))
    return sized.withColumn(
        "steps", F.greatest(F.expr(f"(train div {int(batch)}) * {int(epochs)}"), F.lit(int(epochs)).cast("long"))
    ).withColumn("accumulation", F.lit(batch // micro_batch // world_size).cast("long"))


def build_vocab(df: DataFrame, text: Column, size: int, byte_pieces: bool = False) -> DataFrame:
    """The ``size`` most frequent tokens as ``(id, piece, n)``; ids follow the three special pieces.

    With ``byte_pieces`` the first 256 of the ``size`` pieces stand for single bytes (``<0x00>`` to ``<0xFF>``, counted 0 times), so
    that ``encode_ids`` can spell any other token. Counting combines before the shuffle; ranking sees at most ``size`` rows.
    """
    held = len(BYTE_PIECES) if byte_pieces else 0
    counts = df.select(F.explode(tokens(text)).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "piece").limit(max(0, size - held))
    rank = F.row_number().over(W.orderBy(F.desc("n"), "piece"))
    ranked = top.select((rank + F.lit(len(SPECIAL_PIECES) + held - 1)).cast("int").alias("id"), "piece", "n")
    if not byte_pieces:
        return ranked
    spelled = [(i, piece, 0) for i, piece in enumerate(BYTE_PIECES, len(SPECIAL_PIECES))]
    return ranked.unionByName(df.sparkSession.createDataFrame(spelled, "id int, piece string, n long"))


def _broadcast_vocab(vocab: DataFrame, limit: int):
    """The pieces of a vocabulary, their ids, and the ids of the 256 bytes, or none if it does not spell them all."""
    rows = vocab.select("id", "piece").limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        raise ValueError(f"vocabulary has more than {limit} pieces; raise the limit if that is intended")
    ids = dict(zip(rows["piece"].to_pylist(), rows["id"].to_pylist()))
    spelled = np.array([ids[p] for p in BYTE_PIECES], np.int32) if all(p in ids for p in BYTE_PIECES) else None
    return vocab.sparkSession.sparkContext.broadcast((pa.array(list(ids), pa.string()), pa.array(list(ids.values()), pa.int32()), spelled))


def _coded(batch: pa.Array, held) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the tokens of all lists in one array, and how many each list has."""
    pieces, ids, spelled = held.value
    lists = batch.fill_null([]) if batch.null_count else batch
    flat = lists.flatten()
    found = pc.fill_null(pc.take(ids, pc.index_in(flat, value_set=pieces)), -1).to_numpy(zero_copy_only=False)
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    unknown = np.flatnonzero(found < 0)
    if spelled is None or not len(unknown):
        return np.where(found < 0, UNK, found), counts
    # unknown tokens become their bytes
    spell = flat.take(pa.array(unknown)).cast(pa.large_binary())
    bounds = np.frombuffer(spell.buffers()[1], np.int64)[spell.offset : spell.offset + len(spell) + 1]
    sizes = np.ones(len(found), np.int64)
    sizes[unknown] = np.diff(bounds)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = np.repeat(found, sizes)
    out[out < 0] = spelled[np.frombuffer(spell.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]]
    ends = np.concatenate([[0], np.cumsum(counts)])
    return out, np.diff(starts[ends])


def encode_ids(
    df: DataFrame, texts: Mapping[str, Column], vocab: DataFrame, limit: int = 1 << 20, counted: Mapping[str, Column] | None = None
) -> DataFrame:
    """Add, under each name, the token ids of a text with begin and end marks; for ``counted`` texts only how many there are.

    A token that is not in the vocabulary becomes the ids of its UTF-8 bytes if the vocabulary has byte pieces, else 0. The
    vocabulary, at most ``limit`` pieces, goes to every executor once; rows are not shuffled.
    """
    held = _broadcast_vocab(vocab, limit)

    def coded(batch: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lengths = pc.fill_null(batch.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in token_slices(lengths):
            yield _coded(batch.slice(a, b - a), held)

    def marked(values: np.ndarray, counts: np.ndarray) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(counts + 2)])
        out = np.full(int(ends[-1]), EOS, dtype=np.int32)
        out[ends[:-1]] = BOS
        inner = np.ones(len(out), dtype=bool)
        inner[ends[:-1]] = False
        inner[ends[1:] - 1] = False
        out[inner] = values
        return pa.ListArray.from_arrays(ends.astype(np.int32), out)

    @F.arrow_udf("array<int>")
    def encoded(batch: pa.Array) -> pa.Array:
        parts = [marked(*part) for part in coded(batch)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    @F.arrow_udf("int")
    def length(batch: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0, np.int64), *[counts + 2 for _, counts in coded(batch)]]), pa.int32())

    added = {name: encoded(tokens(text)) for name, text in texts.items()}
    return df.withColumns(added | {name: length(tokens(text)) for name, text in (counted or {}).items()})


def mask_labels(prompt_tokens: Column, full_ids: Column, length: int) -> Column:
    """Struct ``(input_ids, labels, attention_mask, real_mask)`` of fixed ``length``, padded right.

    The prompt, without its end mark, is ignored in the labels.  The attention mask is all ones, also on
    padding; ``real_mask`` is not.
    """
    size = F.lit(length)
    kept = F.slice(full_ids, 1, length)
    padded = F.slice(F.concat(kept, F.array_repeat(F.lit(PAD), size)), 1, length)
    # the tokenizer truncates the prompt to length + 1 before its last id is left out
    ignored = F.least(prompt_tokens, F.lit(length + 1)) - 1
    labels = F.concat(F.array_repeat(F.lit(IGNORED), ignored), F.slice(padded, ignored + 1, size))
    real = F.slice(
        F.concat(F.array_repeat(F.lit(1), F.size(kept)), F.array_repeat(F.lit(0), size)), 1, length
    )
    return F.struct(
        padded.alias("input_ids"),
        labels.alias("labels"),
        F.array_repeat(F.lit(1), size).alias("attention_mask"),
        real.alias("real_mask"),
    )


def answer_twice_check(df: DataFrame, prompt: Column, output: Column, keys: Sequence[str] = ()) -> DataFrame:
    """How many masked prompts already hold the answer, per key or over everything."""
    leaks = (F.length(output) > 0) & (F.instr(prompt, output) > 0)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(leaks.cast("long")).alias("leaking"),
    )

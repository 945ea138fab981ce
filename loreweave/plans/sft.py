"""Instruction records to masked, split, shuffled and batched training examples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loreweave.functions.templates import TRAIN_TEMPLATE, fill_template
from loreweave.operators.chat import turn_pairs
from loreweave.operators.training import (
    assign_batches,
    encode_ids,
    exact_split,
    global_index,
    mask_labels,
    order_hash,
)
from loreweave.session import written

DEFAULT_INSTRUCTION = "Continue the conversation."


def instruction_records(conversations: DataFrame) -> DataFrame:
    """``(id, conv_id, turn, instruction, input, output)``: every answered turn, with its system text if any."""
    system = (
        conversations.where(F.col("role") == "system").groupBy("conv_id").agg(F.min_by("text", "turn").alias("_system"))
    )
    return (
        turn_pairs(conversations)
        .join(system, "conv_id", "left")
        .select(
            F.concat_ws("/", "conv_id", "turn").alias("id"),
            "conv_id",
            "turn",
            F.coalesce("_system", F.lit(DEFAULT_INSTRUCTION)).alias("instruction"),
            "input",
            "output",
        )
    )


def placed_records(
    records: DataFrame,
    *,
    ratio: float = 0.3,
    seed: int = 42,
    shuffle_seed: int = 7,
    micro_batch: int = 8,
    batch: int = 64,
) -> DataFrame:
    """The records with ``split``, ``position`` in the shuffle of their split, ``micro_batch`` and ``step``.

    Ranks are computed on ids alone; the texts are moved once, to be joined with them.
    """
    # narrow, and read twice below
    ids = written(exact_split(records.select("id"), "id", ratio, seed), "split")
    hashed = ids.withColumn("_h", order_hash(F.col("id"), shuffle_seed))
    shuffled = global_index(hashed, "_h", "id", "position", by=["split"]).drop("_h")
    return records.join(assign_batches(shuffled, "position", micro_batch, batch), "id")


def encoded_examples(placed: DataFrame, vocab: DataFrame, template: str = TRAIN_TEMPLATE, length: int = 2048) -> DataFrame:
    """Ids, labels and masks of placed records.  No shuffle: the long arrays are made where the record is."""
    fields = {c: F.col(c) for c in ("instruction", "input", "output")}
    prompts = placed.withColumn("_prompt", fill_template(template, fields))
    coded = encode_ids(prompts, {"_full": F.concat("_prompt", "output")}, vocab, counted={"_n_prompt": F.col("_prompt")})
    masked = mask_labels(F.col("_n_prompt"), F.col("_full"), length)
    return coded.select("id", "split", "position", "micro_batch", "step", masked.alias("_m")).select(
        "id", "split", "position", "micro_batch", "step", "_m.*"
    )


def sft_dataset(
    records: DataFrame, vocab: DataFrame, *, template: str = TRAIN_TEMPLATE, length: int = 2048, **placing
) -> DataFrame:
    """Examples ``(id, split, position, micro_batch, step, input_ids, labels, attention_mask, real_mask)``."""
    return encoded_examples(placed_records(records, **placing), vocab, template, length)


def write_sft_dataset(
    records: DataFrame, vocab: DataFrame, path: str, *, template: str = TRAIN_TEMPLATE, length: int = 2048, **placing
) -> DataFrame:
    """Store the examples by split in training order and read them back.

    Records are put in order while they are still short.
    """
    placed = placed_records(records, **placing).repartitionByRange("split", "position")
    ordered = placed.sortWithinPartitions("split", "position")
    encoded_examples(ordered, vocab, template, length).write.partitionBy("split").parquet(path)
    return records.sparkSession.read.parquet(path)

"""Assigning rows to batches, batches to workers, and batches to updates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.columns import idiv
from lexmill.operators.ordinal import dense_ordinal, shuffled_rank


def _batches(ranked: DataFrame, batch_size: int) -> DataFrame:
    return ranked.withColumns(
        {
            "batch_id": idiv(F.col("_rank"), batch_size),
            "pos_in_batch": (F.col("_rank") % batch_size).cast("int"),
        }
    ).drop("_rank")


def batch_shuffled(rows: DataFrame, batch_size: int = 32, seed: int = 42, id_col: str = "chunk_id") -> DataFrame:
    """Batches in a new random order for each ``epoch``; the short last batch is kept."""
    return _batches(shuffled_rank(rows, seed, id_col, "_rank", ["epoch"]), batch_size)


def batch_in_split_order(rows: DataFrame, batch_size: int = 32, seed: int = 42, id_col: str = "chunk_id") -> DataFrame:
    """Sequential batches of one side of the exact split, in the order the split drew it."""
    return _batches(shuffled_rank(rows, seed, id_col, "_rank"), batch_size)


def batch_sequential(rows: DataFrame, batch_size: int = 16, order_col: str = "row_ord", dense: bool = True) -> DataFrame:
    """Batches of consecutive rows. A dense ``order_col`` needs no shuffle at all."""
    ranked = rows.withColumn("_rank", F.col(order_col)) if dense else dense_ordinal(rows, order_col, "_rank")
    return _batches(ranked, batch_size)


def shard_batches(batches: DataFrame, world: int) -> DataFrame:
    """Worker of each batch, round robin; write with ``partitionBy('shard')``."""
    return batches.withColumn("shard", (F.col("batch_id") % world).cast("int"))


def step_budget(rows: DataFrame, batch_size: int = 32, epochs: int = 3, accumulation: int = 4) -> DataFrame:
    """Rows, batches per epoch, total steps, and updates when ``accumulation`` batches make one."""
    per_epoch = idiv(F.col("n_rows") + batch_size - 1, batch_size)
    return (
        rows.agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("batches_per_epoch", per_epoch)
        .withColumn("training_steps", F.col("batches_per_epoch") * epochs)
        .withColumn("updates_per_epoch", idiv(F.col("batches_per_epoch") + accumulation - 1, accumulation))
    )


def with_update_id(batches: DataFrame, accumulation: int = 4) -> DataFrame:
    return batches.withColumn("update_id", idiv(F.col("batch_id"), accumulation))

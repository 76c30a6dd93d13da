"""Token losses to batch losses, and batch losses to perplexity and running means.

The three perplexities differ on purpose when the last batch is short; do not merge them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexmill.functions.columns import idiv

BLOCK_FANOUT = 4096


def batch_losses(scored: DataFrame, batches: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys…, batch_id, n_rows, n_pred, loss): mean nll over the predicted tokens of each batch.

    A batch without any predicted token has no mean: its loss is NaN. ``batches`` has one row per
    batch member.
    """
    by = [*(keys or []), "batch_id"]
    rows = batches.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    sums = scored.groupBy(*by).agg(F.sum("nll").alias("_nll"), F.count(F.lit(1)).alias("_n"))
    loss = F.when(F.col("_n") > 0, F.col("_nll") / F.col("_n")).otherwise(F.lit(float("nan")))
    return rows.join(sums, by, "left").select(
        *by, "n_rows", F.coalesce("_n", F.lit(0)).alias("n_pred"), loss.alias("loss")
    )


def row_losses(scored: DataFrame, keys: list[str]) -> DataFrame:
    """(keys…, row_nll, row_pred): what each row adds to the loss of the batch it lies in."""
    return scored.groupBy(*keys).agg(F.sum("nll").alias("row_nll"), F.count(F.lit(1)).alias("row_pred"))


def losses_of_rows(rows: DataFrame, batches: DataFrame, on: list[str], keys: list[str] | None = None) -> DataFrame:
    """The same as :func:`batch_losses` from :func:`row_losses`, which meet the batches' members ``on`` their keys.

    Only a pair of numbers a row moves, so rows scored once can be put into any number of batch orders.
    """
    by = [*(keys or []), "batch_id"]
    met = batches.select(*dict.fromkeys([*by, *on])).join(rows, on, "left")
    n = F.coalesce(F.sum("row_pred"), F.lit(0))
    loss = F.when(n > 0, F.sum("row_nll") / n).otherwise(F.lit(float("nan")))
    return met.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), n.alias("n_pred"), loss.alias("loss"))


def update_log(losses: DataFrame, accumulation: int = 4, every: int = 5) -> DataFrame:
    """(step, mean_loss): after every ``every``-th update, the mean loss of the batches since the entry before.

    ``losses`` holds the batches of each ``epoch``. ``accumulation`` batches make an update, the last one of an epoch may have fewer;
    updates are numbered from 1 through all epochs. Updates after the last full group are not logged.
    """
    per_epoch = losses.groupBy("epoch").agg((idiv(F.max("batch_id"), accumulation) + 1).alias("_updates"))
    # One row per epoch.
    before = F.coalesce(F.sum("_updates").over(W.orderBy("epoch").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = per_epoch.select("epoch", before.alias("_before"), F.sum("_updates").over(W.partitionBy()).alias("_all"))
    update = F.col("_before") + idiv(F.col("batch_id"), accumulation)
    step = (idiv(update, every) + 1) * every
    logged = losses.join(starts, "epoch").withColumn("step", step).filter(F.col("step") <= F.col("_all"))
    return logged.groupBy("step").agg(F.avg("loss").alias("mean_loss"))


def perplexity_weighted(losses: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """exp of the batch losses averaged with the number of rows of each batch."""
    mean = F.sum(F.col("loss") * F.col("n_rows")) / F.sum("n_rows")
    return losses.groupBy(*(keys or [])).agg(F.exp(mean).alias("perplexity"))


def perplexity_gather(losses: DataFrame, batch_size: int, keys: list[str] | None = None) -> DataFrame:
    """exp of the mean of every batch loss repeated ``batch_size`` times and cut to the number of rows.

    Repeating and cutting is a weight: the full batch size, or what is left for the last batch.
    """
    keys = keys or []
    sizes = losses.groupBy(*keys).agg(F.sum("n_rows").alias("_rows"))
    joined = losses.join(sizes, keys) if keys else losses.withColumn("_rows", sizes.scalar())
    left = F.col("_rows") - F.lit(batch_size) * F.col("batch_id")
    weight = F.greatest(F.least(F.lit(batch_size), left), F.lit(0))
    mean = F.sum(F.col("loss") * weight) / F.max("_rows")
    return joined.groupBy(*keys).agg(F.exp(mean).alias("perplexity"))


def perplexity_unweighted(losses: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """exp of the plain mean of the batch losses."""
    return losses.groupBy(*(keys or [])).agg(F.exp(F.avg("loss")).alias("perplexity"))


def validation_log(losses: DataFrame, step_counts: DataFrame, every: int = 200) -> DataFrame:
    """(step, batch_id, perplexity): the unweighted value logged at every ``every``-th validation batch.

    ``losses`` holds the validation batches of each ``epoch`` and ``step_counts`` (epoch, step) the
    training steps made before it. The value covers the whole set, so it is computed once per epoch.
    """
    whole = perplexity_unweighted(losses, ["epoch"])
    marks = losses.filter(F.col("batch_id") % every == 0).select("epoch", "batch_id")
    return marks.join(whole, "epoch").join(step_counts, "epoch").select("step", "batch_id", "perplexity")


def running_loss(losses: DataFrame, every: int = 100) -> DataFrame:
    """(epoch, batch_id, mean_loss) at every ``every``-th batch: mean over the epoch up to that batch.

    Batches are first summed in blocks that end at the reported batches, blocks in blocks of `BLOCK_FANOUT`; sums are
    accumulated inside those and over them, so no task gets a whole epoch.
    """
    block = F.ceil(F.col("batch_id") / F.lit(every)).cast("bigint")
    blocks = losses.groupBy("epoch", block.alias("_block")).agg(
        F.sum("loss").alias("_loss"), F.count(F.lit(1)).alias("_n"), F.max("batch_id").alias("_last")
    )
    blocks = blocks.withColumn("_group", idiv(F.col("_block"), BLOCK_FANOUT))
    before = W.partitionBy("epoch").orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    groups = blocks.groupBy("epoch", "_group").agg(F.sum("_loss").alias("_gl"), F.sum("_n").alias("_gn"))
    bases = groups.select(
        "epoch",
        "_group",
        F.coalesce(F.sum("_gl").over(before), F.lit(0.0)).alias("_base_loss"),
        F.coalesce(F.sum("_gn").over(before), F.lit(0)).alias("_base_n"),
    )
    upto = W.partitionBy("epoch", "_group").orderBy("_block").rowsBetween(W.unboundedPreceding, 0)
    inside = blocks.withColumns({"_own_loss": F.sum("_loss").over(upto), "_own_n": F.sum("_n").over(upto)})
    mean = (F.col("_base_loss") + F.col("_own_loss")) / (F.col("_base_n") + F.col("_own_n"))
    return (
        inside.join(bases, ["epoch", "_group"])
        .withColumn("mean_loss", mean)
        .filter(F.col("_last") == F.col("_block") * every)
        .select("epoch", F.col("_last").alias("batch_id"), "mean_loss")
    )


def epoch_loss(losses: DataFrame) -> DataFrame:
    return losses.groupBy("epoch").agg(F.avg("loss").alias("train_loss"))


def phase_loss(losses: DataFrame) -> DataFrame:
    """Mean step loss for each ``phase`` and ``epoch``."""
    return losses.groupBy("phase", "epoch").agg(
        F.count(F.lit(1)).alias("n_steps"), F.avg("loss").alias("mean_loss")
    )

"""Random masking as a function of (seed, epoch, row, position): the same draw on every retry.

One md5 digest serves four neighbouring positions, 32 bits each; a chosen position draws what happens
to it from a digest of its own. Digests are made for whole batches in the Python workers, step by step over arrays (`functions/digests.py`),
as everything else is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.digests import md5_numbered, md5_of_hex
from lexmill.functions.workers import reach_package
from lexmill.operators.vocab import MASK, SPECIALS

IGNORE = -100
STATIC_EPOCH = -1
MASK_SHARE, RANDOM_SHARE = 0.8, 0.1
LANES = 4


def limit(share: float) -> int:
    """32-bit numbers below this are the given share of all."""
    return min(round(share * (1 << 32)), 1 << 32)


def _masker(vocab_size: int, probability: float, seed: int, n_specials: int):
    least = limit(probability)
    to_mask, to_random = limit(MASK_SHARE), limit(MASK_SHARE + RANDOM_SHARE)

    def run(input_ids: pa.Array, epoch: pa.Array, row: pa.Array) -> pa.Array:
        offsets = input_ids.offsets.to_numpy().astype(np.int64)
        ids = input_ids.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False).copy()
        offsets -= offsets[0]
        sizes = np.diff(offsets)
        blocks = -(-sizes // LANES)
        digests = md5_numbered([f"{seed}:{e}:{r}:".encode() for e, r in zip(epoch.to_pylist(), row.to_pylist())], blocks)
        # Place of each token among the four draws of every block.
        first = np.cumsum(blocks) - blocks
        inside = np.arange(len(ids)) - np.repeat(offsets[:-1], sizes)
        place = np.repeat(first, sizes) * LANES + inside
        draws = digests.view(">u4").ravel()[place].astype(np.int64)
        chosen = np.flatnonzero((ids >= n_specials) & (draws < least))
        labels = np.full(len(ids), IGNORE, np.int32)
        labels[chosen] = ids[chosen]
        block, lane = np.divmod(place[chosen], LANES)
        words = md5_of_hex(digests[block], lane).view(">u4").astype(np.int64)
        fate, other = words[:, 0], words[:, 1] % vocab_size
        ids[chosen] = np.where(fate < to_mask, MASK, np.where(fate < to_random, other, ids[chosen]))
        borders = pa.array(offsets, pa.int32())
        lists = [pa.ListArray.from_arrays(borders, pa.array(x, pa.int32())) for x in (ids, labels)]
        return pa.StructArray.from_arrays(lists, names=["input_ids", "labels"])

    return F.arrow_udf(run, "input_ids array<int>, labels array<int>")


def mask_rows(
    chunks: DataFrame,
    vocab_size: int,
    epoch: Column,
    probability: float = 0.2,
    seed: int = 42,
    n_specials: int = len(SPECIALS),
    id_col: str = "chunk_id",
) -> DataFrame:
    """Corrupt ``input_ids`` and set ``labels``.

    Each token that is not special is chosen with ``probability``. A chosen token becomes the mask id
    (80 %), any vocabulary id (10 %) or stays (10 %); its label is the original id. All other labels
    are `IGNORE`.
    """
    reach_package(chunks.sparkSession)
    masked = _masker(vocab_size, probability, seed, n_specials)
    drawn = chunks.withColumn("_drawn", masked(F.col("input_ids"), epoch.cast("string"), F.col(id_col).cast("string")))
    return drawn.withColumns({"input_ids": F.col("_drawn")["input_ids"], "labels": F.col("_drawn")["labels"]}).drop("_drawn")


def mask_static(chunks: DataFrame, vocab_size: int, **options) -> DataFrame:
    """One fixed mask per row, for evaluation. Write the result once and reuse it every epoch."""
    return mask_rows(chunks, vocab_size, F.lit(STATIC_EPOCH), **options)


def repeat_epochs(chunks: DataFrame, epochs: int) -> DataFrame:
    """Every row once per epoch, with an ``epoch`` column; rows stay in their partition."""
    return chunks.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def mask_epochs(chunks: DataFrame, vocab_size: int, **options) -> DataFrame:
    """Fresh masks for every (epoch, row) of a table made by :func:`repeat_epochs`."""
    return mask_rows(chunks, vocab_size, F.col("epoch"), **options)

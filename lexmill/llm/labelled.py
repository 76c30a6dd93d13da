"""A bounded sample of labelled documents, for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents that a classifier learns from at most.
SAMPLE_ROWS = 20_000


def crc_fold(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int = SAMPLE_ROWS, seed: int = 7
) -> DataFrame:
    """``text, y`` of at most ``rows`` labelled documents outside the held-out fold, the same ones at every run.

    Rows with a null id or label, and ids with contradicting labels, teach nothing. The sample of ids is a small
    table of a fixed bound, so it is broadcast and no text moves to find its labels.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("key"), F.col(label).cast("int").alias("y"))
        .where(F.col("key").isNotNull() & F.col("y").isin(0, 1) & (crc_fold("key", folds) != held_out))
        .groupBy("key")
        .agg(F.min("y").alias("y"), F.max("y").alias("most"))
        .where("y = most")
        .orderBy(F.xxhash64("key", F.lit(seed)), "key")
        .limit(rows)
        .select("key", "y")
    )
    docs = documents.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return docs.join(F.broadcast(chosen), "key").select(F.coalesce("text", F.lit("")).alias("text"), "y")

"""Positions in a total order: dense ranks and prefix sums that never sort all rows in one task.

Rows are grouped into small buckets that follow the order, each bucket is totalled, the totals are
added up, and every row adds its position inside its bucket. The buckets' totals are added up inside ranges that follow
the data; only the totals of these ranges meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexmill.functions.columns import hex_prefix, idiv, md5_key
from lexmill.functions.scratch import materialize

BUCKET_ROWS = 128
KEY_DIGITS = 5


def _before(window: W) -> W:
    return window.rowsBetween(W.unboundedPreceding, -1)


def exclusive_bases(totals: DataFrame, bucket: str, total: str, parts: list[str] | None = None) -> DataFrame:
    """(parts…, bucket, total, base) with ``base`` = sum of ``total`` over all smaller buckets.

    ``totals`` has one row per (parts…, bucket). It is written first, in order and dealt into ranges taken from the data, because it is
    read twice and behind it may be a scan of the whole text. Only the ranges' totals meet: one row per shuffle partition
    (and part), however the buckets are spread over their numbers.
    """
    parts = parts or []
    order = [*parts, bucket]
    dealt = totals.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    totals = materialize(dealt, "totals")
    ranges = (
        totals.groupBy(*parts, "_range")
        .agg(F.sum(total).alias("_sum"))
        .withColumn("_range_base", F.sum("_sum").over(_before(W.partitionBy(*parts).orderBy("_range"))))
        .drop("_sum")
    )
    inside = F.sum(total).over(_before(W.partitionBy(*parts, "_range").orderBy(bucket)))
    return (
        totals.withColumn("_inside", inside)
        .join(ranges, [*parts, "_range"])
        .select(
            *parts,
            bucket,
            total,
            (F.coalesce("_range_base", F.lit(0)) + F.coalesce("_inside", F.lit(0))).cast("bigint").alias("base"),
        )
    )


def bucketed_rank(
    df: DataFrame, bucket: Column, order: list[str], out: str, parts: list[str] | None = None
) -> DataFrame:
    """Add ``out``, the dense rank from 0 by ``order`` within ``parts``.

    ``bucket`` must not decrease along ``order``. The rows move once, to the hash of their bucket;
    the join with the totals reuses that placement and order, so it is asked to be a merge join (for
    a small input the optimizer would broadcast the rows instead and work in one task). ``df`` is read twice, the first time for the
    bucket only, so it should be a scan or a cheap derivation of one.
    """
    parts = parts or []
    keyed = df.withColumn("_bucket", bucket)
    totals = keyed.groupBy(*parts, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    bases = exclusive_bases(totals, "_bucket", "_n", parts)
    place = F.row_number().over(W.partitionBy(*parts, "_bucket").orderBy(*order))
    return (
        keyed.withColumn("_place", place.cast("bigint"))
        .join(bases.hint("merge"), [*parts, "_bucket"])
        .withColumn(out, F.col("base") + F.col("_place") - 1)
        .drop("_bucket", "_place", "_n", "base")
    )


def dense_ordinal(df: DataFrame, order_col: str, out: str = "row_ord") -> DataFrame:
    """Renumber rows 0, 1, 2… by a unique whole-number column, say after a filter left gaps."""
    return bucketed_rank(df, idiv(F.col(order_col), BUCKET_ROWS), [order_col], out)


def sorted_ordinal(df: DataFrame, order: list[str], out: str = "row_ord") -> DataFrame:
    """Number rows from 0 by any unique key, however its values are spread.

    The rows are sorted by range and written with their place inside their partition; a later scan
    adds the rows of the earlier partitions. Ranges follow the data, so a key prefix that holds many
    rows is split. The broadcast table has one row per shuffle partition.
    """
    local_bits = F.lit((1 << 33) - 1)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = materialize(
        placed.withColumns(
            {"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(local_bits)}
        ),
        "sorted",
    )
    sizes = written.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    base = F.coalesce(F.sum("_n").over(_before(W.orderBy("_part"))), F.lit(0))
    bases = F.broadcast(sizes.select("_part", base.alias("_base")))
    return (
        written.join(bases, "_part")
        .withColumn(out, (F.col("_base") + F.col("_place")).cast("bigint"))
        .drop("_part", "_place", "_base")
    )


def shuffled_rank(df: DataFrame, seed: Column | int | str, id_col: str, out: str, parts: list[str] | None = None) -> DataFrame:
    """Dense rank from 0 in the repeatable random order given by the md5 of seed, parts and id."""
    parts = parts or []
    key = md5_key(seed, *[F.col(p) for p in parts], F.col(id_col))
    keyed = df.withColumn("_key", key)
    ranked = bucketed_rank(keyed, hex_prefix(F.col("_key"), KEY_DIGITS), ["_key", id_col], out, parts)
    return ranked.drop("_key")


def file_ordinal(scan: DataFrame, out: str = "row_ord") -> DataFrame:
    """Number the rows of a file scan in file order.

    ``scan`` carries `_path` and `_block` from the file metadata (and may be filtered). Rows of one block are read in order by one
    task, so their monotonic ids are consecutive. The rows are parsed once and written with them; the table then says where
    each block begins and how many rows lie before it. Nothing depends on how a later scan would be split.
    """
    rows = materialize(scan.withColumn("_mid", F.monotonically_increasing_id()), "file_rows")
    blocks = rows.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # One row per input split. It is written, so its size is known, and broadcast only while it is small.
    base = F.coalesce(F.sum("_n").over(_before(W.orderBy("_path", "_block"))), F.lit(0))
    blocks = materialize(blocks.select("_path", "_block", "_first", base.alias("_base")), "blocks")
    place = F.col("_base") + F.col("_mid") - F.col("_first")
    return (
        rows.join(blocks, ["_path", "_block"])
        .withColumn(out, place.cast("bigint"))
        .drop("_path", "_block", "_mid", "_first", "_base")
    )

"""Cutting a stream of tokens into rows of fixed length.

Every row learns the position of its first token by a running sum, cuts itself at the multiples of
the row length, and only the cut pieces meet. No long concatenated list is ever built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexmill.functions.columns import idiv
from lexmill.operators.encode import with_masks
from lexmill.operators.ordinal import BUCKET_ROWS, exclusive_bases

WINDOW_ROWS = 1000
CHUNK_BITS = 32


def _running(size: str, partition: str) -> Column:
    """Sum over the earlier rows of the partition."""
    before = W.partitionBy(partition).orderBy("row_ord").rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(before), F.lit(0))


def _cut(placed: DataFrame, keys: list[str], columns: list[str], length: int) -> DataFrame:
    """(keys…, chunk_no, lo, one slice per column) from rows with ``_start`` and ``_n``."""
    start = F.col("_start")
    end = start + F.col("_n")

    def piece(c: Column) -> Column:
        lo = F.greatest(start, c * length)
        hi = F.least(end, (c + 1) * length)
        cuts = [F.slice(col, (lo - start + 1).cast("int"), (hi - lo).cast("int")).alias(col) for col in columns]
        return F.struct(c.alias("chunk_no"), lo.alias("lo"), *cuts)

    # An empty row owns no token; `sequence` would count downwards for it.
    pieces = F.transform(F.sequence(idiv(start, length), idiv(end - 1, length)), piece)
    return placed.filter(F.col("_n") > 0).select(*keys, F.inline(pieces))


def _assemble(pieces: DataFrame, keys: list[str], columns: list[str], length: int) -> DataFrame:
    """Put the pieces of each chunk in order; a chunk that is not full is the dropped tail."""
    group = pieces.groupBy(*keys, "chunk_no").agg(
        F.array_sort(F.collect_list(F.struct("lo", *columns))).alias("_p"), F.sum(F.size(columns[0])).alias("_len")
    )
    joined = [F.flatten(F.col("_p")[col]).alias(col) for col in columns]
    return group.filter(F.col("_len") == length).select(*keys, "chunk_no", *joined)


def _with_labels(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("labels", F.col("input_ids"))


def chunk_tokens(
    tokens: DataFrame, chunk_size: int = 128, window_rows: int = WINDOW_ROWS, columns: list[str] | None = None
) -> DataFrame:
    """Chunks of ``chunk_size`` tokens inside windows of ``window_rows`` consecutive rows.

    ``row_ord`` must be dense from 0 over the rows that remain after filtering. The remainder of each
    window is dropped. Token arrays are shuffled once, by window, and every later step reuses that
    placement. Type ids and attention mask are constant for unpadded rows and are made afterwards;
    name ``columns`` to carry other lists along (then labels copy the first).
    """
    carried = columns or ["input_ids"]
    window = tokens.select(
        idiv(F.col("row_ord"), window_rows).alias("window_id"),
        "row_ord",
        *carried,
        F.size(carried[0]).cast("bigint").alias("_n"),
    )
    placed = window.withColumn("_start", _running("_n", "window_id"))
    chunks = _assemble(_cut(placed, ["window_id"], carried, chunk_size), ["window_id"], carried, chunk_size)
    # Unique and in order, without counting the chunks of earlier windows.
    chunk_id = F.shiftleft(F.col("window_id"), CHUNK_BITS) + F.col("chunk_no")
    chunks = chunks.select("window_id", "chunk_no", chunk_id.alias("chunk_id"), *carried)
    return _with_labels(chunks if columns else with_masks(chunks))


def pack_causal(tokens: DataFrame, end_id: int, length: int = 256) -> DataFrame:
    """Rows of ``length`` tokens from all texts joined with ``end_id`` after each; one tail is dropped.

    The place of a row in the whole stream is the total of the earlier buckets plus a running sum
    inside its bucket, so nothing is totalled in one task but the bucket totals.
    """
    ended = tokens.select(
        "row_ord",
        idiv(F.col("row_ord"), BUCKET_ROWS).alias("_bucket"),
        F.concat(F.col("input_ids"), F.array(F.lit(end_id))).alias("input_ids"),
    ).withColumn("_n", F.size("input_ids").cast("bigint"))
    # The totals need lengths only; a stored ``n_tokens`` keeps that first reading narrow.
    length_of = F.col("n_tokens") if "n_tokens" in tokens.columns else F.size("input_ids")
    totals = tokens.select(idiv(F.col("row_ord"), BUCKET_ROWS).alias("_bucket"), (length_of + 1).alias("_m"))
    totals = totals.groupBy("_bucket").agg(F.sum("_m").alias("_total"))
    placed = (
        ended.withColumn("_inside", _running("_n", "_bucket"))
        .join(exclusive_bases(totals, "_bucket", "_total").hint("merge"), "_bucket")
        .withColumn("_start", F.col("base") + F.col("_inside"))
    )
    keys = ["_bucket", "base", "_total"]
    pieces = _cut(placed, keys, ["input_ids"], length)
    # A chunk inside one bucket is put together where the bucket already is; only the chunks on the
    # border of two buckets are shuffled again.
    first = F.col("chunk_no") * length
    inside = (first >= F.col("base")) & (first + length <= F.col("base") + F.col("_total"))
    whole = _assemble(pieces.filter(inside), ["_bucket"], ["input_ids"], length)
    border = _assemble(pieces.filter(~inside), [], ["input_ids"], length)
    packed = whole.drop("_bucket").unionByName(border)
    return _with_labels(with_masks(packed.select(F.col("chunk_no").alias("chunk_id"), "input_ids")))

"""Token ids of whole documents in ORC files, in ascending order of the ids of the documents.

Writing: texts are dealt to ranges of ``doc_id`` (rows that repeat an id are told apart by a hash of the text and a row number, so one
id may fill many ranges), sorted inside a range, tokenized where they lie and written by Spark's ORC writer, one
file per range. Texts move, not ids, because they are the smaller of the two; nothing is tokenized twice, as
the ranges are found from a scan of the table alone. A row is a document: ``doc_id``, the number of its range (``part``),
its place among the ids of the range (``first``), ``n_tokens`` and ``ids``. ORC keeps integers, and the items of lists, in run-length
encoding, an index entry (least and largest value, place in the stripe) for every ``INDEX_ROWS`` rows, and a Bloom filter of
``doc_id`` for each entry. Files appear when Spark commits the job, so a lost executor leaves nothing that is read.

Reading: stripes are read by different tasks. The total of each range gives the place of a document among all ids, so no
task sees more than its own rows; only the totals (one row a range) are put in order together. :func:`find` asks for
single documents: least and largest values rule out files and stripes, the Bloom filters rule out most groups
of rows. :func:`between` reads a run of places in the whole stream and opens the files of the ranges it lies in.

Defined cases: null or empty text is the closing id alone; rows with a null id come first; rows that repeat an id are ordered
by a hash of their text, equal rows in any order (their rows of the result are alike but for ``start``); an empty table gives files
without rows and an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.scratch import scratch_path
from lexmill.llm.pieces import IdMemo, Splitter
from lexmill.llm.texts import as_lists, reach_package, slices

END_ID = 2
INDEX_ROWS = 1000
STRIPE_BYTES = 32 << 20
BLOOM_FPP = 0.01

ROWS = "doc_id long, part int, first long, n_tokens long, ids array<int>"
_memos: dict[str, IdMemo] = {}


def _encoder(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if path not in _memos:
            _memos[path] = IdMemo(Splitter(path))
        memo, part, first = _memos[path], TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, offsets = memo.encode(rows.column("text"))
                ids = np.insert(ids.astype(np.int32), offsets[1:], end_id)
                lengths = np.diff(offsets) + 1
                ends = first + np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(np.full(len(lengths), part, np.int32)),
                        pa.array(ends - lengths),
                        pa.array(lengths),
                        as_lists(ids, lengths, pa.int32()),
                    ],
                    names=["doc_id", "part", "first", "n_tokens", "ids"],
                )
                first = int(ends[-1])

    return run


def write(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = END_ID,
    doc_id: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = STRIPE_BYTES,
    index_rows: int = INDEX_ROWS,
) -> None:
    """Write the ids of all documents, each followed by ``end_id``, as ORC files into ``folder``."""
    reach_package(documents.sparkSession)
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order: list[Column | str] = ["doc_id", "text_hash", "row"]
    keyed = docs.withColumns({"text_hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    sorted_docs = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    (
        sorted_docs.mapInArrow(_encoder(tokenizer, end_id), ROWS)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", index_rows)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .orc(folder)
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the files as they were written."""
    return spark.read.schema(ROWS).orc(folder)


def part_starts(rows: DataFrame) -> DataFrame:
    """``part, part_start``: how many ids lie before each range. One row a range meets in the last step."""
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))


def placed(spark: SparkSession, folder: str) -> DataFrame:
    """The rows with ``start``, the place of their first id in the whole stream."""
    rows = read(spark, folder)
    starts = part_starts(rows)
    return rows.join(starts, "part").select("doc_id", (F.col("part_start") + F.col("first")).alias("start"), "n_tokens", "ids")


def find(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The rows of single documents, found through the metadata of files, stripes and groups of rows."""
    return read(spark, folder).where(F.col("doc_id").isin(*doc_ids))


def between(spark: SparkSession, folder: str, low: int, high: int) -> DataFrame:
    """The documents with an id at a place from ``low`` to below ``high``, and ``ids`` cut to those places.

    Only ranges that overlap are read: their numbers go into the filter of the scan."""
    starts = part_starts(read(spark, folder)).withColumn("part_end", F.lead("part_start").over(Window.orderBy("part")))
    hit = starts.where((F.col("part_start") < high) & (F.col("part_end").isNull() | (F.col("part_end") > low)))
    edge = hit.agg(F.min("part").alias("low"), F.max("part").alias("high")).first()
    if edge["low"] is None:
        return placed(spark, folder).limit(0)
    rows = read(spark, folder).where(F.col("part").between(edge["low"], edge["high"])).join(hit, "part")
    start = F.col("part_start") + F.col("first")
    end = start + F.col("n_tokens")
    skip = F.greatest(F.lit(low) - start, F.lit(0))
    kept = F.least(F.lit(high), end) - start - skip
    return rows.where((start < high) & (end > low)).select(
        "doc_id",
        (start + skip).alias("start"),
        kept.alias("n_tokens"),
        F.slice("ids", (skip + 1).cast("int"), kept.cast("int")).alias("ids"),
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = lists.offsets.to_numpy()
        raw = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).cast("B")
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
        kept = [batch.column(c) for c in ("doc_id", "part", "first")]
        counted = pa.array(np.diff(offsets).astype(np.int64))
        yield pa.RecordBatch.from_arrays([*kept, counted, pa.array(crc, pa.int64())], names=["doc_id", "part", "first", "n_tokens", "ids_crc32"])


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the stored ids: ``doc_id, start, n_tokens, ids_crc32``."""
    reach_package(spark)
    rows = read(spark, folder)
    read_back = rows.mapInArrow(_digests, "doc_id long, part int, first long, n_tokens long, ids_crc32 long")
    return read_back.join(part_starts(rows), "part").select(
        "doc_id", (F.col("part_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )


def stored_documents(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    """Query op13: write all documents, read the files back."""
    folder = scratch_path(spark, "token-files")
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, tokenizer)
    return digests(spark, folder)

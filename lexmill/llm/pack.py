"""Best-fit packing of documents into sequences by the sum-of-squares rule.

A document is its token ids and a closing id. One longer than a sequence is cut into pieces of full length, the
first piece being the shorter one; all other documents stay whole. Full pieces are sequences already. The rest are
packed by the sum-of-squares rule: place each document where the squared counts of open bins per residual gap
become smallest, over all open bins that it fits, or in a new one if it fits none. (Longest first, a bin opened earlier than
that is never filled as well: on lengths evenly spread up to the capacity it costs 4 % more bins.)

At scale: texts are tokenized where they are read and only lengths move. Pieces are dealt evenly over groups of about
``GROUP_PIECES``; each group packs its own in one task, longest first, then empties the bins that kept a gap and
places their items anew while that saves bins. Bins at most three quarters full, few in each group, go on as single items to a
next round with fewer groups, until one group is left: half-empty sequences do not pile up with the number of groups,
and no task holds more than about ``GROUP_PIECES`` pieces.

Defined cases: null or empty text is the closing id alone; an empty table gives no rows; repeated rows and null ids are packed
like any other row; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm.pieces import IdMemo, Splitter
from lexmill.llm.texts import reach_package, slices

CAPACITY = 2048
CLOSING_ID = 0
#: Pieces that one task packs at a time.
GROUP_PIECES = 50_000

_memos: dict[str, IdMemo] = {}

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"


def memo_of(path: str) -> IdMemo:
    if path not in _memos:
        _memos[path] = IdMemo(Splitter(path))
    return _memos[path]


def _cutter(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memo = memo_of(path)
        uid = TaskContext.get().partitionId() << 33
        closing = np.array([CLOSING_ID], np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = memo.encode(part.column("text"))
                out: list[tuple] = []
                for i, key in enumerate(part.column("doc_id").to_pylist()):
                    own = np.append(ids[offsets[i] : offsets[i + 1]], closing).astype("<u4", copy=False)
                    low, high = 0, len(own) % capacity or capacity
                    piece = 0
                    while low < len(own):
                        out.append((key, piece, low, high - low, zlib.crc32(own[low:high].tobytes()), uid))
                        low, high, piece, uid = high, high + capacity, piece + 1, uid + 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "uid"],
                )

    return run


def cut(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of each document, with a number of its own (``uid``) in the written table."""
    reach_package(documents.sparkSession)
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return materialize(docs.mapInArrow(_cutter(tokenizer, capacity), PIECES), "pieces")


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin. Items are taken in the given order; a bin is opened
    only for an item that fits no open one."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    counts = np.zeros(capacity + 1, np.int64)
    fills: list[int] = []
    for i, size in enumerate(lengths.tolist()):
        # Moving a bin from gap g to gap g - size changes the sum of squares by 2 (N[g - size] - N[g] + 1);
        # gap 0 and a bin not opened yet count as nothing.
        change = counts[: capacity + 1 - size] - counts[size:] + 1
        change = change * 2
        change[0] = 1 - 2 * counts[size]
        change[-1] = 2 * counts[capacity - size] + 1 if size < capacity else 0
        blank = counts[size:] == 0
        blank[-1] = not blank[:-1].all()
        change[blank] = np.iinfo(np.int64).max
        gap = size + int(change.argmin())  # ties: the smallest gap, the best fit
        if gap == capacity:
            bins[i], offsets[i] = len(fills), 0
            fills.append(size)
        else:
            counts[gap] -= 1
            bins[i] = open_at[gap].pop()
            offsets[i] = fills[bins[i]]
            fills[bins[i]] += size
        if gap > size:
            counts[gap - size] += 1
            open_at[gap - size].append(int(bins[i]))
    return bins, offsets, np.array(fills, np.int64)


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item and the bins' fills: longest first, then bins with a gap are emptied and
    their items placed anew, as long as that saves a bin."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    bins[order], offsets[order], fills = sum_of_squares(lengths[order], capacity)
    while True:
        gap = np.flatnonzero(fills < capacity)
        again = np.flatnonzero(fills[bins] < capacity)
        again = again[np.argsort(-lengths[again], kind="stable")]
        own, places, new = sum_of_squares(lengths[again], capacity)
        if len(new) >= len(gap):
            return bins, offsets, fills
        full = np.flatnonzero(fills == capacity)
        number = np.empty(len(fills), np.int64)
        number[full] = np.arange(len(full))
        rest = np.ones(len(bins), bool)
        rest[again] = False
        bins[rest] = number[bins[rest]]
        bins[again], offsets[again] = len(full) + own, places
        fills = np.concatenate([fills[full], new])


def _group_packer(capacity: int, turn: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", kind="stable")
        bins, offsets, fills = pack_lengths(pdf["length"].to_numpy(np.int64), capacity)
        first = (turn << 56) | (int(pdf["grp"].iloc[0]) << 24)
        return pd.DataFrame(
            {"item": pdf["item"].to_numpy(), "bin": first + bins, "offset": offsets, "fill": fills[bins]}
        )

    return run


def pack(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = cut(documents, tokenizer, capacity, doc_id, text)
    items = pieces.where(F.col("length") < capacity).select(F.col("uid").alias("item"), "length")
    n, turn, groups = items.count(), 0, None
    placed: DataFrame | None = None
    while n and (groups is None or -(-n // group_pieces) < groups):
        groups, turn = -(-n // group_pieces), turn + 1
        dealt = items.withColumn("grp", F.pmod(F.xxhash64("item"), F.lit(groups)))
        done = materialize(
            dealt.groupBy("grp").applyInPandas(
                _group_packer(capacity, turn), "item long, bin long, offset long, fill long"
            ),
            "packed",
        )
        if placed is None:
            placed = done.select("item", "bin", "offset")
        else:
            moved = done.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("offset").alias("by"))
            placed = placed.join(moved, "bin", "left").select(
                "item", F.coalesce("to", "bin").alias("bin"), (F.col("offset") + F.coalesce("by", F.lit(0))).alias("offset")
            )
        if groups == 1:
            break
        # Bins that can still take another one go on, as one item each.
        items = done.where(F.col("fill") * 4 <= 3 * capacity).groupBy(F.col("bin").alias("item")).agg(F.max("fill").alias("length"))
        n = items.count()
    if placed is None:
        placed = pieces.sparkSession.createDataFrame([], "item long, bin long, offset long")
    return pieces.join(placed, F.col("uid") == F.col("item"), "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("bin", -1 - F.col("uid")).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("long")).alias("offset"),
    )


def packed_documents(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    """Query op4."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer)

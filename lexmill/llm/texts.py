"""Whole texts inside Arrow batches: bounded slices of rows, word borders and word hashes.

Everything here works on the UTF-8 bytes that Spark hands over, so no Python object is made per word. Memory
is bounded by a slice of rows (one row at least) and, for hashing, by pieces of it.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import SparkSession

SLICE_BYTES, SLICE_ROWS = 2 << 20, 8192
#: Longest range that is hashed block by block for all ranges at once; longer ones are rare.
_BLOCKWISE_BYTES = 64
_SEED = 0x5851F42D4C957F2D


def reach_package(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package whatever their working folder is."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def byte_classes(separators: bytes) -> np.ndarray:
    """Truth table over byte values: true where a byte belongs to a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words `[^\x20\x09-\x0D]+`.
SPACED = byte_classes(bytes([0x20, *range(0x09, 0x0E)]))
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, to be used on lower-cased bytes.
ALNUM = byte_classes(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def give_back() -> None:
    """Return freed memory to the system: workers live on after a stage, and the next one adds to what they keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def slices(
    batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES, max_rows: int = SLICE_ROWS
) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of at most ``max_rows`` rows that hold at most ``max_bytes`` of text, or a single row.

    After the last one, memory that is free by then is given back."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else 0
        high = min(low + max_rows, max(low + 1, int(np.searchsorted(ends, before + max_bytes, side="right"))))
        yield batch.slice(low, high - low)
        low = high
    give_back()


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the rows' offsets in them; null rows are empty."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Borders of the words of a column: ``row`` of each word, ``start`` and ``end`` byte in ``data``."""

    def __init__(self, column: pa.Array, word_byte: np.ndarray):
        raw, self.offsets = raw_bytes(column)
        self.data = LOWER[raw]
        inside = word_byte[self.data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        low, high = self.offsets[:-1], self.offsets[1:]
        full = high > low
        first[low[full]] = inside[low[full]]
        last[high[full] - 1] = inside[high[full] - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(low, self.start, side="right") - 1
        self.rows = len(low)

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each lower-cased word."""
        return range_hashes(self.data, self.start, self.end)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range: eight bytes after eight are mixed into the state, so no sum of the bytes' places decides it.

    Ranges of up to eight bytes and equal length have different hashes. Long ranges are hashed one by one."""
    length = ends - starts
    out = mix(length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(_SEED))
    if not len(out):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, np.dtype("<u8"), padded, strides=(1,))
    left = np.flatnonzero((length > 0) & (length <= _BLOCKWISE_BYTES))
    done = 0
    while len(left):
        rest = length[left] - done
        used = np.minimum(rest, 8).astype(np.uint64)
        block = blocks[starts[left] + done] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - used * np.uint64(8)))
        out[left] = mix((out[left] ^ block) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(_SEED))
        left = left[rest > 8]
        done += 8
    for i in np.flatnonzero(length > _BLOCKWISE_BYTES):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), _SEED)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits (the finalizer of a public 64-bit generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside a row, and the index of each run's first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[j : j + n]
    at = np.flatnonzero(row[:n] == row[k - 1 : k - 1 + n])
    return mix(out[at] ^ np.uint64(k)), at


def as_lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array of consecutive runs of ``flat``."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))

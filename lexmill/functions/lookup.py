"""Lists of tokens to lists of ids, by a table of any size.

The most frequent entries, as many as fit ``HEAD_BYTES``, are the *head*: sorted by a hash and broadcast, one copy per executor,
so task binaries stay as small as they are. Rows find their ids where they lie, batch by batch: the tokens of a batch
are taken in slices, and a slice looks up its distinct tokens, or all of them in one pass where the head is small beside it. Equal
hashes are told apart by the tokens themselves. A worker holds one batch, the arrays of one slice and the head, however many rows its task has.

A table that fits the head moves no row. Of a larger one, the rest is the *tail*: tokens that the head does not hold leave a gap
in their row, are joined with the tail by shuffle, and are put back into the gaps of the written rows. The tail's tokens
are rarer than all of the head's, so what moves is small and no token of it is hot; a frequent token that no entry has is
the exception, which adaptive execution splits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lexmill.functions.columns import idiv
from lexmill.functions.scratch import materialize
from lexmill.functions.workers import give_back, reach_package

#: Bytes of the tokens and ids that are broadcast.
HEAD_BYTES = 32 << 20
#: Ids that share a bucket where frequencies are equal.
_ID_BUCKET = 1 << 12
#: Tokens handled together in a task.
_SLICE_TOKENS = 1 << 17
#: A head of so many times fewer entries than a slice has tokens is made a hash table for the slice.
_SMALL_HEAD = 4
_GAP = -1


@dataclass(frozen=True)
class TokenTable:
    name: str
    head: Broadcast
    tail: DataFrame | None  # (token, ids)


def _as_entries(table: DataFrame, value: str) -> DataFrame:
    ids = F.col(value) if isinstance(table.schema[value].dataType, T.ArrayType) else F.array(F.col(value))
    freq = F.col("freq") if "freq" in table.columns else F.lit(0)
    place = F.lit(0) if isinstance(table.schema[value].dataType, T.ArrayType) else idiv(F.col(value), _ID_BUCKET)
    return table.select("token", ids.cast("array<int>").alias("ids"), freq.cast("bigint").alias("freq"), place.cast("bigint").alias("place"))


def _split(entries: DataFrame, head_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """The head and, if there is more, the tail. Entries are taken by frequency, those of one frequency by their first id."""
    weight = F.octet_length("token") + 4 * F.size("ids") + 16
    total = entries.agg(F.sum(weight)).first()[0] or 0
    if total <= head_bytes:
        return entries, None
    # One row per frequency and id bucket, whatever the number of entries.
    tally = entries.groupBy("freq", "place").agg(F.sum(weight).alias("bytes"))
    upto = F.sum("bytes").over(W.orderBy(F.desc("freq"), "place").rowsBetween(W.unboundedPreceding, 0))
    last = tally.withColumn("upto", upto).filter(F.col("upto") <= head_bytes).orderBy(F.desc("upto")).limit(1).first()
    if last is None:
        return entries.limit(0), entries
    inside = (F.col("freq") > last["freq"]) | ((F.col("freq") == last["freq"]) & (F.col("place") <= last["place"]))
    return entries.filter(inside), entries.filter(~inside)


def token_table(table: DataFrame, value: str = "id", head_bytes: int = HEAD_BYTES) -> TokenTable:
    """Prepare (token, ``value``, freq), unique by token, for lookups. ``value`` is an id or a list of ids.

    ``table`` should be a written table: it is read more than once."""
    head, tail = _split(_as_entries(table, value), head_bytes)
    rows = head.select("token", "ids").toArrow().combine_chunks()
    hashes = _hashes(rows["token"].to_pylist())
    order = pa.array(np.argsort(hashes, kind="stable"))
    rows = rows.take(order).append_column("hash", pa.array(np.sort(hashes)))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    packed = table.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())
    return TokenTable(uuid.uuid4().hex, packed, tail and tail.select("token", "ids"))


def _hashes(tokens: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


class _Head:
    """The head inside a worker."""

    def __init__(self, packed: bytes):
        rows = pa.ipc.open_stream(packed).read_all().combine_chunks()
        column = lambda name: pa.concat_arrays(rows[name].chunks) if rows.num_rows else pa.array([], rows.schema.field(name).type)
        self.tokens, ids = column("token"), column("ids")
        self.hashes = column("hash").to_numpy()
        self.flat = ids.flatten().to_numpy(zero_copy_only=False)
        self.length = np.asarray(pc.list_value_length(ids).to_numpy(zero_copy_only=False), np.int64)
        self.start = np.cumsum(self.length) - self.length

    def find(self, tokens: pa.Array) -> np.ndarray:
        """The entry of each token, -1 if there is none."""
        out = np.full(len(tokens), -1, np.int64)
        if not len(self.hashes):
            return out
        hashes = _hashes(tokens.to_pylist())
        at = np.searchsorted(self.hashes, hashes)
        left = np.arange(len(tokens))
        while len(left):
            left = left[at[left] < len(self.hashes)]
            left = left[self.hashes[at[left]] == hashes[left]]
            own, theirs = tokens.take(pa.array(left)), self.tokens.take(pa.array(at[left]))
            same = np.asarray(pc.equal(own, theirs.cast(own.type)).to_numpy(zero_copy_only=False), bool)
            out[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
        return out

    def entries(self, tokens: pa.Array) -> np.ndarray:
        """The same for tokens that repeat."""
        if len(self.tokens) * _SMALL_HEAD <= len(tokens):
            return pc.index_in(tokens, value_set=self.tokens.cast(tokens.type)).fill_null(-1).to_numpy(zero_copy_only=False)
        distinct = tokens.dictionary_encode()
        codes = distinct.indices.to_numpy(zero_copy_only=False)
        return self.find(distinct.dictionary)[codes] if len(codes) else np.zeros(0, np.int64)


_heads: dict[str, _Head] = {}


def _opened(name: str, packed: Broadcast) -> _Head:
    if name not in _heads:
        if len(_heads) > 3:
            _heads.clear()
        _heads[name] = _Head(packed.value)
    return _heads[name]


def _row_slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with a bounded number of list items, one row at least."""
    ends = batch.column(column).offsets.to_numpy()[1:].astype(np.int64) if batch.num_rows else []
    low = 0
    while low < batch.num_rows:
        before = ends[low - 1] if low else int(batch.column(column).offsets[0].as_py())
        high = max(low + 1, int(np.searchsorted(ends, before + _SLICE_TOKENS, side="right")))
        yield batch.slice(low, high - low)
        low = high


def _list_of(flat: pa.Array | np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    values = flat if isinstance(flat, pa.Array) else pa.array(flat, kind)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), pa.int32()), values)


def _mapper(table: TokenTable, missing: int, keep: list[str]):
    name, packed, fill, gaps = table.name, table.head, missing if table.tail is None else _GAP, table.tail is not None

    def coded(batch: pa.RecordBatch, head: _Head) -> Iterator[pa.RecordBatch]:
        for rows in _row_slices(batch, "_tokens"):
            lists = rows.column("_tokens")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            tokens = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
            entry = head.entries(tokens)
            known = entry >= 0
            length, start = np.ones(len(entry), np.int64), np.zeros(len(entry), np.int64)
            length[known], start[known] = head.length[entry[known]], head.start[entry[known]]
            ends = np.cumsum(length)
            source = np.repeat(start - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)
            ids = head.flat[source] if len(head.flat) else np.zeros(len(source), np.int32)
            ids[np.repeat(~known, length)] = fill
            upto = np.concatenate([[0], ends])
            columns = [*[rows.column(c) for c in keep], _list_of(ids.astype(np.int32), upto[offsets - offsets[0]], pa.int32())]
            if gaps:
                absent = np.concatenate([[0], np.cumsum(~known)])
                texts = tokens.take(pa.array(np.flatnonzero(~known))).cast(pa.string())
                columns.append(_list_of(texts, absent[offsets - offsets[0]], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "input_ids", *(["_missed"] if gaps else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = _opened(name, packed)
        for batch in batches:
            yield from coded(batch, head)
            # Before the next batch is read.
            del batch
            give_back()

    return run


def _filler(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _row_slices(batch, "input_ids"):
                lists = rows.column("input_ids")
                offsets = lists.offsets.to_numpy().astype(np.int64)
                ids = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
                found = rows.column("_found").flatten()
                length = np.ones(len(ids), np.int64)
                gap = ids == _GAP
                length[gap] = pc.list_value_length(found).to_numpy(zero_copy_only=False)
                ends = np.cumsum(length)
                out = np.repeat(ids, length)
                out[np.repeat(gap, length)] = found.flatten().to_numpy(zero_copy_only=False)
                upto = np.concatenate([[0], ends])
                filled = _list_of(out, upto[offsets - offsets[0]], pa.int32())
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], filled], names=[*keep, "input_ids"])

    return run


def tokens_to_ids(rows: DataFrame, tokens: Column, keep: list[str], table: TokenTable, missing: int) -> DataFrame:
    """The columns ``keep`` and ``input_ids``: the ids of all tokens in order, ``missing`` for a token without an entry."""
    reach_package(rows.sparkSession)
    kept = rows.select(*keep, tokens.alias("_tokens"))
    ids = T.StructField("input_ids", T.ArrayType(T.IntegerType()))
    schema = T.StructType([*[kept.schema[c] for c in keep], ids])
    if table.tail is None:
        return kept.mapInArrow(_mapper(table, missing, keep), schema)
    if rows.isStreaming:
        raise ValueError("a stream needs a vocabulary that fits the broadcast head")
    gapped = T.StructType([*schema.fields, T.StructField("_missed", T.ArrayType(T.StringType()))])
    coded = kept.mapInArrow(_mapper(table, missing, keep), gapped).withColumn("_row", F.monotonically_increasing_id())
    coded = materialize(coded, "head_coded")
    asked = coded.select("_row", F.posexplode("_missed").alias("_no", "token"))
    answer = F.coalesce("ids", F.array(F.lit(missing)))
    found = (
        asked.join(table.tail, "token", "left")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct("_no", answer.alias("ids")))).alias("_pairs"))
        .select("_row", F.col("_pairs")["ids"].alias("_found"))
    )
    open_ = coded.filter(F.size("_missed") > 0).join(found, "_row").select(*keep, "input_ids", "_found")
    whole = coded.filter(F.size("_missed") == 0).select(*keep, "input_ids")
    return whole.unionByName(open_.mapInArrow(_filler(keep), schema))

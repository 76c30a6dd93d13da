"""Token counts of whole texts without token ids: pre-token frequencies joined to a table of piece counts.

A pre-token is a unit of :mod:`lexmill.llm.pieces`, which no token crosses. Three steps:

1. Each task sums the frequencies of its pre-tokens; one aggregation makes the table of distinct pre-tokens of the corpus.
2. Each distinct pre-token is tokenized once: ``(pre_token, n_pieces)``.
3. Each text becomes pre-token frequencies again. The ``HEAD_PRETOKENS`` most frequent pre-tokens (a fixed number, so a
   bounded broadcast) are joined in place; a document's other pre-tokens, each of which is rare by construction, are
   joined by shuffle with the whole table. Pieces times frequency, summed, are the tokens of the document.

Neither texts nor ids are shuffled, and no key of the join can be hot, because the hot ones are in the head.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows and repeated or null ids give a row each;
other columns are not read. Texts that cannot be cut (special strings, white space outside ASCII, other
tokenizers) are counted whole, where they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm.pieces import HashTable, Splitter, Units
from lexmill.llm.texts import range_hashes, raw_bytes, reach_package, slices

LIMIT = 1024
#: Pre-tokens joined by broadcast: about 3 MB to send, 30 MB in a worker.
HEAD_PRETOKENS = 1 << 18
#: Distinct pre-tokens that a task of step 1 sums before it hands them on.
TASK_PRETOKENS = 400_000

_splitters: dict[str, Splitter] = {}
_heads: dict[int, tuple[HashTable, np.ndarray]] = {}


def splitter_of(path: str) -> Splitter:
    if path not in _splitters:
        _splitters[path] = Splitter(path)
    return _splitters[path]


def _unit_texts(units: Units, at: np.ndarray) -> list[str]:
    return [units.text(i) for i in at]


def _frequencies(path: str):
    def emit(texts: list[str], counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()), pa.array(counts[: len(texts)], pa.int64())], names=["pre_token", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = splitter_of(path)
        table, texts, counts = HashTable(), [], np.zeros(1 << 16, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                units = Units(part.column("text"), splitter)
                use = ~units.whole[units.row]
                keys, first, n = np.unique(units.hashes[use], return_index=True, return_counts=True)
                number = table.find(keys)
                new = np.flatnonzero(number < 0)
                if table.n + len(new) > TASK_PRETOKENS and texts:
                    yield emit(texts, counts)
                    table, texts, counts = HashTable(), [], np.zeros(1 << 16, np.int64)
                    number[:], new = -1, np.arange(len(keys))
                table.add(keys[new])
                texts += _unit_texts(units, np.flatnonzero(use)[first[new]])
                while len(counts) < table.n:
                    counts = np.concatenate([counts, np.zeros_like(counts)])
                number[new] = table.find(keys[new])
                counts[number] += n
        if texts:
            yield emit(texts, counts)

    return run


def _piece_counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = splitter_of(path)
        for batch in batches:
            pieces = [len(splitter.ids(t)) for t in batch.column("pre_token").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pre_token"), batch.column("n"), pa.array(pieces, pa.int64())],
                names=["pre_token", "n", "n_pieces"],
            )

    return run


def _head_table(shared, ident: str) -> tuple[HashTable, np.ndarray]:
    if ident not in _heads:
        _heads.clear()
        names, pieces = shared.value
        data, offsets = raw_bytes(pa.array(names, pa.string()))
        table = HashTable()
        table.add(range_hashes(data, offsets[:-1], offsets[1:]))
        _heads[ident] = table, np.append(np.array(pieces, np.int64), 0)
    return _heads[ident]


def _document_counts(path: str, shared, ident: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        splitter = splitter_of(path)
        table, pieces = _head_table(shared, ident)
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text"):
                column = part.column("text")
                units, rows = Units(column, splitter), part.num_rows
                use = np.flatnonzero(~units.whole[units.row])
                number = table.find(units.hashes[use])
                known = np.bincount(units.row[use], pieces[number], minlength=rows).astype(np.int64)
                for i in np.flatnonzero(units.whole):
                    known[i] = len(splitter.ids(column[i].as_py() or ""))
                rare = use[number < 0]
                order = np.lexsort((units.hashes[rare], units.row[rare]))
                rare = rare[order]
                h, row = units.hashes[rare], units.row[rare]
                fresh = np.ones(len(rare), bool)
                fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(fresh)
                n = np.diff(np.append(at, len(rare)))
                per_row = np.bincount(row[at], minlength=rows) if len(at) else np.zeros(rows, np.int64)
                offsets = np.zeros(rows + 1, np.int32)
                np.cumsum(per_row, out=offsets[1:])
                tail = pa.StructArray.from_arrays(
                    [pa.array(_unit_texts(units, rare[at]), pa.string()), pa.array(n, pa.int64())], names=["pre_token", "n"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(uid + np.arange(rows), pa.int64()),
                        pc.binary_length(column).cast(pa.int64()).fill_null(0),
                        pa.array(known, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), tail),
                    ],
                    names=["doc_id", "uid", "n_bytes", "known", "tail"],
                )
                uid += rows

    return run


def pretoken_table(documents: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Written table ``pre_token, n, n_pieces``: each distinct pre-token of the corpus, tokenized once."""
    reach_package(documents.sparkSession)
    texts = documents.select(F.col(text).cast("string").alias("text"))
    counted = texts.mapInArrow(_frequencies(tokenizer), "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))
    return materialize(counted.mapInArrow(_piece_counts(tokenizer), "pre_token string, n long, n_pieces long"), "pretokens")


def _most_frequent(table: DataFrame, most: int) -> DataFrame:
    """At most ``most`` of the most frequent rows, by a bound on the frequency instead of a sort."""
    level = F.floor(F.log2("n") * 16)
    levels = table.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).orderBy(F.desc("level")).collect()
    above, least = 0, None
    for r in levels:
        above += r["rows"]
        if above > most:
            break
        least = r["level"]
    return table.where(level >= least) if least is not None else table.limit(0)


def count_tokens(
    documents: DataFrame,
    tokenizer: str,
    limit: int = LIMIT,
    doc_id: str = "doc_id",
    text: str = "text",
    head: int = HEAD_PRETOKENS,
) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``."""
    spark = documents.sparkSession
    table = pretoken_table(documents, tokenizer, text)
    top = _most_frequent(table, head).select("pre_token", "n_pieces").toPandas()
    shared = spark.sparkContext.broadcast((top["pre_token"].tolist(), top["n_pieces"].tolist()))
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = materialize(
        docs.mapInArrow(
            _document_counts(tokenizer, shared, str(shared._jbroadcast.id())),
            "doc_id long, uid long, n_bytes long, known long, tail array<struct<pre_token:string,n:long>>",
        ),
        "doc-pretokens",
    )
    rare = (
        counted.select("uid", F.explode("tail").alias("t"))
        .select("uid", "t.pre_token", F.col("t.n").alias("times"))
        .join(table.select("pre_token", "n_pieces"), "pre_token")
        .groupBy("uid")
        .agg(F.sum(F.col("times") * F.col("n_pieces")).alias("rest"))
    )
    total = F.col("known") + F.coalesce("rest", F.lit(0))
    return counted.select("doc_id", "uid", "n_bytes", "known").join(rare, "uid", "left").select(
        "doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit")
    )


def document_tokens(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    """Query op6."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer)

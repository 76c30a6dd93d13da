"""Ranked lexical search over hashed max-sketches with exact rescoring.

Terms, weights and scores are whole numbers (:func:`impact`, :func:`weight`): a document's score for an item is the sum, over the item's
terms with repeats, of the term's weight times the document's impact of the term.

Index: one row per document with a term: its distinct terms with their counts, its length norm, and a *sketch*: the impacts of
its terms, rounded up to multiples of ``STEP``, fold into coordinatewise maxima; a term's coordinate is its hash modulo the sketch's
width, a power of two of at least ``SPARSE`` times the number of distinct terms. A sketch looked up at the
coordinates of an item's terms gives no less than the true impacts, so the weighted sum bounds the score from above.

Search: items are taken in blocks (of bounded rows and bytes) against all rows of the index. A task looks up all items of the block
in the sketches of a slice of documents at once, then goes through the documents of each item by descending bound, scores
them exactly from their stored terms and stops at the first bound below the item's threshold: the score of its tenth best so far.
Thresholds start at the tenth best scores within a sample of about ``SEED_DOCUMENTS`` documents, which can only be too low; the sample
saves rescoring and never decides a result. Each task gives its best ten per item, and those of all tasks are ranked per item.

Hashes pick coordinates only; terms are compared as bytes, so equal hashes loosen a bound and change no score.

Defined cases: null or empty text, or text without a term, is found by nothing and finds nothing; documents that repeat an id are ranked row
by row; a null ``doc_id`` comes after all others of its score; each row of the items is an item of its own, also with a null or
repeated ``item_id``, and items without a hit give no row; empty tables give no row; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize, scratch_path
from lexmill.llm.texts import Words, byte_classes, reach_package, slices

TOP = 10
#: Coordinates of a sketch for each distinct term, at least.
SPARSE = 4
_LEAST_WIDTH = 64
#: Impacts are below 10^6, so one byte holds them in these steps.
STEP = 4000
SEED_DOCUMENTS = 8192
BLOCK_ITEMS, BLOCK_BYTES = 1024, 4 << 20
_TEXT_PIECE = 1 << 20
_SLICE_ROWS = 2048

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_TERM_BYTE = byte_classes(_SEPARATORS)
_SPLIT = bytes(0x20 if b in _SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))

INDEX = "doc_id long, n long, norm long, width int, sketch binary, terms binary, counts binary"


def term_counts(text: bytes) -> Counter:
    """The terms `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+` of a text with A-Z in lower case, and how often they occur."""
    found: Counter = Counter()
    plain = text.translate(_SPLIT)
    low = 0
    while low < len(plain):
        high = min(len(plain), low + _TEXT_PIECE)
        if high < len(plain):
            cut = plain.rfind(b" ", low, high)
            high = cut if cut > low else plain.find(b" ", high)
            high = high if high > 0 else len(plain)
        found.update(plain[low:high].split())
        low = high
    return found


def norm(n: int, documents: int, terms: int) -> int:
    """Length norm of a document of ``n`` terms among ``documents`` with ``terms`` in all."""
    return 100 - 75 + (75 * n * documents) // terms


def impact(count, length_norm):
    """What a term that a document holds ``count`` times adds for each unit of its weight."""
    return (1_000_000_000 * count) // (1000 * count + 8 * length_norm)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    documents = terms = 0
    for batch in batches:
        for rows in slices(batch, "text"):
            n = Words(rows.column("text"), _TERM_BYTE).counts()
            documents, terms = documents + int((n > 0).sum()), terms + int(n.sum())
    yield pa.RecordBatch.from_arrays([pa.array([documents], pa.int64()), pa.array([terms], pa.int64())], names=["documents", "terms"])


def _sketcher(documents: int, all_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                out = []
                for key, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").cast(pa.binary()).to_pylist()):
                    found = term_counts(text) if text else None
                    if not found:
                        continue
                    n = found.total()
                    m = norm(n, documents, all_terms)
                    width = max(_LEAST_WIDTH, 1 << (SPARSE * len(found) - 1).bit_length())
                    counts = np.fromiter(found.values(), np.int64, len(found))
                    at = np.fromiter(map(crc32, found), np.int64, len(found)) & (width - 1)
                    sketch = np.zeros(width, np.uint8)
                    np.maximum.at(sketch, at, (-(-impact(counts, m) // STEP)).astype(np.uint8))
                    out.append((key, n, m, width, sketch.tobytes(), b" ".join(found), counts.astype(np.uint32).tobytes()))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 3]
                    names = ["doc_id", "n", "norm", "width", "sketch", "terms", "counts"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def build(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """The written index of all documents, and how many of them hold a term."""
    reach_package(documents.sparkSession)
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sizes = docs.select("text").mapInArrow(_sizes, "documents long, terms long")
    total = sizes.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("n"), F.coalesce(F.sum("terms"), F.lit(0)).alias("l")).first()
    return materialize(docs.mapInArrow(_sketcher(total["n"], total["l"]), INDEX), "sketches"), total["n"]


def _holders(vocabulary: frozenset[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for terms in batch.column("terms"):
                found.update(vocabulary.intersection(terms.as_py().split()))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["term", "df"])

    return run


def weights(index: DataFrame, documents: int, vocabulary: set[bytes]) -> dict[bytes, int]:
    """Weights above 0 of those terms of a block that any document holds."""
    per_task = index.select("terms").mapInArrow(_holders(frozenset(vocabulary)), "term binary, df long")
    held = per_task.groupBy("term").agg(F.sum("df").alias("df")).collect()
    return {bytes(r["term"]): w for r in held if (w := weight(documents, r["df"]))}


class Items:
    """The items of a block: weight of each term times its repeats, and the terms' hashes."""

    def __init__(self, texts: list[bytes], weight_of: dict[bytes, int], seeds: dict[int, int] | None = None, top: int = TOP):
        self.top = top
        self.terms = [{t: c * weight_of[t] for t, c in term_counts(text).items() if t in weight_of} for text in texts]
        self.hashes = [np.fromiter(map(crc32, terms), np.int64, len(terms)) for terms in self.terms]
        self.weights = [np.fromiter(terms.values(), np.float64, len(terms)) for terms in self.terms]
        self.seeds = [(seeds or {}).get(i, 1) for i in range(len(texts))]

    def bounds(self, sketches: list[bytes], widths: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores: a row per item, a column per document. Whole numbers below 2^53, so doubles are exact."""
        out = np.zeros((len(self.terms), len(widths)))
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            table = np.frombuffer(b"".join([sketches[i] for i in at]), np.uint8).reshape(len(at), width).T.copy()
            for i, hashes in enumerate(self.hashes):
                if len(hashes):
                    out[i, at] = self.weights[i] @ table[hashes & (width - 1)]
        return out * STEP


def _searcher(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items.terms]
        least = list(items.seeds)
        for batch in batches:
            for part in slices(batch, "sketch"):
                for low in range(0, part.num_rows, _SLICE_ROWS):
                    _rescore(items, part.slice(low, _SLICE_ROWS), best, least)
        rows = [(i, key, score) for i, own in enumerate(best) for score, known, minus in own for key in [-minus if known else None]]
        if rows:
            kinds = [pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["item", "doc_id", "score"])

    return run


def _rescore(items: Items, rows: pa.RecordBatch, best: list[list[tuple]], least: list[int]) -> None:
    """Take the rows into the best of each item: by descending bound, until the bound is below the threshold."""
    ids, norms = rows.column("doc_id").to_pylist(), rows.column("norm").to_pylist()
    bounds = items.bounds(rows.column("sketch").to_pylist(), rows.column("width").to_numpy())
    opened: dict[int, dict[bytes, int]] = {}
    for i, terms in enumerate(items.terms):
        own = bounds[i]
        hopeful = np.flatnonzero(own >= least[i])
        for d in hopeful[np.argsort(-own[hopeful], kind="stable")].tolist():
            if own[d] < least[i]:
                break
            if d not in opened:
                counts = np.frombuffer(rows.column("counts")[d].as_py(), np.uint32).astype(np.int64)
                opened[d] = dict(zip(rows.column("terms")[d].as_py().split(), impact(counts, norms[d]).tolist()))
            impacts = opened[d]
            score = sum(w * impacts[t] for t, w in terms.items() if t in impacts)
            if score < least[i]:
                continue
            entry = (score, ids[d] is not None, -(ids[d] or 0))
            if len(best[i]) < items.top:
                heapq.heappush(best[i], entry)
            else:
                heapq.heappushpop(best[i], entry)
            if len(best[i]) == items.top:
                least[i] = max(least[i], best[i][0][0])


def _ranked(index: DataFrame, items: Items) -> DataFrame:
    """``item, rank, doc_id, score`` of the best documents; ``item`` counts within the block."""
    found = index.select("doc_id", "norm", "width", "sketch", "terms", "counts").mapInArrow(_searcher(items), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= items.top)


def blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple]]:
    """The items in lists of bounded rows and bytes (one item at least); the driver holds one list and one partition."""
    block, size = [], 0
    for row in items.select(F.col(item_id), F.col(text).cast("binary")).toLocalIterator():
        own = bytes(row[1] or b"")
        if block and (len(block) == BLOCK_ITEMS or size + len(own) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((row[0], own))
        size += len(own)
    if block:
        yield block


def search(index: DataFrame, documents: int, items: DataFrame, top: int = TOP, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the best ``top`` documents with a score above 0 of each item."""
    spark = index.sparkSession
    kind = items.select(item_id).schema[0].dataType
    folder, schema = scratch_path(spark, "ranked"), f"item_id {kind.simpleString()}, rank int, doc_id long, score long"
    spark.createDataFrame([], schema).write.parquet(folder)
    # A sample of the documents, the same for every block, only to begin with useful thresholds.
    share = max(1, documents // SEED_DOCUMENTS)
    sample = index.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(share)) == 0)
    for block in blocks(items, item_id, text):
        texts = [t for _, t in block]
        weight_of = weights(index, documents, set().union(*map(term_counts, texts)))
        if not weight_of:
            continue
        first = _ranked(sample, Items(texts, weight_of, top=top)).where(F.col("rank") == top).select("item", "score").collect()
        found = _ranked(index, Items(texts, weight_of, {r["item"]: r["score"] for r in first}, top))
        names = spark.createDataFrame([(i, own) for i, (own, _) in enumerate(block)], f"item int, item_id {kind.simpleString()}")
        found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op12: all documents ranked for each benchmark item."""
    index, documents = build(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(index, documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
i AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS repeats FROM i GROUP BY ALL),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
size AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM len),
df AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY term),
m AS (SELECT doc_id, 100 - 75 + ((75 * n * docs) // terms) AS m FROM len, size),
scores AS (
  SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN m USING (doc_id) GROUP BY ALL),
ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""

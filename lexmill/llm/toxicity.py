"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

Features are the distinct runs of 3 to 6 lower-cased characters of a text, hashed into ``1 << HASH_BITS`` buckets. On
a bounded sample of labelled texts (``SAMPLE_ROWS``), Spark counts for each bucket the toxic and the other texts
that hold it; buckets whose counts differ more than chance allows (likelihood ratio above ``LEAST_RATIO``) become features,
``MAX_FEATURES`` at most. A feature's value is its log-count ratio, and a regularised logistic regression on the sample's feature lists weighs it.
Scoring needs one pass over the texts: n-gram hashes, a table look-up, a sum over the distinct features met. Texts never
move, and the model is a few megabytes whatever the corpus.

Defined cases: null and empty texts have no features and get the score of the bias; without labelled texts, or with
labels of one kind only, every score is 0; null ids and repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm.labelled import SAMPLE_ROWS, crc_fold, labelled_sample
from lexmill.llm.texts import raw_bytes, reach_package, slices

SIZES = (3, 4, 5, 6)
HASH_BITS = 20
MAX_FEATURES = 4_000
#: Twice the log likelihood ratio of a feature, about a chance of 1 in 10,000.
LEAST_RATIO = 15.0
FOLDS, HELD_OUT = 5, 0
_SLICE = 1 << 20
#: Partitions of the sample; each emits its non-zero counts.
_SAMPLE_PARTS = 12

_LOW = np.arange(0x250, dtype=np.uint32)
for _c in range(0x250):
    if len(chr(_c).lower()) == 1:
        _LOW[_c] = ord(chr(_c).lower())


def _code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all rows, and the rows' offsets in them."""
    data, _ = raw_bytes(column)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).copy()
    small = points < len(_LOW)
    points[small] = _LOW[points[small]]
    sizes = pc.utf8_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return points, offsets


def grams(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs: ``table`` maps buckets to features, or to -1."""
    points, offsets = _code_points(column)
    n = len(points)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    rows, features = [], []
    h = np.zeros(n, np.uint32)
    for size in range(1, max(SIZES) + 1):
        if n < size:
            break
        h = h[: n - size + 1] * np.uint32(0x01000193) + points[size - 1 :]
        if size not in SIZES:
            continue
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        mixed = (mixed ^ (mixed >> np.uint32(12)) ^ np.uint32(size)) * np.uint32(0x297A2D39)
        feature = table[mixed >> np.uint32(32 - HASH_BITS)]
        at = np.flatnonzero(feature >= 0)
        at = at[at + size <= ends[at]]
        rows.append(np.searchsorted(offsets, at, side="right") - 1)
        features.append(feature[at])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = int(table.max()) + 1
    pairs = np.unique(np.concatenate(rows) * width + np.concatenate(features))
    return pairs // width, pairs % width


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    every = np.arange(1 << HASH_BITS, dtype=np.int64)
    counts = np.zeros((2, 1 << HASH_BITS), np.int32)
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            y = part.column("y").to_numpy(zero_copy_only=False)
            rows, buckets = grams(part.column("text"), every)
            for kind in (0, 1):
                counts[kind] += np.bincount(buckets[y[rows] == kind], minlength=1 << HASH_BITS).astype(np.int32)
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int32()), pa.array(counts[1][at], pa.int32()), pa.array(counts[0][at], pa.int32())],
        names=["bucket", "p", "q"],
    )


def _lists(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                rows, features = grams(part.column("text"), table)
                offsets = np.zeros(part.num_rows + 1, np.int32)
                np.cumsum(np.bincount(rows, minlength=part.num_rows), out=offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [part.column("y"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(features, pa.int32()))],
                    names=["y", "features"],
                )

    return run


def fit_weights(y: np.ndarray, lists: list[np.ndarray], ratios: np.ndarray, decay: float = 1e-3, turns: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression on present features times their ratios, by accelerated gradient steps."""
    flat = np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(lists) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    value = ratios[flat]
    n, k = len(y), len(ratios)
    # A bound on the curvature from the largest row and column sums of the squared values.
    square = np.abs(value)
    most = (np.bincount(row, square, n).max() if len(flat) else 0.0) * (np.bincount(flat, square, k).max() if len(flat) else 0.0)
    step = 1.0 / (0.25 * (most + n) / n + decay)
    w, b = np.zeros(k), float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    vw, vb, last_w, last_b = w, b, w, b
    for turn in range(turns):
        z = np.bincount(row, value * vw[flat], n) + vb
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        w = vw - step * (np.bincount(flat, value * error[row], k) / n + decay * vw)
        b = vb - step * error.mean()
        speed = turn / (turn + 3)
        vw, vb = w + speed * (w - last_w), b + speed * (b - last_b)
        last_w, last_b = w, b
    return w, float(b)


def learn(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, float] | None:
    """(bucket table, weight of each feature, bias) from ``text, y``; none if the labels are of one kind."""
    sample = materialize(sample.repartition(_SAMPLE_PARTS), "toxic-sample")
    found = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(found) < 2:
        return None
    toxic, other = found[1], found[0]
    counts = sample.mapInArrow(_count, "bucket int, p int, q int").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))

    def term(seen, of):
        return F.when(seen > 0, seen * F.log(seen / of)).otherwise(0.0)

    p, q, rate = F.col("p"), F.col("q"), toxic / (toxic + other)
    total = p + q
    ratio = 2 * (
        term(p, total * rate) + term(q, total * (1 - rate)) + term(toxic - p, (toxic + other - total) * rate) + term(other - q, (toxic + other - total) * (1 - rate))
    )
    logs = F.log(((p + 1.0) / (toxic + 1.0)) / ((q + 1.0) / (other + 1.0)))
    best = (
        counts.select("bucket", logs.alias("r"), ratio.alias("g"))
        .where(F.col("g") >= LEAST_RATIO)
        .orderBy(F.desc("g"), "bucket")
        .limit(MAX_FEATURES)
        .toPandas()
        .sort_values("bucket")
    )
    table = np.full(1 << HASH_BITS, -1, np.int32)
    table[best["bucket"].to_numpy(np.int64)] = np.arange(len(best))
    if best.empty:
        return table, np.zeros(0), float(np.log(toxic / other))
    ratios = best["r"].to_numpy(float)
    rows = sample.mapInArrow(_lists(table), "y int, features array<int>").toPandas()
    weights, bias = fit_weights(rows["y"].to_numpy(float), list(rows["features"]), ratios)
    return table, (weights * ratios), bias


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                n = part.num_rows
                if model is None:
                    score = np.zeros(n)
                else:
                    table, weights, bias = model
                    rows, features = grams(part.column("text"), table) if len(weights) else (np.zeros(0, int), np.zeros(0, int))
                    score = 1 / (1 + np.exp(-np.clip(np.bincount(rows, weights[features], n) + bias, -500, 500)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return run


def score(documents: DataFrame, model) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    reach_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scorer(shared), "doc_id long, score double")


def toxicity(spark: SparkSession, sf_dir: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Query op1: learned outside the held-out fold, scored everywhere."""
    reach_package(spark)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = learn(labelled_sample(documents, labels, "toxic", FOLDS, HELD_OUT, rows))
    return score(documents, model).select(
        "doc_id",
        F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )

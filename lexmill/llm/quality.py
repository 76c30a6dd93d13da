"""Quality: a generalised additive model with pairwise interactions, learned by cyclic boosting of shallow trees.

Each text becomes ``FEATURES``: plain figures about its characters, words and lines. Features are cut into at most
``BINS`` bins at quantiles of a bounded sample of labelled texts (``SAMPLE_ROWS``). Boosting goes round the
features; in each turn a tree of at most ``LEAVES`` leaves over one feature's bins is fitted to the current gradients and added, with a
small step, to that feature's look-up table. Then pairs of features are ranked by what a 2x2 split of the
residuals gains, and the best ``PAIRS`` get tables of their own in the same way. ``BAGS`` models, each fitted in a task of its own
and stopped early on the part of the sample it leaves out, are averaged. A score is the sigmoid of table entries
added up for whole batches at once.

Texts are read once, where they are; only bounded samples and tables of a few kilobytes move.

Defined cases: null and empty texts have all figures 0 and are scored by their bins; without labelled texts, or with labels
of one kind only, the score is the share of label 1 (1 without any label), so nothing is rejected for lack of
evidence; null ids and repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm.labelled import SAMPLE_ROWS, crc_fold, labelled_sample
from lexmill.llm.texts import SPACED, Words, grams, range_hashes, raw_bytes, reach_package, slices

FEATURES = (
    "log_bytes letters upper digits sentence_marks symbols spaces entropy log_words word_length long_words distinct_words "
    "same_as_last distinct_pairs symbol_ends upper_words letter_words lines distinct_lines top_byte marks_per_word"
).split()
BINS = 48
LEAVES = 3
BAGS = 4
ROUNDS = 150
STEP = 0.15
PAIRS = 6
PAIR_BINS = 8
PAIR_ROUNDS = 40
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Texts measured together: the arrays of a slice take about 50 times its bytes and 8 kB a row.
SLICE_BYTES, SLICE_ROWS = 1 << 19, 1024

# Classes of bytes: letters are ASCII letters and all bytes outside ASCII.
_UPPER, _LOWER, _DIGIT, _MARK, _SPACE, _SYMBOL = range(6)
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[0x80:] = _LOWER
_KIND[0x61:0x7B] = _LOWER
_KIND[0x41:0x5B] = _UPPER
_KIND[0x30:0x3A] = _DIGIT
_KIND[[ord(c) for c in ".,;:?'\"()-"]] = _MARK
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE


def figures(column: pa.Array) -> np.ndarray:
    """The features of each row, one row per text."""
    raw, offsets = raw_bytes(column)
    n, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n, dtype=np.int32), size)
    histogram = np.bincount(row * 256 + raw, minlength=n * 256).reshape(n, 256).astype(float)
    kinds = np.stack([histogram[:, _KIND == k].sum(axis=1) for k in range(6)], axis=1)
    length = np.maximum(size, 1)
    letters = kinds[:, _UPPER] + kinds[:, _LOWER]
    share = histogram / length[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)

    words = Words(column, SPACED)
    h, count = words.hashes(), words.counts()
    some = np.maximum(count, 1)
    wrow, wlen = words.row, (words.end - words.start).astype(float)

    def per_word(flag: np.ndarray) -> np.ndarray:
        return np.bincount(wrow, flag, n) / some

    def distinct(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Share of distinct keys in each row."""
        order = np.lexsort((keys, rows))
        k, r = keys[order], rows[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
        return np.bincount(r, new, n) / np.maximum(np.bincount(r, minlength=n), 1)

    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (wrow[1:] == wrow[:-1])
    pairs, at = grams(h, wrow, 2)
    kind = _KIND[raw]
    letter_sum = np.concatenate([[0], np.cumsum(kind <= _LOWER)])
    upper_sum = np.concatenate([[0], np.cumsum(kind == _UPPER)])
    word_letters = letter_sum[words.end] - letter_sum[words.start]
    word_upper = upper_sum[words.end] - upper_sum[words.start]

    feed = raw == 0x0A
    first = feed.copy()
    first[1:], first[:1] = feed[:-1], False
    first[offsets[:-1][size > 0]] = True
    line_start = np.flatnonzero(first)
    line_end = np.append(line_start[1:], len(raw))
    line_row = row[line_start] if len(raw) else np.zeros(0, np.int32)
    line_hash = range_hashes(raw, line_start, line_end)
    lines = np.bincount(line_row, minlength=n)

    columns = [
        np.log1p(size),
        letters / length,
        kinds[:, _UPPER] / np.maximum(letters, 1),
        kinds[:, _DIGIT] / length,
        kinds[:, _MARK] / length,
        kinds[:, _SYMBOL] / length,
        kinds[:, _SPACE] / length,
        entropy,
        np.log1p(count),
        per_word(wlen),
        per_word(wlen > 20),
        distinct(h, wrow),
        per_word(again),
        distinct(pairs, wrow[at]),
        per_word(kind[words.end - 1] == _SYMBOL) if len(h) else np.zeros(n),
        per_word((word_upper > 1) & (word_upper == word_letters)),
        per_word(word_letters == wlen),
        lines / some,
        distinct(line_hash, line_row),
        histogram.max(axis=1) / length,
        (kinds[:, _MARK] + kinds[:, _SYMBOL]) / some,
    ]
    return np.stack(columns, axis=1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES, SLICE_ROWS):
            x = figures(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("y"), *(pa.array(c) for c in x.T)], names=["y", *FEATURES]
            )


def _tree(gain_g: np.ndarray, gain_h: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over ordered bins as one value per bin: Newton steps in at most ``leaves`` runs of bins."""
    edges = [0, len(gain_g)]
    g, h = np.concatenate([[0], np.cumsum(gain_g)]), np.concatenate([[0], np.cumsum(gain_h)])

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    for _ in range(leaves - 1):
        best, where = 1e-9, None
        for a, b in zip(edges, edges[1:]):
            cut = np.arange(a + 1, b)
            if len(cut):
                won = worth(a, cut) + worth(cut, b) - worth(a, b)
                k = int(won.argmax())
                if won[k] > best:
                    best, where = won[k], int(cut[k])
        if where is None:
            break
        edges = sorted([*edges, where])
    out = np.empty(len(gain_g))
    for a, b in zip(edges, edges[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y > 0, -z, z)).mean())


def coarse_bins(bins: np.ndarray, widths: list[int]) -> np.ndarray:
    """Bins for the pair tables: each feature's own bins, ``widths`` of them, in at most ``PAIR_BINS`` runs of equal length."""
    return bins * PAIR_BINS // np.maximum(widths, PAIR_BINS)


def boost(
    bins: np.ndarray, y: np.ndarray, hold: np.ndarray, widths: list[int], pairs: int = PAIRS
) -> tuple[float, np.ndarray, list]:
    """(bias, table per feature, [(i, j, table)]) from binned features; rows in ``hold`` only tell when to stop."""
    fit = ~hold
    bias = float(np.log((y[fit].sum() + 0.5) / ((1 - y[fit]).sum() + 0.5)))
    z = np.full(len(y), bias)
    tables = np.zeros((bins.shape[1], BINS))
    best, kept, idle = _loss(z[hold], y[hold]), (tables.copy(), z.copy()), 0
    for _ in range(ROUNDS):
        for f in range(bins.shape[1]):
            p = _sigmoid(z[fit])
            b = bins[fit, f]
            update = STEP * _tree(np.bincount(b, y[fit] - p, BINS), np.bincount(b, p * (1 - p), BINS), LEAVES)
            tables[f] += update
            z += update[bins[:, f]]
        now = _loss(z[hold], y[hold])
        if now < best - 1e-6:
            best, kept, idle = now, (tables.copy(), z.copy()), 0
        elif (idle := idle + 1) >= 10:
            break
    tables, z = kept
    crosses = []
    coarse = coarse_bins(bins, widths)
    # The 2x2 split of a pair is made at the middle of each feature's own runs.
    middle = (np.minimum(widths, PAIR_BINS) + 1) // 2
    error, weight = y[fit] - _sigmoid(z[fit]), _sigmoid(z[fit]) * (1 - _sigmoid(z[fit]))
    for i in range(bins.shape[1]):
        for j in range(i):
            cell = (coarse[fit, i] >= middle[i]) * 2 + (coarse[fit, j] >= middle[j])
            g, h = np.bincount(cell, error, 4), np.bincount(cell, weight, 4)
            crosses.append(((g**2 / (h + 1)).sum(), i, j))
    chosen = [(i, j, np.zeros(PAIR_BINS**2)) for _, i, j in sorted(crosses, reverse=True)[:pairs]]
    kept_pairs, idle = [t.copy() for _, _, t in chosen], 0
    for _ in range(PAIR_ROUNDS):
        for i, j, table in chosen:
            cell = coarse[:, i] * PAIR_BINS + coarse[:, j]
            p = _sigmoid(z[fit])
            g = np.bincount(cell[fit], y[fit] - p, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)
            h = np.bincount(cell[fit], p * (1 - p), PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)
            # Two levels: a split of the first feature, then one of the second within each side.
            side = _tree(g.sum(axis=1), h.sum(axis=1), 2)
            update = np.empty((PAIR_BINS, PAIR_BINS))
            for value in np.unique(side):
                rows = side == value
                update[rows] = _tree(g[rows].sum(axis=0), h[rows].sum(axis=0), 2)
            table += STEP * update.ravel()
            z += STEP * update.ravel()[cell]
        now = _loss(z[hold], y[hold])
        if now < best - 1e-6:
            best, kept_pairs, idle = now, [t.copy() for _, _, t in chosen], 0
        elif (idle := idle + 1) >= 5:
            break
    return bias, tables, [(i, j, t) for (i, j, _), t in zip(chosen, kept_pairs)]


def _binned(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Bin of each figure: how many of the feature's cuts are not above it."""
    return np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(cuts)], axis=1)


def _bag_fitter(cuts: list[np.ndarray]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bag = int(pdf["bag"].iloc[0])
        pdf = pdf.sort_values(["part", *FEATURES])
        bins = _binned(pdf[FEATURES].to_numpy(), cuts)
        bias, tables, pairs = boost(bins, pdf["y"].to_numpy(float), (pdf["part"] == bag).to_numpy(), [len(c) + 1 for c in cuts])
        rows = [(bag, -1, -1, [bias]), *((bag, f, -1, t.tolist()) for f, t in enumerate(tables))]
        rows += [(bag, i, j, t.tolist()) for i, j, t in pairs]
        return pd.DataFrame(rows, columns=["bag", "i", "j", "entries"])

    return run


def learn(sample: DataFrame, bags: int = BAGS) -> dict:
    """The model from ``text, y``: cuts, bias, tables and pair tables, averaged over the bags."""
    columns = ", ".join(f"{f} double" for f in FEATURES)
    measured = materialize(sample.mapInArrow(_measure, f"y int, {columns}"), "quality-sample")
    seen = {r["y"]: r["n"] for r in measured.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        return {"share": 1.0 if not seen else float(1 in seen)}
    steps = [k / BINS for k in range(1, BINS)]
    cuts = [np.unique(c) for c in measured.approxQuantile(FEATURES, steps, 0.002)]
    dealt = measured.withColumn("part", F.pmod(F.xxhash64(*FEATURES), F.lit(bags)).cast("int"))
    copies = dealt.withColumn("bag", F.explode(F.array(*[F.lit(b) for b in range(bags)])))
    # Ranges, unlike hashes, give every bag a task of its own.
    fitted = copies.repartitionByRange(bags, "bag").groupBy("bag").applyInPandas(_bag_fitter(cuts), "bag int, i int, j int, entries array<double>").toPandas()
    model = {"cuts": cuts, "bias": 0.0, "tables": np.zeros((len(FEATURES), BINS)), "pairs": {}}
    n = fitted["bag"].nunique()
    for r in fitted.itertuples():
        entries = np.asarray(r.entries) / n
        if r.i < 0:
            model["bias"] += entries[0]
        elif r.j < 0:
            model["tables"][r.i] += entries
        else:
            model["pairs"][r.i, r.j] = model["pairs"].get((r.i, r.j), 0) + entries
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    if "share" in model:
        return np.full(len(x), model["share"])
    bins = _binned(x, model["cuts"])
    z = np.full(len(x), model["bias"])
    for f, table in enumerate(model["tables"]):
        z += table[bins[:, f]]
    coarse = coarse_bins(bins, [len(c) + 1 for c in model["cuts"]])
    for (i, j), table in model["pairs"].items():
        z += table[coarse[:, i] * PAIR_BINS + coarse[:, j]]
    return _sigmoid(z)


def _scored(model: dict, rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for part in slices(rows, "text", SLICE_BYTES, SLICE_ROWS):
        yield part, predict(model, figures(part.column("text")))


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, score in _scored(shared.value, batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def _good(shared, threshold: float):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            rows = pa.RecordBatch.from_arrays([text], names=["text"])
            kept = [score >= threshold for _, score in _scored(shared.value, rows)]
            yield pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))

    return F.arrow_udf(run, "boolean")


def score(documents: DataFrame, model: dict) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    reach_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scorer(shared), "doc_id long, score double")


def keep_good(documents: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, all columns, that score at least ``threshold``. Only texts go to Python and verdicts come back."""
    reach_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return documents.where(_good(shared, threshold)(F.col("text").cast("string")))


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    reach_package(spark)
    return learn(labelled_sample(documents, labels, "quality", FOLDS, HELD_OUT, rows))


def quality(spark: SparkSession, sf_dir: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Query op2: learned outside the held-out fold, scored everywhere."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(spark, documents, spark.read.parquet(f"{sf_dir}/labels.parquet"), rows)
    return score(documents, model).select(
        "doc_id",
        F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

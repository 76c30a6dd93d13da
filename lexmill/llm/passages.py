"""Repeated passages by collinear chaining of shared word seeds.

1. Seeds: of every ``WINDOW`` successive ``SEED_WORDS``-grams of lower-cased words the one with the smallest hash (winnowing), so any
   run of ``SEED_WORDS + WINDOW - 1`` equal words has a seed in common. Texts under ``MIN_WORDS`` words cannot hold a passage.
2. Matches: each seed that several documents hold is joined to its *first* occurrence only (smallest id). So a passage
   that very many documents share gives one match per document and seed, never pairs of them; what combines before the shuffle is a minimum.
3. Chains: the matches of a document with one other document are chained where both positions grow. A seed is worth
   ``SEED_WORTH``, a step costs ``GAP_COST`` per word it moves on in either text; a Fenwick tree over the other text's
   positions holds the best chain to extend. Chains are cut where a gap is over ``MAX_GAP`` words.
   Chains that touch in the document, whichever documents they lead to, count together: a passage may have come in parts.
4. Alignment: the words of both sides are fetched for chains that can reach ``MIN_WORDS`` words. Between seeds words are compared along
   the diagonal, or by edit distance where an edit has moved it; the ends grow as long as words agree. A chain with a share of at least
   ``SIMILARITY`` equal words is kept, and the union of a document's chains is a passage from ``MIN_WORDS`` words.

The smallest document that holds a passage is never reported for it and keeps it.

Skew: the joins by seed and by the fetched stretches of the first occurrence are sort-merge joins with one row per key
on one side, whose large keys adaptive execution splits. Chaining gathers by document only, so a task holds at
most the matches of the longest text.

Defined cases: null or empty texts and null ids give no row; rows that repeat an id are one document as far as
references go; repeats within one document are not reported; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm.texts import SPACED, Words, grams, reach_package, slices

SEED_WORDS = 5
WINDOW = 8
MIN_WORDS = 50
SIMILARITY = 0.8
SEED_WORTH = 5.0
GAP_COST = 0.1
MAX_GAP = 24
#: Words past a chain's ends that are fetched and compared.
MARGIN = 24
_SLICE = 1 << 20


def winnow(h: np.ndarray, row: np.ndarray, window: int) -> np.ndarray:
    """Indices of the smallest of every ``window`` successive hashes of a row, each once."""
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best = np.arange(n)
    low = h[:n].copy()
    for j in range(1, window):
        smaller = h[j : j + n] < low
        low[smaller] = h[j : j + n][smaller]
        best[smaller] = np.flatnonzero(smaller) + j
    return np.unique(best[row[:n] == row[window - 1 :]])


def _seeder(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                words = Words(part.column("text"), SPACED)
                keys, at = grams(words.hashes(), words.row, SEED_WORDS)
                row = words.row[at]
                seed = winnow(keys, row, WINDOW)
                seed = seed[words.counts()[row[seed]] >= min_words]
                # A word said over and over gives one seed, not one for each time.
                again = np.zeros(len(seed), bool)
                again[1:] = (keys[seed][1:] == keys[seed][:-1]) & (row[seed][1:] == row[seed][:-1])
                seed = seed[~again]
                starts = np.concatenate([[0], np.cumsum(words.counts())])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[seed].view(np.int64), pa.int64()),
                        part.column("doc_id").take(pa.array(row[seed])),
                        pa.array(at[seed] - starts[row[seed]], pa.int32()),
                    ],
                    names=["seed", "doc_id", "pos"],
                )

    return run


class _Fenwick:
    """Largest value and its holder over the positions below a bound."""

    def __init__(self, n: int):
        self.best = [(-np.inf, -1)] * (n + 1)

    def put(self, i: int, value: float, who: int) -> None:
        i += 1
        while i < len(self.best):
            if value > self.best[i][0]:
                self.best[i] = (value, who)
            i += i & -i

    def below(self, i: int) -> tuple[float, int]:
        out = (-np.inf, -1)
        while i > 0:
            if self.best[i][0] > out[0]:
                out = self.best[i]
            i -= i & -i
        return out


def chain(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Collinear chains (indices) of matches sorted by ``x``, each match in one of them at most."""
    if len(x) == 1:
        return [np.zeros(1, np.int64)]
    if (np.diff(y) > 0).all():
        order = [np.arange(len(x))]
    else:
        places, rank = np.unique(y, return_inverse=True)
        tree, score, before = _Fenwick(len(places)), np.zeros(len(x)), np.full(len(x), -1)
        waiting: list[int] = []
        for j in range(len(x)):
            if waiting and x[waiting[0]] < x[j]:
                for i in waiting:
                    tree.put(int(rank[i]), score[i] + GAP_COST * (x[i] + y[i]), i)
                waiting = []
            value, i = tree.below(int(rank[j]))
            value -= GAP_COST * (x[j] + y[j])
            score[j] = SEED_WORTH
            if i >= 0 and value > 0 and x[j] - x[i] <= MAX_GAP and y[j] - y[i] <= MAX_GAP:
                score[j], before[j] = SEED_WORTH + value, i
            waiting.append(j)
        used, order = np.zeros(len(x), bool), []
        for j in np.argsort(-score, kind="stable").tolist():
            path = []
            while j >= 0 and not used[j]:
                used[j] = True
                path.append(j)
                j = int(before[j])
            if path:
                order.append(np.array(path[::-1]))
    out = []
    for path in order:
        cut = np.flatnonzero((np.diff(x[path]) > MAX_GAP) | (np.diff(y[path]) > MAX_GAP)) + 1
        out += np.split(path, cut)
    return out


def _chains_of(other: np.ndarray, pos: np.ndarray, there: np.ndarray, min_words: int) -> list[tuple]:
    """(other document, own places, places there) of a document's chains that can be part of a passage."""
    order = np.lexsort((pos, other))
    other, pos, there = other[order], pos[order], there[order]
    found = []
    for run in np.split(np.arange(len(other)), np.flatnonzero(np.diff(other)) + 1):
        for path in chain(pos[run], there[run]):
            at = run[path]
            found.append((int(other[at[0]]), pos[at], there[at]))
    found.sort(key=lambda c: int(c[1][0]))
    reach = SEED_WORDS + WINDOW - 1
    out, group, low, high = [], [], 0, -1
    for c in [*found, None]:
        if c is None or group and c[1][0] > high + reach:
            if group and high - low + 2 * reach >= min_words:
                out += group
            group = []
        if c is not None:
            low = int(c[1][0]) if not group else low
            high = max(high if group else -1, int(c[1][-1]) + SEED_WORDS)
            group.append(c)
    return out


def _chainer(min_words: int):
    """Rows come sorted by document; a document's rows may go over several batches."""
    names = ["doc_id", "start", "end", "ref_doc_id", "ref_start", "ref_end", "own", "there"]

    def emit(doc: np.ndarray, pos: np.ndarray, other: np.ndarray, there: np.ndarray) -> pa.RecordBatch:
        rows: list[tuple] = []
        for run in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(doc)) + 1):
            if len(run):
                for ref, own, far in _chains_of(other[run], pos[run], there[run], min_words):
                    rows.append(
                        (int(doc[run[0]]), int(own[0]), int(own[-1]) + SEED_WORDS, ref, int(far[0]), int(far[-1]) + SEED_WORDS, own, far)
                    )
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "pos", "ref", "ref_pos")]
            last = int(np.searchsorted(now[0], now[0][-1]))
            if last or held and held[0][0][0] != now[0][0]:
                yield emit(*(np.concatenate(c) for c in zip(*held, [a[:last] for a in now])))
                held = []
            held.append([a[last:] for a in now])
        if held:
            yield emit(*(np.concatenate(c) for c in zip(*held)))

    return run


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word hashes of the asked stretches of each text, from ``at`` on."""
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            words = Words(part.column("text"), SPACED)
            h = (words.hashes() >> np.uint64(32)).astype(np.uint32)
            first = np.concatenate([[0], np.cumsum(words.counts())])
            out: list[tuple] = []
            for i, (doc, asked) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("asked").to_pylist())):
                own = h[first[i] : first[i + 1]]
                for a in asked:
                    low = max(a["start"] - MARGIN, 0)
                    out.append((doc, a["start"], a["end"], low, own[low : a["end"] + MARGIN].tobytes()))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc", "s", "e", "low", "words"])


def _grow(equal: np.ndarray) -> tuple[int, int]:
    """How far agreement goes on (an unequal word costs three equal ones), and the equal words in it."""
    if not len(equal):
        return 0, 0
    total = np.cumsum(np.where(equal, 1, -3))
    best = int(total.argmax())
    return (best + 1, int(equal[: best + 1].sum())) if total[best] > 0 else (0, 0)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short word lists."""
    row = np.zeros(len(b) + 1, np.int64)
    for w in a:
        step = np.maximum(row[1:], row[:-1] + (b == w))
        row[1:] = np.maximum.accumulate(step)
    return int(row[-1])


def align(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[int, int, int, int, int]:
    """(start, end) in both word lists and the equal words of a chain whose seeds are at ``x`` and ``y``."""
    same = 0
    for i in range(len(x) - 1):
        dx, dy = x[i + 1] - x[i], y[i + 1] - y[i]
        if dx == dy:
            same += int((a[x[i] : x[i + 1]] == b[y[i] : y[i + 1]]).sum())
        else:
            same += _common(a[x[i] : x[i + 1]], b[y[i] : y[i + 1]])
    xe, ye = int(x[-1]) + SEED_WORDS, int(y[-1]) + SEED_WORDS
    same += SEED_WORDS
    n = min(int(x[0]), int(y[0]))
    left, more = _grow((a[x[0] - n : x[0]] == b[y[0] - n : y[0]])[::-1])
    same += more
    n = min(len(a) - xe, len(b) - ye)
    right, more = _grow(a[xe : xe + n] == b[ye : ye + n])
    return int(x[0]) - left, xe + right, int(y[0]) - left, ye + right, same + more


def _aligner(similarity: float):
    names = ["doc_id", "start", "end", "ref_doc_id", "ref_start", "ref_end", "same"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                a, b = np.frombuffer(r["words"], np.uint32), np.frombuffer(r["ref_words"], np.uint32)
                x, y = np.array(r["own"]) - r["low"], np.array(r["there"]) - r["ref_low"]
                s, e, rs, re, same = align(a, b, x, y)
                if same >= similarity * max(e - s, re - rs):
                    rows.append((r["doc_id"], s + r["low"], e + r["low"], r["ref_doc_id"], rs + r["ref_low"], re + r["ref_low"], same))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def aligned_chains(documents: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, start, end, ref_doc_id, ref_start, ref_end, same``: word ranges of fuzzy repeats of earlier documents."""
    reach_package(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    )
    seeds = materialize(docs.mapInArrow(_seeder(min_words), "seed long, doc_id long, pos int"), "seeds")
    first = (
        seeds.groupBy("seed").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.max("doc_id").alias("most"))
        .where("first.doc_id < most").select("seed", F.col("first.doc_id").alias("ref"), F.col("first.pos").alias("ref_pos"))
    )
    matches = materialize(seeds.join(first, "seed").where("doc_id > ref").select("doc_id", "pos", "ref", "ref_pos"), "matches")
    chains = materialize(
        matches.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(
            _chainer(min_words),
            "doc_id long, start int, end int, ref_doc_id long, ref_start int, ref_end int, own array<int>, there array<int>",
        ),
        "chains",
    )
    wanted = (
        chains.select("doc_id", "start", "end")
        .unionByName(chains.select(F.col("ref_doc_id").alias("doc_id"), F.col("ref_start").alias("start"), F.col("ref_end").alias("end")))
        .distinct()
        .groupBy("doc_id", (F.col("start") / 4096).cast("int").alias("stretch"))
        .agg(F.collect_list(F.struct("start", "end")).alias("asked"))
    )
    fetched = docs.join(wanted, "doc_id").select("doc_id", "text", "asked").mapInArrow(
        _stretches, "doc long, s int, e int, low int, words binary"
    )
    # Rows that repeat an id ask for the same stretch.
    words = materialize(fetched, "stretches").groupBy("doc", "s", "e").agg(F.max(F.struct("low", "words")).alias("w"))
    words = materialize(words.select("doc", "s", "e", "w.low", "w.words"), "stretches")
    own = words.select(F.col("doc").alias("doc_id"), F.col("s").alias("start"), F.col("e").alias("end"), "low", "words")
    ref = words.select(
        F.col("doc").alias("ref_doc_id"), F.col("s").alias("ref_start"), F.col("e").alias("ref_end"),
        F.col("low").alias("ref_low"), F.col("words").alias("ref_words"),
    )
    both = chains.join(own, ["doc_id", "start", "end"]).join(ref, ["ref_doc_id", "ref_start", "ref_end"])
    return materialize(
        both.select("doc_id", "ref_doc_id", "own", "there", "low", "words", "ref_low", "ref_words").mapInArrow(
            _aligner(similarity), "doc_id long, start int, end int, ref_doc_id long, ref_start int, ref_end int, same int"
        ),
        "aligned",
    )


def passages(documents: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One row per passage that repeats earlier documents: ``doc_id, start_word, end_word, n_words, ref_doc_id,
    ref_doc_ids, share_equal``."""
    chains = aligned_chains(documents, min_words, similarity)
    by_place = Window.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    numbered = chains.withColumn("new", (reach.isNull() | (F.col("start") > reach)).cast("int")).withColumn("no", F.sum("new").over(by_place))
    grouped = numbered.groupBy("doc_id", "no").agg(
        F.min("start").alias("start_word"),
        F.max("end").alias("end_word"),
        F.array_sort(F.collect_set("ref_doc_id")).alias("ref_doc_ids"),
        (F.sum("same") / F.sum(F.col("end") - F.col("start"))).alias("share_equal"),
    )
    return grouped.where(F.col("end_word") - F.col("start_word") >= min_words).select(
        "doc_id",
        "start_word",
        "end_word",
        (F.col("end_word") - F.col("start_word")).alias("n_words"),
        F.array_min("ref_doc_ids").alias("ref_doc_id"),
        "ref_doc_ids",
        "share_equal",
    )


def _remover(columns: list[str], name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, cuts = batch.column("text"), batch.column(name).to_pylist()
            new = []
            for i, spans in enumerate(cuts):
                if not spans:
                    new.append(text[i].as_py())
                    continue
                words = Words(text.slice(i, 1), SPACED)
                raw, at, kept = text[i].as_py().encode(), 0, []
                for s in sorted(spans, key=lambda s: s["start_word"]):
                    if s["start_word"] >= len(words.start):
                        continue
                    kept.append(raw[at : words.start[s["start_word"]]])
                    at = int(words.start[s["end_word"]]) if s["end_word"] < len(words.start) else len(raw)
                new.append(b"".join([*kept, raw[at:]]).decode())
            out = batch.set_column(batch.schema.get_field_index("text"), pa.field("text", pa.string()), pa.array(new, pa.string()))
            yield out.select([*columns, name])

    return run


def remove_passages(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents, all columns, without the passages found; ``n_chars`` (if there) follows, and a document that was
    nothing but repeats is left out."""
    reach_package(documents.sparkSession)
    columns = documents.columns
    name = "cuts"
    while name in map(str.lower, columns):
        name += "_"
    cuts = found.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias(name))
    joined = documents.join(cuts, "doc_id", "left").select(*columns, name)
    cut = joined.mapInArrow(_remover(columns, name), joined.schema)
    cut = cut.where(F.col(name).isNull() | (F.length(F.regexp_replace("text", r"[\x09-\x0D\x20]+", "")) > 0))
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col(name).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return cut.select(*columns)


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op7."""
    return passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))

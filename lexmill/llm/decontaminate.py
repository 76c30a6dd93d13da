"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, one scan of each text.

Items (questions and answers) and documents are lower-cased (A-Z) and cut into words of digits, letters a-z and
all characters from U+0080 up. A window is ``window`` consecutive words of an item; an item of fewer words, but
not none, is one window. Every window becomes a pattern with word borders; the automaton finds all of them in
one pass over the normalised text, and word numbers lead back to places in the original text.

Size: an automaton holds about ``block_windows`` windows at most. A larger benchmark is dealt over several automata,
each of which scans every document, so nothing is cut off; the item texts reach the tasks as a broadcast whose size that
bound fixes (``GROUP_BLOCKS`` blocks at a time). Documents are scanned where they are read: no text is shuffled.

Defined cases: null or empty text has no words and no hits; an item with no words or a null text or id is not
searched for; items with equal texts are all reported; repeated rows are reported each; other columns of either
table are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm.texts import ALNUM, LOWER, Words, reach_package, slices

WINDOW = 10
#: Windows in one automaton: about 2 kB each in a task's memory.
BLOCK_WINDOWS = 50_000
#: Blocks whose item texts one broadcast holds.
GROUP_BLOCKS = 16
#: Text that a task scans at a time; with several blocks, an automaton is built for each so many bytes.
SCAN_BYTES = 32 << 20

_FOLD = bytes(np.where(ALNUM[LOWER], LOWER, 0x20).astype(np.uint8))
_automata: dict[int, ahocorasick.Automaton] = {}

_SPANS = "array<struct<start:int,end:int,first_byte:bigint,end_byte:bigint>>"
_PLACES = pa.list_(
    pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first_byte", pa.int64()), ("end_byte", pa.int64())])
)


def normal(text: bytes | None) -> bytes:
    """The words of a text, each between single spaces."""
    return b" ".join([b"", *(text or b"").translate(_FOLD).split(), b""])


def windows_of(text: str | None, window: int) -> list[bytes]:
    words = normal((text or "").encode()).split()
    if len(words) <= window:
        return [b" ".join([b"", *words, b""])] if words else []
    return [b" ".join([b"", *words[i : i + window], b""]) for i in range(len(words) - window + 1)]


def build(items: list[tuple[str, str | None]], window: int) -> ahocorasick.Automaton:
    """Automaton whose values are (length in words, items that hold the window)."""
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in windows_of(text, window):
            owners.setdefault(w, set()).add(item)
    automaton = ahocorasick.Automaton()
    for w, who in owners.items():
        # Bytes as one character each: places are byte places, and the patterns stay short.
        automaton.add_word(w.decode("latin-1"), (w.count(b" ") - 1, len(w), tuple(sorted(who))))
    if owners:
        automaton.make_automaton()
    return automaton


def scan(automaton: ahocorasick.Automaton, text: bytes) -> tuple[list[tuple[int, int]], set[str]]:
    """(first word, end word) of every occurrence in a normalised text, and the items found."""
    found = [(end, value) for end, value in automaton.iter(text.decode("latin-1"))]
    if not found:
        return [], set()
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20)
    # A match ends on the border after its last word; that border's number is the end word.
    last = np.searchsorted(spaces, [end for end, _ in found])
    spans = [(int(e) - value[0], int(e)) for e, (_, value) in zip(last, found)]
    return spans, {item for _, value in found for item in value[2]}


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _automaton_getter(shared, ident: int, window: int, n_blocks: int):
    def automaton_of(block: int) -> ahocorasick.Automaton:
        if n_blocks > 1:
            return build(shared.value[block], window)
        if ident not in _automata:
            _automata.clear()
            _automata[ident] = build(shared.value[block], window)
        return _automata[ident]

    return automaton_of


def _scanner(shared, ident: int, window: int, n_blocks: int):
    """Adds what one broadcast's blocks find to each row; a single block's automaton stays for the next task."""

    automaton_of = _automaton_getter(shared, ident, window, n_blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            n_words = [0] * batch.num_rows
            spans = [[(s["start"], s["end"]) for s in row or ()] for row in batch.column("spans").to_pylist()]
            items = [set(row or ()) for row in batch.column("items").to_pylist()]
            for block in range(n_blocks):
                automaton = automaton_of(block)
                some = len(automaton) > 0
                for i in range(batch.num_rows):
                    plain = normal(texts[i].as_py())
                    n_words[i] = max(plain.count(b" ") - 1, 0)
                    if some:
                        more, found = scan(automaton, plain)
                        spans[i] += more
                        items[i] |= found
            places = []
            for i, row in enumerate(spans):
                merged = _union(row)
                if merged:
                    words = Words(batch.column("text").slice(i, 1), ALNUM)
                    merged = [
                        {"start": a, "end": b, "first_byte": int(words.start[a]), "end_byte": int(words.end[b - 1])}
                        for a, b in merged
                    ]
                places.append(merged)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("text"),
                    pa.array(n_words, pa.int64()),
                    pa.array(places, _PLACES),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                names=["key", "text", "n_words", "spans", "items"],
            )

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(part for batch in batches for part in slices(batch, "text", SCAN_BYTES))

    return sliced


def _groups(
    benchmark: DataFrame, id_column: str, text_column: str, window: int, block_windows: int
) -> Iterator[list[list[tuple[str, str]]]]:
    """Items in blocks of about ``block_windows`` windows, up to ``GROUP_BLOCKS`` blocks at a time."""
    items = materialize(
        benchmark.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text"))
        .where(F.col("item").isNotNull() & F.col("text").isNotNull())
        # Words, counted generously, bound the windows.
        .withColumn("size", F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))),
        "bench-items",
    )
    total = items.agg(F.sum("size")).first()[0] or 0
    n_blocks = max(1, -(-2 * int(total) // block_windows)) if total > block_windows else 1
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)).cast("int"))
    for low in range(0, n_blocks, GROUP_BLOCKS):
        blocks: list[list[tuple[str, str]]] = [[] for _ in range(min(GROUP_BLOCKS, n_blocks - low))]
        for r in dealt.where((F.col("block") >= low) & (F.col("block") < low + GROUP_BLOCKS)).collect():
            blocks[r["block"] - low].append((r["item"], r["text"]))
        yield blocks


def find_windows(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """One row per document: ``doc_id, text, n_words, spans, items``; spans are disjoint word ranges with the
    bytes they take in the original text, items the sorted ids of the test items found."""
    spark = documents.sparkSession
    reach_package(spark)
    found = documents.select(
        F.col(doc_id).alias("key"),
        F.col(text).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPANS).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for blocks in _groups(benchmark, item_id, item_text, window, block_windows):
        shared = spark.sparkContext.broadcast(blocks)
        found = found.mapInArrow(_scanner(shared, uuid.uuid4().int, window, len(blocks)), found.schema)
    return found.withColumnRenamed("key", "doc_id")


def _cleaner(shared, ident: int, window: int, n_blocks: int):
    automaton_of = _automaton_getter(shared, ident, window, n_blocks)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            plain = column.cast(pa.binary())
            clean = np.ones(len(plain), bool)
            for block in range(n_blocks):
                automaton = automaton_of(block)
                if len(automaton):
                    for i in np.flatnonzero(clean):
                        clean[i] = next(automaton.iter(normal(plain[i].as_py()).decode("latin-1")), None) is None
            yield pa.array(clean)

    return F.arrow_udf(run, "boolean")


def keep_clean(
    documents: DataFrame,
    benchmark: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The rows of ``documents`` (text in ``text``), all columns, that hold no window of a test item. Only texts go to Python and
    verdicts come back."""
    spark = documents.sparkSession
    reach_package(spark)
    clean = documents
    for blocks in _groups(benchmark, item_id, item_text, window, block_windows):
        shared = spark.sparkContext.broadcast(blocks)
        verdict = _cleaner(shared, uuid.uuid4().int, window, len(blocks))
        clean = clean.where(verdict(F.col("text").cast("string")))
    return clean


def n_hit() -> Column:
    """Words inside any occurrence."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op10: the digest of every document's hits."""
    found = find_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
    )


def brute_force(text: str | None, items: list[tuple[str, str | None]], window: int = WINDOW) -> tuple[int, int, list[str]]:
    """(words, words hit, items found) by comparing word lists place by place; for tests."""
    words = normal((text or "").encode()).split()
    hit, found = set(), set()
    for item, item_text in items:
        for w in windows_of(item_text, window):
            want = w.split()
            for i in range(len(words) - len(want) + 1):
                if words[i : i + len(want)] == want:
                    hit.update(range(i, i + len(want)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()

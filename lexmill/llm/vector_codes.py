"""Product codes of vectors, learnt in whole numbers over Hilbert-sorted blocks.

A component x becomes ``floor(4096 x)``; a vector is cut into ``PARTS`` equal parts, and each part position has a codebook of
``ENTRIES``, which start as that part of the vectors with the smallest ids and are moved for ``ROUNDS`` rounds to the mean
(rounded down) of the parts nearest to them. The code of a vector is the index of the nearest entry of each part.

Blocks: the parts of a position are sorted along a Hilbert curve over their standardised components, dealt by ranges of
the curve and cut into blocks of ``BLOCK_ROWS``. A block keeps its box (least and largest value of each component), the sums of its
components and its rows, flat. In a round, the least and the largest distance of each entry to the box give the entries
that can be nearest to anything inside: one whose least distance exceeds another one's largest is out. With
one entry left, the block counts through its sums and its rows are not looked at; else a small kernel in 64-bit integers
compares its rows with the entries left. All distances are exact, so neither the curve nor the blocks change a result; they
only decide how much is compared, and boxes get tighter as rows get more.

At scale: rows move once to be sorted (keys end in a row number, so a vector that very many rows share is split over ranges) and once, as
narrow rows, to bring the codes of a vector together. A round reads the blocks where they were written and sends
``PARTS * ENTRIES`` sums a task; the driver holds the codebooks only.

Defined cases: vectors that are null, empty or hold null or non-finite components are dropped, and so are those of another
length than most (the longer of two equally frequent ones) or of a length that ``PARTS`` does not divide. Components beyond
``-2^15`` or ``2^15`` (less for more than 64 components, :func:`reach`) count as if they lay there, so that all distances fit 64 bits. Rows with a null id are coded, but start no entry. Rows that
repeat an id are rows of their own, and ties among the smallest ids go to the smaller vector. With fewer than ``ENTRIES`` ids the
codebooks have that many entries; if all ids are null, the smallest vectors start them. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm.texts import reach_package

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
BLOCK_ROWS = 128
#: Standard deviations that the curve covers; components outside lie on its border.
_SPAN = 3.0
#: Blocks looked at together.
_BLOCKS = 512

KEYED = "part int, key long, uid long, x binary"
BLOCKS = "part int, n int, low binary, high binary, sums binary, uids binary, rows binary"


def reach(width: int) -> int:
    """Bound of a component as a whole number, so that squared distances of whole vectors stay below 2^63."""
    return 1 << min(27, (62 - (width - 1).bit_length()) // 2 - 1)


def whole(vector: Column, width: int) -> Column:
    """The components as whole numbers, rounded down."""
    bound = float(reach(width))
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(bound)), F.lit(-bound))).cast("int"))


def kept_vectors(embeddings: DataFrame, vec_id: str, vector: str, label: str | None, parts: int) -> DataFrame:
    """Written table ``uid, vec_id, label, q`` of the rows that take part."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | x.cast("double").isin(float("inf"), float("-inf")))
    usable = embeddings.where(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & ~odd)
    lengths = usable.groupBy(F.size(v).alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("length")).limit(1).first()
    width = usual["length"] if usual else parts
    rows = usable.where(F.size(v) == width).select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(vec_id).cast("long").alias("vec_id"),
        (F.col(label) if label else F.lit(None).cast("int")).alias("label"),
        whole(v, width).alias("q"),
    )
    return materialize(rows, "vectors")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            x = _matrix(batch.column("q"), width).astype(np.float64)
            n, total, squares = n + len(x), total + x.sum(axis=0), squares + (x * x).sum(axis=0)
        columns = [np.arange(width, dtype=np.int32), np.full(width, float(n)), total, squares]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["at", "n", "total", "squares"])

    return run


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (whole numbers below ``2^bits``) on the Hilbert curve through all of them.

    The cells are first turned into the curve's own axes, from the highest bit down: where a bit is set, the lower bits of the first axis
    are flipped, else they are exchanged with those of the axis at hand. A Gray code over the axes then gives the bits of the place."""
    axes = [cells[:, i].astype(np.uint64) for i in range(cells.shape[1])]
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        lower = np.uint64((1 << b) - 1)
        for i, axis in enumerate(axes):
            is_set = (axis >> np.uint64(b)) & one == 1
            swap = np.where(is_set, np.uint64(0), (axes[0] ^ axis) & lower)
            axes[0] = np.where(is_set, axes[0] ^ lower, axes[0] ^ swap)
            if i:
                axes[i] = axis ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros(len(cells), np.uint64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> np.uint64(b)) & one == 1, np.uint64((1 << b) - 1), np.uint64(0))
    key = np.zeros(len(cells), np.uint64)
    for b in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << one) | (((axis ^ flip) >> np.uint64(b)) & one)
    return key.astype(np.int64)


def curve_keys(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Curve places of parts with the given moments of their components; at most 63 bits, of the first 63 components."""
    used = min(x.shape[1], 63)
    bits = min(16, 63 // used)
    scaled = (x[:, :used] - mean[:used]) / np.where(spread[:used] > 0, spread[:used], 1.0)
    cells = np.clip((scaled + _SPAN) * ((1 << bits) / (2 * _SPAN)), 0, (1 << bits) - 1).astype(np.int64)
    return hilbert_keys(cells, bits)


def _cut(width: int, parts: int, mean: np.ndarray, spread: np.ndarray):
    step = width // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("q"), width)
            for part in range(parts):
                at = slice(part * step, (part + 1) * step)
                own = np.ascontiguousarray(x[:, at], np.int32)
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * step), len(own), [None, pa.py_buffer(own)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), part, np.int32)),
                        pa.array(curve_keys(own, mean[at], spread[at])),
                        batch.column("uid"),
                        flat.cast(pa.binary()),
                    ],
                    names=["part", "key", "uid", "x"],
                )

    return run


def _block(step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            uid = batch.column("uid").to_numpy()
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.int32).reshape(-1, step)
            # A block ends where the part changes, after BLOCK_ROWS rows and with the batch.
            runs = np.flatnonzero(np.diff(part, prepend=-1))
            cuts = np.concatenate([np.arange(a, b, BLOCK_ROWS) for a, b in zip(runs, [*runs[1:], len(part)])] or [runs])
            out = []
            for a, b in zip(cuts, [*cuts[1:], len(part)]):
                own = x[a:b]
                bounds = own.min(axis=0), own.max(axis=0)
                sums = own.sum(axis=0, dtype=np.int64)
                out.append((int(part[a]), int(b - a), bounds[0].tobytes(), bounds[1].tobytes(), sums.tobytes(), uid[a:b].tobytes(), own.tobytes()))
            names = ["part", "n", "low", "high", "sums", "uids", "rows"]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def blocks_of(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """Written table of the blocks of all parts."""
    reach_package(vectors.sparkSession)
    moments = vectors.select("q").mapInArrow(_moments(width), "at int, n double, total double, squares double")
    found = moments.groupBy("at").agg(F.sum("n"), F.sum("total"), F.sum("squares")).orderBy("at").collect()
    n, total, squares = np.array([tuple(r)[1:] for r in found]).T
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean**2, 0))
    keyed = vectors.select("uid", "q").mapInArrow(_cut(width, parts, mean, spread), KEYED)
    order = ["part", "key", "uid"]
    dealt = materialize(keyed, "parts").repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(dealt.select("part", "uid", "x").mapInArrow(_block(width // parts), BLOCKS), "blocks")


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """For each box (rows of ``low`` and ``high``) the entries that can be nearest to something inside, as truth values."""
    a, b = low[:, None, :] - entries[None], entries[None] - high[:, None, :]
    out = np.maximum(np.maximum(a, b), 0)
    least = (out * out).sum(axis=2)
    far = np.maximum(np.abs(a), np.abs(b))
    largest = (far * far).sum(axis=2)
    return least <= largest.min(axis=1, keepdims=True)


def nearest(rows: np.ndarray, of: np.ndarray, allowed: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each row among those that its block (``of``) allows; ties to the lower."""
    best = np.full(len(rows), np.iinfo(np.int64).max)
    index = np.zeros(len(rows), np.int64)
    for e in np.flatnonzero(allowed.any(axis=0)):
        at = np.flatnonzero(allowed[of, e])
        d = rows[at] - entries[e]
        d = (d * d).sum(axis=1)
        closer = d < best[at]
        best[at[closer]] = d[closer]
        index[at[closer]] = e
    return index, best


def _slices(batches: Iterator[pa.RecordBatch], step: int):
    """The blocks of one part at a time: ``part``, sizes, boxes, and the batch's slice."""
    for batch in batches:
        part = batch.column("part").to_numpy()
        for p in np.unique(part):
            own = batch.take(pa.array(np.flatnonzero(part == p)))
            for low in range(0, own.num_rows, _BLOCKS):
                got = own.slice(low, _BLOCKS)
                box = [np.frombuffer(b"".join(got.column(c).to_pylist()), np.int32).reshape(-1, step).astype(np.int64) for c in ("low", "high")]
                yield int(p), got.column("n").to_numpy().astype(np.int64), *box, got


def _rows(got: pa.RecordBatch, picked: np.ndarray, step: int) -> np.ndarray:
    raw = b"".join(got.column("rows").take(pa.array(picked)).to_pylist())
    return np.frombuffer(raw, np.int32).reshape(-1, step).astype(np.int64)


def _summer(codebooks: np.ndarray):
    parts, k, step = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, k, step), np.int64), np.zeros((parts, k), np.int64)
        for p, n, low, high, got in _slices(batches, step):
            allowed = shortlists(low, high, codebooks[p])
            single = allowed.sum(axis=1) == 1
            sure, only = np.flatnonzero(single), allowed.argmax(axis=1)
            if len(sure):
                block_sums = np.frombuffer(b"".join(got.column("sums").take(pa.array(sure)).to_pylist()), np.int64).reshape(-1, step)
                np.add.at(sums[p], only[sure], block_sums)
                np.add.at(counts[p], only[sure], n[sure])
            open_ = np.flatnonzero(~single)
            if len(open_):
                rows = _rows(got, open_, step)
                index, _ = nearest(rows, np.repeat(np.arange(len(open_)), n[open_]), allowed[open_], codebooks[p])
                for e in np.unique(index):
                    own = index == e
                    sums[p, e] += rows[own].sum(axis=0)
                    counts[p, e] += int(own.sum())
        out = [(p, e, int(counts[p, e]), sums[p, e].tolist()) for p, e in zip(*np.nonzero(counts))]
        if out:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["part", "entry", "n", "sums"])

    return run


def moved(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    step = codebooks.shape[2]
    per_task = blocks.drop("uids").mapInArrow(_summer(codebooks), "part int, entry int, n long, sums array<long>")
    totals = [F.sum(F.get("sums", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(step)]
    new = codebooks.copy()
    for r in per_task.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*totals).alias("sums")).collect():
        new[r["part"], r["entry"]] = [int(s) // r["n"] for s in r["sums"]]
    return new


def _coder(codebooks: np.ndarray):
    parts, _, step = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, n, low, high, got in _slices(batches, step):
            rows = _rows(got, np.arange(len(n)), step)
            of = np.repeat(np.arange(len(n)), n)
            index, error = nearest(rows, of, shortlists(low, high, codebooks[p]), codebooks[p])
            uid = np.frombuffer(b"".join(got.column("uids").to_pylist()), np.int64)
            code = np.full(len(uid), p, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(code), pa.array(index.astype(np.int32)), pa.array(error)], names=["uid", "part", "entry", "error"])

    return run


def first_codebooks(vectors: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids."""
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), "q").limit(entries).select("vec_id", "q").collect()
    named = [r for r in rows if r["vec_id"] is not None] or rows
    return np.array([r["q"] for r in named], np.int64).reshape(-1, parts, width // parts).transpose(1, 0, 2).copy()


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def learn(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray] | None:
    """The written blocks and the final codebooks (part, entry, component); none for an empty table."""
    head = vectors.select(F.size("q").alias("width")).first()
    if head is None:
        return None
    blocks = blocks_of(vectors, head["width"], parts)
    codebooks = first_codebooks(vectors, head["width"], parts, entries)
    for _ in range(rounds):
        codebooks = moved(blocks, codebooks)
    return blocks, codebooks


def coded(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str | None = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per vector that takes part: ``vec_id, code, error, label_error, codebooks_sha256``; at most 256 entries."""
    vectors = kept_vectors(embeddings, vec_id, vector, label, parts)
    learnt = learn(vectors, parts, entries, rounds)
    if learnt is None:
        return vectors.select(
            "vec_id",
            F.lit("").alias("code"),
            F.lit(0).cast("long").alias("error"),
            F.lit(0).cast("long").alias("label_error"),
            F.lit("").alias("codebooks_sha256"),
        )
    blocks, codebooks = learnt
    named = vectors.select("uid", "vec_id", "label", F.lit(None).cast("int").alias("part"), F.lit(None).cast("int").alias("entry"), F.lit(0).cast("long").alias("error"))
    found = blocks.select("part", "n", "low", "high", "uids", "rows").mapInArrow(_coder(codebooks), "uid long, part int, entry int, error long")
    digits = F.concat(*[F.lpad(F.lower(F.hex(F.max(F.when(F.col("part") == p, F.col("entry"))))), 2, "0") for p in range(parts)])
    codes = (
        found.unionByName(named, allowMissingColumns=True)
        .groupBy("uid")
        .agg(F.max("vec_id").alias("vec_id"), F.max("label").alias("label"), digits.alias("code"), F.sum("error").alias("error"))
    )
    codes = materialize(codes.drop("uid"), "codes")
    # Errors of a label are summed in its tasks first; what is joined back is one row a label.
    of_label = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return codes.join(of_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )


def coded_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op11."""
    return coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle() -> str:
    rounds, books = [], "b0"
    assign = """
  SELECT vec_id, label, part, x, entry, d FROM (
    SELECT *, row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) AS place FROM (
      SELECT p.vec_id, p.label, p.part, p.x, b.entry,
        list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
      FROM p JOIN {books} AS b USING (part)))
  WHERE place = 1"""
    for i in range(1, 7):
        rounds.append(f"""a{i} AS ({assign.format(books=books)}),
u{i} AS (
  SELECT part, entry, pos, sum(c) AS s, count(*) AS n
  FROM (SELECT part, entry, unnest(x) AS c, unnest(range(1, 9)) AS pos FROM a{i}) GROUP BY ALL),
n{i} AS (
  SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS x FROM u{i} GROUP BY part, entry),
b{i} AS (SELECT b.part, b.entry, coalesce(n.x, b.x) AS x FROM {books} AS b LEFT JOIN n{i} AS n USING (part, entry))""")
        books = f"b{i}"
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT vec_id, label, part, q[8 * part + 1 : 8 * part + 8] AS x FROM kept, range(8) AS r(part)),
b0 AS (
  SELECT part, entry, x
  FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 16) JOIN p USING (vec_id)),
{", ".join(rounds)},
last AS ({assign.format(books=books)}),
codes AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM last
  GROUP BY vec_id, label),
sums AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM {books})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM codes, sums
"""


#: 64 components in 8 parts of 8, distinct ids: the given tables.
ORACLE = _oracle()

"""Near-duplicate documents by b-bit MinHash.

Words are runs of characters other than ASCII white space, A-Z lower-cased; a document's set holds its distinct shingles of
``shingle`` words, or its whole word sequence if it has fewer, or nothing. Documents are linked when their sets
have a Jaccard similarity of ``percent``/100 or more; a document's component is the smallest id it is linked to over any number
of links.

1. One pass over the texts gives a digest of the set, ``HASHES`` minima under different permutations, the hashes of
   ``BANDS`` bands of them, and the lowest ``BITS`` bits of every minimum, packed into 64-bit words. Documents with equal sets (exact
   copies above all) form a class at once; only the smallest id of a class goes on.
2. Candidates: in each band bucket, every document meets one document of that bucket (the one that shares its buckets with most
   others), never all of them: first in ``FIRST_BANDS`` bands, then in the others where it is not yet in the same component. The packed bits estimate the similarity: equal b-bit values, counted with a bit count and
   corrected for chance collisions. Pairs far below the threshold (``SLACK``, five standard errors) are dropped.
3. Confirmation on the full sets, after either round of meetings.
4. What the choice in step 2 can have missed: in buckets that still hold several components, documents outside
   the bucket's largest component are held against those of other components. Shingles that no other of these
   documents has bound the similarity a document can reach with any other; what the bound, the set sizes and the packed
   bits leave is confirmed as before. Only small buckets of small components (``FEW``) take this way, so a row meets few others.
   In the rest, a dense group, the documents do not meet in buckets but by what sets them apart from the centre of the largest
   component (``departures``): two documents can only be linked if they share enough of their departures, however many shingles of the
   centre both have.

A pair at the threshold shares no band with probability (1 - 0.8^4)^32, about 5e-8.

Nothing is collected and no group is expanded into its pairs. Texts are shuffled only to get the sets of documents that share
a bucket, and not even then while the list of their ids is short.

Defined cases: null and empty texts have an empty set, no links and are kept; rows with a null id are not linked, have a
null component and are kept; rows that repeat an id count as one document, whose sets are all considered; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm.components import components
from lexmill.llm.texts import SPACED, Words, as_lists, grams, mix, reach_package, slices

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Bands that are looked at before any component is known.
FIRST_BANDS = 3
BITS = 4
WORDS64 = HASHES * BITS // 64
SLACK = 0.19
#: Documents of a bucket and of its largest component up to which a bucket's documents are held against each other directly.
FEW = 16
#: Ids, 8 bytes each, up to which a list of documents is broadcast.
BROADCAST_IDS = 500_000
_SLICE = 1 << 20

_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_ODD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)


def shingle_sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of each row, sorted within it, and their number per row."""
    words = Words(column, SPACED)
    h = words.hashes()
    keys, at = grams(h, words.row, shingle)
    row = words.row[at]
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])
        extra = [int(grams(h[first[i] : first[i + 1]], np.zeros(counts[i], np.int64), int(counts[i]))[0][0]) for i in short]
        keys, row = np.concatenate([keys, np.array(extra, np.uint64)]), np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        keys, row = keys[order], row[order]
    sizes, borders = np.zeros(len(counts), np.int64), np.searchsorted(row, np.arange(len(counts) + 1))
    parts = []
    for i in range(len(counts)):
        own = np.unique(keys[borders[i] : borders[i + 1]])
        sizes[i] = len(own)
        parts.append(own)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), sizes


def minima(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``HASHES`` minima for each non-empty run of keys."""
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    x = (keys >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), HASHES), np.uint32)
    for j in range(HASHES):
        v = (x ^ _XOR[j]) * _ODD[j]
        v = (v ^ (v >> np.uint32(16))) * np.uint32(0x85EBCA6B)
        out[:, j] = np.minimum.reduceat(v, starts) if len(starts) else 0
    return out


def pack_bits(low: np.ndarray) -> np.ndarray:
    """The lowest bits of each minimum, ``64 // BITS`` to a word."""
    per = 64 // BITS
    low = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(low), WORDS64, per)
    return (low << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64).view(np.int64)


def digests(keys: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """A digest of each run of keys, none for empty ones."""
    return [hashlib.blake2b(keys[e - n : e].tobytes(), digest_size=16).digest() if n else None for n, e in zip(sizes, np.cumsum(sizes))]


def _sketcher(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                keys, sizes = shingle_sets(part.column("text"), shingle)
                low = minima(keys, sizes)
                full = sizes > 0
                bands = np.zeros((len(low), BANDS), np.uint64)
                for b in range(BANDS):
                    key = np.full(len(low), b + 1, np.uint64)
                    for j in range(ROWS):
                        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + low[:, b * ROWS + j])
                    bands[:, b] = key
                bits = pack_bits(low)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests(keys, sizes), pa.binary()),
                        as_lists(bands.view(np.int64).ravel(), np.where(full, BANDS, 0), pa.int64()),
                        as_lists(bits.ravel(), np.where(full, WORDS64, 0), pa.int64()),
                    ],
                    names=["doc_id", "n_shingles", "digest", "bands", "bits"],
                )

    return run


def _set_maker(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                keys, sizes = shingle_sets(part.column("text"), shingle)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(digests(keys, sizes), pa.binary()), as_lists(keys.view(np.int64), sizes, pa.int64())],
                    names=["node", "digest", "shingles"],
                )

    return run


def _confirmer(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            left, right = batch.column("sa"), batch.column("sb")
            for i in range(batch.num_rows):
                x, y = left[i].values.to_numpy(), right[i].values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def estimate(left: str, right: str) -> Column:
    """Similarity of two packed signatures, corrected for values that are equal by chance."""
    ones = F.lit(sum(1 << (BITS * i) for i in range(64 // BITS)))
    different = None
    for k in range(WORDS64):
        x = F.col(left)[k].bitwiseXOR(F.col(right)[k])
        any_bit = x
        for s in range(1, BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(x, s))
        n = F.bit_count(any_bit.bitwiseAND(ones))
        different = n if different is None else different + n
    chance = 2.0**-BITS
    return (1 - different / F.lit(float(HASHES)) - chance) / (1 - chance)


class _Links:
    """Candidates confirmed on full sets, and the components they make."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, percent: int):
        self.nodes, self.sets, self.percent = nodes, sets, percent
        self.edges: DataFrame | None = None
        self.seen: DataFrame | None = None

    def plausible(self, pairs: DataFrame) -> DataFrame:
        """Pairs ``a, b`` whose sizes and packed bits allow a link, with the estimate."""
        side = self.nodes.select("node", "n", "bits")
        a = side.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ba"))
        b = side.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bb"))
        return (
            pairs.join(a, "a").join(b, "b").where(self._sizes_fit("na", "nb"))
            .select("a", "b", estimate("ba", "bb").alias("est"))
            .where(F.col("est") >= self.percent / 100 - SLACK)
        )

    def meet(self, pairs: DataFrame) -> None:
        """Confirm the pairs ``a, b`` that the packed bits leave."""
        candidates = materialize(self.plausible(pairs).select("a", "b"), "candidates")
        self.seen = candidates if self.seen is None else self.seen.unionByName(candidates)
        self.confirm(candidates)

    def _sizes_fit(self, x: str, y: str) -> Column:
        return (F.col(x) * 100 >= F.col(y) * self.percent) & (F.col(y) * 100 >= F.col(x) * self.percent)

    def confirm(self, pairs: DataFrame) -> None:
        pairs = pairs.select("a", "b")
        both = pairs.join(self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
            self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"
        )
        self.add(both.select("a", "b", "sa", "sb").mapInArrow(_confirmer(self.percent), "a long, b long"))

    def add(self, linked: DataFrame) -> None:
        self.edges = materialize(linked if self.edges is None else linked.unionByName(self.edges), "links")

    def components(self) -> DataFrame:
        found = components(self.edges)
        return materialize(
            self.nodes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("comp")), "comps"
        )


def _sets_of(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """Written shingle sets of the documents in ``wanted``; a list of ids of a checked size is broadcast, so that texts stay where
    they are, and a longer one is joined by shuffle."""
    few = wanted.count() <= BROADCAST_IDS
    chosen = docs.join(F.broadcast(wanted) if few else wanted, "doc_id", "left_semi")
    made = chosen.mapInArrow(_set_maker(shingle), "node long, digest binary, shingles array<long>")
    return materialize(made.select("node", F.xxhash64("digest").alias("mark"), "shingles"), "sets")


def departures(group: DataFrame, sets: DataFrame) -> DataFrame:
    """``group`` (``hub, node, mark, ...``) with ``hub_n``, the size of the hub's set, and ``away``: the shingles that are in one of the
    two sets only. Of a hub with several sets one is taken for all its rows."""
    hub_sets = (
        sets.join(group.select(F.col("hub").alias("node")).distinct(), "node", "left_semi")
        .groupBy(F.col("node").alias("hub")).agg(F.min_by("shingles", "mark").alias("of_hub"))
    )
    own = sets.join(group.select("node", "mark").distinct(), ["node", "mark"], "left_semi").dropDuplicates(["node", "mark"])
    away = F.concat(F.array_except("shingles", "of_hub"), F.array_except("of_hub", "shingles"))
    return (
        group.join(own, ["node", "mark"]).join(hub_sets, "hub")
        .select(*group.columns, F.size("of_hub").cast("long").alias("hub_n"), away.alias("away"))
    )


def pairs_by_departures(departed: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components, not both inside, that can be linked, of rows
    ``hub, node, mark, comp, inside, n, away``; pairs that are both linked with the hub may be missing.

    Sets of ``na`` and ``nb`` shingles are linked if they differ in at most (na + nb) * (100 - percent) / (100 + percent) shingles. They differ in
    ``xa + xb - 2 * common`` ones, where xa, xb count their departures from the hub's set and ``common`` those they share, so a link needs
    2 * common >= xa + xb - that limit. If this asks for none, xa and xb are so small that both are linked with the hub. Else
    the shared departures, the rarest first, have a first common one, and from there on both documents must have as many
    left as the link needs. A linked document has at most n * (100 - percent) / percent shingles that the other lacks or lacks
    itself, so it needs x less that number of common departures with any other, and the last ones of its list cannot be the first common one.
    """
    single = departed.select("hub", "node", "mark", F.explode("away").alias("shingle"))
    times = single.groupBy("hub", "shingle").agg(F.count("*").alias("times")).where("times > 1")
    listed = (
        single.join(times, ["hub", "shingle"])
        .groupBy("hub", "node", "mark").agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("shared"))
    )
    least_common = F.greatest(F.lit(1), F.col("x") - F.floor(F.col("n") * (100 - percent) / percent))
    rows = materialize(
        departed.select("hub", "node", "mark", "comp", "inside", "n", F.size("away").cast("long").alias("x")).join(listed, ["hub", "node", "mark"])
        .withColumn("firsts", F.greatest(F.lit(0), F.size("shared") - least_common + 1).cast("int"))
        .select("hub", "node", "comp", "inside", "n", "x", F.size("shared").alias("y"), F.posexplode(F.slice("shared", 1, F.col("firsts"))).alias("at", "entry"))
        .select("hub", F.col("entry.shingle").alias("shingle"), "node", "comp", "inside", "n", "x", (F.col("y") - F.col("at")).cast("long").alias("left")),
        "departures",
    )
    a, b = (
        rows.select("hub", "shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "comp", "inside", "n", "x", "left")]) for side in ("a", "b")
    )
    both_n, both_x = F.col("n_a") + F.col("n_b"), F.col("x_a") + F.col("x_b")
    return (
        a.where("not inside_a").join(b, ["hub", "shingle"])
        .where((F.col("comp_a") != F.col("comp_b")) & (F.col("inside_b") | (F.col("node_a") < F.col("node_b"))))
        .where((F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent))
        .where(F.least("left_a", "left_b") * (2 * (100 + percent)) >= both_x * (100 + percent) - both_n * (100 - percent))
        .select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
        .distinct()
    )


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    reach_package(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = materialize(
        docs.mapInArrow(
            _sketcher(shingle), "doc_id long, n_shingles long, digest binary, bands array<long>, bits array<long>"
        ),
        "sketches",
    )
    usable = sketches.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = materialize(usable.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    members = usable.select("doc_id", "digest").join(classes, "digest").select("doc_id", "node")
    nodes = materialize(
        usable.join(classes.select("digest", F.col("node").alias("doc_id")), ["digest", "doc_id"], "left_semi")
        .dropDuplicates(["digest"])
        .select(F.col("doc_id").alias("node"), F.xxhash64("digest").alias("mark"), F.col("n_shingles").alias("n"), "bands", "bits"),
        "nodes",
    )
    placed = nodes.select("node", F.posexplode("bands").alias("band", "key")).select("node", "band", "key")
    sizes = placed.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(placed.join(sizes, ["band", "key"]), "shared-buckets")
    # The document that shares its buckets with most others comes first, in all its buckets: in a dense group that is what the
    # others are copies of, while two of them may be further apart than the threshold.
    crowd = shared.groupBy("node").agg(F.sum("size").alias("crowd"))
    central = F.max(F.struct("crowd", F.xxhash64("node").alias("o"), "node")).alias("pivot")
    ranked = materialize(shared.select("node", "band", "key").join(crowd, "node"), "ranked-buckets")
    buckets = ranked.groupBy("band", "key").agg(central).select("band", "key", F.col("pivot.node").alias("pivot"))
    crowded = materialize(ranked.join(buckets, ["band", "key"]), "crowded")
    sets = _sets_of(docs, materialize(crowded.select(F.col("node").alias("doc_id")).distinct(), "crowded-ids"), shingle)
    links = _Links(nodes.select("node", "n", "bits"), sets, percent)
    # A first few bands, then the others for documents that are still apart: the members of a dense group lie in buckets
    # of many different first documents, and one link to the group is enough.
    met = crowded.where((F.col("node") != F.col("pivot")) & (F.col("band") < FIRST_BANDS))
    links.meet(met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())
    apart = materialize(crowded.select("node", "band", "key", "crowd").join(links.components(), "node"), "apart")
    first = F.max(F.struct("crowd", F.xxhash64("node").alias("o"), "node", "comp")).alias("first")
    mixed = apart.groupBy("band", "key").agg(first, F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    pivots = mixed.select("band", "key", F.col("first.node").alias("pivot"), F.col("first.comp").alias("pivot_comp"))
    others = apart.join(pivots, ["band", "key"]).where("comp <> pivot_comp")
    links.meet(others.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())

    # Links that no meeting with a bucket's chosen document has shown.
    comps = links.components()
    rated = materialize(
        crowded.join(comps, "node").join(nodes.select("node", "mark", "n", "bits"), "node")
        .select("node", "mark", "band", "key", "crowd", "comp", "n", "bits"),
        "rated",
    )
    share = rated.groupBy("band", "key", "comp").agg(F.count("*").alias("n"))
    mixed = (
        share.groupBy("band", "key").agg(F.max_by("comp", "n").alias("main"), F.count("*").alias("comps"), F.sum("n").alias("size"))
        .where("comps > 1")
    )
    centre = F.max(F.struct("crowd", F.xxhash64("node").alias("o"), "node")).alias("centre")
    centres = rated.select("comp", "node", "crowd").distinct().groupBy(F.col("comp").alias("main")).agg(centre, F.count("*").alias("members"))
    dense = (F.greatest("size", "members") > FEW).alias("dense")
    mixed = mixed.join(centres, "main").select("band", "key", "main", F.col("centre.node").alias("hub"), dense)
    # Sizes that differ by less than a class step are in the same or in neighbouring classes.
    level = F.floor(F.log("n") / F.log(F.lit(100.0 / percent))).cast("int")
    open_ = materialize(rated.join(mixed, ["band", "key"]).withColumn("level", level), "open")
    # A shingle that no other of these documents has is in no intersection, which bounds what a document can reach.
    alone = (
        sets.join(open_.select("node", "mark").distinct(), ["node", "mark"], "left_semi").select("node", "mark", F.explode("shingles").alias("shingle"))
        .groupBy("shingle").agg(F.count("*").alias("times"), F.min("node").alias("node"), F.min("mark").alias("mark")).where("times = 1")
        .groupBy("node", "mark").agg(F.count("*").alias("alone"))
    )
    bounded = materialize(
        open_.join(alone, ["node", "mark"], "left").withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0)))
        .where(F.col("most") * 100 >= F.col("n") * percent),
        "bounded",
    )
    group = bounded.where("dense").select("hub", "node", "mark", "comp", (F.col("comp") == F.col("main")).alias("inside"), "n").distinct()
    group = materialize(group.join(group.where("not inside").select("hub").distinct(), "hub", "left_semi"), "dense")
    departed = materialize(departures(group, sets), "departed")
    limit = (F.col("n") + F.col("hub_n")) * (100 - percent)
    with_hub = departed.where(~F.col("inside") & (F.size("away") * (100 + percent) <= limit))
    links.add(with_hub.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")))
    few = bounded.where("not dense")
    outside = few.where("comp <> main").select(
        "band", "key", F.col("node").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"), F.col("most").alias("ma"), F.col("bits").alias("ba"),
        F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)).alias("level"),
    )
    others = few.select(
        "band", "key", "level", F.col("node").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"), F.col("most").alias("mb"), F.col("bits").alias("bb"),
        (F.col("comp") != F.col("main")).alias("out_b"),
    )
    shared = F.least("ma", "mb")
    rest = (
        outside.join(others, ["band", "key", "level"])
        .where((F.col("ca") != F.col("cb")) & (~F.col("out_b") | (F.col("a") < F.col("b"))))
        .where(shared * 100 >= (F.col("na") + F.col("nb") - shared) * percent)
        .where(estimate("ba", "bb") >= percent / 100 - SLACK)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    rest = rest.unionByName(pairs_by_departures(departed, percent)).distinct()
    links.confirm(materialize(rest.join(links.seen, ["a", "b"], "left_anti"), "candidates"))

    # Rows of one id may belong to several classes: the id ties these together.
    same = members.join(links.components(), "node").select("doc_id", F.col("comp").alias("node"))
    ties = same.select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    final = components(ties)
    return sketches.join(final.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )


def near_duplicate_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op9: shingles of four words."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=4, percent=80)

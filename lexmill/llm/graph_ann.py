"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

The measure is the largest inner product. With one more component, ``sqrt(M^2 - |x|^2)`` (M: the largest norm of the shard), inner products
with a query become Euclidean distances, for which the graphs are built. That component must not drown the others, so a shard
holds vectors of nearly equal norm: norms are cut into bands a factor of ``BAND`` wide, and a band into as many shards as its
rows need. Equal vectors are one node; its copies (ids) come
back at the end, so copies neither crowd out other neighbours nor break the pruning.

Building a shard (at most about ``SHARD_NODES`` nodes, dealt by hash inside a band): nodes are inserted in batches that double in size. For each, a
greedy search on the graph so far proposes neighbours: all nodes it has visited. Robust pruning takes the nearest proposal
again and again and drops those that the chosen one is nearer to by the factor ``ALPHA``, up to ``DEGREE`` edges. Reverse edges are
added, and pruned alike when a node has half as many again. A second round over all nodes repairs what the first batches lacked.

Searching: the queries are dealt in blocks; a task has one shard and one block, walks the graph for all its queries at
once with a beam of ``SEARCH_BEAM`` nodes and returns the best of the beam with inner products in double precision on the
original vectors. The best over all shards are the answer. Every row is indexed; queries are the stated set only.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part, as rows or as queries, and
neither do rows without an id or of another length than most vectors; rows that repeat an id with the same vector count once; with
fewer candidates than ``k`` all of them are returned; ties go to the smaller id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize
from lexmill.llm.texts import reach_package

SHARD_NODES = 4096
QUERY_BLOCK = 4096
DEGREE = 24
#: Nodes kept while proposals are searched, and while queries are answered.
BEAM, SEARCH_BEAM = 64, 128
ALPHA = 1.2
#: Norms of a band differ by this factor at most; those below the last of ``BANDS`` bands (a thousandth of the largest) are in it.
BAND, BANDS = 1.05, 142
#: Queries that walk a shard together.
_LANE = 256


def _distances(points: np.ndarray, norms: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distance of each query to the listed nodes, up to the query's own norm."""
    return norms[ids] - 2 * np.einsum("bnd,bd->bn", points[ids], q, optimize=True)


def walk(points: np.ndarray, norms: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, beam: int, trail: bool = False):
    """Greedy beam search for all queries at once: beam ids and distances, and with ``trail`` the visited nodes.

    ``graph`` holds -1 where a node has fewer edges."""
    n, lanes = len(points), len(q)
    seen = np.zeros((lanes, n + 1), bool)
    seen[:, n] = True
    row = np.arange(lanes)
    ids = np.full((lanes, beam), n, np.int64)
    dist = np.full((lanes, beam), np.inf, np.float32)
    done = np.ones((lanes, beam), bool)
    ids[:, 0], done[:, 0] = entry, False
    dist[:, 0] = _distances(points, norms, np.full((lanes, 1), entry), q)[:, 0]
    seen[:, entry] = True
    visited: list[tuple[np.ndarray, np.ndarray]] = []
    live = row
    while len(live):
        open_ = np.where(done[live], np.inf, dist[live])
        at = open_.argmin(axis=1)
        more = np.isfinite(open_[np.arange(len(live)), at])
        live, at = live[more], at[more]
        if not len(live):
            break
        node = ids[live, at]
        done[live, at] = True
        if trail:
            visited.append((live, node))
        near = graph[node]
        near = np.where(near < 0, n, near)
        new = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        near = np.where(new, near, 0)
        d = _distances(points, norms, near, q[live]).astype(np.float32)
        d[~new] = np.inf
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_dist = np.concatenate([dist[live], d], axis=1)
        all_done = np.concatenate([done[live], ~new], axis=1)
        best = np.argpartition(all_dist, beam - 1, axis=1)[:, :beam]
        ids[live] = np.take_along_axis(all_ids, best, 1)
        dist[live] = np.take_along_axis(all_dist, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1)
    return (ids, dist, visited) if trail else (ids, dist)


def robust_prune(points: np.ndarray, node: int, proposals: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse out-edges of a node from its proposals (distinct, without the node)."""
    d = ((points[proposals] - points[node]) ** 2).sum(axis=1)
    order = np.argsort(d, kind="stable")
    proposals, d = proposals[order], d[order]
    x = points[proposals]
    sq = (x**2).sum(axis=1)
    between = sq[:, None] + sq[None, :] - 2 * (x @ x.T)
    left = np.ones(len(proposals), bool)
    kept = []
    for i in range(len(proposals)):
        if left[i]:
            kept.append(i)
            if len(kept) == degree:
                break
            left &= alpha * alpha * between[i] > d
    return proposals[kept]


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Adjacency (-1 where a node has fewer edges) and entry node."""
    n = len(points)
    points = points.astype(np.float32)
    norms = (points**2).sum(axis=1)
    width = degree + degree // 2
    graph = np.full((n, width), -1, np.int64)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(5).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    for turn in (0, 1):
        low = 1 if turn == 0 else 0
        while low < n:
            # A first batch of more nodes than the graph has would find nothing to link to.
            high = min(n, low + (min(low, _LANE * 2) if turn == 0 else _LANE * 2))
            batch = order[low:high]
            ids, _, visited = walk(points, norms, graph, entry, points[batch], beam, trail=True)
            lanes = np.concatenate([v[0] for v in visited])
            nodes = np.concatenate([v[1] for v in visited])
            by = np.argsort(lanes, kind="stable")
            lanes, nodes = lanes[by], nodes[by]
            borders = np.searchsorted(lanes, np.arange(len(batch) + 1))
            back: dict[int, list[int]] = {}
            for i, node in enumerate(batch.tolist()):
                proposals = np.unique(np.concatenate([nodes[borders[i] : borders[i + 1]], ids[i], graph[node]]))
                proposals = proposals[(proposals >= 0) & (proposals < n) & (proposals != node)]
                chosen = robust_prune(points, node, proposals, degree, alpha)
                graph[node] = -1
                graph[node, : len(chosen)] = chosen
                for c in chosen.tolist():
                    back.setdefault(c, []).append(node)
            for node, extra in back.items():
                own = graph[node][graph[node] >= 0]
                extra = np.setdiff1d(np.array(extra), own)
                if len(own) + len(extra) <= width:
                    graph[node, len(own) : len(own) + len(extra)] = extra
                else:
                    chosen = robust_prune(points, node, np.concatenate([own, extra]), degree, alpha)
                    graph[node] = -1
                    graph[node, : len(chosen)] = chosen
            low = high
    return graph, entry


def lifted(x: np.ndarray) -> np.ndarray:
    """Vectors with the component that gives all of them the largest norm among them."""
    squares = (x**2).sum(axis=1)
    return np.concatenate([x, np.sqrt(squares.max() - squares)[:, None]], axis=1)


def _builder(degree: int, beam: int, alpha: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", kind="stable")
        graph, entry = build(lifted(np.stack(pdf["vector"].to_numpy())), degree, beam, alpha)
        return pd.DataFrame(
            {
                "shard": pdf["shard"],
                "node": pdf["node"],
                "vector": pdf["vector"],
                "edges": list(graph.astype(np.int32)),
                "place": np.arange(len(pdf), dtype=np.int32),
                "entry": np.arange(len(pdf)) == entry,
            }
        )

    return run


def build_index(vectors: DataFrame, shard_nodes: int = SHARD_NODES, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[DataFrame, int]:
    """Written index of distinct ``node, vector``, and the number of shards."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    largest = vectors.agg(F.max(norm)).first()[0] or 1.0
    # The largest norm and what rounding takes from it are in band 0.
    band = F.greatest(F.ceil(F.log(norm / F.lit(largest)) / F.log(F.lit(BAND))), F.lit(1 - BANDS)).cast("int")
    banded = vectors.withColumn("band", band)
    first, shards = {}, 0
    for r in banded.groupBy("band").agg(F.count("*").alias("n")).orderBy("band").collect():  # at most BANDS rows
        many = -(-r["n"] // shard_nodes)
        first[r["band"]] = (shards, many)
        shards += many
    pick = lambda i: F.element_at(F.create_map(*[F.lit(v) for b, own in (first or {0: (0, 1)}).items() for v in (b, own[i])]), F.col("band"))
    dealt = banded.select("node", "vector", (pick(0) + F.pmod(F.xxhash64("node"), pick(1))).cast("int").alias("shard"))
    built = dealt.groupBy("shard").applyInPandas(
        _builder(degree, beam, alpha),
        "shard int, node long, vector array<double>, edges array<int>, place int, entry boolean",
    )
    return materialize(built, "ann-index"), max(1, shards)


def _searcher(k: int, beam: int):
    def run(key, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if index.empty or queries.empty:
            return pd.DataFrame({"query": pd.Series(dtype="int64"), "node": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        index = index.sort_values("place")
        exact = np.stack(index["vector"].to_numpy())
        points = lifted(exact).astype(np.float32)
        norms = (points**2).sum(axis=1)
        graph = np.stack(index["edges"].to_numpy()).astype(np.int64)
        entry = int(np.flatnonzero(index["entry"].to_numpy())[0])
        names = index["node"].to_numpy()
        q = np.stack(queries["vector"].to_numpy())
        who = queries["query"].to_numpy()
        out = []
        for low in range(0, len(q), _LANE):
            part = q[low : low + _LANE]
            flat = np.concatenate([part, np.zeros((len(part), 1))], axis=1).astype(np.float32)
            ids, dist = walk(points, norms, graph, entry, flat, beam)
            row, col = np.nonzero(np.isfinite(dist))
            found = ids[row, col]
            score = np.einsum("nd,nd->n", exact[found], part[row])
            best = np.lexsort((names[found], -score, row))
            row, found, score = row[best], found[best], score[best]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            keep = rank < k
            out.append(pd.DataFrame({"query": who[low + row[keep]], "node": names[found[keep]], "score": score[keep]}))
        return pd.concat(out, ignore_index=True)

    return run


def usable(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Distinct ``vec_id, vector`` that take part."""
    cast = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    fine = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    good = cast.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine)
    widths = good.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    width = widths[0]["w"] if widths else 0
    # -0.0 and 0.0 are the same component.
    return good.where(F.size("vector") == width).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))


def search(
    rows: DataFrame,
    every: int,
    k: int,
    beam: int = BEAM,
    search_beam: int = SEARCH_BEAM,
    shard_nodes: int = SHARD_NODES,
    degree: int = DEGREE,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``, against all other rows."""
    reach_package(rows.sparkSession)
    rows = materialize(usable(rows).withColumn("hash", F.xxhash64("vector")), "ann-rows")
    # Distinct vectors: the smallest id stands for all copies.
    nodes = materialize(rows.groupBy("hash", "vector").agg(F.min("vec_id").alias("node")), "ann-nodes")
    index, shards = build_index(nodes.select("node", "vector"), shard_nodes, degree, beam)
    # A vector is searched once for all its queries; one more neighbour makes up for the query's own vector.
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).select("hash", "vector").distinct().join(nodes, ["hash", "vector"])
    asked = materialize(asked.select(F.col("node").alias("query"), "vector"), "ann-queries")
    blocks = max(1, -(-asked.count() // query_block))
    shard_list = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    block_list = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    sent = asked.select("query", "vector", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"), shard_list)
    there = index.select("*", block_list)
    found = materialize(
        there.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block")).applyInPandas(
            _searcher(k + 1, max(search_beam, k + 1)), "query long, node long, score double"
        ),
        "ann-found",
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    top = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).select("query", "node", "score")
    # Copies: the k + 1 smallest ids of a vector are all that any answer can hold.
    groups = rows.join(nodes, ["hash", "vector"]).select("vec_id", "node").distinct()
    copies = smallest(groups, k + 1)
    queries = groups.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
    answers = top.join(copies, "node").select("query", "score", F.explode("ids").alias("vec_id"))
    near = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = (
        answers.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k + 1)
        .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("list"))
    )
    own = F.filter("list", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        queries.join(lists, "query").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("pos", "hit"))
        .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
    )


def smallest(groups: DataFrame, k: int) -> DataFrame:
    """``node, ids``: the ``k`` smallest ids of each node; salted, so that no task gets a large group whole."""
    salted = groups.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(32)))
    first = salted.withColumn("r", F.row_number().over(Window.partitionBy("node", "salt").orderBy("vec_id"))).where(F.col("r") <= k)
    second = first.withColumn("r", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))).where(F.col("r") <= k)
    return second.groupBy("node").agg(F.collect_list("vec_id").alias("ids"))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op3: the 20 nearest of every 20th row."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=20, k=20)

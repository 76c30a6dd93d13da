"""Connected components of an edge list by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.scratch import materialize


def _follow(parents: DataFrame) -> DataFrame:
    """Replace parents by their parents until nothing changes: ``node, parent`` with roots as parents."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        moved = materialize(
            parents.join(up, "parent", "left").select("node", F.coalesce("top", "parent").alias("parent"), (F.col("top") < F.col("parent")).alias("moved")),
            "cc-parents",
        )
        parents = moved.select("node", "parent")
        if not moved.where("moved").limit(1).count():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; the component is its smallest node.

    Each round joins every node to its smallest neighbour, follows these links to their roots and keeps one edge
    per pair of roots, so stars and dense groups collapse at once and the number of nodes at least halves. Every round is
    a written table; per-node minima combine before they are shuffled.
    """
    edges = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    known: DataFrame | None = None
    while edges.limit(1).count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        parents = _follow(materialize(least.select("node", F.least("node", "parent").alias("parent")), "cc-least"))
        if known is None:
            known = parents
        else:
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
            known = materialize(known.join(up, "parent", "left").select("node", F.coalesce("top", "parent").alias("parent")), "cc-known")
        a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = materialize(
            edges.join(a, "a").join(b, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            "cc-edges",
        )
    if known is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return known.select("node", F.col("parent").alias("component"))

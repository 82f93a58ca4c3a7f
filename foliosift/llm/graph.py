"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliosift.session import materialise


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link every ``b`` beside a node ``a`` to the smallest node around ``a``, and ``a``
    itself too. The minimum is combined before the shuffle and stored, so the look-up is a
    plain join of two tables, which Spark can split at a node with very many edges."""
    least = materialise(
        edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star"
    )
    met = edges.join(least, "a")
    if larger_only:
        moved = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.withColumnRenamed("m", "b"))
    return materialise(moved.where("a <> b").distinct(), "edges")


def _settled(edges: DataFrame) -> bool:
    """Every node but the roots has one edge, to a root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    loose = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR out > 0 AND into > 0")
    return loose.isEmpty()


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node of the component.

    Each round's edges are written to the shared folder. The number of rounds grows with the
    logarithm of the longest path.
    """
    now = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    for _ in range(limit):
        if _settled(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        # The larger neighbours of a node go to its smallest neighbour; then a node and its
        # smaller neighbours go to the smallest of them.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = _star(_star(both, larger_only=True), larger_only=False)
    raise RuntimeError(f"components did not settle in {limit} rounds")

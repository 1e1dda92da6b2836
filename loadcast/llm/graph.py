"""Connected components of an undirected graph given as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.session import materialize


def _minimum(edges: DataFrame) -> DataFrame:
    """Edges with the smallest neighbour of their first end, that end included."""
    low = edges.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("low"))
    return edges.join(low, F.col("a") == F.col("c")).select("a", "b", F.least("low", "a").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _minimum(both).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    to_low = _minimum(down)
    moved = to_low.select(F.col("b").alias("a"), F.col("low").alias("b")).union(to_low.select("a", F.col("low").alias("b")))
    return moved.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge to another; component is the smallest node reachable.

    Large and small stars in turn until nothing moves: about the logarithm of the longest path in rounds. Every round is
    written to the shared folder, which cuts the lineage and survives lost executors. Loops and null ends are ignored.
    """
    edges = edges.select("a", "b").where("a <> b").distinct()
    edges = materialize(edges, "edges")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if now == before or now["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
        edges = materialize(_small_star(_large_star(edges)), "edges")

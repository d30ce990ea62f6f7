"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations and two joins over the edge table; a node with
very many neighbours is pre-aggregated map-side and its join rows can be split
by AQE, so no task ever holds one node's whole neighbourhood.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``edges(a, b)`` of bigint ids to ``(node, component)``; component is the smallest id reachable.

    Nodes without an edge do not appear.  Self-loops, repeated edges, either
    direction and null ends (ignored) are allowed; no edges give no rows.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = stored(e, label)
    before = _signature(e)
    while before[0]:
        e = stored(_small_star(_large_star(e)), label)
        after = _signature(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)

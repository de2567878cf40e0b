"""Connected components by alternating star contraction.

Edges (a, b) of long node ids; every node gets the smallest id it can reach.
Each round hooks the neighbours of a node to the smallest of them, first the
larger neighbours, then the smaller ones, until the edges are stars. A round
is two joins of a stored edge table with its per-node minimum (map-side
combined, so a hub costs one row per task); only two counters reach the
driver. Rounds are written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: link each larger neighbour of u to m(u) = min(u, neighbours).
    Small star: link u and its smaller neighbours to m(u)."""
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "star_min")
        out = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = stored(down.groupBy("a").agg(F.min("b").alias("m")), "star_min")
        out = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))
        )
    return out.where("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge to another node."""
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges"
    )
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("digest"),
        ).first()
        if state == before or state["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        edges = stored(_star(stored(_star(edges, True), "edges"), False), "edges")

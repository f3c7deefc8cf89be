"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every neighbour of a node to the smallest one; ``large``: the larger neighbours, else the smaller ones and itself."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = around.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``(a, b)``; the root is the smallest node that can be reached.

    A node's minimum is combined before the shuffle and joined back, so a hub is never gathered in one
    task. Rounds go on until no link moves; their number grows with the logarithm of the longest path.
    Every round is stored, which cuts the lineage.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")

    def state(table: DataFrame) -> tuple:
        mark = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(table.agg(F.count(F.lit(1)), F.sum(mark)).first())

    seen = state(edges)
    while seen[0]:
        edges = stored(_star(stored(_star(edges, True), "links"), False), "links")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )

"""Connected components of an edge table, by alternating large and small stars.

Each step is a grouped minimum, which Spark combines before its shuffle, and a join
whose skewed keys it may split, so a node with a third of all edges is spread out.
Every step's edges are written to the shared folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.llm.tables import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b), both directions stored once each as a > b."""
    if large:  # all neighbours of a node; its larger ones move to the least
        sides = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # a node's smaller neighbours and itself move to the least
        sides = edges
    least = sides.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    joined = sides.join(least, "a")
    if large:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Rows (node, label) of every node that has an edge (a, b) of integers to another.

    The label is the least node reachable. Null ends and loops are no edges.
    """
    now = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        purpose,
    )
    seen = None
    while True:
        # A star's edges are a node's only ones, so an unchanged set of them is the end.
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        seen = mark
        now = stored(_star(_star(now, True), False), purpose)

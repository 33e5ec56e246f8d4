"""Connected components by alternating stars, as joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.shared import parked, unparked


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node itself, move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for each node of ``links`` (a, b) that is not its component's least node."""
    edges = parked(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = None
    while True:
        last, edges = edges, parked(_small_star(_large_star(edges).filter("a <> b").distinct()), "links")
        unparked(last)
        found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = found

"""Connected components of links by alternating star contractions; nothing of the graph reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.shared import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours go to the smallest node of its neighbourhood."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them. Links lead from larger to smaller nodes."""
    least = links.groupBy("u").agg(F.min("v").alias("_m"))
    moved = links.join(least, "u").where(F.col("v") != F.col("_m")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.union(least.select("u", F.col("_m").alias("v"))).distinct()


def component_roots(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root) of every node in ``links`` (a, b) but the roots themselves; the root is a component's least node.

    Each round is written to the shared folder, so a lost executor costs at most one round. Rounds grow with the
    logarithm of the components' size.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    state = None
    while True:
        edges = written(_small_star(_large_star(edges)), name)
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if state == tuple(now):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(now)

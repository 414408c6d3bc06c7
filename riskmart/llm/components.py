"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, and its result is written to the shared folder. A round
joins nodes to ever smaller labels until each component is a star; the number of rounds grows with
the logarithm of the longest path. Nothing but the count of changed edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link every (larger, or smaller) neighbour of a node, and the node, to its smallest neighbour."""
    near = edges.select("u", "v")
    if large:
        near = near.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    linked = near.join(low, "u")
    if large:
        return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    lower = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.union(low.filter("u <> m").select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(u, v) links of any direction -> (node, root) for every linked node but the roots; root is the least."""
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, name)
    before = None
    while True:
        large = written(_star(edges, True), name)
        edges = written(_star(large, False), name)
        # A star forest is unchanged by both steps: equal counts and equal hash sums mean it has been reached.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now

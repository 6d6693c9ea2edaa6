"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (combined map-side, so a hub moves one row
per task) and one join on the grouping node (which adaptive execution may
split when a hub holds a large share of the edges). Edges are written to the
shared folder after every round; the loop ends when only stars are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.tables import stage


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Connect neighbours of every node to the smallest node around it."""
    e = edges.select("a", "b")
    if both_ways:
        e = e.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = e.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    if both_ways:  # larger neighbours go to the minimum
        near = e.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # the node and its smaller neighbours go to the minimum
        near = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return near.where("a <> b")


def _settled(edges: DataFrame) -> bool:
    """Whether every node points to one root and no root points further."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("out"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("out"), F.lit(1).alias("root")))
    roles = ends.groupBy("v").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    return roles.where("out > 1 OR (out > 0 AND root > 0)").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest
    node that can be reached. Edges to itself and null ends count as none;
    nodes without another edge are absent. No edges give no rows."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = stage(e, name)
    while not _settled(e):
        e = stage(_star(_star(e, True), False).distinct(), name)
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so a node with millions of neighbours costs a partial aggregate per task and
is never gathered. Edges stay linear in number and shrink to one row per node that is not a root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areapanel.session import drop_scratch, write_scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's neighbours on the smallest of them: the larger neighbours (large star) or the smaller (small)."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    moved = around.join(low, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            low.select("u", F.col("low").alias("v")))
    return out.where("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (u, v long, no nulls) that is not the smallest of its component.

    Loops, repeated and reversed edges are allowed; an empty table gives an empty result.
    """
    now = write_scratch(edges.select("u", "v").where("u != v").distinct(), "edges")
    seen = None
    while True:
        after = write_scratch(_star(_star(now, large=True), large=False), "edges")
        state = after.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(20,0)"))).first()
        drop_scratch(now)
        now = after
        if tuple(state) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)

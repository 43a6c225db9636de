"""Connected components of a distributed edge table.

Alternating large-star and small-star steps (Kiveris et al.): every step is an aggregate and a join, so
no node's neighbours are ever gathered, and the number of steps grows with the logarithm of the longest
path. Each step is staged as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.scratch import Scratch


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Re-hang neighbours on the smallest one. edges: (u, v), u > v."""
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    hung = around.join(least, "u")
    if larger:
        moved = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u > v").distinct()


def components(edges: DataFrame, scratch: Scratch, label: str = "components") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node reachable.

    edges: two columns (u, v) in either direction; loops and repeats are ignored.
    """
    u, v = edges.columns
    now = scratch.stage(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct(), f"{label}-0"
    )
    turn = 0
    while True:
        turn += 1
        wide = scratch.stage(_star(now, True), f"{label}-{turn}-wide")
        tight = scratch.stage(_star(wide, False), f"{label}-{turn}")
        # settled when every edge leads from a leaf straight to a root: no target has an edge of its own
        open_ends = tight.join(tight.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty()
        single = tight.groupBy("u").count().where("count > 1").isEmpty() if open_ends else False
        scratch.drop(f"{label}-{turn - 1}", f"{label}-{turn}-wide")
        if open_ends and single:
            break
        now = tight
    roots = tight.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return tight.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

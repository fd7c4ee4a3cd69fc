"""Connected components by alternating large-star and small-star steps over tables of edges.

Each step joins every node with the least of its neighbours, one row an edge; nothing is gathered at a node. A hub's
rows are those of an equi-join, which adaptive execution splits. Steps are written to the shared folder, which cuts
the lineage; the steps needed grow with the logarithm of the longest path. Edges replaced by a step are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.operators.lineage import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """For each node u: its larger neighbours point to the least of u and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """For each node u: u and its smaller neighbours point to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the least node it is connected to. Ids are of any one type with an order."""
    scratch = Scratch(edges.sparkSession, "components")
    kind = edges.select("a", "b").filter("a <> b").distinct()
    now, before = scratch.cut(kind), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before is not None and mark == before:
            break
        before = mark
        step = scratch.cut(_small_star(_large_star(now).distinct()).distinct())
        scratch.release(now)
        now = step
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())

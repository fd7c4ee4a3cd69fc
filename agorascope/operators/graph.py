"""Degrees, modularity, subgraphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.functions.scores import marker_size
from agorascope.operators.edges import directed, undirected
from agorascope.operators.rows import top_k
from agorascope.operators.skew import join_ends


def vertices(edges: DataFrame) -> DataFrame:
    """The distinct ends of the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


def _ends(edges: DataFrame) -> DataFrame:
    """Two rows per edge, one for each end."""
    zero = F.lit(0).cast("long")
    out = F.struct(F.col("src").alias("node"), zero.alias("in_w"), F.col("weight").alias("out_w"))
    into = F.struct(F.col("dst").alias("node"), F.col("weight").alias("in_w"), zero.alias("out_w"))
    return edges.select(F.inline(F.array(out, into)))


def weighted_degrees(edges: DataFrame) -> DataFrame:
    """Weighted in, out and total degree of every node."""
    return (
        _ends(directed(edges))
        .groupBy("node")
        .agg(F.sum("in_w").alias("in_degree_w"), F.sum("out_w").alias("out_degree_w"))
        .withColumn("degree_w", F.col("in_degree_w") + F.col("out_degree_w"))
    )


def undirected_degrees(pairs: DataFrame) -> DataFrame:
    """Weighted degree in an undirected graph; a self loop counts twice."""
    return (
        _ends(pairs)
        .groupBy("node")
        .agg(F.sum(F.col("in_w") + F.col("out_w")).alias("degree_w"))
    )


def label_ends(pairs: DataFrame, labels: DataFrame, how: str = "left") -> DataFrame:
    """Adds `src_comm` and `dst_comm` from (node, community)."""
    return join_ends(pairs, labels, "community", "comm", how)


def modularity(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row (communities, modularity) for a partition (node, community) of undirected edges."""
    marked = label_ends(pairs, labels, "inner")
    inner = F.when(F.col("src_comm") == F.col("dst_comm"), F.col("weight")).otherwise(0)
    ends = F.array(
        F.struct(F.col("src_comm").alias("community"), inner.alias("inside"), F.col("weight")),
        F.struct(
            F.col("dst_comm").alias("community"), F.lit(0).cast("long").alias("inside"), F.col("weight")
        ),
    )
    by_community = (
        marked.select(F.inline(ends))
        .groupBy("community")
        .agg(F.sum("inside").alias("inside"), F.sum("weight").alias("degree"))
    )
    degree = F.col("degree").cast("double")
    two_m = F.sum("degree").cast("double")
    return by_community.agg(
        F.count("*").alias("communities"),
        (
            2 * F.sum("inside") / two_m - F.sum(degree * degree) / (two_m * two_m)
        ).alias("modularity"),
    )


def community_sizes(labels: DataFrame) -> DataFrame:
    """Members per community."""
    return labels.groupBy("community").agg(F.count("*").alias("size"))


def top_degree_subgraph(
    edges: DataFrame, communities: DataFrame, n: int = 300
) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) among the `n` nodes of largest degree.

    Degrees in the result count edges inside the subgraph only; nodes of unknown community get -1.
    """
    pairs = undirected(edges)
    seeds = top_k(undirected_degrees(pairs), "degree_w", "node", n).select("node")  # at most n rows
    inside = pairs
    for end in ("src", "dst"):
        inside = inside.join(F.broadcast(seeds.withColumnRenamed("node", end)), end, "left_semi")
    known = communities.select("node", "community").join(F.broadcast(seeds), "node", "left_semi")
    marked = (
        seeds.join(known, "node", "left")
        .join(undirected_degrees(inside), "node", "left")
        .select(
            "node",
            F.coalesce("community", F.lit(-1)).alias("community"),
            F.coalesce("degree_w", F.lit(0)).alias("degree_w"),
        )
    )
    nodes = marked.withColumn("marker_size", marker_size(F.col("degree_w"))).orderBy(
        F.desc("degree_w"), F.asc("node")
    )
    links = inside
    for end in ("src", "dst"):
        side = marked.select(F.col("node").alias(end), F.col("community").alias(f"{end}_comm"))
        links = links.join(F.broadcast(side), end)
    return nodes, links.select("src", "dst", "weight", "src_comm", "dst_comm")

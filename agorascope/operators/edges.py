"""Interaction edges from messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.functions.scores import int_or
from agorascope.functions.text import account, mentions
from agorascope.operators.rows import first_per_key
from agorascope.operators.skew import lookup_join

EDGE_KEY = ["src", "dst", "edge_type"]


def _seen(run_time: datetime | None) -> Column:
    """Event time, or the run's time for a message without one."""
    now = F.current_timestamp() if run_time is None else F.lit(run_time)
    return F.coalesce(F.col("event_ts").cast("timestamp"), now.cast("timestamp"))


def replies_and_mentions_source(
    messages: DataFrame, comment_topic: str, run_time: datetime | None = None
) -> DataFrame:
    """Comments with a parent and a usable author."""
    return (
        messages.filter((F.col("topic") == comment_topic) & F.col("parent_id").isNotNull())
        .withColumn("src", account(F.col("author")))
        .filter(F.col("src").isNotNull())
        .withColumn("seen", _seen(run_time))
    )


def parent_authors(messages: DataFrame) -> DataFrame:
    """J1, right side: one author per fullname, that of its earliest message."""
    narrow = messages.filter(F.col("fullname").isNotNull()).select(
        F.col("fullname").alias("parent_id"), "author", "event_ts"
    )
    order = [F.asc_nulls_last("event_ts"), F.asc_nulls_last("author")]
    first = first_per_key(narrow, ["parent_id"], order)
    return first.select("parent_id", account(F.col("author")).alias("dst")).filter("dst IS NOT NULL")


def accumulate(rows: DataFrame, *keys: str) -> DataFrame:
    """Weight, first and last time per key, from rows that may already be partial sums."""
    return rows.groupBy(*keys).agg(
        F.sum("weight").alias("weight"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )


def _start(rows: DataFrame) -> DataFrame:
    seen = F.col("seen")
    return rows.withColumns(
        {"weight": F.lit(1).cast("long"), "first_seen": seen, "last_seen": seen}
    ).drop("seen")


def reply_edges(
    messages: DataFrame,
    comment_topic: str = "comments",
    run_time: datetime | None = None,
    parents: DataFrame | None = None,
) -> DataFrame:
    """Author of a comment to author of its parent.

    Comments are summed per (parent, author) before the join, so a parent that draws a large share
    of all comments enters it with one row per author.
    """
    source = replies_and_mentions_source(messages, comment_topic, run_time)
    summed = accumulate(_start(source.select("parent_id", "src", "seen")), "parent_id", "src")
    parents = messages if parents is None else parents
    joined = lookup_join(
        summed, parent_authors(parents), ["parent_id"],
        bound=parents.select("fullname", "author"), keys_from=source.select("parent_id"),
    )
    linked = joined.filter(F.col("src") != F.col("dst"))
    return accumulate(linked.withColumn("edge_type", F.lit("reply")), *EDGE_KEY)


def mention_edges(
    messages: DataFrame,
    comment_topic: str = "comments",
    run_time: datetime | None = None,
    text: str = "body",
) -> DataFrame:
    """Author of a comment to each account it mentions, read from the raw text."""
    source = replies_and_mentions_source(messages, comment_topic, run_time)
    named = source.select("src", "seen", F.explode_outer(mentions(F.col(text))).alias("name"))
    linked = named.select(
        "src", account(F.col("name")).alias("dst"), F.lit("mention").alias("edge_type"), "seen"
    ).filter(F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    return accumulate(_start(linked), *EDGE_KEY)


def interaction_edges(
    messages: DataFrame,
    comment_topic: str = "comments",
    run_time: datetime | None = None,
    text: str = "body",
    parents: DataFrame | None = None,
) -> DataFrame:
    """G1: reply and mention edges. `parents` are the messages replies may point to, by default `messages`."""
    replies = reply_edges(messages, comment_topic, run_time, parents)
    return replies.unionByName(mention_edges(messages, comment_topic, run_time, text))


def merge_edges(*edge_tables: DataFrame) -> DataFrame:
    """Edge tables of separate batches as one, as if built in one pass."""
    rows = edge_tables[0]
    for table in edge_tables[1:]:
        rows = rows.unionByName(table)
    return accumulate(rows, *EDGE_KEY)


def _usable(edges: DataFrame) -> DataFrame:
    for end in ("src", "dst"):
        edges = edges.filter(F.col(end).isNotNull() & (F.col(end) != ""))
    return edges.withColumn("weight", int_or(F.col("weight"), 1).cast("long"))


def directed(edges: DataFrame) -> DataFrame:
    """One row per (src, dst) with the weight summed over edge types."""
    return _usable(edges).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def undirected(edges: DataFrame) -> DataFrame:
    """One row per unordered pair, `src` the smaller name."""
    return (
        _usable(edges)
        .groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .agg(F.sum("weight").alias("weight"))
    )

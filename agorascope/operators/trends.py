"""Trends per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agorascope.operators.aggregates import window_volume
from agorascope.operators.rows import first_per_key, top_per_group


def top_in_windows(
    messages: DataFrame, by: str = "author", duration: str = "5 minutes", k: int = 10, time: str = "event_ts"
) -> DataFrame:
    """The `k` most active authors or channels of each window."""
    counts = window_volume(messages.filter(F.col(by).isNotNull()), duration, time, (by,))
    return top_per_group(counts, ["window_start", "window_end"], [F.desc("volume"), F.asc(by)], k)


def label_trend(labelled: DataFrame, duration: str = "1 day", time: str = "event_ts", label: str = "label") -> DataFrame:
    """D3: rows and share per window and label (a sentiment or a topic)."""
    counts = window_volume(labelled.filter(F.col(label).isNotNull()), duration, time, (label,))
    total = F.sum("volume").over(W.partitionBy("window_start"))  # one row per label
    return counts.withColumn("share", F.col("volume") / total)


def dominant_topic(weights: DataFrame, id_col: str) -> DataFrame:
    """D3: the heaviest topic of each document, ties to the smaller number."""
    best = weights.groupBy(id_col).agg(F.max(F.struct("weight", (-F.col("topic_id")).alias("minus"))).alias("b"))
    return best.select(id_col, (-F.col("b.minus")).alias("topic_id"))


def dominant_per_channel(labelled: DataFrame, channel: str = "subreddit", label: str = "topic_id") -> DataFrame:
    """D3: the most frequent topic of each channel."""
    counts = labelled.groupBy(channel, label).agg(F.count("*").alias("volume"))
    return first_per_key(counts, [channel], [F.desc("volume"), F.asc(label)])

"""Windowed and plain aggregates (A1-A5, A13-A15, A18). They read batch and streaming input alike."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.functions.scores import since


def window_stats(
    df: DataFrame,
    duration: str = "5 minutes",
    time: str = "event_ts",
    keys: Sequence[str] = ("topic", "subreddit"),
    score: str = "score",
) -> DataFrame:
    """Rows and mean score per event-time window and key; rows without a time are left out."""
    return (
        df.groupBy(F.window(time, duration), *keys)
        .agg(
            F.count("*").alias("volume"),
            F.avg(F.col(score).cast("double")).alias("avg_score"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "volume",
            "avg_score",
        )
    )


def window_volume(
    df: DataFrame,
    duration: str = "5 minutes",
    time: str = "kafka_ts",
    keys: Sequence[str] = ("topic",),
) -> DataFrame:
    """A2: rows per arrival-time window and key."""
    return (
        df.groupBy(F.window(time, duration), *keys)
        .agg(F.count("*").alias("volume"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "volume",
        )
    )


def top_channels(
    windows: DataFrame, as_of: Column, span: str = "INTERVAL 1 HOUR", k: int = 10,
    channel: str = "subreddit",
) -> DataFrame:
    """A3: channels with the largest volume in the windows of the last hour."""
    return (
        windows.filter(since(F.col("window_start"), as_of, span))
        .groupBy(channel)
        .agg(F.sum("volume").alias("volume"))
        .orderBy(F.desc("volume"), F.asc(channel))
        .limit(k)
    )


def value_counts(df: DataFrame, *keys: str, k: int | None = None) -> DataFrame:
    """Rows per value combination, most frequent first; `k` keeps the top ones."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("count"))
    counts = counts.orderBy(F.desc("count"), *[F.asc(x) for x in keys])
    return counts.limit(k) if k else counts


def label_distribution(df: DataFrame, label: str = "sentiment.label") -> DataFrame:
    """Rows per label, rows without one left out."""
    labelled = df.filter(F.col(label).isNotNull())
    return value_counts(labelled.select(F.col(label).alias("label")), "label")


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row (metric, value) per table."""
    rows = [
        df.agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "value")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)

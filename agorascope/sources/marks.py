"""Incremental reads against a high-watermark per kind and channel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.operators.skew import lookup_join
from agorascope.sources.files import read_batches, write_batch

KEY = ["kind", "channel"]


def new_items(items: DataFrame, marks: DataFrame) -> DataFrame:
    """Items strictly after the mark of their channel; no mark and no time both count as 0."""
    created = F.coalesce(F.col("created_utc").cast("long"), F.lit(0))
    last = marks.select(*KEY, F.col("last_created_utc").alias("_last"))
    joined = lookup_join(items, last, KEY, "left")
    return joined.filter(created > F.coalesce("_last", F.lit(0))).drop("_last")


def oldest_first(items: DataFrame) -> DataFrame:
    """K7: in event-time order, as they are published."""
    return items.orderBy(F.asc("created_utc"), F.asc("fullname"))


def next_marks(marks: DataFrame, fresh: DataFrame) -> DataFrame:
    """The largest time per channel; a channel without new items keeps its mark."""
    seen = fresh.select(*KEY, F.col("created_utc").cast("long").alias("last_created_utc"))
    return (
        marks.select(*KEY, F.col("last_created_utc").cast("long"))
        .unionByName(seen)
        .groupBy(*KEY)
        .agg(F.max("last_created_utc").alias("last_created_utc"))
    )


def save_marks(marks: DataFrame, batch_id: int, path: str) -> None:
    """Call after the data is written. Marks of a batch appear as a whole or not at all."""
    write_batch(marks, batch_id, path)


def load_marks(spark: SparkSession, path: str) -> DataFrame:
    """Marks only rise, so the largest of all batches is the current one."""
    rows = read_batches(spark, path)
    return rows.groupBy(*KEY).agg(F.max("last_created_utc").alias("last_created_utc"))

"""Listing envelopes landed as JSON, and the records in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope import schemas


def unnest(landed: DataFrame, value: str = "value") -> DataFrame:
    """S3: one row per child that carries data; an envelope without children gives none."""
    envelope = F.from_json(F.col(value), schemas.LISTING)
    child = F.explode(envelope["data"]["children"]).alias("child")
    return landed.select(child).filter("child.data IS NOT NULL").select("child.kind", "child.data.*")


def _normalised(items: DataFrame, kind: str, names: list[str], ingested_at: Column, source: str) -> DataFrame:
    constants = {
        "schema_version": F.lit(1),
        "source": F.lit(source),
        "event_type": F.lit(kind),
        "ingested_at": ingested_at,
        "fullname": F.col("name"),
    }
    return items.select(*[constants.get(name, F.col(name)).alias(name) for name in names])


def normalise_posts(items: DataFrame, ingested_at: Column, source: str) -> DataFrame:
    """The 18 columns of a post message."""
    return _normalised(items, "post", schemas.POST.names, ingested_at, source)


def normalise_comments(items: DataFrame, ingested_at: Column, source: str) -> DataFrame:
    """P5: the 15 columns of a comment message."""
    return _normalised(items, "comment", schemas.COMMENT.names, ingested_at, source)


def unite(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """By name, columns a side lacks are null."""
    return posts.unionByName(comments, allowMissingColumns=True)

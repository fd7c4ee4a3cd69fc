"""Scoring only what has no score yet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unscored(records: DataFrame, scored: DataFrame, key: str = "id") -> DataFrame:
    """Records whose key has no score. Records without a key stay."""
    return records.join(scored.select(key).distinct(), key, "left_anti")


def keep_first(scored: DataFrame, fresh: DataFrame, key: str = "id") -> DataFrame:
    """`scored` plus the rows of `fresh` it lacks; a score once written is not changed."""
    return scored.unionByName(unscored(fresh, scored, key), allowMissingColumns=True)

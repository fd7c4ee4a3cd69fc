"""Choosing rows: dedupe, top-k, samples, splits, row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from agorascope.operators.lineage import cut
from agorascope.operators.skew import lookup_join


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """K6: the first `k` rows of each group, with `rank` from 1.

    Spark limits each group before the shuffle, so a hot group sends at most `k` rows per task.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in `order`, whatever the partitioning."""
    return top_per_group(df, keys, order, 1).drop("rank")


def first_per_identity(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per identity, the first in `order`; every row without an identity stays."""
    known = F.col(key).isNotNull()
    return first_per_key(df.filter(known), [key], order).unionByName(df.filter(~known))


def latest(df: DataFrame, ts: str, tie: str, n: int = 20) -> DataFrame:
    """K1, K2: the `n` latest rows."""
    return df.orderBy(F.desc(ts), F.asc(tie)).limit(n)


def top_k(df: DataFrame, value: str, tie: str, k: int) -> DataFrame:
    """K3, K4: the `k` rows with the largest value, ties by `tie`."""
    return df.orderBy(F.desc(value), F.asc(tie)).limit(k)


def seeded_key(id_col: str, seed: int) -> Column:
    """A pseudo-random order that depends on the id and the seed alone."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def seeded_sample(df: DataFrame, id_col: str, n: int = 100, seed: int = 42) -> DataFrame:
    """K9: exactly min(n, rows) rows."""
    return df.orderBy(seeded_key(id_col, seed), F.asc(id_col)).limit(n)


def stratified_split(
    df: DataFrame, id_col: str, label_col: str, test_share: float = 0.25, seed: int = 42
) -> DataFrame:
    """Adds `is_test`, true for the first ceil(share x n) rows of each label in seeded order.

    No label is sorted as a whole: counts per hash bucket show in which bucket the cut falls, and
    only the rows of that bucket (one in 65,536) are ranked. `id_col` is unique. Rows without a label
    are split among themselves.
    """
    text = F.col(label_col).cast("string")
    stratum = F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text))
    keyed = df.withColumns({"_h": seeded_key(id_col, seed), "_l": stratum}).withColumn("_b", F.substring("_h", 1, 4))
    counts = keyed.groupBy("_l", "_b").agg(F.count("*").alias("_n"))
    by_label = W.partitionBy("_l")
    upto = by_label.orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    cuts = (
        counts.withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_take", F.ceil(F.lit(test_share) * F.sum("_n").over(by_label)))
        .filter((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_n") < F.col("_take")))
        .select(
            "_l",
            F.col("_b").alias("_cut"),
            (F.col("_take") - F.col("_upto") + F.col("_n")).alias("_need"),
        )
    )
    placed = lookup_join(keyed, cut(cuts, "cuts"), ["_l"])
    sure = placed.filter(F.col("_b") != F.col("_cut")).withColumn("is_test", F.col("_b") < F.col("_cut"))
    edge_order = W.partitionBy("_l").orderBy("_h", id_col)
    edge = (
        placed.filter(F.col("_b") == F.col("_cut"))
        .withColumn("_rn", F.row_number().over(edge_order))
        .withColumn("is_test", F.col("_rn") <= F.col("_need"))
        .drop("_rn")
    )
    return sure.unionByName(edge).select(*df.columns, "is_test")


def with_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Numbers rows from 0 in a total order, sorted by range over all tasks.

    Each task numbers its own rows; the offsets come from one count per task, so the table that
    is broadcast has as many rows as there are tasks.
    """
    part, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    ordered = cut(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "row-index")
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + row)
        .drop("_id", "_part", "_offset")
    )

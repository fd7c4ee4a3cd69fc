"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.operators.lineage import cut

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_KEYS = 1024
#: Rows of one key from which it is spread, and about as many as one of its parts has then.
HOT_ROWS = 1_000_000
#: Parts of the rows without a key, which meet nothing.
SALTS = 64


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether `df` was measured and found small enough to broadcast, by rows and by bytes."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if field.dataType.typeName() == "string":
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    rows, size = df.agg(F.count("*"), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def hot_keys(
    df: DataFrame, on: Sequence[str], min_rows: int | None = None, limit: int = HOT_KEYS
) -> DataFrame:
    """The most frequent keys, at most `limit` of them, and in how many parts (`_parts`) each is spread.

    A key outside this list owns less than 1/limit of the rows or fewer than `min_rows`. The list
    only decides which keys are spread; no row depends on it.
    """
    min_rows = HOT_ROWS if min_rows is None else min_rows
    counts = df.dropna(subset=list(on)).groupBy(*on).agg(F.count("*").alias("_rows"))
    return (
        counts.filter(F.col("_rows") >= min_rows)
        .orderBy(F.desc("_rows"), *on)
        .limit(limit)
        .select(*on, F.greatest(F.lit(2), F.ceil(F.col("_rows") / min_rows)).cast("int").alias("_parts"))
    )


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    min_rows: int | None = None,
) -> DataFrame:
    """Equi-join where rows of a hot key in `big` go to as many tasks as its rows ask for, its `small` rows to all of them.

    `how` is inner, left, left_semi or left_anti. Rows of `big` should be distinct (aggregate
    copies first), since the salt is a hash of the row and stays the same when a task is rerun.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    on = list(on)
    hot = F.broadcast(hot_keys(big, on, min_rows) if hot is None else hot)
    plain = [f.name for f in big.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    hashed = F.xxhash64(*plain)
    no_key = F.lit(False)
    for name in on:
        no_key = no_key | F.col(name).isNull()
    left = (
        big.join(hot, on, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_parts").isNotNull(), F.pmod(hashed, F.col("_parts")))
            .when(no_key, F.pmod(hashed, F.lit(SALTS))).otherwise(0).cast("int"),
        )
        .drop("_parts")
    )
    spread = F.sequence(F.lit(0), F.col("_parts") - 1)
    copies = F.when(F.col("_parts").isNotNull(), spread).otherwise(F.array(F.lit(0)))
    right = small.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_parts")
    return left.join(right, on + ["_salt"], how).drop("_salt")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    bound: DataFrame | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join `big` to a lookup table: broadcast when the table is counted small, else spread hot keys.

    `bound` is a table at least as large that is cheaper to measure, `keys_from` one with the key
    columns of `big` that is cheaper to read.
    """
    if fits_broadcast(small if bound is None else bound, max_rows):
        return big.join(F.broadcast(small), list(on), how)
    hot = None if keys_from is None else hot_keys(keys_from, on)
    return spread_join(big, small, on, how, hot)


def join_ends(
    pairs: DataFrame, labels: DataFrame, value: str, suffix: str, how: str = "inner"
) -> DataFrame:
    """Adds `src_<suffix>` and `dst_<suffix>` to edges, from a table (node, value) with one row per node."""
    small = fits_broadcast(labels.select("node", value))
    pairs = stored = pairs if small else cut(pairs, "pairs")
    for end in ("src", "dst"):
        side = labels.select(F.col("node").alias(end), F.col(value).alias(f"{end}_{suffix}"))
        if small:
            pairs = pairs.join(F.broadcast(side), end, how)
        else:
            pairs = spread_join(pairs, side, [end], how, hot=hot_keys(stored, [end]))
    return pairs

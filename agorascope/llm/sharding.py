"""Sharding by a two-pass external shuffle, in DataFrame operations only.

First pass: a record's seeded hash sends it to one of n buckets, n = all bytes / `BUCKET_BYTES`, so a bucket fits in a
task's memory. Second pass: one task a bucket sorts its records by hash, shuffles them (Spark's `shuffle` is a seeded
Fisher-Yates) and deals them out. A record's place among all is its place in its bucket after those of the buckets
before; shard i is the i-th stretch of places, so counts are at most one apart (the law `rows`) and slots have no gap.
Each bucket lies in one shard, or a few where it is larger than a shard, and can be written as it is.

The hash is of all columns, not of an id: equal texts, repeated ids and rows without an id are spread like any others.
Rows alike in every column are numbered first, so they too go to different buckets. The result is a function of rows,
seed and `BUCKET_BYTES` alone; partitions, reruns and lost executors do not change it. Columns of kinds that Spark does
not hash (maps, variants) move along; rows that differ in nothing else count as alike.

Null and empty texts have size 8. A text longer than a bucket makes its bucket as much larger. Columns are kept in a
struct, so their names clash with nothing. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.operators.lineage import Scratch
from agorascope.operators.skew import lookup_join

SHARDS = 24
#: Bytes of text in a bucket, about.
BUCKET_BYTES = 16 << 20
#: What a row counts besides its text.
ROW_BYTES = 8
#: Buckets whose counts one task adds up.
SPAN = 1024


def text_bytes(text: Column) -> Column:
    """The UTF-8 bytes of a text and `ROW_BYTES`; null has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def _hashed(docs: DataFrame) -> list[Column]:
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return [F.col(f"`{n}`") for n, kind in kinds.items() if "map<" not in kind and "variant" not in kind]


def _numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds `copy`, counted from 0 among rows alike. A group is numbered where its rows lie, after those of earlier parts."""
    same = ["h1", "h2"]
    if rows.groupBy(*same).count().filter("count > 1").isEmpty():
        return rows.withColumn("copy", F.lit(0).cast("long"))
    counts = rows.groupBy(*same, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*same).orderBy("part")) - F.col("n")
    here = F.row_number().over(Window.partitionBy(*same, "part").orderBy("part"))
    placed = rows.withColumn("here", here).join(counts.select(*same, "part", before.alias("before")), [*same, "part"])
    numbered = scratch.cut(placed.select("record", "size", *same, (F.col("before") + F.col("here") - 1).alias("copy")))
    scratch.release(rows)
    return numbered


def _offsets(counts: DataFrame) -> DataFrame:
    """(bucket, before): the rows in the buckets before each, by sums over spans of buckets."""
    counts = counts.withColumn("span", F.call_function("div", F.col("bucket"), F.lit(SPAN)))
    spans = counts.groupBy("span").agg(F.sum("n").alias("all"))
    spans = spans.select("span", (F.sum("all").over(Window.orderBy("span")) - F.col("all")).alias("skip"))
    inside = F.sum("n").over(Window.partitionBy("span").orderBy("bucket")) - F.col("n")
    return counts.withColumn("inside", inside).join(spans, "span").select("bucket", (F.col("skip") + F.col("inside")).alias("before"))


def sharded(
    docs: DataFrame, shards: int = SHARDS, seed: int = 0, text_column: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """(record, size, shard, slot) for each row of `docs`: `record` has its columns, `slot` counts from 0 in each shard."""
    scratch = Scratch(docs.sparkSession, "sharding")
    columns = _hashed(docs)
    text = F.col(f"`{text_column}`").cast("string")
    rows = scratch.cut(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), text_bytes(text).alias("size"),
            F.xxhash64(*columns).alias("h1"), F.xxhash64(F.lit(seed), *columns).alias("h2"), F.spark_partition_id().alias("part"),
        )
    )
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    key = F.xxhash64(F.lit(seed), "h2", "h1", "copy")
    numbered = _numbered(rows, scratch).select("record", "size", "h1", "h2", "copy", key.alias("key"))
    numbered = numbered.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))
    offsets = scratch.cut(_offsets(numbered.groupBy("bucket").agg(F.count("*").alias("n"))).coalesce(4))

    order = ("key", "h1", "h2", "copy")
    after = lambda a, b: F.coalesce(
        *[F.when(a[k] < b[k], -1).when(a[k] > b[k], 1) for k in order], F.lit(0)
    )
    rows_of = F.collect_list(F.struct(*order, "size", "record"))
    filled = numbered.repartitionById(buckets, "bucket").groupBy("bucket").agg(rows_of.alias("rows"))
    mixed = filled.select("bucket", F.shuffle(F.array_sort("rows", after), seed).alias("rows"))
    dealt = lookup_join(mixed, offsets, ["bucket"], bound=offsets).select("before", F.posexplode("rows").alias("at", "row"))
    least, more = divmod(count, shards)
    wide = F.lit(more * (least + 1)).cast("long")
    place = F.col("before") + F.col("at")
    div = lambda a, n: F.call_function("div", a, F.lit(n).cast("long"))
    narrow = place - wide
    shard = F.when(place < wide, div(place, least + 1)).otherwise(more + div(narrow, max(1, least)))
    slot = F.when(place < wide, place % (least + 1)).otherwise(narrow % max(1, least))
    return dealt.select("row.record", "row.size", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(placed: DataFrame, path: str) -> None:
    """Writes what `sharded` returns, a folder for each shard; `slot` is the order in it."""
    placed.write.partitionBy("shard").parquet(path)

"""File readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorascope import schemas
from agorascope.functions.text import strip
from agorascope.operators.rows import first_per_key
from agorascope.sources import utf16


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] = ("*",), where: Column | None = None
) -> DataFrame:
    """A stored table; the filter and the column list reach the Parquet scan."""
    table = spark.read.parquet(path)
    if where is not None:
        table = table.filter(where)
    return table.select(*columns)


def balanced(table: DataFrame, key: str) -> DataFrame:
    """A scan spread over all cores when its files split into fewer parts than there are cores.

    For plain scans of text that costs much work per row; large tables split well and stay as read.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, key) if table.rdd.getNumPartitions() < cores else table


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-16", range_bytes: int = utf16.RANGE
) -> DataFrame:
    """One JSON object per line, blank lines skipped. Files are split among tasks in either encoding."""
    utf8 = encoding.upper() in ("UTF-8", "UTF8")
    source = spark.read.text(path) if utf8 else utf16.read_lines(spark, path, encoding, range_bytes)
    lines = source.select(strip(F.col("value")).alias("line"))
    parsed = lines.filter("line <> ''").select(F.from_json("line", schema).alias("data"))
    return parsed.select("data.*")


def read_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.LABELLED) -> DataFrame:
    """Header, quoted text over several lines."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"')


def write_csv(df: DataFrame, path: str) -> None:
    """S14."""
    df.write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row."""
    df.write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report table of a few lines as tab-separated text with its header, in one file."""
    head = report.sparkSession.range(1).select(
        F.lit("\t".join(report.columns)).alias("value"), F.lit(0).alias("part")
    )
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in report.columns])
    body = report.select(line.alias("value"), F.lit(1).alias("part"))
    lines = head.unionByName(body).orderBy("part", "value").select("value")
    lines.coalesce(1).write.mode("overwrite").text(path)


def replace_table(df: DataFrame, path: str) -> None:
    """The table holds exactly `df` afterwards."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows, for example one row per run to a log."""
    df.write.mode("append").parquet(path)


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Append one batch under its number. Writing it again replaces it, so a retry adds nothing."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All batches of a table, with `batch_id`."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
    return reader.parquet(path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether something has been written at `path` yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def batch_numbers(spark: SparkSession, path: str) -> list[int]:
    """The batches of a table that were written to their end."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS")
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)


def newest(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """T4: the row of the latest batch for each key (merge on read)."""
    return first_per_key(batches, keys, [F.desc("batch_id")]).drop("batch_id")

"""A corpus pipeline: five stages, each over all documents that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of `docs`; the last one adds `copy`.
Ids may repeat or be null: stages that decide on rows then number them first, in a written table, so every row has its own
fate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.llm import decontaminate, jaccard, mixing, substrings, toxicity
from agorascope.llm.exchange import free_name
from agorascope.operators.lineage import cut

#: A list of rows (16 bytes each) is broadcast up to this many; beyond, the documents are shuffled to it.
BROADCAST_ROWS = 1_000_000


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` and the column that tells its rows apart: `doc_id`, or where ids are null or repeat a number, written with them."""
    if docs.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1").isEmpty():
        return docs, "doc_id"
    row = free_name(docs, "row")
    return cut(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _by_row(docs: DataFrame, rows: DataFrame, row: str, how: str) -> DataFrame:
    """`docs` joined with a written table that has a row once at most."""
    return docs.join(F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows, row, how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go."""
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, index).filter("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays (a null id only if no other has one)."""
    numbered, row = _numbered(docs)
    found = jaccard.near_duplicates(numbered, row).select(row, F.col("component_id").alias("group"))
    found = cut(found.join(numbered.select(row, F.col("doc_id").alias("own")), row), "near")
    order = F.struct(F.col("own").isNull().alias("none"), "own", row)
    first = found.groupBy("group").agg(F.min(order).getField(row).alias("first"), F.count("*").alias("n")).filter("n > 1")
    gone = cut(found.join(first, "group").filter(F.col(row) != F.col("first")).select(row), "gone")
    return _by_row(numbered, gone, row, "left_anti").select(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages that start earlier elsewhere go; the text is the words that stay, `n_chars` their length."""
    found = substrings.repeated_words(docs)
    return found.withColumns({"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = decontaminate.benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter("n_hit = 0").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (not at all, up to three times), numbered by `copy`."""
    numbered, row = _numbered(docs)
    taken = cut(mixing.mixed(numbered, row).filter("copies > 0").select(F.col("id").alias(row), F.col("copies").cast("int").alias("copies")), "taken")
    taken = taken.withColumnRenamed("copies", free_name(docs, "copies"))
    copies = F.explode(F.sequence(F.lit(1), F.col(free_name(docs, "copies")))).alias("copy")
    return _by_row(numbered, taken, row, "inner").select(*docs.columns, copies)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
]

#: The stages are not expressible in SQL; tests compare them with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

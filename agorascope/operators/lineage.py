"""Cutting lineage in iterative jobs with tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only for a local session without it."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="agorascope-")
    context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str = "table") -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/agorascope/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Tables written between the rounds of a loop.

    A written table survives lost executors, ends the lineage, and gives the next round true sizes
    to choose its joins by.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        self._tables: list[tuple[DataFrame, str]] = []

    def cut(self, df: DataFrame) -> DataFrame:
        path = new_path(self.spark, self.name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self._tables.append((table, path))
        return table

    def release(self, *tables: DataFrame) -> None:
        """Delete tables no later step reads."""
        for table, path in self._tables:
            if any(table is done for done in tables):
                self._delete(path)
        self._tables = [t for t in self._tables if not any(t[0] is done for done in tables)]

    def release_all(self) -> None:
        """Delete every table this object wrote."""
        self.release(*[table for table, _ in self._tables])

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write `df` to the shared folder and read it back."""
    return Scratch(df.sparkSession, name).cut(df)

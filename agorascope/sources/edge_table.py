"""A stored edge table that batches are merged into.

The table is partitioned by a hash of the edge's key and bucketed by the key. A merge reads, joins and rewrites only the
partitions that the batch has edges in; their bucketed files join the batch as they lie, so only the batch is shuffled. Each
partition carries the number of the last batch in it: a merge that was stopped is repeated, and partitions it had replaced
are left alone, so no weight is added twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.operators.edges import EDGE_KEY, accumulate
from agorascope.operators.lineage import cut
from agorascope.sources.files import folder_exists

#: Parts of the key space that are rewritten on their own, and files of each. Fixed when a table is made.
PARTS, BUCKETS = 64, 8
COLUMNS = [*EDGE_KEY, "weight", "first_seen", "last_seen"]


class EdgeTable:
    """The edge table at `path`, under a name of this session."""

    def __init__(self, spark: SparkSession, name: str, path: str, parts: int = PARTS, buckets: int = BUCKETS):
        self.spark, self.name, self.path, self.parts, self.buckets = spark, name, path, parts, buckets
        keys = ", ".join(EDGE_KEY)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (src STRING, dst STRING, edge_type STRING, weight BIGINT, first_seen TIMESTAMP, "
            f"last_seen TIMESTAMP, batch BIGINT, part INT) USING parquet PARTITIONED BY (part) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def _stored(self) -> DataFrame:
        """The table with all partitions at its path; other sessions may have added some."""
        if folder_exists(self.spark, self.path):
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def edges(self) -> DataFrame:
        """All edges merged so far."""
        return self._stored().select(*COLUMNS)

    def merged(self, fresh: DataFrame, batch: int) -> DataFrame:
        """The partitions that `fresh` touches, as they are after it; those that hold `batch` already are not among them."""
        part = F.pmod(F.xxhash64(*EDGE_KEY), F.lit(self.parts)).cast("int")
        fresh = cut(accumulate(fresh, *EDGE_KEY).withColumn("part", part), "fresh")  # read three times below
        touched = {r.part for r in fresh.select("part").distinct().collect()}  # at most `parts` numbers
        stored = self._stored()
        merged = stored.filter(F.col("part").isin(sorted(touched)) & (F.col("batch") >= batch))
        done = {r.part for r in merged.select("part").distinct().collect()}
        todo = sorted(touched - done)
        old = stored.filter(F.col("part").isin(todo)).drop("batch")
        # Dealt as the stored buckets are, so that those stay where they lie.
        new = fresh.filter(F.col("part").isin(todo)).repartition(self.buckets, *EDGE_KEY)
        both = old.alias("o").join(new.alias("f"), EDGE_KEY, "full_outer")
        zero = F.lit(0)
        return both.select(
            *EDGE_KEY, (F.coalesce("o.weight", zero) + F.coalesce("f.weight", zero)).alias("weight"),
            F.least("o.first_seen", "f.first_seen").alias("first_seen"), F.greatest("o.last_seen", "f.last_seen").alias("last_seen"),
            F.lit(batch).cast("long").alias("batch"), F.coalesce("o.part", "f.part").alias("part"),
        )

    def merge(self, fresh: DataFrame, batch: int) -> None:
        """Adds the edges of a batch. Batches come in ascending order; one that is repeated changes nothing."""
        rows = self.merged(fresh, batch)
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            rows.write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)

"""The stored edge table: equal sums, what a merge shuffles and rewrites, and repeats after a stop."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from agorascope.operators import edges
from agorascope.sources.edge_table import COLUMNS, EdgeTable

SCHEMA = "src string, dst string, edge_type string, weight long, first_seen timestamp, last_seen timestamp"


def batch(seed, n=60, people=12):
    r = random.Random(seed)
    at = lambda: datetime(2024, 1, 1 + r.randrange(20))
    return [(f"u{r.randrange(people)}", f"u{r.randrange(people)}", r.choice(["reply", "mention"]), r.randint(1, 3), at(), at()) for _ in range(n)]


@pytest.fixture
def stored(spark, tmp_path):
    return EdgeTable(spark, f"edges_{abs(hash(str(tmp_path)))}", str(tmp_path / "edges"), parts=16, buckets=4)


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def test_merges_equal_one_pass(spark, stored):
    parts = [spark.createDataFrame(batch(i), SCHEMA) for i in range(3)]
    for i, part in enumerate(parts):
        stored.merge(part, i)
        stored.merge(part, i)
    assert rows(stored.edges()) == rows(edges.merge_edges(*parts))


def test_old_edges_are_not_shuffled_and_untouched_parts_stay(spark, stored, tmp_path):
    stored.merge(spark.createDataFrame(batch(1, 400, 60), SCHEMA), 0)
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(tmp_path / "edges") for f in names if f.endswith(".parquet")}
    before = files()
    fresh = spark.createDataFrame(batch(2, 2), SCHEMA)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = stored.merged(fresh, 1)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scan = next(i for i, line in enumerate(plan) if "FileScan parquet" in line)
    join = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line)
    assert join < scan and "Bucketed: true" in plan[scan] and not any("Exchange" in line for line in plan[join:scan])
    stored.merge(fresh, 1)
    parts = {f.split("part=")[1].split("/")[0] for f in before ^ files()}
    assert 0 < len(parts) <= 2 and len(before & files()) > 10


def test_a_stopped_merge_is_repeated(spark, stored, tmp_path):
    first, second = (spark.createDataFrame(batch(i, 80), SCHEMA) for i in (5, 6))
    stored.merge(first, 0)
    want = rows(edges.merge_edges(first, second))
    # As if only some partitions had been replaced when the merge stopped.
    half = stored.merged(second, 1).filter("part < 8")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        half.write.insertInto(stored.name, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    assert rows(stored.edges()) != want
    stored.merge(second, 1)
    assert rows(stored.edges()) == want


def test_another_session_name_reads_the_same_table(spark, stored, tmp_path):
    stored.merge(spark.createDataFrame(batch(9), SCHEMA), 0)
    again = EdgeTable(spark, stored.name + "_again", str(tmp_path / "edges"), parts=16, buckets=4)
    again.merge(spark.createDataFrame(batch(10), SCHEMA), 1)
    parts = [spark.createDataFrame(batch(i), SCHEMA) for i in (9, 10)]
    assert rows(stored.edges()) == rows(edges.merge_edges(*parts)) == rows(again.edges())


def test_a_merge_makes_its_batch_once(spark, tmp_path):
    """F16: the edges of a batch are made once a merge, however often the merge reads them."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(weight):
        made.add(1)
        return weight

    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    rows = [(f"a{i}", f"b{i}", "reply", 1) for i in range(40)]
    fresh = spark.createDataFrame(rows, "src string, dst string, edge_type string, n long").select(
        "src", "dst", "edge_type", seen("n").alias("weight"), at.alias("first_seen"), at.alias("last_seen")
    )
    stored = EdgeTable(spark, "made_once", str(tmp_path / "edges"), parts=2, buckets=2)
    stored.merge(fresh, 0)
    assert made.value == 40
    assert stored.edges().agg(F.sum("weight")).first()[0] == 40
    spark.sql("DROP TABLE made_once")

import math

import pytest
from pyspark.sql import functions as F

from agorascope.operators import rows, skew


def test_spread_join_equals_plain_join(spark):
    big = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"),
        F.col("id").alias("v"),
    )
    small = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = big.join(small, ["k"], how)
        got = skew.spread_join(big, small, ["k"], how, min_rows=100)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        over = skew.lookup_join(big, small, ["k"], how, max_rows=1)
        assert sorted(map(str, over.collect())) == sorted(map(str, want.collect()))


def test_spread_join_spreads_the_hot_key(spark):
    big = spark.range(10_000).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(7, "x")], "k int, w string")
    assert [r["k"] for r in skew.hot_keys(big, ["k"], 100).collect()] == [7]
    joined = skew.spread_join(big, small, ["k"], min_rows=100)
    assert joined.count() == 10_000


def test_hot_keys_are_bounded(spark):
    many = spark.range(5000).select((F.col("id") % 2500).alias("k"))
    assert skew.hot_keys(many, ["k"], min_rows=1).count() == skew.HOT_KEYS


@pytest.mark.parametrize("share", [0.25, 0.1, 1.0])
def test_stratified_split_equals_ranking(spark, share):
    df = spark.range(700).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("label"))
    got = {r["id"]: r["is_test"] for r in rows.stratified_split(df.repartition(5), "id", "label", share).collect()}
    assert len(got) == 700
    import hashlib

    for label in ("a", "b"):
        ids = [i for i in range(700) if (i % 3 == 0) == (label == "a")]
        ids.sort(key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
        take = math.ceil(share * len(ids))
        assert [got[i] for i in ids] == [True] * take + [False] * (len(ids) - take)


def test_row_index_is_the_rank(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(6)
    got = rows.with_row_index(df, [F.asc("x")], "n").collect()
    assert all(r["x"] == r["n"] for r in got) and len(got) == 1000


def test_top_per_group_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    top = rows.top_per_group(df, ["g"], [F.desc("v")], 3)
    assert sorted((r["g"], r["v"], r["rank"]) for r in top.collect()) == [
        (0, 994, 3), (0, 996, 2), (0, 998, 1), (1, 995, 3), (1, 997, 2), (1, 999, 1),
    ]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") >= 2


def test_split_keeps_rows_without_a_label(spark):
    df = spark.range(300).selectExpr("id", "CASE WHEN id % 3 > 0 THEN id % 3 END AS label")
    got = rows.stratified_split(df, "id", "label").groupBy("label").agg({"is_test": "count"}).collect()
    assert sorted((str(r[0]), r[1]) for r in got) == [("1", 100), ("2", 100), ("None", 100)]


def test_every_row_without_an_identity_stays(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "key string, at int")
    from pyspark.sql import functions as F

    assert sorted(r.at for r in rows.first_per_identity(df, "key", [F.asc("at")]).collect()) == [1, 3, 4]

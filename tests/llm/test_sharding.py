"""Sharding: the law, gapless slots, whole rows, equal results however the rows lie."""

import random
from collections import Counter

import pytest

from agorascope.llm import sharding


def placed(df, **options):
    return [(r.record.asDict(), r["size"], r.shard, r.slot) for r in sharding.sharded(df, **options).collect()]


def some_rows():
    r = random.Random(4)
    rows = [(i, "word " * r.randint(0, 300), "a") for i in range(300)]
    rows += [(7, "the same row", "b")] * 200 + [(None, None, None)] * 100 + [(None, "", "c"), (1, "é" * 50_000, "d")]
    return rows


SCHEMA = "doc_id long, text string, shard string"


@pytest.mark.parametrize("shards", [1, 24, 7])
def test_counts_are_at_most_one_apart_and_slots_have_no_gap(make, shards):
    rows = some_rows()
    got = placed(make(rows, SCHEMA).repartition(5), shards=shards, bucket_bytes=20_000)
    assert Counter(tuple(r.values()) for r, *_ in got) == Counter(rows)
    assert all(size == len((r["text"] or "").encode()) + 8 for r, size, *_ in got)
    slots = {}
    for _, _, shard, slot in got:
        slots.setdefault(shard, []).append(slot)
    assert sorted(slots) == list(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_result_depends_on_rows_and_seed_only(make, spark):
    rows = some_rows()
    first = placed(make(rows, SCHEMA).repartition(5), bucket_bytes=20_000)
    random.Random(1).shuffle(rows)
    key = lambda got: sorted((str(r), s, t) for r, _, s, t in got)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert key(placed(make(rows, SCHEMA).repartition(2), bucket_bytes=20_000)) == key(first)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert key(placed(make(rows, SCHEMA), bucket_bytes=20_000, seed=9)) != key(first)


def test_places_are_uniform(make):
    """Copies of one row and neighbours by id land in every shard about equally often, and in any order."""
    df = make([(i, "x", "s") for i in range(6000)], SCHEMA).repartition(4)
    got = placed(df, shards=6, bucket_bytes=10_000)
    place = [shard * 1000 + slot for r, _, shard, slot in sorted(got, key=lambda x: x[0]["doc_id"])]
    assert sorted(place) == list(range(6000))
    for low in range(0, 6000, 1000):
        inside = Counter(p // 1000 for p in place[low : low + 1000])
        assert sum((n - 1000 / 6) ** 2 / (1000 / 6) for n in inside.values()) < 30
    rising = sum(a < b for a, b in zip(place, place[1:], strict=False))
    assert abs(rising - 3000) < 200


def test_one_bucket_is_a_permutation_and_few_rows_leave_shards_empty(make):
    got = placed(make([(i, "x", "s") for i in range(5)], SCHEMA))
    assert sorted((shard, slot) for *_, shard, slot in got) == [(i, 0) for i in range(5)]
    assert placed(make([], SCHEMA)) == []


def test_maps_and_odd_names_move_along(make):
    rows = [(1, "t", {"k": "v"}, 1.5), (1, "t", {"k": "w"}, 1.5), (2, None, None, None)]
    got = placed(make(rows, "doc_id long, text string, `a.b` map<string,string>, size double"))
    assert sorted(str(tuple(r.values())) for r, *_ in got) == sorted(map(str, rows))


def test_written_shards_read_back(make, spark, tmp_path):
    rows = some_rows()
    sharding.write_shards(sharding.sharded(make(rows, SCHEMA), bucket_bytes=20_000), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(tuple(r.record) for r in back.collect()) == Counter(rows)
    assert back.filter("shard = 23").count() in (25, 26)

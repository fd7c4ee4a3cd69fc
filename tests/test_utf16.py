"""UTF-16 lines in ranges: every line once, wherever the ranges fall."""

import random

import pytest

from agorascope.sources import files, utf16


def some_lines(seed, n=60):
    r = random.Random(seed)
    # Neighbours whose inner bytes look like a line end: U+0A05 U+3000 (little-endian), U+3000 U+0A05 (big-endian).
    pool = ["a", "é", "日", "😀", "ਅ　", "　ਅ", "ਊ", "x y"]
    return ["".join(r.choices(pool, k=r.choice([0, 1, 3, 40]))) for _ in range(n)]


@pytest.mark.parametrize("encoding", ["utf-16-le", "utf-16-be", "utf-16"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_have_each_line_once(tmp_path, monkeypatch, encoding, end):
    for seed, chunk in ((1, 4), (2, 6), (3, 64), (4, 1 << 20)):
        monkeypatch.setattr(utf16, "CHUNK", chunk)
        want = some_lines(seed)
        last = end if seed % 2 else ""
        path = tmp_path / f"{seed}.txt"
        path.write_bytes((end.join(want) + last).encode(encoding))
        for size in (2, 7, 50, 333, 1 << 20):
            parts = utf16.ranges(str(path), "utf-16-be" if encoding == "utf-16-be" else "utf-16-le", size)
            got = [line for part in parts for line in utf16.lines(part)]
            assert got == (want if want[-1] or last else want[:-1]), (seed, size)
            assert size > 300 or len(parts) > 5


def test_folder_marks_and_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert utf16.read_lines(spark, str(tmp_path / "in")).count() == 0
    (tmp_path / "in" / "_SUCCESS").write_text("")
    (tmp_path / "in" / "a.txt").write_bytes("﻿one\ntwo\n".encode("utf-16-be"))
    (tmp_path / "in" / "b.txt").write_bytes("three\r\n\r\nfour".encode("utf-16-le"))
    (tmp_path / "in" / "empty.txt").write_bytes(b"")
    df = utf16.read_lines(spark, str(tmp_path / "in"), range_bytes=4)
    assert sorted(r.value for r in df.collect()) == ["", "four", "one", "three", "two"]
    assert df.rdd.getNumPartitions() > 4


def test_jsonl_in_ranges(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text("\n".join(f'{{"id": {i}, "t": "{"é" * i}"}}' for i in range(200)), encoding="utf-16")
    schema = spark.createDataFrame([], "id long, t string").schema
    got = files.read_jsonl(spark, "file://" + str(path), schema, range_bytes=1000)
    assert sorted(map(tuple, got.collect())) == [(i, "é" * i) for i in range(200)]


def test_tasks_do_not_multiply_with_ranges(spark, tmp_path):
    """short ranges of a long file share tasks, and all lines are read once."""
    want = [f"{i} é" for i in range(20_000)]
    path = tmp_path / "long.txt"
    path.write_bytes("\n".join(want).encode("utf-16-le"))
    found = utf16.ranges(str(path), "utf-16-le", 100)
    tasks = utf16.dealt(found)
    assert len(found) > 2500 and len(tasks) <= utf16.TASKS + 2
    assert [r for t in tasks for r in t.ranges] == found
    df = utf16.read_lines(spark, str(path), range_bytes=100)
    assert df.rdd.getNumPartitions() <= utf16.TASKS + 2
    assert sorted(r.value for r in df.collect()) == sorted(want)

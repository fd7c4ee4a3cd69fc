from datetime import datetime

import pytest
from pyspark.sql import functions as F

from agorascope.functions import scores, text


def value(spark, column, **given):
    row = spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} string" for k in given))
    return row.select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("It's GREAT, see http://a.b/c?d now", "it s great see now"),
        ("prewww.x.y post", "pre post"),
        ("été 5€ — naïve", "t 5 na ve"),
        ("  \n\t ", ""),
    ],
)
def test_clean(spark, raw, want):
    assert value(spark, text.clean(F.col("c")), c=raw) == want


@pytest.mark.parametrize("raw", ["\t a b\n", "　x ", "\x1cq\x1f", " \x85z", "", "plain"])
def test_strip_equals_python(spark, raw):
    assert value(spark, text.strip(F.col("c")), c=raw) == raw.strip()


@pytest.mark.parametrize(
    "row, want",
    [
        (dict(text=" hi ", body="b", title="t", selftext="s"), "hi"),
        (dict(text="  ", body=" b ", title="t", selftext="s"), "b"),
        (dict(text=None, body=None, title=" t ", selftext=" s "), "t\ns"),
        (dict(text=None, body="", title=" t ", selftext=None), "t"),
        (dict(text=None, body=None, title=None, content="c"), "c"),
        (dict(text=None, body=None, title=None), ""),
    ],
)
def test_fallback_text(spark, row, want):
    assert value(spark, text.fallback_text(row), **row) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        # Latin-1 read as UTF-8 where it is valid, other non-Latin and broken bytes dropped; entities decoded once;
        # links cut to their text or dropped; runs of white space to one space.
        ("don\xe2t", "dont"),
        ("caf\xc3\xa9", "caf\xe9"),
        ("plain", "plain"),
        ("a &gt; b &amp;amp; c", "a > b &amp; c"),
        ("\u4e2d text", "text"),
        ("x [txt](y) z", "x txt z"),
        ("\xe9 alone", "alone"),
        ("see [txt](http://a.b/c) end", "see [txt]( end"),
        ("many   \n spaces\xa0 here ", "many spaces here"),
    ],
)
def test_label_text(spark, raw, want):
    assert value(spark, text.clean_label_text(F.col("c")), c=raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("u/abc and (/u/Def_1) xu/no u/ab", ["abc", "Def_1"]),
        ("U/abc u/abc u/ABC", ["abc", "ABC"]),
        ("u/" + "a" * 25, ["a" * 20]),
        ("\u00a0u/abc\u3000u/def\x1cu/ghi", ["abc", "def", "ghi"]),
        (None, []),
    ],
)
def test_mentions(spark, raw, want):
    assert value(spark, text.mentions(F.col("c")), c=raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [(" bob ", "bob"), ("[Deleted]", None), (" NONE", None), ("null", None), ("", None), ("  ", None), (None, None)],
)
def test_account(spark, raw, want):
    assert value(spark, text.account(F.col("c")), c=raw) == want


def test_polarity_label_bounds(spark):
    rows = spark.createDataFrame([(0.05,), (-0.05,), (0.049,), (None,)], "s double")
    both = rows.select(
        scores.polarity_label(F.col("s")).alias("a"), scores.polarity_label(F.col("s"), inclusive=False).alias("b")
    )
    assert [tuple(r) for r in both.collect()] == [
        ("pos", "neu"), ("neg", "neu"), ("neu", "neu"), (None, None),
    ]


def test_epoch_keeps_fraction_and_repeated_hour(spark):
    rows = spark.createDataFrame([(1729990800.0,), (1769384374.123457,), (None,)], "s double")
    got = [r[0] for r in rows.select(scores.epoch_to_timestamp(F.col("s")).cast("timestamp_ntz")).collect()]
    assert got == [datetime(2024, 10, 27, 1, 0), datetime(2026, 1, 25, 23, 39, 34, 123457), None]


def test_small_numbers(spark):
    rows = spark.createDataFrame([("7",), (None,), ("x",), ("3000000000",)], "w string")
    assert [r[0] for r in rows.select(scores.int_or(F.col("w"), 1)).collect()] == [7, 1, 1, 3_000_000_000]
    sizes = spark.createDataFrame([(1,), (100,), (1000,)], "d int").select(scores.marker_size(F.col("d")))
    assert [r[0] for r in sizes.collect()] == [20, 200, 800]

"""String functions (F2-F6, F8, F11, F15, P8, P9, P14). All stay in the JVM except HTML entities."""

from __future__ import annotations

from collections.abc import Iterable
from html import unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from agorascope import fixed


def strip(c: Column) -> Column:
    """remove Unicode white space at both ends (Spark's `trim` knows only U+0020)."""
    return F.btrim(c, F.lit(fixed.WHITESPACE))


def non_blank(c: Column) -> Column:
    """The stripped string, or null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def join_parts(*parts: Column) -> Column:
    """join the non-null parts with one space; never null."""
    return F.concat_ws(" ", *[p.cast("string") for p in parts])


def clean(c: Column) -> Column:
    """lower case, no URLs, only `[a-z0-9]` words separated by single spaces."""
    c = F.regexp_replace(F.lower(c), fixed.URL_PATTERN, "")
    c = F.regexp_replace(c, fixed.NOT_ALNUM_PATTERN, " ")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def fallback_text(columns: Iterable[str]) -> Column:
    """first non-blank of text and body, else title and selftext (or content) on two lines.

    `columns` are the columns the table has; absent ones are skipped.
    """
    have = set(columns)

    def pick(name: str) -> Column:
        return F.col(name).cast("string") if name in have else F.lit(None).cast("string")

    empty = F.lit("")
    rest = F.coalesce(F.nullif(pick("selftext"), empty), pick("content"), empty)
    headed = strip(F.concat(strip(F.coalesce(pick("title"), empty)), F.lit("\n"), strip(rest)))
    return F.coalesce(non_blank(pick("text")), non_blank(pick("body")), headed)


def repair_encoding(c: Column) -> Column:
    """Undo UTF-8 read as Latin-1; characters that cannot have come from it are dropped."""
    latin = F.encode(F.regexp_replace(c, r"[^\x{00}-\x{FF}]", ""), "ISO-8859-1")
    return F.regexp_replace(F.make_valid_utf8(latin.cast("string")), "\ufffd", "")


def unescape_html(c: Column) -> Column:
    """Decode HTML entities. Only strings with an ampersand travel to Python."""

    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        return s.map(unescape, na_action="ignore")

    return F.coalesce(decode(F.when(c.contains("&"), c)), c)


def clean_label_text(c: Column) -> Column:
    """encoding repair, entities, URLs, markdown links to their text, single spaces."""
    c = unescape_html(repair_encoding(F.coalesce(c.cast("string"), F.lit(""))))
    c = F.regexp_replace(c, r"(?U)http\S+", "")
    c = F.regexp_replace(c, fixed.MARKDOWN_LINK_PATTERN, "$1")
    return strip(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def mentions(c: Column) -> Column:
    """Distinct account names written `u/name` or `/u/name`."""
    return F.array_distinct(
        F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(fixed.MENTION_PATTERN), 1)
    )


def account(c: Column) -> Column:
    """Stripped account name, null when blank or a stand-in for a deleted account."""
    name = non_blank(c)
    return F.when(~F.lower(name).isin(fixed.NO_ACCOUNT), name)


def label_text(c: Column) -> Column:
    """label spelling used for comparison."""
    return F.lower(strip(c.cast("string")))


def has_text(c: Column) -> Column:
    """Neither null nor empty."""
    return c.isNotNull() & (F.length(c) > 0)


def at_least(c: Column, n: int) -> Column:
    """At least `n` characters; null is not."""
    return F.coalesce(F.length(c) >= n, F.lit(False))


def excerpt(c: Column, n: int = 220) -> Column:
    """F8: the first `n` characters, for showing an example in a report."""
    return F.substring(c, 1, n)


def tokens(c: Column) -> Column:
    """Lower-case words of two or more letters, digits or underscores, in order."""
    return F.regexp_extract_all(F.lower(c), F.lit(fixed.TOKEN_PATTERN), 0)

"""Number, label and time functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from agorascope import fixed


def epoch_to_timestamp(seconds: Column) -> Column:
    """epoch seconds, whole or fractional, to a timestamp, free of any local-time detour."""
    return F.timestamp_micros(F.round(seconds.cast("double") * 1_000_000).cast("long"))


def utc_iso(ts: Column) -> Column:
    """ISO-8601 text with offset; the session time zone is UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def since(ts: Column, as_of: Column, span: str = "INTERVAL 1 HOUR") -> Column:
    """Not earlier than `as_of` minus `span`; `as_of` is given, so runs can be repeated."""
    return ts >= as_of - F.expr(span)


def polarity_label(
    score: Column,
    labels: Sequence[str] = fixed.SHORT_LABELS,
    threshold: float = 0.05,
    inclusive: bool = True,
) -> Column:
    """label of a score; null stays null. Mean polarity uses `inclusive=False`."""
    negative, neutral, positive = labels
    if inclusive:
        is_pos, is_neg = score >= threshold, score <= -threshold
    else:
        is_pos, is_neg = score > threshold, score < -threshold
    return (
        F.when(score.isNull(), None)
        .when(is_pos, positive)
        .when(is_neg, negative)
        .otherwise(neutral)
    )


def probability_map(labels: Sequence[str], probabilities: Column) -> Column:
    """class to probability, from an array in the order of `labels`."""
    return F.map_from_arrays(F.array(*[F.lit(x) for x in labels]), probabilities)


def int_or(c: Column, default: int) -> Column:
    """integer value, or a default when missing or not a number."""
    return F.coalesce(c.try_cast("bigint"), F.lit(default).cast("bigint"))


def marker_size(degree: Column) -> Column:
    """twice the degree, kept between 20 and 800."""
    return F.greatest(F.lit(20), F.least(F.lit(800), degree * 2))

"""Text corpora for labelling and training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope import schemas
from agorascope.functions import text
from agorascope.functions.scores import int_or
from agorascope.operators.rows import first_per_key, seeded_sample


def export_corpus(
    messages: DataFrame, min_chars: int = 5, arrival: str = "kafka_ts", with_event_type: bool = True,
    max_rows: int | None = None,
) -> DataFrame:
    """Messages with at least `min_chars` of body, one per id, the first to arrive.

    K8: `max_rows` bounds the kept messages, in order of arrival and before the dedupe.
    """
    columns = [c for c in schemas.CORPUS if with_event_type or c != "event_type"]
    body = text.strip(F.coalesce("body", F.lit("")))
    kept = messages.withColumn("text", body).filter(text.at_least(F.col("text"), min_chars))
    if max_rows is not None:
        kept = kept.orderBy(F.asc(arrival), F.asc("id")).limit(max_rows)
    kept = kept.withColumn("score", int_or(F.col("score").cast("string"), 0))
    order = [F.asc_nulls_last(arrival), F.asc("created_utc"), F.asc("text")]
    return first_per_key(kept, ["id"], order).select(*columns)


def label_set(
    corpus: DataFrame, n: int = 100, min_chars: int = 10, seed: int = 42, id_col: str = "id"
) -> DataFrame:
    """A seeded sample of cleaned texts with an empty label column."""
    cleaned = corpus.dropna(subset=[id_col, "text"]).select(
        id_col, text.clean_label_text(F.col("text")).alias("text")
    )
    long_enough = cleaned.filter(text.at_least(F.col("text"), min_chars))
    return seeded_sample(long_enough, id_col, n, seed).withColumn("true_label", F.lit(""))

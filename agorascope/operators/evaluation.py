"""Comparing predicted with true labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope import fixed
from agorascope.functions.text import label_text


def stack_predictions(truth_and_predictions: DataFrame, truth: str, models: Sequence[str]) -> DataFrame:
    """M8: one row (model, true_label, predicted) per row and model column, labels normalised."""
    pairs = [F.struct(F.lit(m).alias("model"), label_text(F.col(m)).alias("predicted")) for m in models]
    return truth_and_predictions.select(
        label_text(F.col(truth)).alias("true_label"), F.inline(F.array(*pairs))
    )


def pair_counts(pairs: DataFrame, labels: Sequence[str] = fixed.SHORT_LABELS) -> DataFrame:
    """Rows per (model, true_label, predicted), with a row also for pairs that never occur."""
    counts = pairs.groupBy("model", "true_label", "predicted").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(x) for x in labels])
    grid = (
        counts.select("model").distinct()
        .withColumn("true_label", F.explode(names))
        .withColumn("predicted", F.explode(names))
        .withColumn("n", F.lit(0).cast("long"))
    )
    both = counts.unionByName(grid).filter(
        F.col("true_label").isin(*labels) & F.col("predicted").isin(*labels)
    )
    return both.groupBy("model", "true_label", "predicted").agg(F.sum("n").alias("n"))


def confusion_matrix(pairs: DataFrame, labels: Sequence[str] = fixed.SHORT_LABELS) -> DataFrame:
    """A row per true label and a column per predicted one; pairs that never occur are 0."""
    counts = pair_counts(pairs, labels)
    return counts.groupBy("model", "true_label").pivot("predicted", list(labels)).agg(F.sum("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / F.nullif(b, F.lit(0)))


def classification_report(pairs: DataFrame, labels: Sequence[str] = fixed.SHORT_LABELS) -> DataFrame:
    """Precision, recall, F1 and support per label, then accuracy, macro avg, weighted avg."""
    true, predicted, n = F.col("true_label"), F.col("predicted"), F.col("n")
    zero = F.lit(0).cast("long")

    def part(label: Column, hit: Column, guessed: Column, support: Column) -> Column:
        return F.struct(
            label.alias("label"), hit.alias("hit"), guessed.alias("guessed"), support.alias("support")
        )

    hit = F.when(true == predicted, n).otherwise(zero)
    sides = F.array(part(true, hit, zero, n), part(predicted, zero, n, zero))
    sums = (
        pair_counts(pairs, labels)
        .select("model", F.inline(sides))
        .groupBy("model", "label")
        .agg(*[F.sum(c).alias(c) for c in ("hit", "guessed", "support")])
        .withColumn("precision", _ratio(F.col("hit"), F.col("guessed")))
        .withColumn("recall", _ratio(F.col("hit"), F.col("support")))
    )
    p, r = F.col("precision"), F.col("recall")
    per_label = sums.withColumn("f1", _ratio(2 * p * r, p + r))
    total = F.sum("support")
    scores = ("precision", "recall", "f1")

    def summary(name: str, **columns: Column) -> DataFrame:
        return per_label.groupBy("model").agg(
            F.lit(name).alias("label"),
            *[columns[c].alias(c) for c in scores],
            total.alias("support"),
        )

    nothing = F.lit(None).cast("double")
    rows = [
        per_label.select("model", "label", *scores, "support"),
        summary("accuracy", precision=nothing, recall=nothing, f1=_ratio(F.sum("hit"), total)),
        summary("macro avg", **{c: F.avg(c) for c in scores}),
        summary("weighted avg", **{c: _ratio(F.sum(F.col(c) * F.col("support")), total) for c in scores}),
    ]
    return reduce(DataFrame.unionByName, rows)

"""Bounded samples of labelled documents, and word-term vectors, for the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.llm import words as W


def held_out(id_column: str) -> Column:
    """Whether a document's label may not be learnt: crc32 of its id as text divides by 5. Null ids are held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(True))


def sample_ids(labels: DataFrame, id_column: str, label_column: str, per_class: int) -> DataFrame:
    """(id, label) of at most `per_class` learnable ids of each class, the least by a hash of the id."""
    known = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & ~held_out("id")).dropDuplicates(["id"])
    parts = [
        known.filter(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(per_class) for c in (0, 1)
    ]
    return parts[0].unionByName(parts[1])


def prior(labels: DataFrame, id_column: str, label_column: str) -> float:
    """The share of label 1 among all learnable labels; a half without any."""
    known = labels.filter(F.col(label_column).isin(0, 1) & ~held_out(id_column))
    share = known.agg(F.avg(F.col(label_column).cast("double"))).first()[0]
    return min(max(0.5 if share is None else share, 1e-3), 1 - 1e-3)


def examples(docs: DataFrame, ids: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, label, text) of the sampled documents; the ids are bounded, so they are broadcast."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(ids), "id").select("id", "label", "text")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression (the last for the constant) by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= move
        if np.abs(move).max() < 1e-9:
            break
    return w


_STEM = 7


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of texts and the text of each: every word, and the first `_STEM` bytes of each longer word.

    Words are runs of letters, digits and non-ASCII characters, in lower case (A-Z).
    """
    words = W.split(data, offsets, W.ALNUM, lower=True)
    owner = words.owner()
    long = words.ends - words.starts > _STEM
    stems = W._hash(words.data, words.starts[long], words.starts[long] + _STEM) ^ np.uint64(0xA5A5A5A5)
    return np.concatenate([words.hashes, stems]), np.concatenate([owner, owner[long]])

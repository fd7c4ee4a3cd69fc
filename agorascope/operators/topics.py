"""Topics by non-negative matrix factorisation (M7)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.functions.text import excerpt
from agorascope.operators.features import tfidf
from agorascope.operators.lineage import cut
from agorascope.operators.rows import top_per_group

TINY = 1e-12
#: Sweeps over a batch's document weights: at most so many, and none after the largest change is this part of the largest weight.
SWEEPS, SETTLED = 200, 1e-9
#: Directions sampled beyond the topics, and passes that sharpen them.
EXTRA, POWER = 10, 2


@dataclass
class Topics:
    """A fitted factorisation: topic x term weights, the loss after each round, and its inputs."""

    weights: np.ndarray
    losses: list[float]
    matrix: DataFrame
    vocabulary: DataFrame


def _document_weights(columns: np.ndarray, values: np.ndarray, lengths: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Non-negative least squares fit of sparse rows to the topics, by coordinate descent.

    The problem is convex, so the result depends on the topics alone; nothing is kept between rounds.
    """
    n, k = len(lengths), h.shape[0]
    row = np.repeat(np.arange(n), lengths)
    target = np.empty((n, k))
    for j in range(k):
        target[:, j] = np.bincount(row, weights=values * h[j, columns], minlength=n)
    gram = h @ h.T
    w = np.maximum(target, 0) / max(float(np.trace(gram)), TINY)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(k):
            new = np.maximum(w[:, j] + (target[:, j] - w @ gram[:, j]) / max(gram[j, j], TINY), 0)
            moved = max(moved, float(np.abs(new - w[:, j]).max(initial=0)))
            w[:, j] = new
        if moved <= SETTLED * float(w.max(initial=0)):
            break
    return w


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, values = batch.column("term_ids"), batch.column("weights")
    lengths = np.diff(ids.offsets.to_numpy())
    return ids.flatten().to_numpy(), values.flatten().to_numpy(), lengths


def _summed(
    matrix: DataFrame, shared: np.ndarray, n_terms: int, block: Callable[..., tuple[np.ndarray, np.ndarray]], width: int
) -> tuple[np.ndarray, np.ndarray]:
    """One pass over the documents: (terms x width, rows x width), summed per task, then over tasks.

    `block` gives both for a batch from its sparse rows and `shared`, which every task holds.
    """
    known = matrix.sparkSession.sparkContext.broadcast(shared)  # topics x max_features numbers
    names = [f"c{j}" for j in range(width)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_term, rest = np.zeros((n_terms, width)), None
        for batch in batches:
            terms, more = block(*_sparse(batch), known.value)
            by_term += terms
            rest = more if rest is None else rest + more
        if rest is None:
            return
        used = np.flatnonzero(by_term.any(axis=1))
        key = np.concatenate([used, -1 - np.arange(len(rest))]).astype("int64")
        out = np.concatenate([by_term[used], rest])
        yield pa.RecordBatch.from_arrays([pa.array(key), *[pa.array(out[:, j]) for j in range(width)]], names=["key", *names])

    schema = "key long, " + ", ".join(f"{c} double" for c in names)
    table = matrix.mapInArrow(sums, schema).groupBy("key").agg(*[F.sum(c).alias(c) for c in names]).toArrow()  # max_features rows and a few
    known.destroy()
    key, values = table["key"].to_numpy(), np.column_stack([table[c].to_numpy() for c in names])
    by_term = np.zeros((n_terms, width))
    by_term[key[key >= 0]] = values[key >= 0]
    rest = np.zeros((int(-key.min(initial=0)), width))
    rest[-1 - key[key < 0]] = values[key < 0]
    return by_term, rest


def _by_term(columns: np.ndarray, values: np.ndarray, rows: np.ndarray, lengths: np.ndarray, n_terms: int) -> np.ndarray:
    """X'M for sparse rows X and dense rows M."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    return np.column_stack([np.bincount(columns, weights=values * rows[row, j], minlength=n_terms) for j in range(rows.shape[1])])


def _times(columns: np.ndarray, values: np.ndarray, lengths: np.ndarray, q: np.ndarray) -> np.ndarray:
    """XQ for sparse rows X."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    return np.column_stack([np.bincount(row, weights=values * q[columns, j], minlength=len(lengths)) for j in range(q.shape[1])])


def _round_sums(matrix: DataFrame, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One pass over the documents: (W'X, W'W, |X|^2)."""
    k = len(h)

    def block(columns: np.ndarray, values: np.ndarray, lengths: np.ndarray, topics: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = _document_weights(columns, values, lengths, topics)
        norm = np.zeros((1, k))
        norm[0, 0] = float(values @ values)
        return _by_term(columns, values, w, lengths, topics.shape[1]), np.concatenate([w.T @ w, norm])

    wx, rest = _summed(matrix, h, h.shape[1], block, k)
    return wx.T, rest[:k] if len(rest) else np.zeros((k, k)), float(rest[k, 0]) if len(rest) else 0.0


def singular_vectors(matrix: DataFrame, n_terms: int, k: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the k largest singular values of the matrix, on the side of the terms.

    Randomised range finder (Halko et al. 2011): X'X times a few seeded directions, made orthogonal on the driver, which
    holds terms x (k + EXTRA) numbers. Each product is one pass over the documents; the last one also gives the small
    matrix whose eigenvectors turn the directions into singular vectors.
    """
    width = min(k + EXTRA, n_terms)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_terms, width)))

    def block(columns: np.ndarray, values: np.ndarray, lengths: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _by_term(columns, values, _times(columns, values, lengths, q), lengths, len(q)), np.zeros((0, width))

    for _ in range(POWER):
        q, _ = np.linalg.qr(_summed(matrix, q, n_terms, block, width)[0])
    product, _ = _summed(matrix, q, n_terms, block, width)
    small = q.T @ product
    found, turned = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-found, kind="stable")[:k]
    return np.sqrt(np.maximum(found[order], 0)), q @ turned[:, order]


def svd_topics(matrix: DataFrame, n_terms: int, k: int, seed: int = 42) -> np.ndarray:
    """Non-negative start from the singular vectors (Boutsidis & Gallopoulos 2008), empty places at the matrix's mean.

    Of each pair of vectors the positive or the negative parts are taken, whichever weigh more together; the weight on the
    side of the documents comes from one more pass that adds up squares.
    """
    values, vectors = singular_vectors(matrix, n_terms, k, seed)

    def block(columns: np.ndarray, weights: np.ndarray, lengths: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = _times(columns, weights, lengths, v)
        sums = np.full(x.shape[1], float(weights.sum()))
        counts = np.full(x.shape[1], float(len(lengths)))
        return np.zeros((len(v), x.shape[1])), np.stack([(np.maximum(x, 0) ** 2).sum(0), (np.maximum(-x, 0) ** 2).sum(0), sums, counts])

    _, rest = _summed(matrix, vectors, n_terms, block, vectors.shape[1])
    h = np.zeros((k, n_terms))
    if not len(rest):
        return h + TINY
    mean = rest[2, 0] / max(rest[3, 0] * n_terms, 1.0)
    for j, value in enumerate(values):
        v = vectors[:, j]
        if j == 0:
            h[0] = np.sqrt(value) * np.abs(v)
            continue
        sides = []
        for part, squares in ((np.maximum(v, 0), rest[0, j]), (np.maximum(-v, 0), rest[1, j])):
            norm = np.linalg.norm(part)
            sides.append((norm * np.sqrt(squares) / max(value, TINY), part / max(norm, TINY)))
        weight, side = max(sides, key=lambda s: s[0])
        h[j] = np.sqrt(value * weight) * side
    return np.where(h < TINY, max(mean, TINY), h)


def _next_topics(h: np.ndarray, wx: np.ndarray, ww: np.ndarray) -> np.ndarray:
    h = h.copy()
    for _ in range(10):
        for j in range(h.shape[0]):
            if ww[j, j] > TINY:
                h[j] = np.maximum(h[j] + (wx[j] - ww[j] @ h) / ww[j, j], TINY)
    return h


def factorise(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    stop_words: Sequence[str] = (),
    k: int = 8,
    rounds: int = 20,
    max_features: int = 20_000,
    min_df: int = 2,
    seed: int = 42,
    tolerance: float = 1e-4,
    start: str = "svd",
) -> Topics:
    """Alternating least squares on the TF-IDF matrix with the Frobenius loss, from singular vectors or (`start` "random") seeded noise.

    Each round is one read of the written matrix. Document weights are solved inside the tasks from
    the current topics, so a round shuffles one row per term and task and keeps no state per document.
    """
    features, vocab = tfidf(docs, id_col, text_col, stop_words, max_features, min_df)
    matrix = cut(
        features.select(
            id_col,
            F.transform("features", lambda x: x["term_id"]).alias("term_ids"),
            F.transform("features", lambda x: x["weight"]).alias("weights"),
        ),
        "matrix",
    )
    n_terms = max(vocab.count(), 1)
    h = svd_topics(matrix, n_terms, k, seed) if start == "svd" else np.random.default_rng(seed).random((k, n_terms))
    losses: list[float] = []
    for _ in range(rounds):
        wx, ww, xx = _round_sums(matrix, h)
        h = _next_topics(h, wx, ww)
        losses.append(float(xx - 2 * np.sum(wx * h) + np.sum(ww * (h @ h.T))))
        if len(losses) > 1 and losses[-2] - losses[-1] <= tolerance * losses[0]:
            break
    return Topics(h, losses, matrix, vocab)


def document_topics(topics: Topics, id_col: str) -> DataFrame:
    """(id, topic_id, weight), positive weights only."""
    shared = topics.matrix.sparkSession.sparkContext.broadcast(topics.weights)
    id_type = topics.matrix.schema[id_col].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = _document_weights(*_sparse(batch), shared.value)
            listed = pa.array(list(w), type=pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(id_col), listed], names=[id_col, "w"])

    rows = topics.matrix.mapInArrow(weigh, f"{id_col} {id_type}, w array<double>")
    long = rows.select(id_col, F.posexplode("w").alias("topic_id", "weight"))
    return long.filter(F.col("weight") > 0)


def topic_terms(topics: Topics, n: int = 12) -> DataFrame:
    """K6: (topic_id, rank, term, weight), the `n` heaviest terms of each topic."""
    spark = topics.matrix.sparkSession
    flat = [
        (int(j), int(t), float(topics.weights[j, t]))
        for j in range(len(topics.weights))
        for t in np.argsort(-topics.weights[j], kind="stable")[:n]
    ]
    best = spark.createDataFrame(flat, "topic_id int, term_id int, weight double")  # k x n rows
    named = topics.vocabulary.select("term_id", "term").join(F.broadcast(best), "term_id")
    order = [F.desc("weight"), F.asc("term")]
    return top_per_group(named, ["topic_id"], order, n).select("topic_id", "rank", "term", "weight")


def topic_report(
    topics: Topics, docs: DataFrame, id_col: str, text_col: str, n_terms: int = 12, n_examples: int = 3
) -> DataFrame:
    """(topic_id, keywords, examples): heaviest terms, and excerpts of the heaviest documents."""
    def listed(rows: DataFrame, value: str, name: str) -> DataFrame:
        pairs = F.array_sort(F.collect_list(F.struct("rank", value)))
        return rows.groupBy("topic_id").agg(F.transform(pairs, lambda x: x[value]).alias(name))

    keywords = listed(topic_terms(topics, n_terms), "term", "keywords")
    order = [F.desc("weight"), F.asc(id_col)]
    chosen = top_per_group(document_topics(topics, id_col), ["topic_id"], order, n_examples)
    chosen = F.broadcast(chosen.select(id_col, "topic_id", "rank"))  # k x n_examples rows
    shown = docs.select(id_col, excerpt(F.col(text_col)).alias("example")).join(chosen, id_col)
    return keywords.join(listed(shown, "example", "examples"), "topic_id", "left")

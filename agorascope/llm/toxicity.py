"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

- Examples: at most `EXAMPLES` labelled documents of each class (bounded, so the model has a bounded size).
- Vocabulary: the `VOCABULARY` terms (words, and stems of long words) that tell the classes of the examples apart most
  surely (chi squared), of those in at least `MIN_EXAMPLES` of them. Their document frequencies come from all documents.
- Index: for each term its postings (example, weight) in order of example, cut into blocks of `BLOCK` examples with the
  greatest weight of each. A document visits the blocks of the greatest upper bounds (its weights times the block maxima),
  then those whose bound is not below its k-th best cosine so far, and no others: the k nearest are exact.
- Votes weigh by cosine. A logistic fit to leave-one-out votes of the examples calibrates them; it is set to the share
  of label 1 among all learnable labels. Documents near no example get the calibrated score of no votes.

Texts are scored whole and where they lie. Null and empty texts, and texts without a known term, are near no example.
Repeated rows are scored each. Without labels of both classes every score is the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm import labelled as L
from agorascope.llm import words as W
from agorascope.llm.exchange import free_name, starts_of
from agorascope.llm.ship import ship

EXAMPLES = 2000
VOCABULARY = 2048
MIN_EXAMPLES = 3
BLOCK = 64
FIRST_BLOCKS = 4
NEAREST = 15


def _counts(piece: pa.RecordBatch, column: str, vocabulary: np.ndarray | None = None):
    """(text, term, count) of a piece, sorted; terms as hashes, or as places in a sorted vocabulary (others left out)."""
    keys, owner = L.terms(*W.text_buffers(piece.column(piece.schema.get_field_index(column))))
    if vocabulary is not None:
        if not len(vocabulary):
            return owner[:0], owner[:0], owner[:0]
        at = np.minimum(np.searchsorted(vocabulary, keys), len(vocabulary) - 1)
        known = vocabulary[at] == keys
        keys, owner = at[known], owner[known]
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    starts = starts_of(owner, keys)
    return owner[starts], keys[starts], np.diff(np.append(starts, len(keys)))


@dataclass
class Index:
    vocabulary: np.ndarray
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    term_starts: np.ndarray  # of postings, by term and block: (terms, blocks + 1)
    examples: np.ndarray
    weights: np.ndarray
    maxima: np.ndarray  # (terms, blocks)
    calibration: np.ndarray

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[terms]
        return w / max(np.sqrt((w * w).sum()), 1e-12)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest positive cosine and the cosines; `skip` is an example left out."""
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = weights @ self.maxima[terms]
        order = np.argsort(-bounds, kind="stable")
        scores = self._cosines(terms, weights, order[:FIRST_BLOCKS], skip)
        bar = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
        rest = order[FIRST_BLOCKS:]
        rest = rest[(bounds[rest] > 0) & (bounds[rest] + 1e-12 >= bar)]
        if len(rest):
            scores = scores + self._cosines(terms, weights, rest, skip)
        found = np.flatnonzero(scores > 0)
        found = found[np.lexsort((found, -scores[found]))[:k]]
        return found, scores[found]

    def _cosines(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray, skip: int) -> np.ndarray:
        """The cosines of the examples in these blocks, 0 elsewhere, from the postings of the terms in them."""
        starts = self.term_starts[terms]
        low, high = starts[:, blocks].ravel(), starts[:, blocks + 1].ravel()
        count = high - low
        at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        parts = np.repeat(np.repeat(weights, len(blocks)), count) * self.weights[at]
        scores = np.bincount(self.examples[at], parts, len(self.labels))
        if skip >= 0:
            scores[skip] = 0
        return scores

    def votes(self, found: np.ndarray, scores: np.ndarray) -> tuple[float, float, float]:
        """Votes for and against, and the greatest cosine."""
        y = self.labels[found]
        return float((scores * y).sum()), float((scores * (1 - y)).sum()), float(scores.max(initial=0))

    def score(self, votes: np.ndarray) -> np.ndarray:
        z = np.column_stack([votes, np.ones(len(votes))]) @ self.calibration
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _select(owner, keys, labels: np.ndarray) -> np.ndarray:
    """The sorted vocabulary: terms by chi squared of their presence against the label."""
    vocabulary, code = np.unique(keys, return_inverse=True)
    n1, n = max(labels.sum(), 1), len(labels)
    df = np.bincount(code, minlength=len(vocabulary)).astype(float)
    both = np.bincount(code, labels[owner], len(vocabulary))
    expected = df * n1 / n
    chi = (both - expected) ** 2 / np.maximum(expected * (1 - n1 / n) * (1 - df / n) + 1e-9, 1e-9)
    chi[df < MIN_EXAMPLES] = 0
    best = np.lexsort((vocabulary, -chi))[:VOCABULARY]
    return np.sort(vocabulary[best[chi[best] > 3.84]])


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Index:
    """The index of the sampled examples."""
    ship(docs.sparkSession)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                owner, keys, counts = _counts(piece, "text")
                cut = np.searchsorted(owner, np.arange(piece.num_rows + 1))
                rows = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0), piece.column(1),
                        pa.array([keys[a:b].tobytes() for a, b in rows], pa.binary()),
                        pa.array([counts[a:b].astype(np.int32).tobytes() for a, b in rows], pa.binary()),
                    ],
                    names=["id", "label", "keys", "counts"],
                )

    ids = L.sample_ids(labels, id_column, label_column, EXAMPLES)
    table = L.examples(docs, ids, id_column, text_column).mapInArrow(vectors, "id long, label int, keys binary, counts binary").toArrow()
    table = table.sort_by("id")
    y = table["label"].to_numpy().astype(float) if table.num_rows else np.zeros(0)
    keys = [np.frombuffer(x.as_py(), np.uint64) for x in table["keys"]]
    counts = [np.frombuffer(x.as_py(), np.int32) for x in table["counts"]]
    owner = np.repeat(np.arange(len(keys)), [len(x) for x in keys]) if keys else np.zeros(0, np.int64)
    flat, many = (np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int32))
    example_ids = table["id"].to_numpy().copy() if table.num_rows else np.zeros(0, np.int64)
    del table, keys, counts
    pa.default_memory_pool().release_unused()
    learnable = len(y) and 0 < y.sum() < len(y)
    vocabulary = _select(owner, flat, y) if learnable else np.zeros(0, np.uint64)
    idf = _idf(docs, text_column, vocabulary)
    at = np.minimum(np.searchsorted(vocabulary, flat), max(len(vocabulary) - 1, 0)) if len(vocabulary) else flat.astype(np.int64)
    known = vocabulary[at] == flat if len(vocabulary) else np.zeros(len(flat), bool)
    owner, at, many = owner[known], at[known].astype(np.int64), many[known]
    weights = (1 + np.log(many)) * idf[at] if len(at) else np.zeros(0)
    norm = np.sqrt(np.bincount(owner, weights * weights, max(len(y), 1)))
    weights = weights / np.maximum(norm[owner], 1e-12) if len(at) else weights
    blocks = max(1, -(-len(y) // BLOCK))
    order = np.lexsort((owner, at))
    owner, at, weights = owner[order], at[order], weights[order]
    cell = at * blocks + owner // BLOCK
    starts = np.searchsorted(cell, np.arange(len(vocabulary) * blocks + 1)).astype(np.int64)
    maxima = np.zeros(len(vocabulary) * blocks)
    np.maximum.at(maxima, cell, weights)
    grid = np.empty((len(vocabulary), blocks + 1), np.int64)
    if len(vocabulary):
        grid[:, :-1] = starts[:-1].reshape(-1, blocks)
        grid[:, -1] = starts[blocks::blocks]
    share = L.prior(labels, id_column, label_column)
    index = Index(vocabulary, idf, example_ids, y, grid, owner, weights,
                  maxima.reshape(len(vocabulary), blocks), np.array([0.0, 0, 0, np.log(share / (1 - share))]))
    if learnable:
        by_owner = np.argsort(owner, kind="stable")
        cut = np.searchsorted(owner[by_owner], np.arange(len(y) + 1))
        own = [by_owner[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        votes = np.array([index.votes(*index.nearest(at[o], weights[o], NEAREST, skip=i)) for i, o in enumerate(own)])
        fitted = L.fit_logistic(votes, y)
        fitted[-1] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
        index.calibration = fitted
    return index


def _idf(docs: DataFrame, text_column: str, vocabulary: np.ndarray) -> np.ndarray:
    """Inverse document frequencies over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(shared.value), np.int64), 0
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                total += np.bincount(_counts(piece, "text", shared.value)[1], minlength=len(total))
                n += piece.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(total)), -1)), pa.array(np.append(total, n))], names=["term", "n"])

    if not len(vocabulary):
        return np.zeros(0)
    rows = docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in rows.collect()}
    df = np.array([found.get(t, 0) for t in range(len(vocabulary))], float)
    return np.log((1 + found.get(-1, 0)) / (1 + df)) + 1


def scored(docs: DataFrame, index: Index, text_column: str = "text") -> DataFrame:
    """All columns of `docs`, with `score`, `predicted` and `neighbours` (the evidence: id, label and cosine, nearest first).

    Columns of `docs` that have one of these names are replaced.
    """
    spark = ship(docs.sparkSession)
    outputs = ("score", "predicted", "neighbours")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in outputs and c != text_column])
    shared = spark.sparkContext.broadcast(index)
    evidence = pa.list_(pa.struct([("id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
    empty = free_name(docs, "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for piece in W.pieces(batch, text_column):
                owner, keys, counts = _counts(piece, text_column, index.vocabulary)
                cut = np.searchsorted(owner, np.arange(piece.num_rows + 1))
                votes, near = [], []
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    terms = keys[a:b]
                    found, scores = index.nearest(terms, index.vector(terms, counts[a:b]), NEAREST) if b > a else (keys[:0], np.zeros(0))
                    votes.append(index.votes(found, scores))
                    near.append([{"id": int(index.ids[f]), "label": int(index.labels[f]), "cosine": float(s)} for f, s in zip(found[:3], scores[:3], strict=True)])
                score = index.score(np.array(votes, float).reshape(-1, 3))
                for name, values in ((empty, pa.array(score)), ("predicted", pa.array((score >= 0.5).astype(np.int32))), ("neighbours", pa.array(near, evidence))):
                    piece = piece.append_column(name, values)
                yield piece

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, {empty} double, predicted int, neighbours array<struct<id:bigint,label:int,cosine:double>>")

"""Exact top-k inner products by no-random-access (NRA) aggregation.

Each task holds one block of candidate vectors and sorts each component into a list. For a query, the contribution of
component j falls along list j, read from its top where the query's component is positive, from its bottom where it is
negative. All lists are read to the same depth, which doubles:

- the lower bound of a vector adds what was read of it to the least each unread list can still give,
- the upper bound adds what was read to the value at each unread list's frontier,
- a query stops when its k-th best lower bound is not below the upper bound of any vector outside the best k.

The bounds of all queries are matrix products over the read part of the lists, in whole numbers (exact in double
precision below 2**53, in Python's integers beyond). The final scores of the vectors that can still qualify are resolved
from their full components, with ties to the smaller id. Queries are taken in blocks of `QUERIES`, so what is broadcast
is bounded; each block is one pass over the candidates. Every task returns k rows a query at most; those are merged by a
rank that Spark limits before the shuffle.

Components become floor(scale * x). Null vectors, and those with null or non-finite components, take no part; vectors
of another length than the query's are not compared with it. Rows without an id take no part. Repeated rows are
candidates each; a query's own id is none. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.llm.ship import ship

SCALE = 1024
QUERIES = 4096
ROWS = 16384
DEPTH = 64


def whole_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """(id, v) of the rows that take part, v as whole numbers."""
    parts = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return parts.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad).select(
        "id", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("double")).alias("v")
    )


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors by length: (their rows, a matrix)."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = {}
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out[int(d)] = rows, flat[offsets[rows][:, None] + np.arange(d)]
    return out


def nra(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, block: np.ndarray, k: int, depth: int = DEPTH):
    """(query number, row, score) of the k best rows of a block for each query, other than rows with its own id."""
    n, d = block.shape
    if n == 0 or len(queries) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    big = float(np.abs(queries).max(initial=0)) * float(np.abs(block).max(initial=0)) * max(d, 1)
    if big >= 2.0**52:
        return _plain(queries, own, ids, block, k)
    order = np.argsort(block, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    lists = np.take_along_axis(block, order, axis=0)
    plus, minus = np.maximum(queries, 0), np.minimum(queries, 0)
    least = plus @ lists[0] + minus @ lists[-1] if d else np.zeros(len(queries))
    excluded = own[:, None] == ids[None, :] if np.isin(own, ids).any() else None
    waiting = np.arange(len(queries))
    out = []
    while len(waiting):
        depth = min(depth, n)
        p, m = plus[waiting], minus[waiting]
        top, bottom = rank >= n - depth, rank < depth
        # what was read, less the least the same lists give: lower = read + least of the unread lists
        lower = p @ np.where(top, block - lists[0], 0).T + m @ np.where(bottom, block - lists[-1], 0).T + least[waiting][:, None]
        upper = p @ np.where(top, block, lists[n - depth]).T + m @ np.where(bottom, block, lists[depth - 1]).T
        if excluded is not None:
            lower[excluded[waiting]] = -np.inf
            upper[excluded[waiting]] = -np.inf
        if n > k:
            bar = np.partition(lower, n - k, axis=1)[:, n - k]
        else:
            bar = np.full(len(waiting), -np.inf)
        may = (upper >= bar[:, None]) & (upper > -np.inf)
        few = may.sum(axis=1)
        ready = (few <= 4 * k) | (depth == n)
        for q in np.flatnonzero(ready):
            rows = np.flatnonzero(may[q])
            score = block[rows] @ queries[waiting[q]]
            best = np.lexsort((ids[rows], -score))[:k]
            out.append((np.full(len(best), waiting[q]), rows[best], score[best].astype(np.int64)))
        waiting = waiting[~ready]
        depth *= 2
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _plain(queries, own, ids, block, k):
    """The same beyond double precision; scores beyond 64 bits end at their limits."""
    out = []
    whole = block.astype(object)
    for q in range(len(queries)):
        score = np.array([sum(int(a) * int(b) for a, b in zip(queries[q], row, strict=True)) for row in whole], object)
        rows = np.array([r for r in range(len(ids)) if ids[r] != own[q]], np.int64)
        rows = np.array(sorted(rows.tolist(), key=lambda r: (-score[r], ids[r]))[:k], np.int64)
        limited = [max(-(1 << 63), min((1 << 63) - 1, score[r])) for r in rows]
        out.append((np.full(len(rows), q), rows, np.array(limited, np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def top_k(
    rows: DataFrame, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 10, scale: int = SCALE
) -> DataFrame:
    """(query_id, rank, id, score): for each row under `is_query`, the k best other rows by inner product."""
    spark = ship(rows.sparkSession)
    vectors = whole_vectors(rows, id_column, vector_column, scale)
    queries = whole_vectors(rows.filter(is_query), id_column, vector_column, scale)
    blocks = max(1, -(-queries.count() // QUERIES))
    found = None
    for b in range(blocks):
        table = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow().combine_chunks()
        ids = table["id"].to_numpy()
        asked = spark.sparkContext.broadcast(
            {d: (ids[at], m) for d, (at, m) in (_matrix(table["v"].combine_chunks()).items() if len(ids) else ())}
        )

        def search(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            held, count = [], 0
            for batch in batches:
                held.append(batch)
                count += batch.num_rows
                if count >= ROWS:
                    yield from _searched(held, asked.value, k)
                    held, count = [], 0
            if count:
                yield from _searched(held, asked.value, k)

        part = vectors.mapInArrow(search, "query_id long, id long, score long")
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _searched(batches: list[pa.RecordBatch], asked: dict, k: int) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches).combine_chunks()
    ids = table["id"].to_numpy()
    vectors = table["v"].combine_chunks()
    vectors = vectors if isinstance(vectors, pa.Array) else vectors.chunk(0)
    for d, (at, block) in _matrix(vectors).items():
        if d not in asked:
            continue
        own, queries = asked[d]
        for low in range(0, len(own), 128):
            q, row, score = nra(queries[low : low + 128], own[low : low + 128], ids[at], block, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[low : low + 128][q]), pa.array(ids[at][row]), pa.array(score)], names=["query_id", "id", "score"]
            )

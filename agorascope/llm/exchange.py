"""Asking all documents about keys of some: packed key lists go from chunks of documents to buckets of keys and back.

A chunk is the documents of one range of ids. It sends each bucket one row: a sorted array of the chunk's
*distinct* keys, so a key that a third of all documents hold arrives once a chunk and no bucket grows hot. A bucket
answers each chunk by one row. Buckets and chunks are spread evenly by their numbers; none depends on how often a key
occurs. Both are groups of bounded size: a chunk by its number of ids, a bucket by the number of buckets, which
follows spark.sql.shuffle.partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 1024
#: The order of a document without an id: after all others.
NO_ID = (1 << 63) - 1


def n_buckets(spark: SparkSession) -> int:
    return max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def chunk_of(id_column: str, size: int = CHUNK) -> Column:
    """The number of a document's chunk."""
    number = F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID))
    return F.call_function("div", number - F.pmod(number, F.lit(size)), F.lit(size)).cast("long")


def id_values(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Document ids as int64, null as `NO_ID`."""
    column = column.cast(pa.int64()).fill_null(NO_ID)
    return np.asarray(column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy())


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins in columns sorted together."""
    n = len(columns[0])
    if n == 0:
        return np.zeros(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def packed(groups: Sequence[np.ndarray], values: Sequence[np.ndarray], starts: np.ndarray, names: Sequence[str]) -> pa.Table:
    """A row for each run of sorted rows that begins at `starts`: its `groups`, and its `values` as bytes."""
    ends = np.append(starts[1:], len(values[0])) if len(starts) else starts
    columns = [pa.array(g[starts]) for g in groups]
    for v in values:
        v = np.ascontiguousarray(v)
        raw, width = v.tobytes(), v.dtype.itemsize
        columns.append(pa.array([raw[s * width : e * width] for s, e in zip(starts, ends, strict=True)], pa.binary()))
    return pa.table(columns, names=list(names))


def unpacked(column: pa.ChunkedArray | pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows one after another, and the row of each."""
    rows = [np.frombuffer(x.as_py() or b"", kind) for x in column]
    sizes = np.array([len(r) for r in rows], np.int64)
    return (np.concatenate(rows) if rows else np.zeros(0, kind)), np.repeat(np.arange(len(rows)), sizes)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores where a column has it already (Spark tells no case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name

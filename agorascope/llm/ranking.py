"""Ranked lexical search over all documents, by bag deduplication.

One pass restricts each document to the terms of the items: its bag is the sorted (term, count) pairs that are left. With
its length norm m a bag decides every score, so documents of one bag and m are a class: they are grouped by a hash, and
the pairs themselves are part of the grouping key, so classes are verified. Each class is scored once; its members follow
by ascending id. Of a class at most k members can be among an item's k best, and of the classes of an item only the k
first by (score, least member): both are ranks that Spark limits before its shuffles, so neither a class of a third of
all documents nor a tie of many classes meets in one task.

Scores are exact 64-bit integers. N, the length of all documents and document frequencies are counted over all documents.
Items are taken in blocks of `BLOCK_ITEMS` items or `BLOCK_TERMS` distinct terms, one pass over the documents each; what is
broadcast (the vocabulary of a block, weights, terms of its items) has that bound.

Null texts and texts without terms match nothing. Each row is a document, also where ids repeat; a null id is ordered
last. Each row of items is an item, also where ids repeat or are null; one without terms has no results. Texts of any
length are read in pieces. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from agorascope.operators.lineage import Scratch
from agorascope.session import ship

K = 50
BLOCK_ITEMS = 1024
BLOCK_TERMS = 1 << 18
#: Bytes of a long text, and bytes of bags, that are worked on at once.
PIECE, BAGS = 1 << 20, 4 << 20

_TERM = b"0123456789abcdefghijklmnopqrstuvwxyz"
_SEPARATED = bytes(
    c if c >= 128 or c in _TERM else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of about `PIECE` bytes."""
    text = text.translate(_SEPARATED)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _item_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(item_id, terms): the distinct terms of each item that has some."""
    source = items.select(F.col(id_column).alias("item_id"), F.col(text_column).cast("string").cast("binary").alias("text"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t for part in terms(x.as_py() or b"") for t in part}) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    kind = items.schema[id_column].dataType.simpleString()
    return source.mapInArrow(distinct, f"item_id {kind}, terms array<binary>").filter(F.size("terms") > 0)


def _bags(docs: DataFrame, number, id_column: str, text_column: str) -> DataFrame:
    """(id, n, bag) of each document with terms: how many it has, and its pairs of 32-bit (term, count), sorted."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = number.value.get
        for batch in batches:
            sizes, bags = [], []
            for x in batch.column(1):
                n, seen = 0, Counter()
                for part in terms(x.as_py() or b""):
                    n += len(part)
                    seen.update(map(get, part))
                seen.pop(None, None)
                sizes.append(n)
                bags.append(np.array(sorted(seen.items()), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], ["id", "n", "bag"])

    kind = docs.schema[id_column].dataType.simpleString()
    return source.mapInArrow(count, f"id {kind}, n long, bag binary").filter("n > 0")


def _bag_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and counts of many bags one after another, and where each bag begins."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    pairs = np.frombuffer(column.buffers()[2], "<u4", (offsets[-1] - offsets[0]) // 4, offsets[0]).astype(np.int64)
    return pairs[0::2], pairs[1::2], (offsets - offsets[0]) // 8


def _document_frequencies(bags: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary: added up in each task, then over tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_bag_arrays(batch.column(0))[0], minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    found = bags.select("bag").filter("length(bag) > 0").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[found["term"].to_numpy()] = found["df"].to_numpy()
    return df


def _weights(spark, df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) for each document frequency that occurs."""
    values = np.unique(df)
    rows = spark.createDataFrame([(int(v),) for v in values], "df long")
    w = F.floor(1000 * F.log((2 * F.lit(n_docs).cast("double") + 2) / (2 * F.col("df").cast("double") + 1))).cast("long")
    by_df = {r.df: r.w for r in rows.select("df", w.alias("w")).collect()}
    return np.array([by_df[int(v)] for v in values], np.int64)[np.searchsorted(values, df)]


def _slices(batch: pa.RecordBatch, place: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose bags have about `BAGS` bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BAGS, "right")))
        yield batch.slice(at, to - at)
        at = to


def _scored(classes: DataFrame, model, k: int, kind: str) -> DataFrame:
    """(item, score, first, ids): of each task's classes the best of each item, ties by least member."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = model.value
        chosen = np.zeros(len(weights), bool)
        best = [np.zeros(0, np.int64)] * len(items)
        for batch in (part for whole in batches for part in _slices(whole, 1)):
            term, tf, starts = _bag_arrays(batch.column(1))
            m = np.repeat(batch.column(0).to_numpy(), np.diff(starts))
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            by_first = pc.rank(batch.column(2), "ascending", null_placement="at_end", tiebreaker="first").to_numpy().astype(np.int64)
            rows, scores, owners = [], [], []
            for i, own in enumerate(items):
                chosen[own] = True
                total = np.add.reduceat(np.where(chosen[term], impact, 0), starts[:-1])
                chosen[own] = False
                least = best[i][0] if len(best[i]) == k else 1
                at = np.flatnonzero(total >= max(1, least))
                if not len(at):
                    continue
                at = at[np.lexsort((by_first[at], -total[at]))[:k]]
                best[i] = np.sort(np.concatenate([best[i], total[at]]))[-k:]
                rows.append(at)
                scores.append(total[at])
                owners.append(np.full(len(at), i, np.int32))
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(owners)), pa.array(np.concatenate(scores)), batch.column(2).take(at), batch.column(3).take(at)],
                    ["item", "score", "first", "ids"],
                )

    return classes.select("m", "bag", "first", "ids").mapInArrow(score, f"item int, score long, first {kind}, ids array<{kind}>")


def _block(docs: DataFrame, block: list, id_column: str, text_column: str, k: int, item_type) -> DataFrame | None:
    """The results for a block of (item_id, terms)."""
    spark = ship(docs.sparkSession)
    scratch = Scratch(spark, "ranking")
    number: dict[bytes, int] = {}
    own = [np.array([number.setdefault(bytes(t), len(number)) for t in r.terms], np.int64) for r in block]
    vocabulary = spark.sparkContext.broadcast(number)
    bags = scratch.cut(_bags(docs, vocabulary, id_column, text_column))
    vocabulary.destroy()
    n_docs, length = bags.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    model = spark.sparkContext.broadcast((_weights(spark, _document_frequencies(bags, len(number)), n_docs), own))

    kind = docs.schema[id_column].dataType.simpleString()
    norm = F.expr(f"cast(100 - 50 + ((50 * cast(n AS decimal(20,0)) * cast({n_docs} AS decimal(12,0))) div cast({length} AS decimal(20,0))) AS bigint)")
    rows = bags.filter("length(bag) > 0").select("id", norm.alias("m"), "bag", F.xxhash64("bag", norm).alias("hash"))
    of_class = ["hash", "m", "bag"]
    place = F.row_number().over(Window.partitionBy(*of_class).orderBy(F.col("id").asc_nulls_last()))
    members = rows.withColumn("place", place).filter(F.col("place") <= k)
    ids = F.transform(F.sort_array(F.collect_list(F.struct("place", "id"))), lambda x: x["id"])
    classes = members.groupBy(*of_class).agg(ids.alias("ids")).withColumn("first", F.col("ids")[0])
    first = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("first").asc_nulls_last()))
    best = _scored(classes, model, k, kind).withColumn("place", first).filter(F.col("place") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    expanded = best.select("item", "score", F.explode("ids").alias("id")).withColumn("rank", rank).filter(F.col("rank") <= k)
    schema = StructType([StructField("item", LongType()), StructField("item_id", item_type)])
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], schema)
    found = scratch.cut(expanded.join(F.broadcast(names), "item").select("item_id", "rank", "id", "score"))
    model.destroy()
    scratch.release(bags)
    return found


def ranked(
    docs: DataFrame, items: DataFrame, k: int = K, id_column: str = "doc_id", text_column: str = "text",
    item_id_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """(item_id, rank, id, score): each item's k best documents with a score above 0, equal scores by ascending id."""
    spark = ship(docs.sparkSession)
    queries = Scratch(spark, "items").cut(_item_terms(items, item_id_column, item_text_column))
    kind = docs.schema[id_column].dataType.simpleString()
    item_type = items.schema[item_id_column].dataType
    results: list[DataFrame] = []
    block: list = []
    held: set[bytes] = set()
    for row in chain(queries.toLocalIterator(), [None]):
        if block and (row is None or len(block) == BLOCK_ITEMS or len(held) + len(row.terms) > BLOCK_TERMS):
            found = _block(docs, block, id_column, text_column, k, item_type)
            results += [found] if found is not None else []
            block, held = [], set()
        if row is not None:
            block.append(row)
            held.update(bytes(t) for t in row.terms)
    if not results:
        return spark.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, id {kind}, score long")
    return reduce(DataFrame.unionAll, results)

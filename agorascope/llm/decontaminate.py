"""Benchmark decontamination by Wu-Manber search over words.

Test strings are the windows of `window` words of the benchmark's items (an item with fewer words is one string). Strings
of one length m form one table set:

- a shift table over blocks of two words: how far a search position may move because no string holds the block nearer
  to its end (m - 1 where no string holds it at all),
- buckets by the hash of a string's last block, told apart by the hash of its first,
- the strings, compared word by word, byte for byte, before an occurrence counts.

The words of a batch of texts are searched in parallel lanes: each lane jumps by the shift at its position, all lanes at
once in numpy. Texts are read where they lie; nothing is shuffled. The benchmark is taken in blocks of `BLOCK_BYTES` of
text, so that what a task holds stays bounded when it grows; blocks follow one another in one pass over the texts.

Null texts and items have no words and hit nothing. Repeated items count once by id (items without one together once, last in
the list), repeated rows each get their row.
Empty tables give no rows, an empty benchmark no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm import exchange as X
from agorascope.llm import words as W
from agorascope.llm.ship import ship

WINDOW = 10
BLOCK_BYTES = 4 << 20
LANE = 256
_TABLE_BITS = 18


@dataclass
class Strings:
    """The test strings of `size` words: hashes of their words, their bytes, and the items that hold each."""

    size: int
    hashes: np.ndarray
    texts: list[bytes]
    items: list[list[int | None]]
    shift: np.ndarray
    order: np.ndarray
    keys: np.ndarray

    @property
    def block(self) -> int:
        return min(2, self.size)


def _block_hash(hashes: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    """The hash of the `block` words that end at `at`."""
    out = hashes[at]
    if block == 2:
        out = out + W.mix(hashes[at - 1])
    return W.mix(out)


def _bucket_key(last: np.ndarray, first: np.ndarray) -> np.ndarray:
    return W.mix(last ^ W.mix(first))


def _ordered(items: set[int | None]) -> list[int | None]:
    return sorted(items, key=lambda i: (i is None, i))


def compile_strings(items: list[tuple[int | None, str]], window: int = WINDOW) -> list[Strings]:
    """The tables of all strings of these items, by length."""
    by_size: dict[int, dict[bytes, tuple[np.ndarray, set[int | None]]]] = {}
    for item, text in items:
        raw = (text or "").encode()
        words = W.split(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), W.ALNUM, lower=True)
        n = len(words.starts)
        if not n:
            continue
        parts = [words.data[a:b].tobytes() for a, b in zip(words.starts, words.ends, strict=True)]
        size = min(n, window)
        for i in range(n - size + 1):
            found = by_size.setdefault(size, {}).setdefault(b" ".join(parts[i : i + size]), (words.hashes[i : i + size], set()))
            found[1].add(item)
    out = []
    for size, strings in sorted(by_size.items()):
        hashes = np.array([h for h, _ in strings.values()], np.uint64).reshape(-1, size)
        block = min(2, size)
        shift = np.full(1 << _TABLE_BITS, size - block + 1, np.uint8 if size < 256 else np.int32)
        for end in range(block - 1, size):
            slots = _slot(_block_hash(hashes.T, np.array([end]), block)[0])
            np.minimum.at(shift, slots, size - 1 - end)
        keys = _bucket_key(
            _block_hash(hashes.T, np.array([size - 1]), block)[0], _block_hash(hashes.T, np.array([block - 1]), block)[0]
        )
        order = np.argsort(keys, kind="stable")
        out.append(Strings(size, hashes, list(strings), [_ordered(x) for _, x in strings.values()], shift, order, keys[order]))
    return out


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _candidates(hashes: np.ndarray, first: np.ndarray, strings: Strings) -> np.ndarray:
    """The positions of last words where the shift is 0, found by jumping lanes."""
    low = np.minimum(first[:-1] + strings.size - 1, first[1:])
    count = -(-(first[1:] - low) // LANE)
    lane = np.repeat(low, count) + LANE * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    stop = np.minimum(lane + LANE, np.repeat(first[1:], count))
    found = []
    at = lane
    while len(at):
        move = strings.shift[_slot(_block_hash(hashes, at, strings.block))].astype(np.int64)
        found.append(at[move == 0])
        at = at + np.maximum(move, 1)
        left = at < stop
        at, stop = at[left], stop[left]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def find(words: W.Words, strings: Strings) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences: the place of the first word, and the number of the string."""
    none = np.zeros(0, np.int64)
    at = _candidates(words.hashes, words.first, strings) if len(words.hashes) else none
    if not len(at):
        return none, none
    begin = at - strings.size + 1
    keys = _bucket_key(
        _block_hash(words.hashes, at, strings.block), _block_hash(words.hashes, begin + strings.block - 1, strings.block)
    )
    low, high = np.searchsorted(strings.keys, keys, "left"), np.searchsorted(strings.keys, keys, "right")
    count = high - low
    begin = np.repeat(begin, count)
    which = strings.order[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    equal = np.ones(len(begin), bool)
    for k in range(strings.size):
        equal &= words.hashes[begin + k] == strings.hashes[which, k]
    begin, which = begin[equal], which[equal]
    data, starts, ends = words.data, words.starts, words.ends
    sure = np.fromiter(
        (
            b" ".join([data[starts[k] : ends[k]].tobytes() for k in range(b, b + strings.size)]) == strings.texts[w]
            for b, w in zip(begin.tolist(), which.tolist(), strict=True)
        ),
        bool,
        len(begin),
    )
    return begin[sure], which[sure]


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size."""
    items = benchmark.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    items = items.filter("text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // BLOCK_BYTES))
    for k in range(n):
        yield [(r.id, r.text) for r in items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).toLocalIterator()]


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """All columns of `docs`, with `n_words`, `n_hit` (words in occurrences) and `items` (sorted ids that occur).

    Columns of `docs` that have one of these names are replaced.
    """
    spark = ship(docs.sparkSession)
    outputs = ("n_words", "n_hit", "items")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in outputs and c != text_column])
    mask = X.free_name(docs, "hit_mask")
    state = docs.withColumn(mask, F.lit(None).cast("binary")).withColumn("n_words", F.lit(0).cast("long"))
    state = state.withColumn("n_hit", F.lit(0).cast("long")).withColumn("items", F.lit(None).cast("array<bigint>"))
    for block in _blocks(benchmark, item_column, item_text_column):
        tables = spark.sparkContext.broadcast(compile_strings(block, window))

        def search(batches: Iterator[pa.RecordBatch], tables=tables) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in W.pieces(batch, text_column):
                    yield _searched(piece, text_column, mask, tables.value)

        state = state.mapInArrow(search, state.schema)
    return state.drop(mask)


def _searched(piece: pa.RecordBatch, column: str, mask: str, tables: list[Strings]) -> pa.RecordBatch:
    """A piece with the hits of these tables added to those it has."""
    at = {name: piece.schema.get_field_index(name) for name in (column, mask, "n_words", "n_hit", "items")}
    words = W.split(*W.text_buffers(piece.column(at[column])), W.ALNUM, lower=True)
    n, rows = len(words.hashes), piece.num_rows
    before, items = piece.column(at[mask]).to_pylist(), [set(x or ()) for x in piece.column(at["items"]).to_pylist()]
    change = np.zeros(n + 1, np.int64)
    for strings in tables:
        begin, which = find(words, strings)
        np.add.at(change, begin, 1)
        np.add.at(change, begin + strings.size, -1)
        for d, w in zip((np.searchsorted(words.first, begin, "right") - 1).tolist(), which.tolist(), strict=True):
            items[d].update(strings.items[w])
    hit = np.cumsum(change)[:n] > 0
    masks: list[bytes | None] = []
    for d, old in enumerate(before):
        own = hit[words.first[d] : words.first[d + 1]]
        if old is not None:
            own |= np.unpackbits(np.frombuffer(old, np.uint8), count=len(own)).astype(bool)
        masks.append(np.packbits(own).tobytes() if items[d] else None)
    sums = np.append(0, np.cumsum(hit))
    new = {
        mask: pa.array(masks, pa.binary()),
        "n_words": pa.array(np.diff(words.first), pa.int64()),
        "n_hit": pa.array(sums[words.first[1:]] - sums[words.first[:-1]], pa.int64()),
        "items": pa.array([_ordered(x) for x in items], pa.list_(pa.int64())),
    }
    columns = [new.get(name, piece.column(k)) for k, name in enumerate(piece.schema.names)]
    assert rows == len(masks)
    return pa.RecordBatch.from_arrays(columns, names=piece.schema.names)

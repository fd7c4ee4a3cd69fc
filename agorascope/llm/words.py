"""Words of Arrow text columns as numpy arrays: byte positions and 64-bit hashes, without a Python object per word.

Texts of any length are worked through in blocks of bytes, so that memory per byte is bounded by `BLOCK`
and only what is kept per word (16 bytes) grows with the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
PIECE = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def _word_bytes(pieces: str) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in (p.split("-") for p in pieces.split()):
        table[int(low, 16) : int(high, 16) + 1] = True
    return table


#: Bytes of words [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (every byte of a non-ASCII character is one).
SPACED = _word_bytes("00-08 0E-1F 21-FF")
ALNUM = _word_bytes("30-39 61-7A 80-FF")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _inverse(x: np.uint64) -> np.uint64:
    return np.uint64(pow(int(x), -1, 1 << 64))


_CACHE: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: np.uint64, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or of its inverse."""
    key = (int(base), inverse)
    have = _CACHE.get(key)
    if have is None or len(have) < n:
        have = _powers(_inverse(base) if inverse else base, max(n, BLOCK + 1))
        if n <= 4 * BLOCK:
            _CACHE[key] = have
    return have[:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind, width = (np.int64, 8) if wide else (np.int32, 4)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, n + 1, column.offset * width).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of n texts: text d has the words `first[d]` to `first[d + 1]`."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def grams(self, size: int) -> np.ndarray:
        """The hash of the `size` words from each word on; of use only where `whole(size)` holds."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(0, np.uint64)
        return gram_hashes(self.hashes, size)

    def whole(self, size: int) -> np.ndarray:
        """Whether the `size` words from each word on belong to one text (one entry for each of `grams`)."""
        n = len(self.hashes)
        if n < size:
            return np.zeros(0, bool)
        last = np.repeat(self.first[1:], np.diff(self.first))[: n - size + 1]
        return np.arange(n - size + 1) + size <= last


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` consecutive entries."""
    n = len(hashes) - size + 1
    total = hashes[:n].copy()
    factor = _GRAM
    for k in range(1, size):
        total += hashes[k : n + k] * factor
        factor = np.uint64(int(factor) * int(_GRAM) & 0xFFFFFFFFFFFFFFFF)
    return mix(total)


def split(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = SPACED, lower: bool = False) -> Words:
    """The words of texts that lie one after another in `data`."""
    if lower:
        data = LOWER[data]
    inside = kind[data]
    size = len(data)
    edge = np.empty(size + 1, bool)
    if size:
        edge[0] = inside[0]
        edge[-1] = inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < size)]
        glued = np.unique(cut[inside[cut] & inside[cut - 1]])
    else:
        edge[:] = False
        glued = np.zeros(0, np.int64)
    flips = np.flatnonzero(edge)
    starts, ends = flips[0::2], flips[1::2]
    if len(glued):
        starts = np.sort(np.concatenate([starts, glued]))
        ends = np.sort(np.concatenate([ends, glued]))
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, first, _hash(data, starts, ends))


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    at, n = 0, len(starts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        sums = np.zeros(high - low + 1, np.uint64)
        values = data[low:high].astype(np.uint64)
        values += np.uint64(1)
        values *= powers(_BASE, high - low)
        np.cumsum(values, out=sums[1:])
        begin = starts[at:to] - low
        total = sums[ends[at:to] - low] - sums[begin]
        out[at:to] = total * powers(_BASE, high - low + 1, inverse=True)[begin]
        at = to
    return mix(out)


def hash_word(word: bytes) -> int:
    """The hash of one word, as `split` gives it."""
    data = np.frombuffer(word, np.uint8)
    return int(_hash(data, np.array([0]), np.array([len(data)]))[0])


def pieces(batch: pa.RecordBatch | pa.Table, column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of whole rows whose texts have about `limit` bytes; a longer text is a slice of its own."""
    if isinstance(batch, pa.Table):
        for part in batch.to_batches():
            yield from pieces(part, column, limit)
        return
    _, offsets = text_buffers(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to

"""Words of Arrow text columns, taken apart inside a task a few texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def flat(words: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and where each text begins and the last one ends."""
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    return words.flatten(), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def blocks(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """The texts in runs of about `size` bytes; a longer text is a run of its own."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(upto // size)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(texts)], strict=True):
        yield texts.slice(start, end - start)


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The white-space words of all texts, as `flat` gives them."""
    words, starts = flat(pc.utf8_split_whitespace(texts))
    kept = pc.greater(pc.binary_length(words), 0)
    return words.filter(kept), np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])[starts]


def runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The runs of letters, digits and underscores of lower-case texts, of any length, as `flat` gives them.

    A white-space word of letters and digits is one as it is, all others are taken apart.
    """
    words, starts = pieces(texts)
    plain = pc.utf8_is_alnum(words)
    parts, first = flat(pc.split_pattern_regex(words.filter(pc.invert(plain)), pattern=r"[^\p{L}\p{N}_]+"))
    whole = plain.to_numpy(zero_copy_only=False)
    counts = np.ones(len(words), np.int64)
    counts[~whole] = np.diff(first)
    begin = np.concatenate([[0], np.cumsum(counts)])
    own = int(whole.sum())
    order = np.empty(begin[-1], np.int64)
    order[begin[:-1][whole]] = np.arange(own)
    order[np.repeat(begin[:-1][~whole] - first[:-1], np.diff(first)) + np.arange(len(parts))] = own + np.arange(len(parts))
    return pa.concat_arrays([words.filter(plain), parts]).take(pa.array(order)), begin[starts]

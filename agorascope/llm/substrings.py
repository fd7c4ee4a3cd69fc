"""Substring dedup by repeated-phrase automata.

A window is `window` consecutive words of one document. A word goes if a window over it has a word sequence that also
starts earlier: in a document with a smaller id, or earlier in the same one.

1. Anchors: the least hash among the 4-word runs of a window. Equal windows have equal anchors, and neighbouring windows
   mostly share theirs, so about one anchor for nine words is counted; a window whose anchor occurs once is unique.
2. Confirming: windows with a recurring anchor are counted by 128 bits (own hash and anchor), with the first place of
   each. What recurs makes the recurring passages: maximal runs of recurring windows.
3. Automata: one Aho-Corasick automaton of word numbers for each shard (a chunk of documents), of the passages that the
   shard can hold. All documents stream through the automaton of their shard, which locates every occurrence of every
   passage; of these, the windows at their first place stay.

Steps 1 and 2 ask for counts by `exchange`; texts are never shuffled by a key of their content, so neither hot
phrases nor groups of copies meet in one task. Replies are written to the shared folder, which cuts the lineage.

Null texts have no words. Rows with the same id are one document's: each is judged against smaller ids and against
earlier places, so a repeated row does not remove its own copy. Rows without an id come last. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm import exchange as X
from agorascope.llm import words as W
from agorascope.llm.ship import ship
from agorascope.operators.lineage import cut

WINDOW = 20
GRAM = 4
_REPLY = "chunk long, kind int, bucket int, keys binary, flags binary"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _anchored(words: W.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows, the text of each, and the anchor of each."""
    at = np.flatnonzero(words.whole(window))
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    size = min(GRAM, window)
    anchors = _sliding_min(words.grams(size), window - size + 1)[at]
    return at, words.owner()[at], anchors


def _periodic(words: W.Words, window: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """1 where the windows from `first` to `last`, of one anchor, may hold it twice: some run of words recurs in reach."""
    size = min(GRAM, window)
    grams, reach = words.grams(size), window - size + 1
    near = np.zeros(len(grams), bool)
    for lag in range(1, reach):
        near[lag:] |= grams[lag:] == grams[:-lag]
    count = np.append(0, np.cumsum(near))
    long = last - first >= reach
    return ((count[np.minimum(last + reach, len(grams))] > count[first]) | long).astype(np.int64)


def _split(piece: pa.RecordBatch, column: str) -> W.Words:
    return W.split(*W.text_buffers(piece.column(piece.schema.get_field_index(column))))


def repeated_words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """All columns of `docs`, with `kept_text` (words that stay, joined by one space), `n_words` and `n_removed`.

    Columns of `docs` that have one of these three names are replaced.
    """
    spark = ship(docs.sparkSession)
    outputs = ("kept_text", "n_words", "n_removed")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in outputs and c not in (id_column, text_column)])
    chunk = X.free_name(docs, "chunk")
    docs = docs.withColumn(chunk, X.chunk_of(id_column))
    buckets = X.n_buckets(spark)

    def count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for piece in W.pieces(batch, "text"):
                words = _split(piece, "text")
                at, owner, anchors = _anchored(words, window)
                starts = X.starts_of(owner, anchors)
                again = _periodic(words, window, at[starts], at[np.append(starts[1:], len(at)) - 1]) if len(at) else starts
                found.append((np.asarray(piece.column(0))[owner[starts]], anchors[starts], 1 + again))
            chunks, keys, n = (np.concatenate(x) for x in zip(*found, strict=True)) if found else ([], [], [])
            if not len(keys):
                continue
            bucket = X.bucket_of(keys, buckets)
            order = np.lexsort((keys, bucket, chunks))
            chunks, bucket, keys, n = chunks[order], bucket[order], keys[order], n[order]
            starts = X.starts_of(chunks, bucket, keys)
            n = np.minimum(np.add.reduceat(n, starts), 2).astype(np.uint8)
            chunks, bucket, keys = chunks[starts], bucket[starts], keys[starts]
            table = X.packed((bucket, chunks), (keys, n), X.starts_of(chunks, bucket), ("bucket", "chunk", "keys", "counts"))
            yield from table.to_batches()

    def recurring_anchors(table: pa.Table) -> pa.Table:
        keys, row = X.unpacked(table["keys"], np.uint64)
        counts, _ = X.unpacked(table["counts"], np.uint8)
        distinct, code = np.unique(keys, return_inverse=True)
        many = (np.bincount(code, counts, len(distinct)) >= 2)[code]
        keys, row = keys[many], row[many]
        of = table["chunk"].to_numpy()[row]
        order = np.lexsort((keys, of))
        keys, of = keys[order], of[order]
        out = X.packed((of,), (keys,), X.starts_of(of), ("chunk", "keys"))
        n = out.num_rows
        return pa.table(
            [out["chunk"].cast(pa.int64()), pa.array([0] * n, pa.int32()), pa.array([0] * n, pa.int32()), out["keys"], pa.array([b""] * n, pa.binary())],
            names=["chunk", "kind", "bucket", "keys", "flags"],
        )

    def candidates(table: pa.Table, replies: pa.Table, columns: tuple[str, str]):
        """The documents of a chunk with their windows that may recur, and those windows' distinct sequences."""
        known, _ = X.unpacked(replies.filter(pc.equal(replies["kind"], 0))["keys"], np.uint64)
        known = np.unique(known)
        found, parts = [], []
        for piece in W.pieces(table, columns[1]):
            words = _split(piece, columns[1])
            at, owner, anchors = _anchored(words, window)
            if len(known):
                may = known[np.minimum(np.searchsorted(known, anchors), len(known) - 1)] == anchors
                at, owner, anchors = at[may], owner[may], anchors[may]
            else:
                at, owner, anchors = at[:0], owner[:0], anchors[:0]
            ids = X.id_values(piece.column(piece.schema.get_field_index(columns[0])))
            keys = W.gram_hashes(words.hashes, window)[at] if len(at) else anchors
            found.append((keys, anchors, ids[owner], at - words.first[owner]))
            parts.append((piece, words, at))
        if not found:
            return parts, None
        keys, anchors, ids, places = (np.concatenate(x) for x in zip(*found, strict=True))
        anchors = (anchors & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        bucket = X.bucket_of(keys, buckets)
        order = np.lexsort((places, ids, anchors, keys, bucket))
        starts = X.starts_of(bucket[order], keys[order], anchors[order])
        entry = np.empty(len(order), np.int64)
        entry[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
        least = order[starts]  # the first place of each within the chunk
        n = np.diff(np.append(starts, len(order)))
        same_place = np.zeros(len(order), bool)  # repeated rows of one id count once
        if len(order):
            same_place[1:] = (ids[order][1:] == ids[order][:-1]) & (places[order][1:] == places[order][:-1])
            same_place[starts] = False
            n = n - np.add.reduceat(same_place.astype(np.int64), starts)
        return parts, (keys, anchors, ids, places, bucket, entry, least, n)

    def window_entries(table: pa.Table, replies: pa.Table) -> pa.Table:
        names = ("bucket", "chunk", "keys", "anchors", "counts", "ids", "places")
        _, found = candidates(table, replies, ("id", "text"))
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
        if found is None or not len(found[6]):
            return pa.table([pa.array([], k) for k in kinds], names=list(names))
        keys, anchors, ids, places, bucket, _, least, n = found
        number = table[0][0].as_py()
        relative = (ids[least] - number * X.CHUNK).astype(np.uint16)
        out = X.packed(
            (bucket[least],),
            (keys[least], anchors[least], np.minimum(n, 2).astype(np.uint8), relative, places[least].astype(np.uint32)),
            X.starts_of(bucket[least]),
            ("bucket", *names[2:]),
        )
        return out.add_column(1, "chunk", pa.array([number] * out.num_rows, pa.int64()))

    def recurring_windows(table: pa.Table) -> pa.Table:
        keys, row = X.unpacked(table["keys"], np.uint64)
        anchors, _ = X.unpacked(table["anchors"], np.uint32)
        counts, _ = X.unpacked(table["counts"], np.uint8)
        ids, _ = X.unpacked(table["ids"], np.uint16)
        places, _ = X.unpacked(table["places"], np.uint32)
        chunks = table["chunk"].to_numpy()
        order = np.lexsort((places, ids, chunks[row], anchors, keys))
        starts = X.starts_of(keys[order], anchors[order])
        many = np.add.reduceat(counts[order].astype(np.int64), starts) >= 2
        flags = np.zeros(len(order), np.uint8)
        flags[order] = np.repeat(many, np.diff(np.append(starts, len(order))))
        flags[order[starts]] |= 2  # here is the first place of all
        ends = np.cumsum(np.bincount(row, minlength=table.num_rows))
        raw = flags.tobytes()
        blobs = [raw[a:b] for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]
        n = table.num_rows
        return pa.table(
            [table["chunk"], pa.array([1] * n, pa.int32()), table["bucket"], pa.array([b""] * n, pa.binary()), pa.array(blobs, pa.binary())],
            names=["chunk", "kind", "bucket", "keys", "flags"],
        )

    def strip(table: pa.Table, replies: pa.Table) -> pa.Table:
        parts, found = candidates(table, replies, (id_column, text_column))
        batches = []
        if found is not None:
            keys, anchors, ids, places, bucket, entry, least, n = found
            told = replies.filter(pc.equal(replies["kind"], 1)).sort_by("bucket")
            flags, _ = X.unpacked(told["flags"], np.uint8)
            if len(flags) != len(least):
                raise ValueError("the documents changed while they were read")
            flags = flags[entry] if len(entry) else np.zeros(0, np.uint8)
            first = (flags & 2 > 0) & (ids == ids[least][entry]) & (places == places[least][entry]) if len(entry) else flags > 0
            done = 0
            jobs = []
            for piece, words, at in parts:
                part = slice(done, done + len(at))
                jobs.append((piece, words, at, flags[part] & 1 > 0, first[part]))
                done += len(at)
            machine, number = _automaton(jobs, window)
            for piece, words, at, _, stays in jobs:
                batches.append(_without(piece, text_column, words, _located(machine, number, words, window), at[stays], window))
        empty = table.slice(0, 0)
        for name, kind in zip(outputs, (pa.string(), pa.int64(), pa.int64()), strict=True):
            empty = empty.append_column(name, pa.array([], kind))
        out = pa.Table.from_batches(batches) if batches else empty
        return out.drop_columns([chunk])

    narrow = docs.select(F.col(chunk).alias("chunk"), F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    blob = "bucket int, chunk long, keys binary, counts binary"
    sent = narrow.select("chunk", "text").mapInArrow(count_anchors, blob)
    anchors = cut(sent.groupBy("bucket").applyInArrow(recurring_anchors, _REPLY), "anchors")
    entries = (
        narrow.groupBy("chunk").cogroup(anchors.groupBy("chunk"))
        .applyInArrow(window_entries, "bucket int, chunk long, keys binary, anchors binary, counts binary, ids binary, places binary")
    )
    masks = cut(entries.groupBy("bucket").applyInArrow(recurring_windows, _REPLY), "windows")
    kept = [f for f in docs.schema.fields if f.name != chunk]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", kept_text string, n_words long, n_removed long"
    return docs.groupBy(chunk).cogroup(anchors.unionByName(masks).groupBy("chunk")).applyInArrow(strip, schema)


def _automaton(jobs: list, window: int):
    """The automaton of a shard's recurring passages, and the numbers of the words that occur in them."""
    spans = []
    for j, (_, words, at, recurs, _) in enumerate(jobs):
        at = at[recurs]
        if not len(at):
            continue
        owner = np.searchsorted(words.first, at, "right")
        starts = X.starts_of(owner, at - np.arange(len(at)))
        ends = np.append(starts[1:], len(at)) - 1
        spans += [(j, a, b) for a, b in zip(at[starts].tolist(), (at[ends] + window).tolist(), strict=True)]
    if not spans:
        return None, None
    number = np.unique(np.concatenate([jobs[j][1].hashes[a:b] for j, a, b in spans]))
    machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for passage in {np.searchsorted(number, jobs[j][1].hashes[a:b]).astype(np.uint32).tobytes() for j, a, b in spans}:
        numbers = tuple(np.frombuffer(passage, np.uint32).tolist())
        machine.add_word(numbers, len(numbers))
    machine.make_automaton()
    return machine, number


def _located(machine, number: np.ndarray | None, words: W.Words, window: int) -> np.ndarray:
    """Whether a window that begins at a word lies in an occurrence of a passage."""
    n = len(words.hashes)
    change = np.zeros(n + 1, np.int64)
    if machine is not None and n:
        code = np.searchsorted(number, words.hashes)
        code[number[np.minimum(code, len(number) - 1)] != words.hashes] = len(number)
        # A word outside all passages keeps the end of one text and the start of the next apart.
        gap = np.insert(code, words.first[1:-1], len(number)) if len(words.first) > 2 else code
        place = np.arange(n)
        if len(words.first) > 2:
            place = np.insert(place, words.first[1:-1], -1)
        hits = [(end, size) for end, size in machine.iter(tuple(gap.tolist()))]
        if hits:
            ends, sizes = np.array(hits).T
            ends = place[ends]
            np.add.at(change, ends - sizes + 1, 1)
            np.add.at(change, ends - window + 2, -1)
    return np.cumsum(change)[:n] > 0


def _without(
    piece: pa.RecordBatch, column: str, words: W.Words, located: np.ndarray, stays: np.ndarray, window: int
) -> pa.RecordBatch:
    n = len(words.hashes)
    starts = located.copy()
    starts[stays] = False
    begin = np.flatnonzero(starts)
    change = np.bincount(begin, minlength=n + 1) - np.bincount(np.minimum(begin + window, n), minlength=n + 1)
    gone = np.cumsum(change)[:n] > 0
    before = np.append(0, np.cumsum(gone))
    total, removed = np.diff(words.first), before[words.first[1:]] - before[words.first[:-1]]
    texts, raw = [], words.data.tobytes()
    keep = ~gone
    for d in range(piece.num_rows):
        own = raw[words.offsets[d] : words.offsets[d + 1]].split()
        if removed[d]:
            own = compress(own, keep[words.first[d] : words.first[d + 1]].tolist())
        texts.append(b" ".join(own).decode())
    for name, values, kind in (("kept_text", texts, pa.string()), ("n_words", total, pa.int64()), ("n_removed", removed, pa.int64())):
        piece = piece.append_column(name, pa.array(values, kind))
    return piece

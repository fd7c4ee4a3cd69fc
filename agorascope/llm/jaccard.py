"""N-gram Jaccard join by multiple-global-order filtering.

A document's set holds the distinct hashes (64 bits) of its 5-word shingles. Two sets x, y with
|x & y| >= t * |x | y| share at least one of the first |x| - ceil(t * |x|) + 1 tokens of x and as many of y, whatever
global order the tokens are put in. Every order used here puts tokens of fewer documents first (by the power of two of
their number); the orders differ in how they scramble tokens of one power.

1. Frequencies: every chunk of documents sends its distinct tokens (40 bits besides the bucket's number) by `exchange`
   and is told those that more than one document holds, with their class of frequency. Two tokens taken for one only
   raise a class, alike for all documents.
2. First order: a document's prefix. Its tokens of a single document can be shared with none, so a document of which a
   quarter is its own has no token left and is linked with nothing. The tokens of the others are what pairs are made from.
3. Pairs are made losslessly for *components*, not for every link: in the block of a token each set meets one leader
   (first the set with the least share of tokens of its own, as the original of edited copies has; then others); sets
   found linked become one class; a block whose sets are all of one class is done. This repeats until the pairs between
   different classes that are left in blocks are few against the sets, or a round takes less than a fifth of them; those that are left are all tested, where the token can be the first that the two share by its
   place in both and by their sizes. So a group of n near copies costs about n tests, and no link between two classes
   is missed.
4. A pair must share prefix tokens in each of the other orders as well before its sets are compared in full.

Links are exact. `component_id` is the least id that links reach.

Documents without words (or null) have the empty set and are linked with nothing. Documents with the same set are one
node, and so are rows with the same id. Rows without an id count as the last id, and their component is null if it has
no other. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm import exchange as X
from agorascope.llm import words as W
from agorascope.llm.components import components
from agorascope.llm.ship import ship
from agorascope.operators.lineage import Scratch, cut

SIZE = 5
PERCENT = 75
#: What scrambles the tokens in the other global orders (fixed values).
ORDERS = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Rounds of leaders go on while the pairs left between classes exceed this many for each set.
PAIRS_PER_SET = 4
#: The ids of the sets to be compared in a round are broadcast up to this many (8 bytes each).
BROADCAST_NODES = 500_000
_SHORT = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(piece: pa.RecordBatch, column: str, size: int = SIZE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; of a text with fewer words, one for all of them."""
    words = W.split(*W.text_buffers(piece.column(piece.schema.get_field_index(column))), W.SPACED, lower=True)
    grams, first = words.grams(size), words.first
    out = []
    for d in range(len(first) - 1):
        n = int(first[d + 1] - first[d])
        if n >= size:
            out.append(np.unique(grams[first[d] : first[d + 1] - size + 1]))
        elif n:
            out.append(W.gram_hashes(words.hashes[first[d] : first[d + 1]], n) ^ W.mix(np.array([n], np.uint64) ^ _SHORT))
        else:
            out.append(grams[:0])
    return out


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def prefix(tokens: np.ndarray, classes: np.ndarray, percent: int, order: int = 0) -> np.ndarray:
    """The places of a set's first tokens in a global order: by class of frequency, then by scrambled value."""
    rank = W.mix(tokens ^ np.uint64(order)) if order else tokens
    return np.lexsort((rank, classes))[: prefix_size(len(tokens), percent)]


def _set_id(tokens: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    with np.errstate(over="ignore"):
        parts = [W.mix(tokens ^ np.uint64(salt)).sum(dtype=np.uint64) for salt in (0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
    return np.array([*parts], np.uint64).tobytes()


def _short_keys(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each token, and 40 bits that tell it from others there."""
    scrambled = W.mix(tokens)
    return X.bucket_of(scrambled, buckets), scrambled & np.uint64(0xFFFFFFFF) | (tokens & np.uint64(0xFF)) << np.uint64(32)


def jaccard_sets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The written table (id, set_id, n, single, tokens, rests, members, classes) of all documents.

    `tokens` are the prefix tokens (first order) that another document holds and `rests` the numbers of tokens from each
    one on; `members` and `classes` are the whole set of a document that has such tokens (of equal sets in a chunk, once). `single` is the share of the
    set's tokens that no other document holds.
    """
    spark = ship(docs.sparkSession)
    narrow = docs.select(
        X.chunk_of(id_column).alias("chunk"), F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")
    )
    buckets = X.n_buckets(spark)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, "text"):
                sets = shingle_sets(piece, "text", size)
                tokens = np.concatenate(sets)
                if not len(tokens):
                    continue
                chunks = np.repeat(np.asarray(piece.column(0)), [len(s) for s in sets])
                bucket, keys = _short_keys(tokens, buckets)
                order = np.lexsort((bucket.astype(np.uint64) << np.uint64(40) | keys, chunks))
                chunks, bucket, keys = chunks[order], bucket[order], keys[order]
                starts = X.starts_of(chunks, bucket, keys)
                count = np.minimum(np.diff(np.append(starts, len(keys))), 255).astype(np.uint8)
                chunks, bucket, keys = chunks[starts], bucket[starts], keys[starts]
                low, high = keys.astype(np.uint32), (keys >> np.uint64(32)).astype(np.uint8)
                yield from X.packed(
                    (bucket, chunks), (low, high, count), X.starts_of(chunks, bucket), ("bucket", "chunk", "low", "high", "counts")
                ).to_batches()

    def answer(table: pa.Table) -> pa.Table:
        low, row = X.unpacked(table["low"], np.uint32)
        high, _ = X.unpacked(table["high"], np.uint8)
        counts, _ = X.unpacked(table["counts"], np.uint8)
        keys = high.astype(np.uint64) << np.uint64(32) | low
        order = np.argsort(keys, kind="stable")
        starts = X.starts_of(keys[order])
        total = np.add.reduceat(counts[order].astype(np.int64), starts)
        classes = np.empty(len(keys), np.uint8)
        classes[order] = np.repeat(np.log2(total).astype(np.uint8) , np.diff(np.append(starts, len(order))))
        many = np.zeros(len(keys), bool)
        many[order] = np.repeat(total > 1, np.diff(np.append(starts, len(order))))
        keys, classes, of = keys[many], classes[many], table["chunk"].to_numpy()[row[many]]
        order = np.argsort(of, kind="stable")
        keys, classes, of = keys[order], classes[order], of[order]
        out = X.packed(
            (of,), (keys.astype(np.uint32), (keys >> np.uint64(32)).astype(np.uint8), classes), X.starts_of(of), ("chunk", "low", "high", "classes")
        )
        return out.add_column(1, "bucket", pa.array([table["bucket"][0].as_py()] * out.num_rows, pa.int32()))

    def sets_of(table: pa.Table, replies: pa.Table) -> pa.Table:
        low, row = X.unpacked(replies["low"], np.uint32)
        high, _ = X.unpacked(replies["high"], np.uint8)
        told, _ = X.unpacked(replies["classes"], np.uint8)
        of = replies["bucket"].to_numpy().astype(np.uint64)[row]
        known, at = np.unique(of << np.uint64(40) | high.astype(np.uint64) << np.uint64(32) | low, return_index=True)
        told = told[at]
        told_of: set[bytes] = set()
        out: dict[str, list] = {k: [] for k in ("id", "set_id", "n", "single", "tokens", "rests", "members", "classes")}
        for piece in W.pieces(table, "text"):
            out["id"].append(piece.column(1))
            for s in shingle_sets(piece, "text", size):
                bucket, keys = _short_keys(s, buckets)
                keys = bucket.astype(np.uint64) << np.uint64(40) | keys
                classes = np.zeros(len(s), np.uint8)
                if len(known):
                    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    classes = np.where(known[at] == keys, told[at], classes)
                first = prefix(s, classes, percent)
                shared = np.flatnonzero(classes[first] > 0)
                own = _set_id(s)
                # Copies in a chunk hold their set once.
                whole = len(shared) > 0 and own not in told_of
                told_of.add(own)
                out["set_id"].append(own)
                out["n"].append(len(s))
                out["single"].append(float((classes == 0).sum()) / max(len(s), 1))
                out["tokens"].append(s[first[shared]].view(np.int64))
                out["rests"].append(len(s) - shared)
                out["members"].append(s.tobytes() if whole else None)
                out["classes"].append(classes.tobytes() if whole else None)
        ids = pa.concat_arrays(out["id"]) if out["id"] else pa.array([], pa.int64())
        kinds = [pa.binary(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.table([ids, *(pa.array(out[k], kind) for k, kind in zip(list(out)[1:], kinds, strict=True))], names=list(out))

    asked = narrow.select("chunk", "text").mapInArrow(ask, "bucket int, chunk long, low binary, high binary, counts binary")
    known = cut(asked.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, low binary, high binary, classes binary"), "frequencies")
    sets = narrow.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        sets_of, "id long, set_id binary, n long, single double, tokens array<bigint>, rests array<bigint>, members binary, classes binary"
    )
    return cut(sets, "sets")


def _members(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, set) of these nodes (distinct); the sets stay where they lie if there are few nodes."""
    few = nodes.count() <= BROADCAST_NODES
    ids = (F.broadcast(nodes) if few else nodes).withColumnRenamed("node", "set_id")
    found = sets.filter("members IS NOT NULL").select("set_id", "members", "classes").join(ids, "set_id")
    return found.groupBy(F.col("set_id").alias("node")).agg(F.first(F.struct("members", "classes")).alias("set"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share prefix tokens in all orders and are similar enough."""
    members = _members(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), sets)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for row in zip(*batch.columns[2:], strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in row[:2])
                p, q = (np.frombuffer(v.as_py(), np.uint8) for v in row[2:])
                keep.append(
                    all(len(np.intersect1d(x[prefix(x, p, percent, o)], y[prefix(y, q, percent, o)], True)) for o in ORDERS)
                    and similar(x, y, percent)
                )
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = members.select(F.col("node").alias("a"), F.col("set").alias("x"))
    right = members.select(F.col("node").alias("b"), F.col("set").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", "x.members", "y.members", "x.classes", "y.classes").toDF("a", "b", "x", "y", "p", "q").mapInArrow(check, "a binary, b binary")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * |x & y| >= percent * |x | y|, for sorted distinct tokens."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(x) + len(y) - both)


def _of_one_id(sets: DataFrame) -> DataFrame:
    """Links (a, b) between the sets of each id that has several."""
    own = sets.filter("id IS NOT NULL AND n > 0").select("id", "set_id").distinct()
    least = own.groupBy("id").agg(F.min("set_id").alias("a"), F.count("*").alias("k")).filter("k > 1")
    return own.join(least, "id").select("a", F.col("set_id").alias("b")).filter("a <> b").distinct()


def _may_link(percent: int):
    """Sizes under which two sets can be similar enough."""
    return (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")).alias("fits")


def linked_classes(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component) of the sets that are linked with others, by their set_id; sets of one id are linked."""
    scratch = Scratch(sets.sparkSession, "classes")
    with_tokens = sets.filter("members IS NOT NULL")
    chosen = with_tokens.groupBy(F.col("set_id").alias("node")).agg(
        F.first("n").alias("n"),
        F.first("single").alias("single"), F.first(F.arrays_zip("tokens", "rests")).alias("tokens"),
    )
    chosen = scratch.cut(chosen)
    count = chosen.count()
    rows = chosen.select("node", "n", "single", F.inline("tokens")).withColumnRenamed("tokens", "token").withColumnRenamed("rests", "rest")
    links = scratch.cut(_of_one_id(sets))
    labels = None if links.isEmpty() else components(links)
    tested = before = None
    turn = 0
    while True:
        now = rows.withColumn("class", F.col("node")) if labels is None else rows.join(labels, "node", "left").withColumn(
            "class", F.coalesce("component", "node")
        ).drop("component")
        now = scratch.cut(now)
        by_class = now.groupBy("token", "class").agg(F.count("*").alias("k"))
        blocks = by_class.groupBy("token").agg(F.count("*").alias("classes"), F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"))
        open_blocks = scratch.cut(blocks.filter("classes > 1"))
        left = open_blocks.agg(F.sum((F.col("k") * F.col("k") - F.col("kk")) / 2)).first()[0] or 0
        inside = now.join(open_blocks.select("token"), "token", "left_semi")
        last = left <= PAIRS_PER_SET * count or (before is not None and 1.25 * left > before)
        before = left
        if last:
            other = inside.select("token", F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("class").alias("class2"), F.col("rest").alias("rest2"))
            met = inside.join(other, "token").filter("node < node2 AND class <> class2").filter(_may_link(percent))
            met = met.filter((100 + percent) * F.least("rest", "rest2") >= percent * (F.col("n") + F.col("n2")))
            pairs = met.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()
        else:
            first = F.col("single") if turn == 0 else F.lit(0.0)
            key = F.struct(first.alias("s"), F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("node2"), F.col("n").alias("n2"), F.col("class").alias("class2"))
            leaders = inside.groupBy("token").agg(F.min(key).alias("leader")).select("token", "leader.node2", "leader.n2", "leader.class2")
            met = inside.join(leaders, "token").filter("class <> class2").filter(_may_link(percent))
            shared_tokens = met.groupBy("node", "node2").agg(F.count("*").alias("k"))
            best = shared_tokens.groupBy("node").agg(F.max(F.struct("k", "node2")).alias("best"))
            pairs = best.select(F.least("node", "best.node2").alias("a"), F.greatest("node", "best.node2").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = scratch.cut(pairs)
        found = scratch.cut(_verified(pairs, sets, percent))
        if labels is not None:  # what was linked before enters as one link a set
            links = labels.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        if labels is None or not found.isEmpty():
            labels = components(links.unionByName(found))
        tested = pairs if tested is None else tested.unionByName(pairs)
        scratch.release(now, open_blocks, found)
        if last:
            return labels
        turn += 1


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE, percent: int = PERCENT
) -> DataFrame:
    """(`id_column`, n_shingles, component_id) for each row of `docs`."""
    sets = jaccard_sets(docs, id_column, text_column, size, percent)
    linked = linked_classes(sets, percent)
    own = sets.filter("n > 0").groupBy("set_id").agg(F.min(F.coalesce("id", F.lit(X.NO_ID))).alias("least"))
    own = own.join(linked.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("group", F.coalesce("component", "set_id"))
    least = own.groupBy("group").agg(F.min("least").alias("component"))
    classes = own.select("set_id", "group").join(least, "group").select("set_id", "component")
    out = sets.select("id", "set_id", "n").join(classes, "set_id", "left")
    # A row without words goes with the other rows of its id.
    empty = sets.filter("n = 0 AND id IS NOT NULL").select("id").distinct()
    worded = sets.filter("n > 0").select("id", "set_id").distinct().join(empty, "id", "left_semi").join(classes, "set_id")
    worded = worded.groupBy("id").agg(F.min("component").alias("of_id"))
    wordless = out.filter("n = 0").join(worded, "id", "left").select("id", "n", F.col("of_id").alias("component"))
    out = out.filter("n > 0").select("id", "n", "component").unionByName(wordless)
    component = F.nullif(F.coalesce("component", "id"), F.lit(X.NO_ID))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"))

"""A prefix trie over conversations whose shared openings were restored, by the splitter skeleton.

Rebuilding: conversation c takes the first h turns of conversation c - c % 20 and its own turns after its first h, h being
crc32(c) % 4. Its path is the list of hashes of its turns (128 bits of SHA-256 over role and text); texts do not move.

The trie: conversations are ranged by (path, id) with splitters from a sample, which only balances the shards. A node is
cut by a splitter only if it lies on the splitter's path; the trie of those paths, the skeleton, is broadcast. Each shard
is sorted and walked once with a stack: nodes off the skeleton are whole there and finished, of nodes on it each shard
gives partial aggregates, which are added up over the shards; what skeleton nodes hold of each other is added up along
their ancestors. A path that many conversations share is split by id over many shards, and its ids reach their digest in
order, as packed chunks. A splitter's path is cut one turn after it leaves the path of the splitter before.

Bounds: at most `MAX_SHARDS` shards, so at most that many splitter paths are sampled times `SAMPLES` and broadcast. A
shard is streamed; of an open node off the skeleton the children wait for its least id. One conversation's hashes (16
bytes a turn) are one row: a path is as deep as its conversation is long.

Null roles and texts are empty. A null turn comes first; turns of one number are ordered by the hash of role and text, so
repeated rows are turns of their own. Rows without a conv_id belong to no conversation and are left out. An empty table
gives no nodes, not even the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.operators.lineage import Scratch
from agorascope.operators.skew import lookup_join
from agorascope.session import ship

SPACED = r"[^\x20\x09-\x0D]+"
GROUP, HEADS = 20, 4
#: Turns in a shard, about; the most shards; sampled conversations for each.
SHARD_TURNS, MAX_SHARDS, SAMPLES = 2048, 16_384, 8
#: Ids in a chunk on the way to the digest of a skeleton node, and rows that a task gives back at once.
CHUNK, ROWS = 8192, 4096

Path = tuple[bytes, ...]


def rebuilt(conversations: DataFrame, scratch: Scratch, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """(conv_id, path, words): the hash and the number of words of each turn of each rebuilt conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turn = F.struct("turn", F.unhex(F.substring(digest, 1, 32)).alias("key"), F.regexp_count(text, F.lit(SPACED)).cast("long").alias("words"))
    own = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    own = scratch.cut(own.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")))
    first = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("opening"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base", "left")
    opening = F.coalesce(F.slice("opening", F.lit(1), h), F.slice("turns", 1, 0))
    turns = F.concat(opening, F.slice("turns", h + 1, F.size("turns")))
    found = scratch.cut(joined.select("conv_id", turns.alias("turns")).select("conv_id", F.col("turns.key").alias("path"), F.col("turns.words").alias("words")))
    scratch.release(own)
    return found


def splitters(convs: DataFrame, shard_turns: int, max_shards: int) -> list[tuple[Path, float]]:
    """Where shards after the first begin: (path, id), ascending; id is -inf where the path alone decides."""
    turns, count = convs.agg(F.sum(F.size("path") + 1), F.count("*")).first()
    shards = min(max_shards, -(-(turns or 0) // shard_turns))
    if shards < 2:
        return []
    part = F.lit(max(1, count // (shards * SAMPLES)))
    sample = convs.filter(F.pmod(F.xxhash64("conv_id"), part) == 0).select("path", "conv_id").collect()
    sample = sorted((tuple(bytes(k) for k in r.path), r.conv_id) for r in sample)
    found: list[tuple[Path, float]] = []
    before: Path = ()
    for i in range(1, shards):
        if not sample:
            break
        path, conv = sample[i * len(sample) // shards]
        if path != before:
            same = next((d for d, (x, y) in enumerate(zip(path, before, strict=False)) if x != y), min(len(path), len(before)))
            begin = (path[: same + 1], float("-inf"))
        else:
            begin = (path, conv)
        if not found or begin > found[-1]:
            found.append(begin)
        before = path
    return found


class Skeleton:
    """The trie of the splitters' paths: nodes by number, 0 the root; `down[i]` maps a turn to the child of node i."""

    def __init__(self, cuts: list[tuple[Path, float]]):
        self.down: list[dict[bytes, int]] = [{}]
        self.up: list[int | None] = [None]
        self.depth = [0]
        for path, conv in cuts:
            at = 0
            for key in path if conv != float("-inf") else path[:-1]:
                if key not in self.down[at]:
                    self.down[at][key] = len(self.down)
                    self.down.append({})
                    self.up.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = self.down[at][key]

    def rows(self) -> Iterator[tuple[int, int | None, int, int, list[int]]]:
        """(node, parent, depth, children on the skeleton, itself and its ancestors)."""
        for i, up in enumerate(self.up):
            line, at = [i], up
            while at is not None:
                line.append(at)
                at = self.up[at]
            yield i, up, self.depth[i], len(self.down[i]), line


class Node:
    """An open node on the path that is walked, with what this shard holds of it."""

    __slots__ = ("key", "words", "skeleton", "conv", "n", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, key: bytes, words: int, skeleton: int | None):
        self.key, self.words, self.skeleton = key, words, skeleton
        self.conv: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.ends: list[bytes] = []
        self.waiting: list[tuple] = []


OUT = pa.schema(
    [("kind", pa.int32()), ("node", pa.int64()), ("parent_conv_id", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()),
     ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
     ("ends_sha256", pa.string()), ("words", pa.int64()), ("shard", pa.int32()), ("seq", pa.int64()), ("chunk", pa.binary())]
)
OUT_DDL = (
    "kind int, node long, parent_conv_id long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, words long, shard int, seq long, chunk binary"
)
FINISHED, PARTIAL, ENDS = 0, 1, 2


class Walk:
    """One sorted shard after another: finished nodes, partial aggregates of skeleton nodes, and chunks of their ids."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.stack: list[Node] = []
        self.shard: int | None = None
        self.out: list[tuple] = []
        self.seq = 0

    def add(self, shard: int, path: list[bytes], words: list[int], conv: int) -> None:
        if shard != self.shard:
            self.close(0)
            self.shard = shard
        if not self.stack:
            self.stack.append(Node(b"", 0, 0))
        depth = 0
        for key in path:
            if depth + 1 >= len(self.stack) or self.stack[depth + 1].key != key:
                break
            depth += 1
        self.close(depth + 1)
        for key, count in zip(path[depth:], words[depth:], strict=True):
            above = self.stack[-1].skeleton
            self.stack.append(Node(key, count, None if above is None else self.skeleton.down[above].get(key)))
        top = self.stack[-1]
        top.n += 1
        top.conv = conv if top.conv is None else min(top.conv, conv)
        top.ends.append(b"%d" % conv)
        if top.skeleton is not None and len(top.ends) == CHUNK:
            self._chunk(top)

    def close(self, depth: int) -> None:
        """Ends the open nodes from `depth` on."""
        while len(self.stack) > depth:
            node, at = self.stack.pop(), len(self.stack)
            above = self.stack[-1] if self.stack else None
            if node.skeleton is None:
                leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.words
                for row in node.waiting:
                    self.out.append((FINISHED, None, node.conv, *row))
                row = (node.conv, at, node.n, node.children, leaves, saved, hashlib.sha256(b",".join(node.ends)).hexdigest(), *[None] * 4)
                above.children += 1
                if above.skeleton is None:
                    above.waiting.append(row)
                else:
                    self.out.append((FINISHED, above.skeleton, None, *row))
            else:
                leaves, saved = node.leaves, node.saved
                self._chunk(node)
                self.out.append((PARTIAL, node.skeleton, None, node.conv, at, node.n, node.children, leaves, saved, None, node.words, *[None] * 3))
            if above is not None:
                above.n += node.n
                above.leaves += leaves
                above.saved += saved
                above.conv = node.conv if above.conv is None else min(above.conv, node.conv)

    def _chunk(self, node: Node) -> None:
        if node.ends:
            self.out.append((ENDS, node.skeleton, *[None] * 9, self.shard, self.seq, b",".join(node.ends)))
            self.seq += 1
            node.ends = []

    def taken(self) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.out), ROWS):
            columns = zip(*self.out[at : at + ROWS], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, OUT, strict=True)], schema=OUT)
        self.out = []


def _ranged(convs: DataFrame, cuts: list[tuple[Path, float]]) -> DataFrame:
    """`convs` with their shard, each shard sorted in a partition of its own."""
    known = convs.sparkSession.sparkContext.broadcast(cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, ids = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            shard = [bisect_right(known.value, (tuple(p), i)) for p, i in zip(paths, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], ["conv_id", "path", "words", "shard"])

    dealt = convs.mapInArrow(place, "conv_id long, path array<binary>, words array<long>, shard int")
    return dealt.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")


def _walked(convs: DataFrame, cuts: list[tuple[Path, float]], skeleton: Skeleton) -> DataFrame:
    known = convs.sparkSession.sparkContext.broadcast(skeleton)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Walk(known.value)
        for batch in batches:
            for conv, path, words, shard in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                state.add(shard, path, words, conv)
                if len(state.out) >= ROWS:
                    yield from state.taken()
        state.close(0)
        yield from state.taken()

    return _ranged(convs, cuts).mapInArrow(walk, OUT_DDL)


def _digests(chunks: DataFrame) -> DataFrame:
    """(node, digest): SHA-256 of the ids of each node, streamed chunk by chunk in their order."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = state = None
        give = lambda: pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([state.hexdigest()])], ["node", "digest"])
        for batch in batches:
            for owner, chunk in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if owner != node:
                    if node is not None:
                        yield give()
                    node, state = owner, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(chunk)
        if node is not None:
            yield give()

    ordered = chunks.select("node", "shard", "seq", "chunk").repartition("node").sortWithinPartitions("node", "shard", "seq")
    return ordered.mapInArrow(digest, "node long, digest string")


def _reduced(walked: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton's nodes, from the partial aggregates of all shards."""
    spark = walked.sparkSession
    known = spark.createDataFrame(list(skeleton.rows()), "node long, parent long, depth long, inner long, line array<long>")
    sums = walked.filter(F.col("kind") == PARTIAL).groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("outer"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("words").alias("words"),
    )
    nodes = known.join(sums, "node").withColumn("n_children", F.col("inner") + F.col("outer"))
    own = nodes.select("line", ((F.col("n_convs") - 1) * F.col("words")).alias("own"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    below = own.select(F.explode("line").alias("node"), "own", "leaf").groupBy("node").agg(
        F.sum("own").alias("more_saved"), F.sum("leaf").alias("more_leaves")
    )
    empty = F.sha2(F.lit("").cast("binary"), 256)
    parents = sums.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joined = nodes.join(below, "node").join(parents, "parent", "left").join(_digests(walked.filter(F.col("kind") == ENDS)), "node", "left")
    return joined.select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("leaves") + F.col("more_leaves")).alias("n_leaves"),
        (F.col("saved") + F.col("more_saved")).alias("saved_tokens"), F.coalesce("digest", empty).alias("ends_sha256"),
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, max_shards: int = MAX_SHARDS) -> DataFrame:
    """One row a node (`COLUMNS`) of the trie over the rebuilt conversations."""
    spark = ship(conversations.sparkSession)
    scratch = Scratch(spark, "trie")
    convs = rebuilt(conversations, scratch)
    cuts = splitters(convs, shard_turns, max_shards)
    skeleton = Skeleton(cuts)
    walked = scratch.cut(_walked(convs, cuts, skeleton))
    scratch.release(convs)
    spine = scratch.cut(_reduced(walked, skeleton).coalesce(4))
    finished = walked.filter(F.col("kind") == FINISHED)
    inner = finished.filter("node IS NULL").select(*COLUMNS)
    tops = lookup_join(finished.filter("node IS NOT NULL").drop("parent_conv_id"), spine.select("node", F.col("conv_id").alias("parent_conv_id")), ["node"])
    return inner.unionByName(tops.select(*COLUMNS)).unionByName(spine.select(*COLUMNS))

"""The levels of `communities.louvain` in a graph that one task holds: the same rounds, draws and ties on arrays.

Nodes are numbered in order of their ids, so places compare as ids do; only the draws take the ids themselves.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.session import ship

MIN_GAIN = 1e-7  # of one move, in edge weight
TOLERANCE = 1e-7  # of a level, or of one round, in modularity
IDLE_ROUNDS = 4
#: Links that are looked at at a time.
SLICE_LINKS = 1 << 19
#: Rows of a batch of results.
OUT_ROWS = 1 << 16
#: Of Spark's xxhash64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
SEED = np.uint64(42)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _ended(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * P2
    x = (x ^ (x >> np.uint64(29))) * P3
    return x ^ (x >> np.uint64(32))


def _hash_long(value: np.ndarray, seed: np.ndarray) -> np.ndarray:
    mixed = _turned(value.astype(np.int64).view(np.uint64) * P2, 31) * P1
    return _ended(_turned((seed + P5 + np.uint64(8)) ^ mixed, 27) * P1 + P4)


def _hash_int(value: int, seed: np.ndarray) -> np.ndarray:
    mixed = np.array([value & 0xFFFFFFFF], np.uint64) * P1
    return _ended(_turned((seed + P5 + np.uint64(4)) ^ mixed, 23) * P2 + P3)


def node_then_turn(ids: np.ndarray, turn: int) -> np.ndarray:
    """Spark's xxhash64 of a long and an int."""
    return _hash_int(turn, _hash_long(ids, np.array([SEED]))).view(np.int64)


def turn_then_node(turn: int, ids: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of an int and a long."""
    return _hash_long(ids, _hash_int(turn, np.array([SEED]))).view(np.int64)


def _rounded(x: np.ndarray) -> np.ndarray:
    """Half away from zero at the ninth place, as Spark rounds."""
    return np.copysign(np.floor(np.abs(x) * 1e9 + 0.5), x) / 1e9


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, their sums)."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(value[order], first) if len(first) else np.zeros(0)


@dataclass
class Graph:
    """Nodes with their weighted degrees and inner weights, and the links that leave each, every link in both directions."""

    ids: np.ndarray
    k: np.ndarray
    inner: np.ndarray
    start: np.ndarray
    head: np.ndarray
    weight: np.ndarray
    two_m: float

    def parts(self) -> Iterator[tuple[int, int, np.ndarray, slice]]:
        """(first node, end of nodes, the node of each of their links less the first, their links), about SLICE_LINKS at a time."""
        cuts = np.searchsorted(self.start, np.arange(0, self.start[-1], SLICE_LINKS))
        for low, high in itertools.pairwise(np.unique([0, *cuts, len(self.ids)])):
            count = np.diff(self.start[low : high + 1])
            yield low, high, np.repeat(np.arange(high - low), count), slice(self.start[low], self.start[high])


def _graph(ids: np.ndarray, inner: np.ndarray, src: np.ndarray, dst: np.ndarray, weight: np.ndarray, two_m: float) -> Graph:
    n = len(ids)
    tail = np.concatenate([src, dst]).astype(np.int32)
    order = np.argsort(tail)
    start = np.concatenate([[0], np.cumsum(np.bincount(tail, minlength=n))])
    del tail
    head, both = np.concatenate([dst, src]).astype(np.int32)[order], np.concatenate([weight, weight])[order]
    k = 2.0 * inner + np.bincount(src, weight, n) + np.bincount(dst, weight, n)
    return Graph(ids, k, inner, start, head, both, two_m)


@dataclass
class Wishes:
    """For each node the community of largest gain and what it gains, and the modularity of their labels."""

    own: np.ndarray
    wish: np.ndarray
    gain: np.ndarray
    quality: float


def _to_communities(
    node: np.ndarray, target: np.ndarray, weight: np.ndarray, own: np.ndarray, c: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, community, weight between them), in order, for communities that nodes have links to or are in."""
    here = np.arange(len(own)) * c + own
    key = node * c + target
    if len(own) * c <= 4 * (len(key) + len(own)):
        met = np.zeros(len(own) * c, bool)
        met[key] = met[here] = True
        found = np.flatnonzero(met)
        w = np.bincount(key, weight, len(met))[found]
    else:
        found, w = _summed(np.concatenate([key, here]), np.concatenate([weight, np.zeros(len(own))]))
    return found // c, found % c, w


def _wishes(graph: Graph, own: np.ndarray) -> Wishes:
    names, place = np.unique(own, return_inverse=True)
    c = len(names)
    total = np.bincount(place, graph.k, c)
    wish, gained, inside = own.copy(), np.zeros(len(own)), 0.0
    for low, high, tail, links in graph.parts():
        mine, k = place[low:high], graph.k[low:high]
        node, target, w = _to_communities(tail, place[graph.head[links]], graph.weight[links], mine, c)
        stays = target == mine[node]
        gain = w - k[node] * (total[target] - np.where(stays, k[node], 0.0)) / graph.two_m
        near, first = _rounded(gain), np.flatnonzero(np.diff(node, prepend=-1))
        top = np.maximum.reduceat(near, first)
        best = near == top[node]
        to = np.where(best[stays], mine, np.minimum.reduceat(np.where(best, target, c), first))
        over = top - gain[stays]
        asks = over > MIN_GAIN
        wish[low:high][asks] = names[to[asks]]
        gained[low:high] = over
        inside += np.sum(w[stays])
    squares = np.sum(graph.k * total[place])
    quality = (inside + 2 * np.sum(graph.inner)) / graph.two_m - squares / (graph.two_m * graph.two_m)
    return Wishes(own, wish, gained, quality)


def _granted(graph: Graph, wishes: Wishes, turn: int) -> np.ndarray:
    """The labels after the wishes that come true at once."""
    own, wish = wishes.own, wishes.wish
    asks = wish != own
    rank = np.empty(len(own), np.int64)
    rank[np.lexsort((graph.ids, node_then_turn(graph.ids, turn)))] = np.arange(len(own))
    free = asks.copy()
    for low, _, tail, links in graph.parts():
        head = graph.head[links]
        met = np.flatnonzero(asks[low + tail] & asks[head])
        a, b = low + tail[met], head[met]
        free[a[((wish[a] == own[b]) | (wish[b] == own[a])) & (rank[b] > rank[a])]] = False
    free = np.flatnonzero(free)
    to, k = wish[free], graph.k[free]
    crowd, lead = np.bincount(to, k, len(own)), np.full(len(own), -1)
    np.maximum.at(lead, to, rank[free])
    draw = (turn_then_node(turn, graph.ids[free]) % (1 << 20)) / float(1 << 20)
    moves = (rank[free] == lead[to]) | (draw * (crowd[to] - k) <= wishes.gain[free] * graph.two_m / k)
    after = own.copy()
    after[free[moves]] = to[moves]
    return after


def _connected(graph: Graph, own: np.ndarray) -> np.ndarray:
    """Labels where each community is in one piece, named by its least node."""
    piece = np.arange(len(own))
    while True:
        near = piece.copy()
        for low, _, tail, links in graph.parts():
            head = graph.head[links]
            inside = np.flatnonzero(own[low + tail] == own[head])
            np.minimum.at(near, low + tail[inside], piece[head[inside]])
        after = np.minimum(near, near[near])
        if np.array_equal(after, piece):
            return piece
        piece = after


def _local_moves(graph: Graph) -> np.ndarray | None:
    """The best labels, or None where they are no better than single nodes."""
    wishes = _wishes(graph, np.arange(len(graph.ids)))
    first, idle = wishes.quality, 0
    for turn in itertools.count():
        if idle == IDLE_ROUNDS or not (wishes.wish != wishes.own).any():
            break
        after = _wishes(graph, _granted(graph, wishes, turn))
        idle = 0 if after.quality > wishes.quality + TOLERANCE else idle + 1
        if after.quality >= wishes.quality:
            wishes = after
    return _connected(graph, wishes.own) if wishes.quality - first > TOLERANCE else None


def _contracted(graph: Graph, labels: np.ndarray) -> tuple[Graph, np.ndarray]:
    """(the graph whose nodes are the communities, the place of each node's community there)."""
    kept, place = np.unique(labels, return_inverse=True)
    n, sums = len(kept), [(np.zeros(0, np.int64), np.zeros(0))]
    for low, _, tail, links in graph.parts():
        head = graph.head[links]
        once = np.flatnonzero(low + tail < head)
        a, b = place[low + tail[once]], place[head[once]]
        sums.append(_summed(np.minimum(a, b) * n + np.maximum(a, b), graph.weight[links][once]))
    key, weight = _summed(*(np.concatenate(side) for side in zip(*sums, strict=True)))
    src, dst = key // n, key % n
    loop = src == dst
    inner = np.bincount(place, graph.inner, n) + np.bincount(src[loop], weight[loop], n)
    return _graph(graph.ids[kept], inner, src[~loop], dst[~loop], weight[~loop], graph.two_m), place


def _levels(graph: Graph) -> np.ndarray:
    """The community of each node after all levels."""
    member = np.arange(len(graph.ids))
    while (labels := _local_moves(graph)) is not None:
        graph, place = _contracted(graph, labels)
        member = place[member]
    return graph.ids[member]


def communities_of_task(pairs: DataFrame, loops: DataFrame, two_m: float) -> DataFrame:
    """(node, community) after all levels above pairs (src < dst, weight) and loops (node, inner), found by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: tuple[list, ...] = ([], [], [], [], [])
        for batch in batches:
            src, dst, weight = (batch.column(name).to_numpy() for name in ("src", "dst", "weight"))
            node = dst < 0
            for side, part in zip(sides, (src[node], weight[node], src[~node], dst[~node], weight[~node]), strict=True):
                side.append(part)
        if not sides[0]:
            return
        ids, inner = np.concatenate(sides[0]), np.concatenate(sides[1])
        order = np.argsort(ids)
        ids, inner = ids[order], inner[order]
        src, dst = (np.concatenate([np.searchsorted(ids, part).astype(np.int32) for part in side]) for side in sides[2:4])
        weight = np.concatenate(sides[4])
        for side in sides:
            side.clear()
        found = _levels(_graph(ids, inner, src, dst, weight, two_m))
        for low in range(0, len(ids), OUT_ROWS):
            some = slice(low, low + OUT_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(found[some])], ["node", "community"])

    ship(pairs.sparkSession)
    nodes = loops.select(F.col("node").alias("src"), F.lit(-1).cast("long").alias("dst"), F.col("inner").alias("weight"))
    return nodes.unionByName(pairs.select("src", "dst", "weight")).repartition(1).mapInArrow(run, "node long, community long")

"""Dependencies of pivots (G3) in a graph that a task holds whole and walks once for each of its pivots.

The links travel as sorted pieces of arrays, which a task lays into one array as they come: a head takes 4 bytes, a weight as
many as the largest asks for, mostly one. Besides them a task has four values for each node, the links of a slice and those kept for the way back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.operators.blocks import NEVER
from agorascope.session import ship

#: Links of a piece. A batch that goes to a task has at most 10,000 pieces.
PIECE_LINKS = 256
#: Links that are followed at a time, in arrays that stay in a processor's cache.
SLICE_LINKS = 1 << 15
#: Links on shortest paths that a walk keeps for its way back, in 24 bytes each; beyond them it follows all links again.
HELD_LINKS = 2_000_000
#: Rows of a batch of results.
OUT_ROWS = 1 << 16
PIECES = "first int, last int, tails binary, heads binary, weights binary"


def _pieces(links: DataFrame, weight: type, parts: int) -> DataFrame:
    """PIECES: the links (node, next, weight) by node; pieces in order of `first` and `last` are the links in that order."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tail, head = (batch.column(name).to_numpy().astype(np.int32) for name in ("node", "next"))
            width, cuts = batch.column("weight").to_numpy().astype(weight), range(0, len(tail), PIECE_LINKS)
            sides = [pa.array([side[at : at + PIECE_LINKS].tobytes() for at in cuts], pa.binary()) for side in (tail, head, width)]
            ends = np.minimum(np.array(cuts) + PIECE_LINKS, len(tail)) - 1
            yield pa.RecordBatch.from_arrays([pa.array(tail[cuts]), pa.array(tail[ends]), *sides], ["first", "last", "tails", "heads", "weights"])

    ordered = links.select("node", "next", "weight").repartitionByRange(parts, "node").sortWithinPartitions("node")
    return ordered.mapInArrow(pack, PIECES)


def _bytes_of(column: pa.Array) -> np.ndarray:
    """All bytes of a binary column, one value after the other."""
    _, ends, data = column.buffers()
    if data is None:
        return np.zeros(0, np.uint8)
    at = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]]


def _followed(nodes: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(nodes, how many links of each, where its links begin here, the links), at most SLICE_LINKS links at a time."""
    count = start[nodes + 1] - start[nodes]
    nodes, count = nodes[count > 0], count[count > 0]
    ends = np.cumsum(count)
    for low in range(0, int(ends[-1]) if len(ends) else 0, SLICE_LINKS):
        high = min(low + SLICE_LINKS, int(ends[-1]))
        some = slice(np.searchsorted(ends, low, "right"), np.searchsorted(ends, high) + 1)
        begin = ends[some] - count[some]
        here = np.maximum(begin, low)
        size = np.minimum(ends[some], high) - here
        yield nodes[some], size, here - low, np.arange(high - low) + np.repeat(start[nodes[some]] + low - begin, size)


def _add_dependency(
    pivot: int, start: np.ndarray, head: np.ndarray, weight: np.ndarray, least: int, place: np.ndarray, value: np.ndarray
) -> None:
    """Adds to `value` the dependency of a pivot on each node (Brandes 2001). `place` is working space.

    Nodes less than the least weight farther than the nearest open one are settled together, since no link leads from one to another.
    """
    n = len(start) - 1
    dist, paths = np.full(n, NEVER), np.zeros(n)
    dist[pivot], paths[pivot] = 0, 1.0
    reached, layers, ways, held = np.array([pivot]), [], [], 0
    while len(reached):
        far = dist[reached]
        near = far - far.min() < least
        layer, reached, way = reached[near], [reached[~near]], []
        layers.append(layer)
        ways.append(way)
        for nodes, size, _, link in _followed(layer, start):
            ends, offer = head[link].astype(np.int64), np.repeat(dist[nodes], size) + weight[link]
            old = dist[ends]
            kept = np.flatnonzero(offer <= old)
            ends, offer, old = ends[kept], offer[kept], old[kept]
            np.minimum.at(dist, ends, offer)
            paths[ends[offer < old]] = 0.0
            tight = np.flatnonzero(offer == dist[ends])
            tails, heads = np.repeat(nodes, size)[kept[tight]], ends[tight]
            np.add.at(paths, heads, paths[tails])
            held += len(tails)
            if held <= HELD_LINKS:
                way.append((tails, heads, offer[tight]))
            else:
                ways[-1] = None
            new = ends[old == NEVER]
            place[new] = np.arange(len(new))
            reached.append(new[place[new] == np.arange(len(new))])
        reached = np.concatenate(reached)
    ahead = np.zeros(n)
    for layer, way in zip(reversed(layers), reversed(ways), strict=True):
        ahead[layer] += 1.0 / paths[layer]
        if way is not None:
            for tails, heads, offer in way:
                tight = offer == dist[heads]
                np.add.at(ahead, tails[tight], ahead[heads[tight]])
            continue
        for nodes, size, first, link in _followed(layer, start):
            ends = head[link]
            tight = np.repeat(dist[nodes], size) + weight[link] == dist[ends]
            ahead[nodes] += np.add.reduceat(np.where(tight, ahead[ends], 0.0), first)
    met = np.concatenate(layers[1:]) if len(layers) > 1 else np.zeros(0, np.int64)
    value[met] += ahead[met] * paths[met] - 1.0


def dependencies_of_shares(pivots: DataFrame, k: int, links: DataFrame, n: int, count: int, size: int) -> DataFrame:
    """(node, value): dependency of `k` pivots (pivot, turn) on each node, summed: each group has about `size` pivots and all links."""
    spark = links.sparkSession
    least, most = links.agg(F.min("weight"), F.max("weight")).first()
    weight = next(kind for kind in (np.uint8, np.uint16, np.int32, np.int64) if most <= np.iinfo(kind).max)
    groups = -(-k // size)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, start, at = [], np.zeros(n + 1, np.int64), 0
        head, width = np.empty(count, np.int32), np.empty(count, weight)
        for batch in batches:
            first, last = batch.column("first").to_numpy(), batch.column("last").to_numpy()
            chosen += last[first < 0].tolist()
            tail, ends = (_bytes_of(batch.column(name)).view(np.int32) for name in ("tails", "heads"))
            to = at + len(ends)
            head[at:to], width[at:to] = ends, _bytes_of(batch.column("weights")).view(weight)
            if len(tail):
                start[tail[0] + 1 : tail[-1] + 2] += np.bincount(tail - tail[0])
            at = to
        np.cumsum(start, out=start)
        value, place = np.zeros(n), np.zeros(n, np.int64)
        for pivot in chosen:
            _add_dependency(pivot, start, head, width, least, place, value)
        met = np.flatnonzero(value)
        for low in range(0, len(met), OUT_ROWS):
            some = met[low : low + OUT_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(value[some])], ["node", "value"])

    ship(spark)
    pieces = _pieces(links, weight, max(spark.sparkContext.defaultParallelism, count // 1_000_000))
    empty = [F.lit(b"").alias(name) for name in ("tails", "heads", "weights")]
    asked = pivots.select(F.lit(-1).alias("first"), F.col("pivot").cast("int").alias("last"), *empty, F.pmod("turn", F.lit(groups)).cast("int").alias("group"))
    sent = pieces.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = asked.unionByName(sent).repartitionById(groups, "group").sortWithinPartitions("first", "last")
    return dealt.mapInArrow(walk, "node long, value double").groupBy("node").agg(F.sum("value").alias("value"))

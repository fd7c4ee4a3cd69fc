"""Dependencies of pivots (G3) in a graph too large for a task: blocks of nodes that tasks walk to the end.

A block is a range of nodes with the links that leave them; the ends of those links that lie in other blocks are its ghosts.
A task follows all paths inside its block, and only what reaches a ghost is sent on, so the rounds are as many as a
shortest path changes blocks, and never more than it has links. All three sums (distances, path counts, dependencies) are
linear over the paths, so a round takes only what is new to a block and no task keeps anything between rounds.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agorascope.operators.lineage import Scratch
from agorascope.session import ship

NEVER = np.iinfo(np.int64).max
#: Ranges of nodes that a block is put together from, about.
BUCKETS = 64
#: Kinds of rows that make up a block.
LINK, NODE, HOLDER = 0, 1, 2
GRAPH = "block int, own long, node binary, home binary, tail binary, head binary, weight binary, shared binary, holder binary"
DAG = "block int, chunk int, code binary, home binary, tail binary, head binary, starts binary, source binary, shared binary, holder binary"
SENT = "block int, turn int, node long, value {}"


def offers(tail: np.ndarray, head: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links that leave a live node, their heads, where each head's run starts), for links sorted by head."""
    sent = np.flatnonzero(live[tail])
    run = head[sent]
    first = np.flatnonzero(np.diff(run, prepend=-1))
    return sent, run[first], first


def nearest(dist: np.ndarray, tail: np.ndarray, head: np.ndarray, weight: np.ndarray) -> None:
    """Lowers `dist` (nodes x pivots, NEVER where not reached) to the shortest distances, for links sorted by head."""
    live = (dist < NEVER).any(axis=1)
    while live.any():
        sent, heads, first = offers(tail, head, live)
        live = np.zeros(len(dist), bool)
        if len(sent):
            from_tail = dist[tail[sent]]
            reached = np.where(from_tail < NEVER, from_tail + weight[sent, None], NEVER)
            best = np.minimum(dist[heads], np.minimum.reduceat(reached, first, axis=0))
            live[heads] = (best < dist[heads]).any(axis=1)
            dist[heads] = best


def _ranges(links: DataFrame, n: int, count: int, size: int) -> tuple[DataFrame, int, int]:
    """((bucket, rows, block), nodes of a bucket, rows of the largest bucket): blocks of about `size` nodes and links."""
    width = max(1, n * size // (BUCKETS * (n + count)))
    rows = links.select("node").unionByName(links.sparkSession.range(n).select(F.col("id").alias("node")))
    sizes = rows.groupBy(F.floor(F.col("node") / width).alias("bucket")).agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sizes.select("bucket", "rows", F.floor(before / size).cast("int").alias("block"))
    return placed, width, sizes.agg(F.max("rows")).first()[0]


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """A block as arrays: its nodes and then its ghosts, each in order, and the links by their places there."""
    block = rows["block"].iloc[0]
    links, own, kept = (rows[rows["kind"] == kind] for kind in (LINK, NODE, HOLDER))
    own = np.sort(own["a"].to_numpy())
    tail, head, home, weight = (links[name].to_numpy() for name in ("a", "b", "home", "weight"))
    away = home != block
    ghosts, at = np.unique(head[away], return_index=True)
    tail = np.searchsorted(own, tail)
    head = np.where(away, len(own) + np.searchsorted(ghosts, head), np.searchsorted(own, head))
    order = np.argsort(head, kind="stable")
    arrays = {
        "node": np.concatenate([own, ghosts]).astype(np.int64),
        "home": np.concatenate([np.full(len(own), block), home[away][at]]).astype(np.int32),
        "tail": tail[order].astype(np.int32), "head": head[order].astype(np.int32), "weight": weight[order].astype(np.int64),
        "shared": np.searchsorted(own, kept["a"].to_numpy()).astype(np.int32), "holder": kept["b"].to_numpy().astype(np.int32),
    }
    return pd.DataFrame([{"block": block, "own": len(own)} | {name: x.tobytes() for name, x in arrays.items()}])


def graph_of_blocks(scratch: Scratch, links: DataFrame, n: int, count: int, size: int) -> tuple[DataFrame, Callable] | None:
    """(a cached row for each block, a function that adds `block` to rows with `node`), or None if a hub outgrows a block."""
    found, width, largest = _ranges(links, n, count, size)
    if largest > 2 * size:
        return None
    ranges = scratch.cut(found)

    def place(df: DataFrame, node: str = "node", name: str = "block") -> DataFrame:
        side = F.broadcast(ranges.select("bucket", F.col("block").alias(name)))
        return df.withColumn("bucket", F.floor(F.col(node) / width)).join(side, "bucket").drop("bucket")

    ends = scratch.cut(place(place(links), "next", "home"))
    zero = F.lit(0).cast("long")
    rows = ends.select("block", F.lit(LINK).alias("kind"), F.col("node").alias("a"), F.col("next").alias("b"), "home", "weight")
    nodes = place(links.sparkSession.range(n).withColumnRenamed("id", "node"))
    rows = rows.unionByName(nodes.select(
        "block", F.lit(NODE).alias("kind"), F.col("node").alias("a"), zero.alias("b"), F.col("block").alias("home"), zero.alias("weight")
    ))
    ghosts = ends.filter("block <> home").select("home", "next", "block").distinct()
    rows = rows.unionByName(ghosts.select(
        F.col("home").alias("block"), F.lit(HOLDER).alias("kind"), F.col("next").alias("a"), F.col("block").cast("long").alias("b"),
        "home", zero.alias("weight"),
    ))
    ship(links.sparkSession)
    parts = _parts(links, -(-(n + count) // size))
    packed = scratch.cut(rows.groupBy("block").applyInPandas(_packed, GRAPH))
    return packed.repartition(parts, "block").persist(), place


def _parts(df: DataFrame, groups: int) -> int:
    """Partitions for so many groups of unequal work."""
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, 4 * groups)


def _array(rows: pd.DataFrame, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(rows[name].iloc[0], kind)


def _opened(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    node = _array(rows, "node", np.int64)
    return node, *(_array(rows, name, np.int32) for name in ("home", "tail", "head")), _array(rows, "weight", np.int64)


def _reached(rows: pd.DataFrame, sent: pd.DataFrame, most: int):
    """(turns, distances of the block's nodes and ghosts from their pivots), at most `most` turns of one chunk at a time."""
    node, _, tail, head, weight = _opened(rows)
    own = int(rows["own"].iloc[0])
    turn, where, value = (sent[name].to_numpy() for name in ("turn", "node", "value"))
    at = np.searchsorted(node[:own], where)
    mine = node[np.minimum(at, own - 1)] == where
    at = np.where(mine, at, own + np.searchsorted(node[own:], where))
    for chunk in np.unique(turn // most):
        now = turn // most == chunk
        turns, column = np.unique(turn[now], return_inverse=True)
        dist = np.full((len(node), len(turns)), NEVER)
        dist[at[now], column] = value[now]
        nearest(dist, tail, head, weight)
        yield chunk, turns, dist


def _table(parts: list[tuple]) -> pd.DataFrame:
    names = ["block", "turn", "node", "value"]
    if not parts:
        return pd.DataFrame({name: [] for name in names})
    return pd.DataFrame({name: np.concatenate(side) for name, side in zip(names, zip(*parts, strict=True), strict=True)})


def _to_ghosts(most: int) -> Callable:
    def walk(rows: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(sent):
            node, home, own = _array(rows, "node", np.int64), _array(rows, "home", np.int32), int(rows["own"].iloc[0])
            for _, turns, dist in _reached(rows, sent, most):
                at, column = np.nonzero(dist[own:] < NEVER)
                at += own
                found.append((home[at], turns[column], node[at], dist[at, column]))
        return _table(found)

    return walk


def _to_holders(most: int) -> Callable:
    """The distances of nodes that are ghosts elsewhere, to the blocks where they are."""

    def walk(rows: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(sent):
            node = _array(rows, "node", np.int64)
            shared, holder = _array(rows, "shared", np.int32), _array(rows, "holder", np.int32)
            for _, turns, dist in _reached(rows, sent, most):
                at, column = np.nonzero(dist[shared] < NEVER)
                found.append((holder[at], turns[column], node[shared[at]], dist[shared[at], column]))
        return _table(found)

    return walk


def _tight(n: int, most: int) -> Callable:
    """The links on shortest paths from each chunk of pivots, sorted by the distance of their tail, between (pivot, node)."""

    def walk(rows: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(sent):
            node, home, tail, head, weight = _opened(rows)
            shared, holder = _array(rows, "shared", np.int32), _array(rows, "holder", np.int32)
            by_node = np.argsort(node, kind="stable")
            for chunk, turns, dist in _reached(rows, sent, most):
                sides: dict[str, list] = {name: [] for name in ("code", "home", "tail", "head", "far", "source", "shared", "holder")}
                place, size = np.full(len(node), -1), 0
                for column, turn in enumerate(turns):
                    far = np.ascontiguousarray(dist[:, column])
                    met = by_node[far[by_node] < NEVER]
                    place[:] = -1
                    place[met] = size + np.arange(len(met))
                    size += len(met)
                    live = np.flatnonzero(place[tail] >= 0)
                    live = live[far[tail[live]] + weight[live] == far[head[live]]]
                    held = np.flatnonzero(place[shared] >= 0)
                    sides["code"].append(turn.astype(np.int64) * n + node[met])
                    sides["home"].append(home[met])
                    sides["tail"].append(place[tail[live]].astype(np.int32))
                    sides["head"].append(place[head[live]].astype(np.int32))
                    sides["far"].append(far[tail[live]])
                    sides["source"].append(place[far == 0].astype(np.int32))
                    sides["shared"].append(place[shared[held]].astype(np.int32))
                    sides["holder"].append(holder[held])
                joined = {name: np.concatenate(side) for name, side in sides.items()}
                far = joined.pop("far")
                order = np.argsort(far, kind="stable")
                joined["tail"], joined["head"] = joined["tail"][order], joined["head"][order]
                joined["starts"] = np.flatnonzero(np.diff(far[order], prepend=-1)).astype(np.int32)
                found.append({"block": rows["block"].iloc[0], "chunk": chunk} | {name: x.tobytes() for name, x in joined.items()})
        return pd.DataFrame(found, columns=[part.split()[0] for part in DAG.split(", ")])

    return walk


class _Dag:
    """The links on shortest paths of one block and chunk."""

    def __init__(self, rows: pd.DataFrame, n: int):
        self.n = n
        self.code = _array(rows, "code", np.int64)
        self.home, self.tail, self.head, self.source, self.shared, self.holder = (
            _array(rows, name, np.int32) for name in ("home", "tail", "head", "source", "shared", "holder")
        )
        self.own = self.home == rows["block"].iloc[0]
        ends = [*_array(rows, "starts", np.int32), len(self.tail)]
        self.runs = [slice(a, b) for a, b in zip(ends, ends[1:], strict=False)]

    def laid(self, sent: pd.DataFrame) -> np.ndarray:
        """What was sent, at its places."""
        value = np.zeros(len(self.code))
        wanted = sent["turn"].to_numpy(np.int64) * self.n + sent["node"].to_numpy()
        at = np.minimum(np.searchsorted(self.code, wanted), len(self.code) - 1)
        here = self.code[at] == wanted
        value[at[here]] = sent["value"].to_numpy()[here]
        return value

    def ahead(self, value: np.ndarray) -> np.ndarray:
        """Adds to each place the values behind it over all paths."""
        for run in self.runs:
            np.add.at(value, self.head[run], value[self.tail[run]])
        return value

    def back(self, value: np.ndarray) -> np.ndarray:
        """Adds to each place the values ahead of it over all paths."""
        for run in reversed(self.runs):
            np.add.at(value, self.tail[run], value[self.head[run]])
        return value

    def paths(self, sent: pd.DataFrame) -> np.ndarray:
        """Path counts at the block's own places, from those that came in there."""
        return np.where(self.own, self.ahead(np.where(self.own, self.laid(sent), 0.0)), 0.0)

    def to_ghosts(self, value: np.ndarray) -> pd.DataFrame:
        at = np.flatnonzero(~self.own & (value != 0))
        return _table([(self.home[at], self.code[at] // self.n, self.code[at] % self.n, value[at])])

    def to_holders(self, value: np.ndarray) -> pd.DataFrame:
        at = np.flatnonzero(value[self.shared] != 0)
        code = self.code[self.shared[at]]
        return _table([(self.holder[at], code // self.n, code % self.n, value[self.shared[at]])])


def _inverse(paths: np.ndarray) -> np.ndarray:
    return np.divide(1.0, paths, out=np.zeros_like(paths), where=paths > 0)


def _on_dag(n: int, step: Callable[[_Dag, pd.DataFrame], pd.DataFrame], names: list[str]) -> Callable:
    def walk(rows: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        return step(_Dag(rows, n), sent) if len(rows) and len(sent) else pd.DataFrame({name: [] for name in names})

    return walk


def _delta(dag: _Dag, sent: pd.DataFrame) -> pd.DataFrame:
    """Dependency of the chunk's pivots on the block's own nodes, from the path counts and dependencies that came in."""
    paths = dag.paths(sent)
    total = dag.back(np.where(dag.own, _inverse(paths), dag.laid(sent)))
    met = paths > 0
    met[dag.source] = False
    nodes, at = np.unique(dag.code[met] % dag.n, return_inverse=True)
    return pd.DataFrame({"node": nodes, "value": np.bincount(at, total[met] * paths[met] - 1.0, len(nodes))})


def dependencies(scratch: Scratch, graph: DataFrame, pivots: DataFrame, n: int, most: int) -> DataFrame:
    """(node, value): dependency of the pivots (block, turn, node) on each node, summed (Brandes 2001)."""
    keys, key = ["block", "turn", "node"], ["block", "chunk"]

    def over_graph(sent: DataFrame, walk: Callable, schema: str) -> DataFrame:
        return graph.groupBy("block").cogroup(sent.select(*keys, "value").groupBy("block")).applyInPandas(walk, schema)

    def reduced(sent: DataFrame, merge: Callable = F.sum) -> DataFrame:
        return sent.groupBy(*keys).agg(merge("value").alias("value"))

    state = scratch.cut(pivots.select(*keys, F.lit(0).cast("long").alias("value"), F.lit(True).alias("fresh")))
    while not state.filter("fresh").isEmpty():
        reached = over_graph(state.filter("fresh"), _to_ghosts(most), SENT.format("long"))
        held = state.select(*keys, "value", F.col("value").alias("old"))
        best = held.unionByName(reached.withColumn("old", F.lit(None).cast("long"))).groupBy(*keys).agg(
            F.min("value").alias("value"), F.min("old").alias("old")
        )
        fresh = F.col("old").isNull() | (F.col("value") < F.col("old"))
        after = scratch.cut(best.select(*keys, "value", fresh.alias("fresh")))
        scratch.release(state)
        state = after
    edge = over_graph(state, _to_holders(most), SENT.format("long"))
    ways = scratch.cut(over_graph(state.drop("fresh").unionByName(edge), _tight(n, most), DAG))
    groups = ways.count()
    dag = ways.repartition(_parts(ways, -(-groups // 4)), *key).persist()

    def over_dag(sent: DataFrame, step: Callable, schema: str) -> DataFrame:
        names = [part.split()[0] for part in schema.split(", ")]
        chunked = sent.select(F.floor(F.col("turn") / most).cast("int").alias("chunk"), *keys, "value")
        return dag.groupBy(*key).cogroup(chunked.groupBy(*key)).applyInPandas(_on_dag(n, step, names), schema)

    def all_rounds(sent: DataFrame, step: Callable) -> DataFrame:
        rounds = []
        while not sent.isEmpty():
            rounds.append(sent)
            sent = scratch.cut(reduced(over_dag(sent, step, SENT.format("double"))))
        rows = rounds[0] if rounds else sent
        for other in rounds[1:]:
            rows = rows.unionByName(other)
        total = scratch.cut(reduced(rows))
        scratch.release(*rounds)
        return total

    start = scratch.cut(pivots.select(*keys, F.lit(1.0).alias("value")))
    paths = all_rounds(start, lambda ways, sent: ways.to_ghosts(ways.ahead(ways.laid(sent))))
    first = over_dag(paths, lambda ways, sent: ways.to_holders(ways.back(_inverse(ways.paths(sent)))), SENT.format("double"))
    behind = all_rounds(scratch.cut(reduced(first)), lambda ways, sent: ways.to_holders(ways.back(ways.laid(sent))))
    found = over_dag(paths.unionByName(behind), _delta, "node long, value double")
    total = scratch.cut(found.groupBy("node").agg(F.sum("value").alias("value")))
    dag.unpersist()
    return total

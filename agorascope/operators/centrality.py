"""Betweenness and eigenvector centrality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.operators.blocks import dependencies, graph_of_blocks
from agorascope.operators.edges import directed
from agorascope.operators.graph import vertices, weighted_degrees
from agorascope.operators.lineage import Scratch, cut
from agorascope.operators.rows import seeded_key, top_k, with_row_index
from agorascope.operators.skew import fits_broadcast, hot_keys, join_ends, spread_join
from agorascope.operators.whole import dependencies_of_shares

STATE_ROWS = 500_000_000
#: Links up to which a task gets the whole graph: 168 MB where no weight is above 255. As rows they take BYTES each.
TASK_LINKS = 32 << 20
BYTES = 48
#: Pivots at least for which a task gets the links, where that leaves a task for each core.
LOAD_PIVOTS = 8
#: Links and nodes of a block of a larger graph, and those of one where there are enough blocks for all tasks.
BLOCK_MOST = 1_000_000
BLOCK_LINKS = 250_000
#: Pivots that a block is walked for at a time, and links or nodes times pivots, at most.
TASK_PIVOTS = 16
TASK_CELLS = 4_000_000


def number_nodes(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, numbered edges): names replaced by 0..n-1 in name order, so ties do not depend on partitions."""
    edges = cut(edges, "pairs")
    nodes = cut(with_row_index(vertices(edges), [F.asc("node")], "id"), "nodes")
    joined = join_ends(edges, nodes, "id", "id")
    numbered = joined.select(F.col("src_id").alias("src"), F.col("dst_id").alias("dst"), "weight")
    return nodes, cut(numbered, "edges")


def _step(state: DataFrame, links: DataFrame, hot: DataFrame | None, small: bool) -> DataFrame:
    """Join (.., node, ..) to the links that leave its node; a hub's links are spread over tasks."""
    if small:
        return state.join(F.broadcast(links), "node")
    return spread_join(links, state, ["node"], hot=hot)


def _distances(scratch: Scratch, pivots: DataFrame, links: DataFrame, hot: DataFrame | None, small: bool) -> DataFrame:
    """(pivot, node, dist): shortest distances, relaxing only what the last round improved."""
    zero = F.lit(0).cast("long")
    state = scratch.cut(
        pivots.select("pivot", F.col("pivot").alias("node"), zero.alias("dist"), F.lit(True).alias("fresh"))
    )
    while True:
        reached = _step(state.filter("fresh").select("pivot", "node", "dist"), links, hot, small)
        offers = reached.select(
            "pivot", F.col("next").alias("node"), (F.col("dist") + F.col("weight")).alias("dist"),
            F.lit(None).cast("long").alias("old"),
        )
        held = state.select("pivot", "node", "dist", F.col("dist").alias("old"))
        best = held.unionByName(offers).groupBy("pivot", "node").agg(
            F.min("dist").alias("dist"), F.min("old").alias("old")
        )
        fresh = F.col("old").isNull() | (F.col("dist") < F.col("old"))
        after = scratch.cut(best.select("pivot", "node", "dist", fresh.alias("fresh")))
        scratch.release(state)
        state = after
        if state.filter("fresh").isEmpty():
            return state


def _spread_along(
    scratch: Scratch, start: DataFrame, links: DataFrame, tail: str, head: str
) -> DataFrame:
    """Sum over all paths of the links: (pivot, node, total) of `start` carried from tail to head.

    Layer h holds what arrives over paths of exactly h links, so the rounds are as many as the
    longest shortest path has links, however many different distances there are.
    """
    layer, layers = start, [start]
    while True:
        carried = layer.withColumnRenamed("node", tail).join(links, ["pivot", tail])
        layer = scratch.cut(
            carried.groupBy("pivot", F.col(head).alias("node")).agg(F.sum("value").alias("value"))
        )
        if layer.isEmpty():
            scratch.release(layer)
            break
        layers.append(layer)
    rows = layers[0]
    for other in layers[1:]:
        rows = rows.unionByName(other)
    total = scratch.cut(rows.groupBy("pivot", "node").agg(F.sum("value").alias("value")))
    scratch.release(*layers[1:])
    return total


def _dependencies(
    scratch: Scratch, pivots: DataFrame, links: DataFrame, hot: DataFrame | None, small: bool
) -> DataFrame:
    """(node, value): dependency of the pivots on each node, summed over them (Brandes 2001)."""
    dist = _distances(scratch, pivots, links, hot, small).select("pivot", "node", "dist")
    ends = dist.select("pivot", F.col("node").alias("next"), F.col("dist").alias("_far"))
    tight = F.col("dist") + F.col("weight") == F.col("_far")
    dag = scratch.cut(
        _step(dist, links, hot, small).join(ends, ["pivot", "next"]).filter(tight)
        .select("pivot", F.col("node").alias("tail"), F.col("next").alias("head"))
    )
    one = pivots.select("pivot", F.col("pivot").alias("node"), F.lit(1.0).alias("value"))
    paths = _spread_along(scratch, one, dag, "tail", "head")
    # delta(v)/sigma(v) sums 1/sigma(w) over all paths from v to w.
    inverse = paths.select("pivot", "node", (1.0 / F.col("value")).alias("value"))
    ahead = _spread_along(scratch, inverse, dag, "head", "tail")
    sigma = paths.withColumnRenamed("value", "sigma")
    delta = F.col("value") * F.col("sigma") - 1.0
    return (
        sigma.join(ahead, ["pivot", "node"])
        .filter(F.col("pivot") != F.col("node"))
        .groupBy("node")
        .agg(F.sum(delta).alias("value"))
    )


def _in_batches(
    scratch: Scratch, pivots: DataFrame, k: int, batch: int, links: DataFrame, blocks: tuple | None, n: int, size: int
) -> DataFrame:
    """(node, value): dependency of all pivots on each node, `batch` pivots at a time."""
    if blocks is None:
        small = fits_broadcast(links)
        hot = None if small else cut(hot_keys(links, ["node"]), "hot")
    else:
        graph, place = blocks
        pivots = scratch.cut(place(pivots.withColumnRenamed("pivot", "node")).withColumn("turn", F.col("turn").cast("int")))
        most = max(1, min(TASK_PIVOTS, TASK_CELLS // size))
    parts = None
    for start in range(0, k, batch):
        turn = F.col("turn")
        group = pivots.filter((turn >= start) & (turn < start + batch))
        inner = Scratch(links.sparkSession, "betweenness")
        if blocks is None:
            part = scratch.cut(_dependencies(inner, group.select("pivot"), links, hot, small))
        else:
            part = scratch.cut(dependencies(inner, graph, group, n, most))
        inner.release_all()
        parts = part if parts is None else parts.unionByName(part)
    if blocks is not None:
        graph.unpersist()
    return parts.groupBy("node").agg(F.sum("value").alias("value"))


def betweenness(
    edges: DataFrame, pivots: int | None = None, seed: int = 42, batch: int | None = None
) -> DataFrame:
    """(node, betweenness), directed, weights as distances, normalised.

    Exact by default; an estimate from that many seeded nodes where `pivots` names a number. Weights
    of 0 or below raise an error. Tasks share the pivots of a graph of at most TASK_LINKS links and walk it one pivot after the
    other. A larger one is cut into blocks that tasks walk to the end, or, with nodes of more links than a block's, followed
    link by link. There pivots are handled `batch` at a time, by default so many that a batch holds at most STATE_ROWS distances
    and links; in blocks at most TASK_CELLS links or nodes times pivots, since a task gets all that a batch sends to its block.
    """
    nodes, numbered = number_nodes(directed(edges))
    n = nodes.count()
    k = n if pivots is None else min(pivots, n)
    if not numbered.filter("weight <= 0").isEmpty():
        raise ValueError("weights are distances here and must be above 0")
    if n < 3:
        return nodes.select("node", F.lit(0.0).alias("betweenness"))
    links = numbered.select(F.col("src").alias("node"), F.col("dst").alias("next"), "weight")
    count = links.count()
    drawn = nodes if k == n else nodes.orderBy(seeded_key("node", seed), "node").limit(k)
    chosen = drawn.select(F.col("id").alias("pivot"))
    chosen = cut(with_row_index(chosen, [F.asc("pivot")], "turn"), "pivots")
    scratch = Scratch(edges.sparkSession, "betweenness")
    cores = edges.sparkSession.sparkContext.defaultParallelism
    if fits_broadcast(links, TASK_LINKS, BYTES * TASK_LINKS):
        size = max(-(-k // (3 * cores)), min(LOAD_PIVOTS, -(-k // cores)))
        total = scratch.cut(dependencies_of_shares(chosen, k, links, n, count, size))
    else:
        size = min(TASK_LINKS, BLOCK_MOST, max(BLOCK_LINKS, (n + count) // cores))
        blocks = graph_of_blocks(scratch, links, n, count, size)
        if blocks is None:
            most = max(1, STATE_ROWS // max(n, count))
        else:
            most = max(1, min(STATE_ROWS // (4 * n), TASK_CELLS // size))
        total = _in_batches(scratch, chosen, k, batch or most, links, blocks, n, size)
    scale = 1.0 / ((n - 1) * (n - 2)) * (n / k)
    return nodes.join(total.withColumnRenamed("node", "id"), "id", "left").select(
        "node", (F.coalesce("value", F.lit(0.0)) * scale).alias("betweenness")
    )


def graph_metrics(edges: DataFrame, pivots: int | None = None, seed: int = 42, batch: int | None = None) -> DataFrame:
    """Degrees and betweenness per node, largest total degree first.

    Without `pivots` betweenness is exact, which takes work with the square of the nodes: name a number for a large graph.
    """
    between = betweenness(edges, pivots, seed, batch)
    return (
        weighted_degrees(edges)
        .join(between, "node", "left")
        .withColumn("betweenness", F.coalesce("betweenness", F.lit(0.0)))
        .orderBy(F.desc("degree_w"), F.asc("node"))
    )


def top_by(metrics: DataFrame, measure: str, k: int = 10) -> DataFrame:
    """K3: the `k` nodes with the largest `measure`."""
    return top_k(metrics, measure, "node", k)


def eigenvector(edges: DataFrame, rounds: int = 100, tolerance: float = 1e-6) -> DataFrame:
    """(node, centrality) by power iteration over incoming weighted edges, unit L2 norm."""
    nodes, numbered = number_nodes(directed(edges))
    n = nodes.count()
    small = fits_broadcast(numbered)
    links = numbered.select(F.col("src").alias("node"), F.col("dst").alias("next"), "weight")
    hot = None if small else cut(hot_keys(links, ["node"]), "hot")
    scratch = Scratch(edges.sparkSession, "eigenvector")
    vector = scratch.cut(nodes.select(F.col("id").alias("node"), F.lit(1.0 / n).alias("x")))
    for _ in range(rounds):
        sent = _step(vector, links, hot, small).select(
            F.col("next").alias("node"), (F.col("x") * F.col("weight")).alias("x"),
            F.lit(0.0).alias("old"),
        )
        own = vector.select("node", "x", F.col("x").alias("old"))
        raw = scratch.cut(
            own.unionByName(sent).groupBy("node").agg(F.sum("x").alias("x"), F.sum("old").alias("old"))
        )
        norm = raw.agg(F.sqrt(F.sum(F.col("x") * F.col("x")))).first()[0]
        moved = raw.agg(F.sum(F.abs(F.col("x") / norm - F.col("old")))).first()[0]
        scratch.release(vector)
        vector = raw.select("node", (F.col("x") / norm).alias("x"))
        if moved < n * tolerance:
            break
        vector = scratch.cut(vector)
        scratch.release(raw)
    else:
        raise ValueError(f"the vector still changes after {rounds} rounds")
    return nodes.join(vector.withColumnRenamed("node", "id"), "id").select(
        "node", F.col("x").alias("centrality")
    )

"""Community detection by modularity."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.operators.centrality import number_nodes
from agorascope.operators.edges import undirected
from agorascope.operators.graph import community_sizes, modularity, vertices
from agorascope.operators.lineage import Scratch, cut
from agorascope.operators.moves import IDLE_ROUNDS, MIN_GAIN, TOLERANCE, communities_of_task
from agorascope.operators.rows import top_k, with_row_index
from agorascope.operators.skew import HOT_ROWS, fits_broadcast, hot_keys, join_ends, spread_join

#: Links, and nodes, of a level up to which one task takes it and those above it, in 60 bytes a link at most. As rows they take BYTES each.
TASK_LINKS = 6_000_000
BYTES = 48
#: Nodes up to which labels are broadcast. Every round does so several times, and each passes through the driver.
ROUND_ROWS = 10_000


@dataclass
class Level:
    """A graph between communities of the level below: pair weights, inner weights included."""

    pairs: DataFrame  # src < dst, weight
    loops: DataFrame  # node, inner (weight inside the node), every node once
    two_m: float


def _attach(rows: DataFrame, labels: DataFrame, on: str, hot: DataFrame | None, small: bool) -> DataFrame:
    """Join to labels; without `hot` keys, by sorting both sides, so that no label passes through the driver."""
    if small:
        return rows.join(F.broadcast(labels), on)
    if hot is None:
        return rows.join(labels.hint("merge"), on)
    return spread_join(rows, labels, [on], hot=hot.withColumnRenamed("node", on))


def _attach_target(rows: DataFrame, targets: DataFrame, on: str, many: bool, small: bool) -> DataFrame:
    """Join rows, at most one a node and community, to one per community; with `many` nodes, one community may be hot."""
    return spread_join(rows, targets, [on]) if many else _attach(rows, targets, on, None, small)


def _nodes(level: Level) -> DataFrame:
    """(node, inner, k): k is the weighted degree, inner weight counted twice."""
    ends = F.array(
        F.struct(F.col("src").alias("node"), F.col("weight").alias("k")),
        F.struct(F.col("dst").alias("node"), F.col("weight").alias("k")),
    )
    outer = level.pairs.select(F.inline(ends), F.lit(0.0).alias("inner"))
    own = level.loops.select("node", (2 * F.col("inner")).alias("k"), "inner")
    return outer.unionByName(own).groupBy("node").agg(F.sum("inner").alias("inner"), F.sum("k").alias("k"))


def _wishes(
    scratch: Scratch, both: DataFrame, labels: DataFrame, two_m: float, hot: DataFrame | None, small: bool, many: bool = False
) -> DataFrame:
    """(node, inner, k, own, own_w, own_k, wish, gain): the community of largest gain for each node, `own` where none gains.

    `own` is its label, `own_w` the weight to others with that label, `own_k` the degree of all of them, `gain` what the wish
    gains over staying.
    """
    totals = labels.groupBy(F.col("community").alias("target")).agg(F.sum("k").alias("total"))
    here = labels.select("node", F.col("community").alias("own"), "k", "inner")
    there = labels.select(F.col("node").alias("next"), F.col("community").alias("target"))
    linked = _attach(both, there, "next", hot, small)
    linked = _attach(linked, here, "node", hot, small)
    staying = here.select("*", F.col("own").alias("target"), F.lit(0.0).alias("weight"))
    links = (
        linked.select(staying.columns)
        .unionByName(staying)
        .groupBy("node", "own", "k", "inner", "target")
        .agg(F.sum("weight").alias("w"))
    )
    if not small:
        links = scratch.cut(links)  # read twice below
    rated = _attach_target(links, totals, "target", many, small)
    stays = F.col("target") == F.col("own")
    rest = F.col("total") - F.when(stays, F.col("k")).otherwise(0.0)
    gain = F.col("w") - F.col("k") * rest / two_m
    choice = F.struct(
        F.round(gain, 9).alias("gain"), stays.alias("stays"), (-F.col("target")).alias("minus")
    )
    best = rated.groupBy("node", "own", "k", "inner").agg(
        F.max(choice).alias("best"),
        F.max(F.when(stays, gain)).alias("own_gain"),
        F.max(F.when(stays, F.col("w"))).alias("own_w"),
        F.max(F.when(stays, F.col("total"))).alias("own_k"),
    )
    over = F.col("best.gain") - F.col("own_gain")
    wish = F.when(over > MIN_GAIN, -F.col("best.minus")).otherwise(F.col("own"))
    return scratch.cut(best.select("node", "inner", "k", "own", "own_w", "own_k", wish.alias("wish"), over.alias("gain")))


def _granted(
    scratch: Scratch, wishes: DataFrame, both: DataFrame, two_m: float, turn: int, hot: DataFrame | None, small: bool, many: bool
) -> DataFrame:
    """(node, k, inner, community): the wishes that come true at once.

    Two neighbours spoil each other's gain where one wishes for the community that the other wishes to leave: of such two, only
    the one with the higher priority may move, a hash that differs from round to round (Luby 1986). Nodes that join one
    community each add their degree to it: a node may move with the probability that its gain outlasts the others, and the
    first of them by priority always does.
    """
    rank = F.struct(F.xxhash64("node", F.lit(turn)).alias("rank"), F.col("node").alias("id"))
    asking = wishes.filter("wish <> own").select("node", "own", "wish", "k", "gain", rank.alias("mine"))
    other = asking.select(F.col("node").alias("next"), F.col("own").alias("left"), F.col("wish").alias("joined"), F.col("mine").alias("other"))
    rivals = _attach(both.select("node", "next"), asking.select("node", "own", "wish", "mine"), "node", hot, small)
    rivals = _attach(rivals, other, "next", hot, small)
    beaten = rivals.filter("(wish = left OR joined = own) AND other > mine").select("node").distinct()
    free = asking.join(beaten if small else beaten.hint("merge"), "node", "left_anti")
    free = scratch.cut(free.select("node", "wish", "k", "gain", "mine"))
    crowds = free.groupBy("wish").agg(F.sum("k").alias("crowd"), F.max("mine").alias("lead"))
    draw = F.pmod(F.xxhash64(F.lit(turn), "node"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    lasts = draw * (F.col("crowd") - F.col("k")) <= F.col("gain") * two_m / F.col("k")
    moves = _attach_target(free, crowds, "wish", many, small).filter((F.col("mine") == F.col("lead")) | lasts)
    moves = moves.select("node", F.col("wish").alias("community"))
    after = wishes.select("node", "k", "inner", "own").join(moves if small else moves.hint("merge"), "node", "left")
    after = scratch.cut(after.select("node", "k", "inner", F.coalesce("community", "own").alias("community")))
    scratch.release(free)
    return after


def _quality(wishes: DataFrame, two_m: float) -> tuple[float, int]:
    """Modularity of the labels that wishes were made from, and how many nodes wish to move."""
    asks = (F.col("wish") != F.col("own")).cast("long")
    inside = F.sum(F.col("own_w") + 2 * F.col("inner"))
    inside, squares, asking = wishes.agg(inside, F.sum(F.col("k") * F.col("own_k")), F.sum(asks)).first()
    return inside / two_m - squares / (two_m * two_m), asking


def _connected(scratch: Scratch, both: DataFrame, labels: DataFrame, hot: DataFrame | None, small: bool) -> DataFrame:
    """Labels where each community is in one piece: of a community in several, each becomes one, named by its least node.

    Least numbers spread along the links inside communities; following a piece's number to that node's own halves the way.
    """
    mine, other = labels.select("node", F.col("community").alias("c1")), labels.select(F.col("node").alias("next"), F.col("community").alias("c2"))
    inside = _attach(_attach(both.select("node", "next"), mine, "node", hot, small), other, "next", hot, small)
    inside = scratch.cut(inside.filter("c1 = c2").select("node", "next"))
    now = scratch.cut(labels.select("node", F.col("node").alias("piece")))
    while True:
        told = _attach(inside, now.select(F.col("node").alias("next"), "piece"), "next", hot, small)
        least = told.unionByName(now.select("node", F.col("node").alias("next"), "piece").select(told.columns))
        least = scratch.cut(least.groupBy("node").agg(F.min("piece").alias("near")))
        far = least.select(F.col("node").alias("near"), F.col("near").alias("far"))
        hopped = least.join(F.broadcast(far) if small else far.hint("merge"), "near").select("node", F.least("near", "far").alias("piece"))
        after = scratch.cut(hopped)
        before = now.withColumnRenamed("piece", "before")
        same = after.join(before if small else before.hint("merge"), "node").filter("piece <> before").isEmpty()
        scratch.release(now, least)
        now = after
        if same:
            break
    found = labels.drop("community").join(now.withColumnRenamed("piece", "community"), "node")
    scratch.release(inside)
    return scratch.cut(found)


def _local_moves(scratch: Scratch, level: Level) -> tuple[DataFrame, bool]:
    """Nodes move to the neighbouring community of largest gain until none gains.

    Moves of one round may still gain less than each expected; labels that turn out worse are dropped, and the next round draws
    other nodes. Ends when no node wishes to move, or when
    `IDLE_ROUNDS` rounds one after another gain nothing. Returns the best labels, each community in one piece, and
    whether they are better than single nodes.
    """
    forward = level.pairs.select(F.col("src").alias("node"), F.col("dst").alias("next"), "weight")
    backward = level.pairs.select(F.col("dst").alias("node"), F.col("src").alias("next"), "weight")
    both = scratch.cut(forward.unionByName(backward))
    labels = scratch.cut(_nodes(level).withColumn("community", F.col("node")))
    small = fits_broadcast(labels, ROUND_ROWS)
    many = not small and labels.count() >= HOT_ROWS  # else no node has so many neighbours, no community so many nodes
    hot = scratch.cut(hot_keys(both, ["node"])) if many else None
    hot = None if hot is None or hot.isEmpty() else hot
    wishes = _wishes(scratch, both, labels, level.two_m, hot, small, many)
    best, asking = _quality(wishes, level.two_m)
    first, idle = best, 0
    for turn in itertools.count():  # each round that is not idle gains at least TOLERANCE of at most 1
        if idle == IDLE_ROUNDS or not asking:
            break
        moved = _granted(scratch, wishes, both, level.two_m, turn, hot, small, many)
        after = _wishes(scratch, both, moved, level.two_m, hot, small, many)
        q, left = _quality(after, level.two_m)
        idle = 0 if q > best + TOLERANCE else idle + 1
        if q < best:
            scratch.release(after, moved)
            continue
        scratch.release(wishes, labels)
        wishes, labels, best, asking = after, moved, q, left
    if best - first <= TOLERANCE:
        return labels, False
    return _connected(scratch, both, labels, hot, small), True


def _contract(scratch: Scratch, level: Level, labels: DataFrame) -> Level:
    """The graph whose nodes are the communities."""
    pairs = join_ends(level.pairs, labels, "community", "c")
    merged = scratch.cut(
        pairs.groupBy(F.least("src_c", "dst_c").alias("src"), F.greatest("src_c", "dst_c").alias("dst"))
        .agg(F.sum("weight").alias("weight"))
    )
    inner = merged.filter("src = dst").select(F.col("src").alias("node"), F.col("weight").alias("inner"))
    below = labels.select(F.col("community").alias("node"), "inner")
    loops = scratch.cut(inner.unionByName(below).groupBy("node").agg(F.sum("inner").alias("inner")))
    return Level(merged.filter("src <> dst"), loops, level.two_m)


def louvain(edges: DataFrame) -> DataFrame:
    """(node, community), communities numbered from 0 by size, then by smallest member name.

    Blondel et al. 2008 with moves made in parallel: in every round those of the nodes that gain by it which do not spoil each
    other's gain, drawn by hash priority, take the community of largest gain; ties keep the node where it is, then prefer the smallest number.
    After a level's moves, communities that have come apart are split into their pieces, which never lowers modularity (Traag
    et al. 2019). Levels are added until one gains nothing. From the first level of at most TASK_LINKS links on, one task makes
    the same moves on arrays, since a round on tables costs seconds however small they are.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "louvain")
    nodes, numbered = number_nodes(undirected(edges))
    numbered = numbered.withColumn("weight", F.col("weight").cast("double"))
    names = nodes.select(F.col("id").alias("node"))
    looped = numbered.filter("src = dst").select(F.col("src").alias("node"), F.col("weight").alias("inner"))
    loops = names.select("node", F.lit(0.0).alias("inner")).unionByName(looped)
    loops = scratch.cut(loops.groupBy("node").agg(F.sum("inner").alias("inner")))
    ordered = numbered.filter("src <> dst").select(
        F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "weight"
    )
    two_m = 2.0 * (numbered.agg(F.sum("weight")).first()[0] or 0.0)
    member = names.withColumn("community", F.col("node"))
    level = Level(ordered, loops, two_m)
    while two_m:
        held = all(fits_broadcast(side, TASK_LINKS, BYTES * TASK_LINKS) for side in (level.loops, level.pairs))
        if held:
            labels = scratch.cut(communities_of_task(level.pairs, level.loops, level.two_m))
        else:
            labels, moved = _local_moves(scratch, level)
            if not moved:
                break
        side = labels.select(F.col("node").alias("community"), F.col("community").alias("above"))
        member = member.join(side, "community").select("node", F.col("above").alias("community"))
        member = scratch.cut(member)
        if held:
            break
        level = _contract(scratch, level, labels)
    found = member.withColumnRenamed("node", "id").join(nodes, "id").select("node", "community")
    sizes = found.groupBy("community").agg(F.count("*").alias("size"), F.min("node").alias("first"))
    order = [F.desc("size"), F.asc("first")]
    ranked = with_row_index(sizes, order, "number").select("community", "number")
    final = found.join(ranked, "community").select("node", F.col("number").cast("int").alias("community"))
    final = cut(final, "communities")
    scratch.release_all()
    return final


def community_outputs(edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node to community, community sizes, one-row run summary)."""
    pairs = undirected(edges)
    labels = louvain(edges)
    return labels, community_sizes(labels), run_summary(pairs, labels)


def run_summary(pairs: DataFrame, labels: DataFrame, algo: str = "louvain") -> DataFrame:
    """Algo, nodes, edges, communities, modularity and the ten largest communities."""
    largest = top_k(community_sizes(labels), "size", "community", 10)  # ten rows
    listed = largest.agg(F.collect_list(F.struct(F.col("size").alias("s"), "community")).alias("l")).select(
        F.lit(algo).alias("algo"),
        F.transform(
            F.array_sort(F.transform("l", lambda x: F.struct((-x["s"]).alias("m"), x["community"].alias("c")))),
            lambda x: F.struct(x["c"].alias("community"), (-x["m"]).alias("size")),
        ).alias("top10_sizes"),
    )
    counts = vertices(pairs).agg(F.count("*").alias("nodes")).withColumn("algo", F.lit(algo))
    links = pairs.agg(F.count("*").alias("edges")).withColumn("algo", F.lit(algo))
    quality = modularity(pairs, labels).withColumn("algo", F.lit(algo))
    return (
        counts.join(links, "algo").join(quality, "algo").join(listed, "algo")
        .select("algo", "nodes", "edges", "communities", "modularity", "top10_sizes")
    )

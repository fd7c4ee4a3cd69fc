import heapq
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from agorascope.operators import centrality, communities, edges, graph, lineage, moves, skew, whole


def table(spark, rows):
    return spark.createDataFrame([(a, b, "reply", w) for a, b, w in rows], "src string, dst string, edge_type string, weight long")


def brandes(rows):
    """Plain single-machine betweenness, by Dijkstra from every node."""
    out, nodes = defaultdict(dict), set()
    for a, b, w in rows:
        out[a][b] = out[a].get(b, 0) + w
        nodes |= {a, b}
    score = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        dist, sigma, before, order, heap = {}, defaultdict(float), defaultdict(list), [], [(0, s)]
        seen = {s: 0}
        sigma[s] = 1.0
        while heap:
            d, v = heapq.heappop(heap)
            if v in dist:
                continue
            dist[v] = d
            order.append(v)
            for u, w in out[v].items():
                if u not in seen or d + w < seen[u]:
                    seen[u], sigma[u], before[u] = d + w, sigma[v], [v]
                    heapq.heappush(heap, (d + w, u))
                elif d + w == seen[u] and u not in dist:
                    sigma[u] += sigma[v]
                    before[u].append(v)
        delta = defaultdict(float)
        for v in reversed(order):
            for u in before[v]:
                delta[u] += sigma[u] / sigma[v] * (1 + delta[v])
            if v != s:
                score[v] += delta[v]
    n = len(nodes)
    return {v: x / ((n - 1) * (n - 2)) for v, x in score.items()}


def found(df):
    return {r["node"]: r["betweenness"] for r in df.collect()}


GRAPHS = {
    "path": [("a", "b", 1), ("b", "c", 1), ("c", "d", 1), ("d", "e", 1)],
    "star": [x for i in range(5) for x in (("hub", f"n{i}", 1), (f"n{i}", "hub", 2))],
    "diamond": [("a", "b", 1), ("a", "c", 2), ("b", "d", 2), ("c", "d", 1), ("a", "d", 9), ("d", "e", 1)],
    "apart": [("a", "b", 1), ("x", "y", 1), ("y", "z", 3)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_betweenness_small_graphs(spark, name):
    got = found(centrality.betweenness(table(spark, GRAPHS[name])))
    assert got == pytest.approx(brandes(GRAPHS[name]), abs=1e-12)


def test_betweenness_random_graph_in_batches_and_without_broadcast(spark, monkeypatch):
    dice = random.Random(3)
    rows = list({(f"n{dice.randrange(25)}", f"n{dice.randrange(25)}") for _ in range(110)})
    rows = [(a, b, dice.randrange(1, 5)) for a, b in rows if a != b]
    want = brandes(rows)
    assert found(centrality.betweenness(table(spark, rows), batch=20)) == pytest.approx(want, abs=1e-12)
    monkeypatch.setattr(centrality, "fits_broadcast", lambda df, *a: False)
    monkeypatch.setattr(skew, "fits_broadcast", lambda df, *a: False)
    assert found(centrality.betweenness(table(spark, rows))) == pytest.approx(want, abs=1e-12)


def test_betweenness_from_all_pivots_is_exact_and_tiny_graph_is_zero(spark):
    rows = GRAPHS["diamond"]
    assert found(centrality.betweenness(table(spark, rows), pivots=5)) == pytest.approx(brandes(rows))
    assert set(found(centrality.betweenness(table(spark, [("a", "b", 1)]))).values()) == {0.0}


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_betweenness_of_a_small_graph_takes_the_same_jobs_however_long_its_paths(spark):
    counts = []
    for n in (5, 40):
        rows = [(f"n{i:02}", f"n{i + 1:02}", 1 + i % 3) for i in range(n)]
        got, jobs = jobs_of(spark, f"path-{n}", lambda rows=rows: found(centrality.betweenness(table(spark, rows))))
        assert got == pytest.approx(brandes(rows), abs=1e-12)
        counts.append(jobs)
    assert counts[1] <= counts[0] + 5


def test_betweenness_in_blocks_that_paths_enter_again_and_again(spark, monkeypatch):
    monkeypatch.setattr(centrality, "TASK_LINKS", 30)
    monkeypatch.setattr(centrality, "TASK_PIVOTS", 7)
    dice = random.Random(5)
    rows = list({(f"n{dice.randrange(30):02}", f"n{dice.randrange(24):02}") for _ in range(110)})
    rows = [(a, b, dice.randrange(1, 6)) for a, b in rows if a != b]
    assert found(centrality.betweenness(table(spark, rows))) == pytest.approx(brandes(rows), abs=1e-12)
    monkeypatch.setattr(centrality, "TASK_LINKS", 5)
    got = found(centrality.betweenness(table(spark, GRAPHS["diamond"]), batch=3))
    assert got == pytest.approx(brandes(GRAPHS["diamond"]), abs=1e-12)


def test_betweenness_of_a_large_graph_takes_jobs_by_blocks_and_not_by_links_of_a_path(spark, monkeypatch):
    monkeypatch.setattr(centrality, "TASK_LINKS", 60)
    rows = [(f"n{i:02}", f"n{i + 1:02}", 1 + i % 3) for i in range(70)]
    got, jobs = jobs_of(spark, "blocks", lambda: found(centrality.betweenness(table(spark, rows))))
    assert got == pytest.approx(brandes(rows), abs=1e-12)
    assert jobs < 140  # three sums of 70 rounds each, link by link


def test_betweenness_with_a_hub_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(centrality, "TASK_LINKS", 5)
    rows = [x for i in range(14) for x in (("hub", f"n{i:02}", 1), (f"n{i:02}", f"n{i % 3:02}", 2), (f"n{i:02}", "hub", 1)) if x[0] != x[1]]
    assert found(centrality.betweenness(table(spark, rows))) == pytest.approx(brandes(rows), abs=1e-12)


def test_betweenness_of_a_graph_that_a_task_holds_is_sent_without_blocks(spark, monkeypatch):
    """A million links and more took one state of all pivots of a block to a task at once."""
    rows = [(f"n{i:02}", f"n{(3 * i + j) % 40:02}", 1 + (i + j) % 3) for i in range(40) for j in range(5) if (2 * i + j) % 40]
    monkeypatch.setattr(centrality, "graph_of_blocks", None)
    monkeypatch.setattr(whole, "PIECE_LINKS", 3)
    monkeypatch.setattr(whole, "SLICE_LINKS", 4)
    assert centrality.TASK_LINKS > 30_000_000 and found(centrality.betweenness(table(spark, rows))) == pytest.approx(brandes(rows), abs=1e-12)


@pytest.mark.parametrize("held", [0, 9, 2_000_000])
def test_dependencies_where_no_weight_is_small_and_links_of_a_node_fall_into_slices(monkeypatch, held):
    monkeypatch.setattr(whole, "SLICE_LINKS", 3)
    monkeypatch.setattr(whole, "HELD_LINKS", held)
    dice = random.Random(9)
    rows = sorted({(dice.randrange(20), dice.randrange(20)) for _ in range(90)} | {(3, i) for i in range(20)})
    rows = [(a, b, dice.randrange(300, 1200)) for a, b in rows if a != b]
    tail, head, weight = (np.array(side) for side in zip(*rows, strict=True))
    start = np.searchsorted(tail, np.arange(21))
    value = np.zeros(20)
    for pivot in range(20):
        whole._add_dependency(pivot, start, head.astype(np.int32), weight.astype(np.uint16), int(weight.min()), np.zeros(20, np.int64), value)
    want = brandes(rows)
    assert list(value / (19 * 18)) == pytest.approx([want[i] for i in range(20)], abs=1e-12)


def test_betweenness_in_blocks_takes_few_pivots_at_a_time_where_blocks_are_large(spark, monkeypatch):
    batches = []
    real = centrality._in_batches
    monkeypatch.setattr(centrality, "TASK_LINKS", 20)
    monkeypatch.setattr(centrality, "TASK_CELLS", 60)
    monkeypatch.setattr(centrality, "_in_batches", lambda scratch, pivots, k, batch, *rest: batches.append(batch) or real(scratch, pivots, k, batch, *rest))
    rows = [(f"n{i:02}", f"n{i + 1:02}", 1 + i % 3) for i in range(8)] + [(f"n{i:02}", "n00", 2) for i in range(2, 8)] + [(f"n{i + 2:02}", f"n{i:02}", 3) for i in range(1, 7)] + [("n08", "n01", 1)]
    assert found(centrality.betweenness(table(spark, rows))) == pytest.approx(brandes(rows), abs=1e-12)
    assert batches == [3]


def cliques(spark):
    rows = []
    for side in ("a", "b"):
        rows += [(f"{side}{i}", f"{side}{j}", 1) for i in range(5) for j in range(i)]
    return table(spark, [*rows, ("a0", "b0", 1)])


def test_modularity_of_two_cliques(spark):
    pairs = edges.undirected(cliques(spark))
    labels = graph.vertices(pairs).select("node", (F.substring("node", 1, 1) == "a").cast("int").alias("community"))
    row = graph.modularity(pairs, labels).first()
    assert row["communities"] == 2
    assert row["modularity"] == pytest.approx(2 * (10 / 21 - (21 / 42) ** 2))
    single = labels.withColumn("community", F.lit(0))
    assert graph.modularity(pairs, single).first()["modularity"] == pytest.approx(0.0)


def sequential_louvain(pairs):
    """Modularity after moving one node at a time, level by level."""
    weights = {}
    for a, b, w in pairs:
        weights.setdefault(a, {})[b] = weights.setdefault(a, {}).get(b, 0) + w
        weights.setdefault(b, {})[a] = weights.setdefault(b, {}).get(a, 0) + (w if a != b else 0)
    two_m = 2 * sum(w for *_, w in pairs)

    def degree(n):
        return sum(w for m, w in weights[n].items()) + weights[n].get(n, 0)

    best = -1.0
    while True:
        label = {n: n for n in weights}
        total = {n: degree(n) for n in weights}
        moved = True
        while moved:
            moved = False
            for n in sorted(weights):
                k, own = degree(n), label[n]
                links = {own: 0.0}
                for m, w in weights[n].items():
                    if m != n:
                        links[label[m]] = links.get(label[m], 0) + w
                total[own] -= k
                gain = {c: w - k * total[c] / two_m for c, w in links.items()}
                to = max(sorted(gain), key=lambda c: (round(gain[c], 9), c == own))
                total[to] += k
                label[n], moved = to, moved or to != own
        inside = {c: 0.0 for c in set(label.values())}
        merged = {c: {} for c in inside}
        for n, row in weights.items():
            for m, w in row.items():
                a, b = label[n], label[m]
                if a == b:
                    inside[a] += w if n != m else 2 * w
                else:
                    merged[a][b] = merged[a].get(b, 0) + w
        q = sum(inside[c] / two_m - (total[c] / two_m) ** 2 for c in inside)
        if q <= best + 1e-7:
            return best
        best = q
        for c in inside:
            if inside[c]:
                merged[c][c] = inside[c] / 2
        weights = merged


def some_graphs():
    r = random.Random(8)
    planted = [(i, j, 1.0) for i in range(60) for j in range(i) if r.random() < (0.5 if i // 12 == j // 12 else 0.03)]
    ring = [(10 * c + i, 10 * c + j, 1.0) for c in range(8) for i in range(5) for j in range(i)] + [(10 * c, 10 * ((c + 1) % 8) + 1, 1.0) for c in range(8)]
    sparse = [(r.randrange(80), r.randrange(80), float(r.randint(1, 5))) for _ in range(130)]
    stars = [(100 * c, 100 * c + i, 1.0) for c in range(5) for i in range(1, 25)] + [(0, 100 * c, 2.0) for c in range(1, 5)]
    grid = [(10 * x + y, 10 * x + y + d, 1.0) for x in range(8) for y in range(8) for d in (1, 10) if (y < 7 or d == 10) and (x < 7 or d == 1)]
    return {"planted": planted, "ring": ring, "sparse": sparse, "stars": stars, "grid": grid}


def test_louvain_is_as_good_as_one_node_at_a_time_and_connected(spark):
    """Over five graphs side by side."""
    pairs = [(1000 * g + a, 1000 * g + b, w) for g, pairs in enumerate(some_graphs().values()) for a, b, w in pairs]
    links = spark.createDataFrame([(f"n{a:04}", f"n{b:04}", w) for a, b, w in pairs], "src string, dst string, weight double")
    found = {r.node: r.community for r in communities.louvain(links).collect()}
    got = graph.modularity(edges.undirected(links), spark.createDataFrame(list(found.items()), "node string, community int")).first()["modularity"]
    assert got >= 0.99 * sequential_louvain(pairs)
    near = {}
    for a, b, _ in pairs:
        near.setdefault(f"n{a:04}", set()).add(f"n{b:04}")
        near.setdefault(f"n{b:04}", set()).add(f"n{a:04}")
    for c in set(found.values()):
        own = {n for n, k in found.items() if k == c}
        seen, todo = set(), [min(own)]
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += near[n] & own
        assert seen == own


def test_a_community_in_two_pieces_is_split(spark):
    scratch = lineage.Scratch(spark, "t")
    both = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 2), (3, 4), (4, 3), (5, 6), (6, 5)], "node long, next long")
    labels = spark.createDataFrame([(i, 1.0, 0.0, 9 if i != 3 else 8) for i in range(1, 7)], "node long, k double, inner double, community long")
    got = {r.node: r.community for r in communities._connected(scratch, both, labels, None, True).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5}


def test_louvain_grants_most_wishes_of_a_dense_graph_at_once(spark):
    """All nodes of a clique are neighbours, so an independent set is one node; a leaf that joins a hub spoils no other's gain."""
    scratch = lineage.Scratch(spark, "t")
    both = spark.createDataFrame([(i, j) for i in range(30) for j in range(30) if i != j], "node long, next long")
    wishes = [(i, 0.0, 29.0, i if i < 5 else 100 + i, 0.0, 29.0, i if i < 5 else i % 5, 0.9) for i in range(30)]
    wishes = spark.createDataFrame(wishes, "node long, inner double, k double, own long, own_w double, own_k double, wish long, gain double")
    after = communities._granted(scratch, wishes, both, 1e6, 0, None, True, False).collect()
    assert all(r.community == (r.node if r.node < 5 else r.node % 5) for r in after)


def test_louvain_sends_no_labels_through_the_driver_beyond_round_rows(spark, monkeypatch):
    monkeypatch.setattr(communities, "ROUND_ROWS", 10)
    scratch = lineage.Scratch(spark, "t")
    rows = spark.range(50).select(F.col("id").alias("node"), (F.col("id") + 1).alias("next"))
    labels = spark.range(51).select(F.col("id").alias("next"), F.lit(1).alias("label"))
    joined = communities._attach(rows, scratch.cut(labels), "next", None, False)
    assert joined.count() == 50
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_louvain_finds_cliques_whatever_the_partitions(spark):
    links = cliques(spark)
    labels, sizes, summary = communities.community_outputs(links)
    got = {r["node"]: r["community"] for r in labels.collect()}
    assert got == {**{f"a{i}": 0 for i in range(5)}, **{f"b{i}": 1 for i in range(5)}}
    again = communities.louvain(links.repartition(3))
    assert {r["node"]: r["community"] for r in again.collect()} == got
    assert sorted(tuple(r) for r in sizes.collect()) == [(0, 5), (1, 5)]
    row = summary.first()
    assert (row["nodes"], row["edges"], row["communities"]) == (10, 21, 2)
    assert [tuple(x) for x in row["top10_sizes"]] == [(0, 5), (1, 5)]


def test_louvain_planted_blocks_without_broadcast(spark, monkeypatch):
    dice = random.Random(5)
    rows = []
    for i in range(40):
        for j in range(i):
            if dice.random() < (0.8 if i // 10 == j // 10 else 0.03):
                rows.append((f"n{i:02}", f"n{j:02}", 1))
    monkeypatch.setattr(communities, "fits_broadcast", lambda df, *a: False)
    monkeypatch.setattr(skew, "fits_broadcast", lambda df, *a: False)
    links = table(spark, rows)
    labels = communities.louvain(links)
    blocks = defaultdict(set)
    for r in labels.collect():
        blocks[r["community"]].add(int(r["node"][1:]) // 10)
    assert len(blocks) == 4 and all(len(b) == 1 for b in blocks.values())


def test_louvain_of_a_graph_that_a_task_holds_makes_the_same_moves_in_few_jobs(spark, monkeypatch):
    dice = random.Random(11)
    rows = [(f"n{i:02}", f"n{j:02}", dice.randint(1, 4)) for i in range(36) for j in range(i + 1) if dice.random() < (0.6 if i // 9 == j // 9 else 0.08)]
    links = table(spark, [*rows, ("m0", "m1", 2), ("m2", "m2", 3)])

    def labels(links):
        return sorted(tuple(r) for r in communities.louvain(links).collect())

    got, jobs = jobs_of(spark, "held", lambda: labels(links))
    assert labels(table(spark, [("a", "b", 1)])) == [("a", 0), ("b", 0)]
    monkeypatch.setattr(communities, "TASK_LINKS", 0)
    want, rounds = jobs_of(spark, "tables", lambda: labels(links))
    assert got == want and 3 * jobs < rounds


def test_moves_do_not_depend_on_the_links_looked_at_at_a_time(monkeypatch):
    pairs = sorted({(min(a, b), max(a, b)) for a, b, _ in some_graphs()["sparse"] if a != b})
    src, dst = (np.array(side) for side in zip(*pairs, strict=True))
    weight = 1.0 + src % 3
    found = []
    for size in (1 << 19, 7):
        monkeypatch.setattr(moves, "SLICE_LINKS", size)
        graph = moves._graph(np.arange(80), np.arange(80) % 2 * 0.5, src, dst, weight, 2 * weight.sum() + 40.0)
        found.append(moves._levels(graph).tolist())
    assert found[0] == found[1] and 1 < len(set(found[0])) < 60


def test_draws_of_moves_are_those_of_the_tables(spark):
    rows = spark.range(-2, 900, 9).select("id", F.xxhash64("id", F.lit(5)).alias("a"), F.xxhash64(F.lit(5), "id").alias("b")).collect()
    ids = np.array([r.id for r in rows])
    assert moves.node_then_turn(ids, 5).tolist() == [r.a for r in rows]
    assert moves.turn_then_node(5, ids).tolist() == [r.b for r in rows]


def test_degrees_collapse_and_subgraph(spark):
    links = table(spark, [("a", "b", 2), ("b", "a", 1), ("a", "c", 4), ("", "c", 9), (None, "b", 9), ("c", "d", 1)])
    degrees = {r["node"]: tuple(r)[1:] for r in graph.weighted_degrees(links).collect()}
    assert degrees == {"a": (1, 6, 7), "b": (2, 1, 3), "c": (4, 1, 5), "d": (1, 0, 1)}
    assert sorted(tuple(r) for r in edges.undirected(links).collect()) == [("a", "b", 3), ("a", "c", 4), ("c", "d", 1)]
    labels = spark.createDataFrame([("a", 0), ("b", 1)], "node string, community int")
    nodes, inside = graph.top_degree_subgraph(links, labels, 3)
    assert [tuple(r) for r in nodes.collect()] == [("a", 0, 7, 20), ("c", -1, 4, 20), ("b", 1, 3, 20)]
    assert sorted(tuple(r) for r in inside.collect()) == [("a", "b", 3, 0, 1), ("a", "c", 4, 0, -1)]


def test_interaction_edges(spark):
    from datetime import datetime

    at = [datetime(2024, 1, 1, h) for h in range(6)]
    rows = [
        ("posts", "t3_1", "ann", None, "post", at[0]),
        ("comments", "t1_1", " bob ", "t3_1", "hi u/ann u/bob (/u/Cy1)", at[2]),
        ("comments", "t1_2", "bob", "t3_1", "again", at[1]),
        ("comments", "t1_3", "ann", "t3_1", "to myself", at[3]),
        ("comments", "t1_4", "[deleted]", "t3_1", "u/ann", at[3]),
        ("comments", "t1_5", "cy", "t1_4", "parent has no author u/none", at[4]),
        ("comments", "t1_6", "cy", "t1_9", "no such parent", None),
        ("comments", "t1_7", "cy", None, "no parent u/ann", at[5]),
        ("posts", "t3_1", "zed", None, "a later copy", at[5]),
    ]
    posts = spark.createDataFrame(rows, "topic string, fullname string, author string, parent_id string, body string, event_ts timestamp")
    got = {(r["src"], r["dst"], r["edge_type"]): (r["weight"], r["first_seen"], r["last_seen"])
           for r in edges.interaction_edges(posts, run_time=at[5]).collect()}
    assert got == {
        ("bob", "ann", "reply"): (2, at[1], at[2]),
        ("bob", "ann", "mention"): (1, at[2], at[2]),
        ("bob", "Cy1", "mention"): (1, at[2], at[2]),
    }


def test_hot_parent_without_broadcast(spark, monkeypatch):
    posts = spark.range(2000).select(
        F.when(F.col("id") == 0, "posts").otherwise("comments").alias("topic"),
        F.concat(F.lit("t"), "id").alias("fullname"),
        F.concat(F.lit("u"), F.col("id") % 700).alias("author"),
        F.when(F.col("id") % 3 > 0, "t0").otherwise(F.concat(F.lit("t"), F.col("id") - 1)).alias("parent_id"),
        F.lit("x").alias("body"),
        F.timestamp_seconds(F.col("id")).alias("event_ts"),
    )
    want = sorted(map(str, edges.reply_edges(posts).collect()))
    monkeypatch.setattr(skew, "fits_broadcast", lambda df, *a: False)
    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    assert sorted(map(str, edges.reply_edges(posts).collect())) == want


def test_eigenvector_of_a_ring_with_a_hub(spark):
    rows = [("a", "b", 1), ("b", "c", 1), ("c", "a", 1), ("a", "c", 1)]
    got = {r["node"]: r["centrality"] for r in centrality.eigenvector(table(spark, rows)).collect()}
    import numpy as np

    m = np.zeros((3, 3))
    for a, b, w in rows:
        m["abc".index(b), "abc".index(a)] += w
    values, vectors = np.linalg.eig(m)
    lead = np.abs(vectors[:, np.argmax(values.real)].real)
    assert [got[x] for x in "abc"] == pytest.approx(list(lead / np.linalg.norm(lead)), abs=1e-4)


def test_weights_beyond_int_and_below_one(spark):
    rows = [("a", "b", 3_000_000_000), ("b", "c", 1)]
    weights = {r["src"]: r["weight"] for r in edges.directed(table(spark, rows)).collect()}
    assert weights == {"a": 3_000_000_000, "b": 1}
    with pytest.raises(ValueError):
        centrality.betweenness(table(spark, [("a", "b", 0), ("b", "a", 0), ("b", "c", 1)]))

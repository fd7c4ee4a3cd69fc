"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Sizes are words. Targets: sources share all words by weight; a target stops at `MOST` times its source's size and the
excess goes to the others by weight (the level at which the targets add up is found by one cumulative sum over the
sources, ordered by where each stops).

Rates: of all rates r_i in (0, MOST] of a source's documents with sum(r_i * size_i) = target, those closest to 1 in
relative entropy are r_i = min(MOST, exp(a * size_i)): the dual is convex in the one number a of each source. Newton
steps solve it for all sources at once, each step one aggregation over the counts by (source, size); a step that leaves
the bracket of a is replaced by its middle. A source whose target is MOST times its size takes every document so often.

Copies: rates are carried through each source in order of size, and the documents of one size get together the whole
numbers that their stretch of the running total passes. What is then missing from the target, or too much, is made up by
single copies from the largest size down, to about half the smallest size. This goes over the distinct sizes of a source,
whose number is bounded by its longest text. The copies of a size are spread evenly over its documents, ordered by a hash
of their id, in as many parts as the square root of their number, so no window sorts a whole source or one hot size. Reruns agree: nothing depends on partitions or on time.

Null texts and texts without words have size 0, rate 1 and take 0 words. A null source is a source, ordered last.
Repeated rows are taken each (rows alike in id, source and size are ordered arbitrarily and equal). Empty tables give no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.operators.lineage import Scratch

WEIGHTS = (5, 2, 1)
MOST = 3.0
#: Newton ends when every source's words are this near their target, as a part of it.
TOLERANCE = 1e-6
STEPS = 200
#: Files of the tables that every step reads: one row a source, and one row a source and size.
STATE_FILES, COUNT_FILES = 4, 32


def word_count(text: Column) -> Column:
    """The number of [^\\x20\\x09-\\x0D]+ in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row a source."""
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(place) - 1) % len(weights) + 1)
    w = sizes.withColumn("weight", weight).withColumn("stop", most * F.col("source_size") / F.col("weight"))
    # Sources by the level (words for each unit of weight) at which they stop: below source i, all before it have stopped.
    so_far = Window.orderBy("stop", F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    w = w.withColumn("stopped", F.sum(most * F.col("source_size")).over(so_far) - most * F.col("source_size"))
    w = w.withColumn("open", F.sum("weight").over(everything) - F.sum("weight").over(so_far) + F.col("weight"))
    w = w.withColumn("all", F.sum("source_size").over(everything).cast("double"))
    level = (F.col("all") - F.col("stopped")) / F.col("open")
    w = w.withColumn("place", F.row_number().over(so_far))
    first_open = F.min(F.when(level <= F.col("stop"), F.struct("place", level.alias("level")))).over(everything)
    w = w.withColumn("level", first_open.getField("level"))
    target = F.least(most * F.col("source_size"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight"))
    return w.select("source", "source_size", target.alias("target"))


def _rate(size: Column, a: Column, full: Column, most: float) -> Column:
    """min(most, exp(a * size)), and `most` where the whole source is taken so often."""
    power = a * size
    return F.when(full, F.lit(most)).when(size == 0, F.lit(1.0)).when(power >= F.log(F.lit(most)), F.lit(most)).otherwise(F.exp(power))


def balanced_rates(counts: DataFrame, wanted: DataFrame, scratch: Scratch, most: float = MOST) -> DataFrame:
    """(source, mean, a, full): the tilt of each source, for sizes in units of the source's mean size.

    `counts` has (source, size, n), `wanted` (source, source_size, target).
    """
    mean = counts.filter("size > 0").groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    start = wanted.alias("w").join(mean.alias("m"), F.col("w.source").eqNullSafe(F.col("m.source")), "left").select(
        "w.source", "w.target", F.coalesce("m.mean", F.lit(1.0)).alias("mean"),
        F.log(F.greatest(F.col("target"), F.lit(1e-300)) / F.greatest(F.col("source_size"), F.lit(1))).alias("a"),
        (F.col("target") >= most * F.col("source_size") * (1 - 1e-12)).alias("full"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
    )
    state = scratch.cut(start.coalesce(STATE_FILES))
    for _ in range(STEPS):
        size = F.col("c.size") / F.col("s.mean")
        rate = _rate(size, F.col("s.a"), F.col("s.full"), most)
        free = F.when(rate < most, rate).otherwise(0.0)
        sums = (
            counts.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
            .groupBy("s.source", "s.target", "s.mean", "s.a", "s.full", "s.low", "s.high")
            .agg(F.sum(F.col("c.n") * F.col("c.size") * rate).alias("words"), F.sum(F.col("c.n") * F.col("c.size") * size * free).alias("slope"))
        )
        done = F.col("full") | (F.abs(F.col("words") - F.col("target")) <= TOLERANCE * F.greatest("target", F.lit(1.0)))
        low = F.when(F.col("words") < F.col("target"), F.col("a")).otherwise(F.col("low"))
        high = F.when(F.col("words") >= F.col("target"), F.col("a")).otherwise(F.col("high"))
        bounded = sums.select("source", "target", "mean", "a", "full", "words", "slope", done.alias("done"), low.alias("low"), high.alias("high"))
        newton = F.col("a") + (F.col("target") - F.col("words")) / F.greatest(F.col("slope"), F.lit(1e-300))
        newton = F.least(F.greatest(newton, F.col("a") - 8), F.col("a") + 8)
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        finite = (F.col("low") > float("-inf")) & (F.col("high") < float("inf"))
        step = F.when(F.col("done"), F.col("a")).when(inside, newton).when(finite, (F.col("low") + F.col("high")) / 2).otherwise(newton)
        after = scratch.cut(bounded.select("source", "target", "mean", step.alias("a"), "full", "low", "high", "done").coalesce(STATE_FILES))
        scratch.release(state)
        state = after
        if state.filter(~F.col("done")).isEmpty():
            return state.select("source", "mean", "a", "full")
    raise ValueError(f"rates were not found in {STEPS} steps")


def mixed(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
    weights: tuple[int, ...] = WEIGHTS, most: float = MOST,
) -> DataFrame:
    """(id, source, size, source_size, target, rate, copies) for each row of `docs`."""
    scratch = Scratch(docs.sparkSession, "mixing")
    rows = scratch.cut(
        docs.select(F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), word_count(F.col(text_column).cast("string")).alias("size"))
    )
    counts = scratch.cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")).coalesce(COUNT_FILES))
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    wanted = scratch.cut(targets(sizes, weights, most).coalesce(STATE_FILES))
    tilt = balanced_rates(counts, wanted, scratch, most)
    same = lambda x, y: F.col(f"{x}.source").eqNullSafe(F.col(f"{y}.source"))
    rated = counts.alias("c").join(wanted.alias("w"), same("c", "w")).join(tilt.alias("t"), same("c", "t")).select(
        "c.source", "c.size", "c.n", "w.source_size", "w.target",
        _rate(F.col("c.size") / F.col("t.mean"), F.col("t.a"), F.col("t.full"), most).alias("rate"),
        F.ceil(F.sqrt("c.n")).cast("long").alias("parts"),
    )
    # The running total of rates before each size; sizes of one source, not documents, are sorted here.
    before = Window.partitionBy("source").orderBy("size")
    mass = F.when(F.col("size") == 0, 0.0).otherwise(F.col("n") * F.col("rate"))
    begin = F.sum(mass).over(before) - mass
    copies = F.floor(begin + mass + 0.5) - F.floor(begin + 0.5)
    copies = F.when(F.col("rate") >= most, F.col("n") * int(most)).when(F.col("size") == 0, F.col("n")).otherwise(copies)
    rated = scratch.cut(rated.withColumn("copies", F.least(copies, F.col("n") * int(most)).cast("long")))
    fixes = _fixes(rated, most)
    rated = rated.alias("g").join(fixes.alias("f"), same("g", "f") & (F.col("g.size") == F.col("f.size")), "left").select(
        "g.*", (F.col("g.copies") + F.coalesce("f.more", F.lit(0))).alias("total")
    )
    with_rate = rows.alias("r").join(rated.alias("g"), same("r", "g") & (F.col("r.size") == F.col("g.size"))).select(
        "r.id", "r.source", "r.size", "g.source_size", "g.target", "g.rate", "g.n", "g.total",
        F.pmod(F.xxhash64(F.col("r.id"), F.lit(1)), F.col("g.parts")).alias("part"),
    )
    with_rate = scratch.cut(with_rate)
    parts = with_rate.groupBy("source", "size", "part").agg(F.count("*").alias("k"))
    earlier = Window.partitionBy("source", "size").orderBy("part")
    parts = parts.withColumn("skip", F.sum("k").over(earlier) - F.col("k"))
    inside = Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("id"), "id")
    ranked = with_rate.withColumn("place", F.row_number().over(inside))
    on = same("x", "p") & (F.col("x.size") == F.col("p.size")) & (F.col("x.part") == F.col("p.part"))
    placed = ranked.alias("x").join(parts.alias("p"), on).select("x.*", (F.col("p.skip") + F.col("x.place")).alias("nth"))
    share = lambda k: F.call_function("div", F.col("total") * k, F.col("n"))
    copies = (share(F.col("nth")) - share(F.col("nth") - 1)).cast("long")
    return placed.select("id", "source", "size", "source_size", "target", "rate", copies.alias("copies"))


def _fixes(rated: DataFrame, most: float) -> DataFrame:
    """(source, size, more): the copies to add or leave out so that each source's words come near its target."""
    size = F.struct("size", "n", "copies")
    groups = rated.filter("size > 0").groupBy("source").agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("missing"), F.sort_array(F.collect_list(size), False).alias("sizes")
    )
    none = F.array().cast("array<struct<size:bigint,more:bigint>>")

    def step(state: Column, x: Column) -> Column:
        wish = F.round(state["missing"] / x["size"]).cast("long")
        more = F.least(F.greatest(wish, -x["copies"]), x["n"] * int(most) - x["copies"])
        fixes = F.when(more == 0, state["fixes"]).otherwise(
            F.concat(state["fixes"], F.array(F.struct(x["size"].alias("size"), more.alias("more"))))
        )
        return F.struct((state["missing"] - more * x["size"]).alias("missing"), fixes.alias("fixes"))

    start = F.struct(F.col("missing").alias("missing"), none.alias("fixes"))
    fixed = F.aggregate("sizes", start, step, lambda state: state["fixes"])
    return groups.select("source", F.inline(fixed))

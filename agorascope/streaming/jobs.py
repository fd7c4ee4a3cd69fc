"""Streaming jobs over keyed messages (T1-T10, S8, S11). The operators are the batch ones."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from agorascope.functions.text import account
from agorascope.operators.aggregates import window_stats, window_volume
from agorascope.operators.edges import accumulate, replies_and_mentions_source
from agorascope.operators.lineage import cut
from agorascope.operators.rows import first_per_key
from agorascope.sources.files import batch_numbers, delete, folder_exists, newest, read_batches, write_batch
from agorascope.session import SETTINGS, ship
from agorascope.sources.messages import TOPICS, decode, parse, processed

BatchWriter = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Start a query. It runs to the end of the present input, or for good with `every` as interval.

    T8: after a restart it goes on from `checkpoint`; writers replace a batch that is repeated.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = stream.writeStream.outputMode(mode).foreachBatch(write).trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()


def start_ingest(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    topics: Mapping[str, T.StructType] = TOPICS,
    every: str | None = None,
) -> StreamingQuery:
    """Each batch is read and parsed once and written to `out`/raw and `out`/processed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        raw = parse(decode(batch), topics).persist()
        write_batch(raw, batch_id, f"{out}/raw")
        write_batch(processed(raw), batch_id, f"{out}/processed")
        raw.unpersist()

    return start(messages, write, checkpoint, every=every)


class _Activity(StreamingQueryListener):
    """When a query last had rows to read."""

    def __init__(self) -> None:
        self.query = ""
        self.last = time.monotonic()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        if str(event.progress.id) == self.query and event.progress.numInputRows:
            self.last = time.monotonic()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def export_rows(rows: DataFrame, out: str, checkpoint: str, limit: int, idle_seconds: float = 10.0) -> int:
    """Writes rows of a stream until `limit` are kept or nothing has come for `idle_seconds`; returns how many are at `out`.

    Filters before this count: only what they keep is counted. Offsets stay in `checkpoint`; none is committed to the
    source. A repeated batch replaces itself; a later call with the same folders goes on where this one stopped.
    """
    spark = rows.sparkSession
    before = {n: 0 for n in batch_numbers(spark, out)} if folder_exists(spark, out) else {}
    kept = {**before, **{r.batch_id: r["count"] for r in read_batches(spark, out).groupBy("batch_id").count().collect()}} if before else {}
    full = threading.Event()

    def write(batch: DataFrame, batch_id: int) -> None:
        room = limit - sum(n for number, n in kept.items() if number != batch_id)
        if room > 0:
            write_batch(batch.limit(room), batch_id, out)
            kept[batch_id] = spark.read.parquet(f"{out}/batch_id={batch_id}").count()
        if sum(kept.values()) >= limit:
            full.set()

    activity = _Activity()
    spark.streams.addListener(activity)
    query = start(rows, write, checkpoint, every="0 seconds")
    activity.query = str(query.id)
    try:
        while query.isActive and not full.wait(0.1) and time.monotonic() - activity.last < idle_seconds:
            pass
        if not query.isActive:
            query.awaitTermination()  # raises what ended it
    finally:
        query.stop()
        spark.streams.removeListener(activity)
    return sum(kept.values())


def window_updates(
    events: DataFrame, delay: str = "10 minutes", duration: str = "5 minutes", time: str = "event_ts", **named
) -> DataFrame:
    """Windowed volume and score of a stream by event time."""
    return window_stats(events.withWatermark(time, delay), duration, time, **named)


def window_closed(
    events: DataFrame, delay: str = "10 minutes", duration: str = "5 minutes", time: str = "kafka_ts", **named
) -> DataFrame:
    """Windowed volume of a stream by arrival time."""
    return window_volume(events.withWatermark(time, delay), duration, time, **named)


def start_window_updates(
    windows: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = None,
    keys: Sequence[str] = ("topic", "subreddit"),
    compact_after: int = 64,
) -> StreamingQuery:
    """T4: a window is written again whenever it grows; `read_windows` takes the newest version.

    After `compact_after` batches, and every so many again, older versions are merged away.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, out)
        if (batch_id + 1) % compact_after == 0:
            compact_windows(batch.sparkSession, out, keys)

    return start(windows, write, checkpoint, "update", every)


def start_window_appends(windows: DataFrame, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """T5: a window is written once, when the watermark has passed its end."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, out)

    return start(windows, write, checkpoint, "append", every)


def _days(out: str) -> str:
    return f"{out.rstrip('/')}-by-day"


def _versions(spark: SparkSession, out: str) -> DataFrame | None:
    """All versions of windows that are stored, with `day` and `batch_id`."""
    day = F.to_date("window_start").alias("day")
    parts = [read_batches(spark, out).select("*", day)] if batch_numbers(spark, out) else []
    if folder_exists(spark, _days(out)):
        parts.append(spark.read.parquet(_days(out)))
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_windows(spark: SparkSession, out: str, keys: Sequence[str], days: Sequence[str] | None = None) -> DataFrame:
    """T4: one row per window and key; with `days`, only of these days, whose files alone are read of compacted ones."""
    found = _versions(spark, out)
    if found is None:
        raise ValueError(f"no windows at {out}")
    if days is not None:
        found = found.filter(F.col("day").isin([date.fromisoformat(d) for d in days]))
    return newest(found, ["window_start", "window_end", *keys]).drop("day")


def compact_windows(spark: SparkSession, out: str, keys: Sequence[str]) -> None:
    """Merge the finished batches into a table with one version a window, partitioned by day, and delete them.

    Only days that the batches touch are read and replaced. A version keeps its batch number, so it does no harm if a stop
    leaves batches that are merged already, or if the stream writes its last batch once more: merging again changes nothing.
    """
    batches = batch_numbers(spark, out)
    if not batches:
        return
    fresh = read_batches(spark, out).filter(F.col("batch_id").isin(batches)).withColumn("day", F.to_date("window_start"))
    versions = fresh
    if folder_exists(spark, _days(out)):
        touched = fresh.select("day").distinct()  # a day a row
        versions = fresh.unionByName(spark.read.parquet(_days(out)).join(F.broadcast(touched), "day", "left_semi"))
    merged = cut(first_per_key(versions, ["window_start", "window_end", *keys], [F.desc("batch_id")]), "windows")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(_days(out))
    for number in batches:
        delete(spark, f"{out}/batch_id={number}")


def reply_links(
    messages: DataFrame, comment_topic: str = "comments", delay: str = "10 minutes", horizon: str = "7 days"
) -> DataFrame:
    """J1 on a stream: (comment, src, dst, seen), each comment with its parent's author, whichever of the two arrives first.

    A comment waits for its parent until the watermark has passed; a parent is kept for comments up to `horizon` later. A
    comment whose parent did not come in time has no `dst`. Of messages with one fullname the first to arrive counts.
    Messages without an event time have no place in event time and are left out.
    """
    timed = messages.filter(F.col("event_ts").isNotNull())
    comments = replies_and_mentions_source(timed, comment_topic).select(F.col("fullname").alias("comment"), "src", "parent_id", "seen")
    parents = timed.filter(F.col("fullname").isNotNull()).select(
        F.col("fullname").alias("parent"), account(F.col("author")).alias("dst"), F.col("event_ts").cast("timestamp").alias("parent_ts")
    )
    parents = parents.withWatermark("parent_ts", delay).dropDuplicatesWithinWatermark(["parent"])
    span = F.expr(f"parent_ts BETWEEN seen - INTERVAL {horizon} AND seen + INTERVAL {horizon}")
    joined = comments.withWatermark("seen", delay).join(parents, (F.col("parent_id") == F.col("parent")) & span, "left_outer")
    return joined.select("comment", "src", "parent_id", "dst", "seen", F.col("parent").isNotNull().alias("met"))


def start_reply_links(links: DataFrame, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """G1 on a stream: what `reply_links` finds, batch by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, out)

    return start(links, write, checkpoint, "append", every)


def read_reply_edges(spark: SparkSession, out: str) -> DataFrame:
    """G1: reply edges from the links written so far, as `edges.reply_edges` has them."""
    links = read_batches(spark, out).filter("dst IS NOT NULL AND src <> dst")
    one = F.lit(1).cast("long")
    rows = links.select("src", "dst", F.lit("reply").alias("edge_type"), one.alias("weight"), F.col("seen").alias("first_seen"), F.col("seen").alias("last_seen"))
    return accumulate(rows, "src", "dst", "edge_type")


def count_orphans(spark: SparkSession, out: str) -> int:
    """Comments whose parent had not come when their time was up."""
    return read_batches(spark, out).filter(~F.col("met")).count()


def dedupe(
    messages: DataFrame, key: str = "fullname", time: str = "event_ts", delay: str = "10 minutes"
) -> DataFrame:
    """The first message of each identity within the watermark, across restarts.

    A message without an identity is one with those only that are alike in every column.
    """
    whole = F.concat(F.lit("#"), F.sha2(F.to_json(F.struct(*messages.columns)), 256))
    marked = messages.withColumn("_identity", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), whole))
    return marked.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_identity"]).drop("_identity")


class _FirstOfKey(StatefulProcessor):
    """Gives back the first row of each key and remembers the key, for `ttl_ms` after its last row (for good if None)."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "done boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for part in rows:
            first = part.head(1) if first is None and len(part) else first
        known = self.seen.exists()
        if not known or self.ttl_ms is not None:
            self.seen.update((True,))
        if not known and first is not None:
            yield first

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self.seen.update((True,))

    def close(self) -> None:
        pass


def first_of_key(records: DataFrame, key: str, done: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """The first record of each key of a stream; records without a key all pass.

    What is known lies in keyed state (RocksDB), so a batch reads nothing that earlier batches wrote. `done` has keys that
    are known from the start; it is read once, when a query begins without a checkpoint.
    """
    ship(records.sparkSession)
    known = None if done is None else done.select(key).filter(F.col(key).isNotNull()).distinct().groupBy(key)
    fresh = records.filter(F.col(key).isNotNull()).groupBy(key).transformWithStateInPandas(
        _FirstOfKey(ttl_ms), records.schema, "Append", "None", initialState=known
    )
    return fresh.unionByName(records.filter(F.col(key).isNull()))


def start_scoring(
    records: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    key: str = "id",
    every: str | None = None,
    ttl_ms: int | None = None,
) -> StreamingQuery:
    """Score what earlier batches have not scored; a score once written stays. Rows without a key are all scored.

    A batch costs what its own records cost, however many are scored. Scores that `out` holds when a query begins without
    its checkpoint count as done. K8: limit a batch at its source, by `maxFilesPerTrigger` or `maxOffsetsPerTrigger`.
    """
    spark = records.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", SETTINGS["spark.sql.streaming.stateStore.providerClass"])
    again = folder_exists(spark, f"{checkpoint}/offsets") or not folder_exists(spark, out)
    earlier = None if again else read_batches(spark, out)
    offset = 0 if earlier is None else earlier.agg(F.max("batch_id")).first()[0] + 1
    mark = f"{checkpoint}/first-batch"
    if earlier is not None:
        spark.range(offset, offset + 1).write.mode("overwrite").parquet(mark)
    elif folder_exists(spark, mark):
        offset = spark.read.parquet(mark).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(score(batch), offset + batch_id, out)

    return start(first_of_key(records, key, earlier, ttl_ms), write, checkpoint, every=every)

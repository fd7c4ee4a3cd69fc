import json
import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorascope import schemas
from agorascope.operators import aggregates, classifier, edges
from agorascope.sources import files, messages
from agorascope.streaming import jobs

EVENT = T.StructType(
    [
        T.StructField("event_ts", T.TimestampType()), T.StructField("topic", T.StringType()),
        T.StructField("subreddit", T.StringType()), T.StructField("score", T.IntegerType()),
        T.StructField("fullname", T.StringType()),
    ]
)


def land(folder, name, rows, order):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    os.utime(path, (1_700_000_000 + order, 1_700_000_000 + order))


def event(at, name, score=1):
    return {"event_ts": at, "topic": "posts", "subreddit": "r1", "score": score, "fullname": name}


def run(query):
    query.awaitTermination()


def test_late_rows_are_dropped_and_windows_merge(spark, tmp_path):
    folder = str(tmp_path / "in")
    times = ["2024-01-02T10:00:00", "2024-01-02T11:00:00", "2024-01-02T11:01:00", "2024-01-02T10:30:00", "2024-01-01T10:00:00"]
    for i, at in enumerate(times):
        land(folder, f"{i}.json", [event(at, f"t{i}", i)], i)
    stream = messages.file_stream(spark, folder, EVENT, "json", maxFilesPerTrigger="1")
    out = str(tmp_path / "windows")
    run(jobs.start_window_updates(jobs.window_updates(stream), out, str(tmp_path / "ck")))
    rows = jobs.read_windows(spark, out, ["topic", "subreddit"]).collect()
    got = {(r["window_start"], r["volume"], r["avg_score"]) for r in rows}
    assert got == {(datetime(2024, 1, 2, 10), 1, 0.0), (datetime(2024, 1, 2, 11), 2, 1.5)}
    assert files.read_batches(spark, out).count() > len(rows)  # the 11:00 window was written twice


def test_append_emits_closed_windows_once_and_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    for i in range(4):
        land(folder, f"{i}.json", [event(f"2024-01-02T1{i}:{m:02}:00", f"t{i}{m}") for m in range(0, 60, 7)], i)
    stream = messages.file_stream(spark, folder, EVENT, "json", maxFilesPerTrigger="1")
    out = str(tmp_path / "closed")
    closed = jobs.window_closed(stream, "10 minutes", "30 minutes", "event_ts")
    run(jobs.start_window_appends(closed, out, str(tmp_path / "ck")))
    got = sorted(map(str, files.read_batches(spark, out).drop("batch_id").collect()))
    batch = aggregates.window_volume(spark.read.schema(EVENT).json(folder), "30 minutes", "event_ts")
    want = sorted(map(str, batch.filter(F.col("window_end") <= F.lit("2024-01-02 13:46:00").cast("timestamp")).collect()))
    assert got == want and len(got) == 7


def test_ingest_restart_adds_only_new_messages(spark, tmp_path):
    folder, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    schema = T.StructType(
        [T.StructField("topic", T.StringType()), T.StructField("timestamp", T.TimestampType()),
         T.StructField("value", T.StringType())]
    )

    def message(i, value=None):
        body = json.dumps({"id": f"c{i}", "fullname": f"t1_c{i}", "created_utc": 1704067200.5, "body": "Hi!"})
        return {"topic": "comments", "timestamp": "2024-01-02T10:00:00", "value": value or body}

    def ingest():
        run(jobs.start_ingest(messages.file_stream(spark, folder, schema, "json"), out, ck))

    land(folder, "0.json", [message(1), message(2, "broken")], 0)
    ingest()
    ingest()
    land(folder, "1.json", [message(3)], 1)
    ingest()
    assert files.read_batches(spark, f"{out}/raw").count() == 3
    done = files.read_batches(spark, f"{out}/processed")
    assert sorted((r["id"], r["text"]) for r in done.collect()) == [("c1", "hi"), ("c3", "hi")]
    assert set(done.columns) == {*schemas.PROCESSED, "batch_id"}


def test_dedupe_across_batches_and_restart(spark, tmp_path):
    folder, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def dedupe():
        stream = messages.file_stream(spark, folder, EVENT, "json", maxFilesPerTrigger="1")
        run(jobs.start_window_appends(jobs.dedupe(stream).select("fullname", "event_ts"), out, ck))

    land(folder, "0.json", [event("2024-01-02T10:00:00", "a"), event("2024-01-02T10:00:00", "b")], 0)
    dedupe()
    land(folder, "1.json", [event("2024-01-02T10:00:00", "a"), event("2024-01-02T10:00:01", "c")], 1)
    dedupe()
    assert sorted(r["fullname"] for r in files.read_batches(spark, out).collect()) == ["a", "b", "c"]


def test_scoring_scores_each_record_once(spark, tmp_path):
    folder, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    land(folder, "0.json", [event("2024-01-02T10:00:00", "a"), event("2024-01-02T10:00:00", "a")], 0)
    land(folder, "1.json", [event("2024-01-02T10:00:00", "a"), event("2024-01-02T10:00:00", "b")], 1)
    stream = messages.file_stream(spark, folder, EVENT, "json", maxFilesPerTrigger="1")

    def score(batch):
        return batch.select("fullname", F.lit("neu").alias("label"))

    run(jobs.start_scoring(stream, score, out, ck, "fullname"))
    assert sorted(r["fullname"] for r in files.read_batches(spark, out).collect()) == ["a", "b"]


def test_scoring_state_replay_and_lost_checkpoint(spark, tmp_path):
    folder, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    read = []

    def score(batch):
        read.append(batch.count())
        return batch.select("fullname", "score", F.lit("neu").alias("label"))

    def run_scoring(checkpoint):
        run(jobs.start_scoring(messages.file_stream(spark, folder, EVENT, "json", maxFilesPerTrigger="1"), score, out, checkpoint, "fullname"))

    rows = lambda: sorted((str(r["fullname"]), r["score"]) for r in files.read_batches(spark, out).collect())
    at = "2024-01-02T10:00:00"
    land(folder, "0.json", [event(at, "a", 1), event(at, "b", 1), event(at, None, 1)], 0)
    run_scoring(ck)
    land(folder, "1.json", [event(at, "a", 2), event(at, "c", 2), event(at, None, 2), event(at, None, 3)], 1)
    run_scoring(ck)
    first = [("None", 1), ("None", 2), ("None", 3), ("a", 1), ("b", 1), ("c", 2)]
    assert rows() == first and [n for n in read if n] == [3, 3]
    # What batches wrote is not read again: a batch works although the first one's files are gone.
    files.delete(spark, f"{out}/batch_id=0")
    land(folder, "2.json", [event(at, "a", 4), event(at, "d", 4)], 2)
    run_scoring(ck)
    assert rows() == [("None", 2), ("None", 3), ("c", 2), ("d", 4)]
    # A new checkpoint: all files come again, what `out` holds counts as done, and no earlier batch is replaced.
    run_scoring(str(tmp_path / "ck2"))
    assert [r for r in rows() if r[0] != "None"] == [("a", 1), ("b", 1), ("c", 2), ("d", 4)]
    run_scoring(str(tmp_path / "ck2"))
    assert [r for r in rows() if r[0] != "None"] == [("a", 1), ("b", 1), ("c", 2), ("d", 4)]


def test_the_trained_classifier_scores_a_stream(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    texts = [(f"{w} word {i % 5}", label) for i in range(30) for w, label in (("lovely", "pos"), ("awful", "neg"))]
    model = classifier.train(spark.createDataFrame(texts, "text string, label string"), "text", "label")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType())])
    for i, text in enumerate(["lovely thing", "an awful one", "", "lovely lovely", None]):
        land(folder, f"{i}.json", [{"id": f"m{i}", "text": text}, {"id": "m0", "text": "awful"}], i)
    stream = messages.file_stream(spark, folder, schema, "json", maxFilesPerTrigger="2")
    run(jobs.start_scoring(stream, lambda batch: classifier.predict(batch, model), out, str(tmp_path / "ck")))
    got = {r["id"]: r["sentiment"]["label"] for r in files.read_batches(spark, out).collect()}
    whole = spark.createDataFrame([(f"m{i}", t) for i, t in enumerate(["lovely thing", "an awful one", "", "lovely lovely", None])], schema)
    want = {r["id"]: r["sentiment"]["label"] for r in classifier.predict(whole, model).collect()}
    assert {k: v for k, v in got.items() if k != "m0"} == {k: v for k, v in want.items() if k != "m0"} and len(got) == 5
    assert got["m1"] == "neg" and got["m3"] == "pos"


def reply(at, name, author, parent=None, topic="comments"):
    return {"event_ts": at, "topic": topic, "fullname": name, "author": author, "parent_id": parent}


REPLY = T.StructType(
    [T.StructField("event_ts", T.TimestampType()), *[T.StructField(c, T.StringType()) for c in ("topic", "fullname", "author", "parent_id")]]
)


def test_reply_edges_of_a_stream_equal_batch_edges(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    r = random.Random(6)
    rows = [reply(f"2024-01-02T10:{i % 60:02}:00", f"t{i}", r.choice(["a", "b", "c", "[deleted]", None]), f"t{r.randrange(60)}", r.choice(["posts", "comments"])) for i in range(60)]
    r.shuffle(rows)  # replies before and after their parents, over several batches
    for i in range(0, 60, 15):
        land(folder, f"{i}.json", rows[i : i + 15], i)
    stream = messages.file_stream(spark, folder, REPLY, "json", maxFilesPerTrigger="1")
    links = jobs.reply_links(stream, delay="2 hours", horizon="2 hours")
    run(jobs.start_reply_links(links, out, str(tmp_path / "ck")))
    want = edges.reply_edges(spark.read.schema(REPLY).json(folder))
    got = jobs.read_reply_edges(spark, out)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and want.count() > 3


def test_replies_whose_parent_comes_too_late_are_counted(spark, tmp_path):
    folder, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def go():
        stream = messages.file_stream(spark, folder, REPLY, "json", maxFilesPerTrigger="1")
        run(jobs.start_reply_links(jobs.reply_links(stream, delay="10 minutes", horizon="1 hour"), out, ck))

    land(folder, "0.json", [reply("2024-01-02T10:00:00", "c1", "a", "p1"), reply("2024-01-02T10:00:00", "c2", "b", "p2")], 0)
    land(folder, "1.json", [reply("2024-01-02T09:59:00", "p1", "z", topic="posts")], 1)
    go()  # the first parent comes in time, in a later batch
    land(folder, "2.json", [reply("2024-01-02T18:00:00", "x", "y", topic="posts"), reply("2024-01-02T18:00:00", "c9", "q", "gone")], 2)
    land(folder, "3.json", [reply("2024-01-02T18:05:00", "x2", "y", topic="posts")], 3)
    go()  # the watermark passes eight hours
    land(folder, "4.json", [reply("2024-01-02T09:59:00", "p2", "z", topic="posts")], 4)
    land(folder, "5.json", [reply("2024-01-02T18:06:00", "x3", "y", topic="posts")], 5)
    go()
    assert [tuple(r)[:4] for r in jobs.read_reply_edges(spark, out).collect()] == [("a", "z", "reply", 1)]
    assert jobs.count_orphans(spark, out) == 1


def stats(out, spark, **options):
    found = jobs.read_windows(spark, out, ["topic", "subreddit"], **options)
    return sorted(tuple(r[c] for c in ("window_start", "topic", "subreddit", "volume", "avg_score")) for r in found.collect())


def test_compaction_keeps_windows_and_bounds_what_is_read(spark, tmp_path):
    folder, out, plain = (str(tmp_path / x) for x in ("in", "out", "plain"))
    for i in range(9):
        land(folder, f"{i}.json", [event(f"2024-01-0{2 + i % 3}T1{i % 4}:{m:02}:00", f"t{i}{m}", i) for m in range(0, 60, 20)], i)

    def go(target, ck, **options):
        stream = messages.file_stream(spark, folder, EVENT, "json", maxFilesPerTrigger="1")
        run(jobs.start_window_updates(jobs.window_updates(stream, delay="9 days"), target, str(tmp_path / ck), **options))

    go(plain, "ck1")
    go(out, "ck2", compact_after=4)
    assert stats(out, spark) == stats(plain, spark)
    assert files.batch_numbers(spark, out) == [8]  # batches 0 to 7 are merged away
    day = ["2024-01-03"]
    assert stats(out, spark, days=day) == [r for r in stats(plain, spark) if r[0].day == 3]
    assert "day IN" in (plan := jobs.read_windows(spark, out, ["topic", "subreddit"], day)._jdf.queryExecution().executedPlan().toString()) or "PartitionFilters" in plan


def test_compaction_survives_a_stop_between_write_and_delete(spark, tmp_path, monkeypatch):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(4):
        land(folder, f"{i}.json", [event(f"2024-01-02T1{m}:00:00", f"t{i}{m}", i) for m in range(i + 1)], i)
    stream = messages.file_stream(spark, folder, EVENT, "json", maxFilesPerTrigger="1")
    run(jobs.start_window_updates(jobs.window_updates(stream, delay="9 days"), out, str(tmp_path / "ck")))
    want, batches = stats(out, spark), files.batch_numbers(spark, out)
    assert batches[:4] == [0, 1, 2, 3]

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(jobs, "delete", stop)
        with pytest.raises(RuntimeError):
            jobs.compact_windows(spark, out, ["topic", "subreddit"])
    assert files.batch_numbers(spark, out) == batches and stats(out, spark) == want
    jobs.compact_windows(spark, out, ["topic", "subreddit"])
    assert files.batch_numbers(spark, out) == [] and stats(out, spark) == want
    # The last batch written once more after it was merged.
    files.write_batch(jobs.read_windows(spark, out, ["topic", "subreddit"]).limit(2), 3, out)
    assert stats(out, spark) == want
    jobs.compact_windows(spark, out, ["topic", "subreddit"])
    assert stats(out, spark) == want


def test_export_ends_when_enough_is_kept_or_nothing_comes(spark, tmp_path):
    folder, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    at = "2024-01-02T10:00:00"
    for i in range(4):
        land(folder, f"{i}.json", [event(at, f"m{i}{k}", k) for k in range(5)], i)
    stream = messages.file_stream(spark, folder, EVENT, "json", maxFilesPerTrigger="1").filter("score > 0")
    assert jobs.export_rows(stream, out, ck, 6, 30) == 6
    assert files.read_batches(spark, out).filter("score > 0").count() == 6
    # The same folders again with more room: it goes on and ends for want of rows.
    assert jobs.export_rows(stream, out, ck, 100, 3) <= 16
    names = [r.fullname for r in files.read_batches(spark, out).collect()]
    assert len(names) == len(set(names)) and len(names) >= 10
    assert jobs.export_rows(messages.file_stream(spark, folder, EVENT, "json").filter("score > 9"), str(tmp_path / "none"), str(tmp_path / "ck2"), 5, 2) == 0

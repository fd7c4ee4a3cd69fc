import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from agorascope import schemas
from agorascope.operators import quality
from agorascope.plans import corpus
from agorascope.sources import files, listings, marks, messages

POST = {"schema_version": 1, "source": "s", "event_type": "post", "ingested_at": "2024-01-01T00:00:00Z",
        "id": "p1", "fullname": "t3_p1", "subreddit": "news", "created_utc": 1704067200, "title": "Hi",
        "selftext": "", "score": 3, "over_18": False}
COMMENT = {"schema_version": 1, "source": "s", "event_type": "comment", "ingested_at": "2024-01-01T00:00:00Z",
           "id": "c1", "fullname": "t1_c1", "subreddit": "news", "created_utc": 1704067200.5, "body": "Yo there",
           "parent_id": "t3_p1", "score": 1}


def stream_rows(spark, rows):
    at = datetime(2024, 1, 1)
    made = [(t, at, k, v) for t, k, v in rows]
    return spark.createDataFrame(made, "topic string, timestamp timestamp, key string, value string")


def test_parse_edge_cases(spark):
    rows = [
        ("posts", "1", json.dumps(POST)),
        ("comments", "2", json.dumps(COMMENT)),
        ("comments", "3", json.dumps({**COMMENT, "id": "c2", "score": 2.5, "title": "not a comment field"})),
        ("comments", "4", "not json"),
        ("comments", "5", None),
        ("posts", "6", json.dumps({**POST, "id": None})),
        ("other", "7", json.dumps(POST)),
    ]
    raw = messages.parse(messages.decode(stream_rows(spark, rows)))
    assert raw.count() == 6  # unknown topics go, unparseable rows stay
    got = {r["id"]: r for r in messages.processed(raw).collect()}
    assert set(got) == {"p1", "c1", "c2"}
    assert list(got["p1"].asDict()) == list(schemas.PROCESSED)
    assert got["p1"]["text"] == "hi" and got["p1"]["event_ts"] == datetime(2024, 1, 1)
    assert got["c1"]["event_ts"] == datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert got["c2"]["score"] is None and got["c2"]["title"] is None


def test_publish_key_and_nulls(spark):
    rows = spark.createDataFrame(
        [("t1_a", "a", "é"), ("", "b", None), (None, None, "x")], "fullname string, id string, body string"
    )
    got = messages.publishable(rows, "comments").collect()
    assert [r["key"] for r in got] == ["t1_a", "b", ""]
    assert json.loads(got[1]["value"]) == {"fullname": "", "id": "b", "body": None}
    assert "é" in got[0]["value"]


def test_contract_violations(spark):
    rows = [
        ("posts", "ok", json.dumps(POST)),
        ("posts", "extra", json.dumps({**POST, "more": [1]})),
        ("posts", "wrong", json.dumps({**POST, "score": "x", "schema_version": 2, "over_18": 1})),
        ("comments", "lacks", json.dumps({k: v for k, v in COMMENT.items() if k != "body"})),
        ("comments", "nulls", json.dumps({**COMMENT, "source": None, "body": None})),
        ("comments", "junk", "[1, 2]"),
    ]
    checked = quality.check(messages.decode(stream_rows(spark, rows)).withColumn("key", F.lit("")))
    found = sorted(tuple(sorted(r["violations"])) for r in checked.collect())
    assert found == sorted(
        [(), (), ("const:schema_version", "type:over_18", "type:score"), ("missing:body",), ("null:source",),
         ("not_json",)]
    )
    assert quality.accepted(checked).count() == 2
    assert {r["json_str"] for r in quality.rejected(checked).collect()} >= {"[1, 2]"}


def test_listing(spark):
    envelopes = [
        {"data": {"children": [{"kind": "t3", "data": {"id": "a", "name": "t3_a", "title": "T"}}, {"kind": "t1"}]}},
        {"data": {"children": []}}, {"data": None}, {},
    ]
    landed = spark.createDataFrame([(json.dumps(e),) for e in envelopes], "value string")
    posts = listings.normalise_posts(listings.unnest(landed), F.lit("now"), "src").collect()
    assert len(posts) == 1
    assert (posts[0]["fullname"], posts[0]["event_type"], posts[0]["schema_version"]) == ("t3_a", "post", 1)
    assert list(posts[0].asDict()) == schemas.POST.names


def test_jsonl_utf16_and_corpus(spark, tmp_path):
    lines = [
        json.dumps({**COMMENT, "id": "a", "body": "  long enough é "}), "", "  ",
        json.dumps({**COMMENT, "id": "b", "body": "tiny"}),
        json.dumps({**COMMENT, "id": "a", "body": "a later copy", "created_utc": 1704067300}),
    ]
    path = tmp_path / "in.jsonl"
    path.write_text("\r\n".join(lines), encoding="utf-16", newline="")
    rows = files.read_jsonl(spark, str(path), schemas.COMMENT)
    assert rows.count() == 3
    out = corpus.export_corpus(rows, arrival="created_utc", with_event_type=False)
    got = out.collect()
    assert [(r["id"], r["text"]) for r in got] == [("a", "long enough é")]
    assert "event_type" not in out.columns
    utf8 = tmp_path / "in8.jsonl"
    utf8.write_text("\n".join(lines), encoding="utf-8")
    assert files.read_jsonl(spark, str(utf8), schemas.COMMENT, "UTF-8").count() == 3


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", 'two\nlines, "quoted"', "pos"), ("2", "plain", "neg")]
    files.write_csv(spark.createDataFrame(rows, schemas.LABELLED), str(tmp_path / "out"))
    assert sorted(tuple(r) for r in files.read_csv(spark, str(tmp_path / "out")).collect()) == rows


def test_report_json_and_log(spark, tmp_path):
    report = spark.createDataFrame([("neg", 0.5)], "label string, f1 double")
    files.write_report(report, str(tmp_path / "r"))
    text = "".join(p.read_text() for p in (tmp_path / "r").glob("part-*"))
    assert text == "label\tf1\nneg\t0.5\n"
    files.write_json(report, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1
    for _ in range(2):
        files.append_rows(report, str(tmp_path / "log"))
        files.replace_table(report, str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    stored = files.read_table(spark, str(tmp_path / "table"), ["label"], F.col("f1") > 0)
    assert [tuple(r) for r in stored.collect()] == [("neg",)]


def test_batches_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "b")
    old = spark.createDataFrame([("k", 1), ("m", 5)], "key string, n int")
    files.write_batch(old, 0, path)
    files.write_batch(old, 0, path)
    files.write_batch(spark.createDataFrame([("k", 2)], "key string, n int"), 1, path)
    batches = files.read_batches(spark, path)
    assert batches.count() == 3
    assert sorted((r["key"], r["n"]) for r in files.newest(batches, ["key"]).collect()) == [("k", 2), ("m", 5)]


def test_marks(spark, tmp_path):
    items = spark.createDataFrame(
        [("posts", "a", "f1", 10), ("posts", "a", "f2", 11), ("posts", "b", "f3", 5), ("posts", "c", "f4", None)],
        "kind string, channel string, fullname string, created_utc long",
    )
    known = spark.createDataFrame([("posts", "a", 10), ("posts", "z", 99)], "kind string, channel string, last_created_utc long")
    fresh = marks.new_items(items, known)
    assert [r["fullname"] for r in marks.oldest_first(fresh).collect()] == ["f3", "f2"]
    after = marks.next_marks(known, fresh)
    want = {("a", 11), ("b", 5), ("z", 99)}
    assert {(r["channel"], r["last_created_utc"]) for r in after.collect()} == want
    marks.save_marks(known, 0, str(tmp_path / "m"))
    marks.save_marks(after, 1, str(tmp_path / "m"))
    assert {(r["channel"], r["last_created_utc"]) for r in marks.load_marks(spark, str(tmp_path / "m")).collect()} == want


def test_label_set_is_exact_and_repeatable(spark):
    docs = spark.range(500).select(F.col("id"), F.concat(F.lit("some text number "), F.col("id")).alias("text"))
    once = corpus.label_set(docs).collect()
    again = corpus.label_set(docs.repartition(7)).collect()
    assert len(once) == 100 and {r["id"] for r in once} == {r["id"] for r in again}
    assert corpus.label_set(docs.limit(5)).count() == 5


def test_max_rows_caps_kept_messages(spark):
    rows = spark.createDataFrame([(f"c{i}", i, "body text") for i in range(10)], "id string, created_utc int, body string")
    full = rows.select(
        *[F.col(n) if n in rows.columns else F.lit(None).cast("string").alias(n) for n in schemas.COMMENT.names]
    )
    assert corpus.export_corpus(full, arrival="created_utc", max_rows=4).count() == 4


def test_kafka_reader_needs_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.topic_batch(spark, "nowhere:1", ["posts"])

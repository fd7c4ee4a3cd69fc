"""The registered queries and the pipeline, on the smallest tables, against SQL and brute force."""

import os
import re

import pytest
from test_dedup import SPACE, classes, hits, kept_words

import corpus_pipeline
from agorascope.llm import toxicity
from agorascope.llm.queries import ORACLES, REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    from compare import connect, oracle_rows, spark_rows

    assert spark_rows(REGISTRY[name](spark, SF_DIR)) == oracle_rows(connect(SF_DIR), ORACLES[name])


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))


def test_other_queries_return_every_row(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    for name, table, key in (("op5_", docs, "doc_id"), ("op8_", docs, "doc_id"), ("op10_", docs, "doc_id"), ("op11_", docs, "doc_id"), ("op6_", pages, "page_id"), ("op9_", pages, "page_id")):
        query = next(n for n in REGISTRY if n.startswith(name))
        got = sorted(r[key] for r in REGISTRY[query](spark, SF_DIR).select(key).collect())
        assert got == sorted(r[key] for r in table.select(key).collect())


def test_main_text_is_the_article(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in REGISTRY["op9_html_extraction"](spark, SF_DIR).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        plain = html.unescape(re.sub(r"</?(?:p|h1|br|div|ul|li)[^>]*>", " ", article).replace("<b>", "").replace("</b>", ""))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)


def test_license_lines_are_found(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, i) for r in rows for i, line in enumerate((r.text or "").split("\n")) if re.search(r"(?i)\blicensed? |MIT License", line))
    assert sorted((r.doc_id, r.place) for r in REGISTRY["op4_license_scan"](spark, SF_DIR).collect()) == want


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "source_mixing"]
    stage = dict(corpus_pipeline.STAGES)
    rows = docs.collect()

    kept = stage["toxicity"](spark, docs, SF_DIR).collect()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
    assert sorted(kept) == sorted(tuple(r[c] for c in columns) for r in scored if r.score < 0.5)

    kept = stage["ngram_jaccard_join"](spark, docs, SF_DIR).collect()
    group = classes([(r.doc_id, r.text) for r in rows])
    assert sorted(kept) == sorted(r for r in rows if group[r.doc_id] == r.doc_id)

    got = {r.doc_id: r for r in stage["substring_dedup"](spark, docs, SF_DIR).collect()}
    for r, (_, _, text) in zip(rows, kept_words([(r.doc_id, r.text) for r in rows]), strict=True):
        assert got[r.doc_id].text == text and got[r.doc_id].n_chars == len(text) and got[r.doc_id].source == r.source

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = stage["benchmark_decontamination"](spark, docs, SF_DIR).collect()
    assert sorted(kept) == sorted(r for r in rows if hits(r.text, items)[1] == 0)

    taken = stage["source_mixing"](spark, docs, SF_DIR)
    assert taken.columns == [*columns, "copy"]
    total = sum(len(re.findall(SPACE, r.text or "")) for r in rows)
    assert abs(sum(len(re.findall(SPACE, r.text or "")) for r in taken.collect()) - total) <= 0.02 * total


def test_run_is_all_stages(spark):
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert out and max(r.copy for r in out) <= 3 and len({(r.doc_id, r.copy) for r in out}) == len(out)


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, None, None, None, 0), (1, None, None, None, 0), (2, "a b c d e f", "en", "s", 1), (3, "A b c d e f", "en", "s", 1)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            assert out.columns[:5] == docs.columns and out.count() <= 3 * len(some)
            if name == "ngram_jaccard_join" and some:
                assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "1", "2", "None"]


def test_rows_without_an_id_or_of_one_id_stay(spark):
    """A third of the ids is null and some repeat with other texts: every clean row passes, and enters the mix."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    clean = [(None if i % 3 == 0 else i // 4, text(i), "en", "ab"[i % 2], 1) for i in range(60)]
    near = [(None, text(0) + " more", "en", "a", 1), (7, text(1), "fr", "b", 1), (None, text(2), "fr", "b", 1)]
    rows = clean + near
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.createDataFrame(rows, schema).repartition(3)
    out = stage["ngram_jaccard_join"](spark, docs, SF_DIR).collect()
    assert sorted(map(str, out)) == sorted(map(str, spark.createDataFrame(clean, schema).collect()))
    for name in ("toxicity", "substring_dedup", "benchmark_decontamination"):
        kept = stage[name](spark, spark.createDataFrame(clean, schema), SF_DIR)
        assert sorted(map(str, kept.collect())) == sorted(map(str, spark.createDataFrame([(*r[:4], len(r[1]) if name == "substring_dedup" else 1) for r in clean], schema).collect()))
    mixed = stage["source_mixing"](spark, spark.createDataFrame(clean, schema), SF_DIR).collect()
    taken = {s: sum(12 for r in mixed if r.source == s) for s in "ab"}
    assert abs(taken["a"] - 720 * 5 / 7) <= 12 and abs(taken["b"] - 720 * 2 / 7) <= 12
    assert any(r.doc_id is None for r in mixed)

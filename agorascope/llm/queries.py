"""Registered queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.llm import decontaminate, extract, jaccard, labelled, licenses, mixing, quality, ranking, sharding, substrings, topk, toxicity, trie, urls

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text):
    return F.sha2(text.cast("binary"), 256)


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.repeated_words(docs).select(
        "doc_id", "n_words", "n_removed", _sha256(F.col("kept_text")).alias("kept_sha256")
    )


@query
def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.benchmark_hits(docs, _table(spark, sf_dir, "benchmark"))
    names = F.transform("items", lambda x: x.cast("string"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        _sha256(F.concat_ws(",", F.array_sort(names))).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(rows, F.col("vec_id") % 100 == 0).withColumnRenamed("id", "vec_id")


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_paragraphs(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "place", "family", "probability", "similarity")


@query
def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mix.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate"
    )


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    found = toxicity.scored(docs, toxicity.fit(docs, labels))
    return found.select("doc_id", labelled.held_out("doc_id").alias("held_out"), "score", "predicted", "neighbours")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    found = quality.scored(docs, quality.fit(docs, labels))
    return found.select("doc_id", labelled.held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.main_texts(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


@query
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages).select("page_id", "host", "path", "rule", "verdict", "block_odds")


@query
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.sharded(_table(spark, sf_dir, "documents"))
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return placed.select(
        "record.doc_id", "size", F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranking.ranked(docs, _table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLES["op1_substring_dedup"] = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 19) AS p FROM w, unnest(range(1, len(w) - 18)) AS t(i)),
firsts AS (SELECT p, min((doc_id, i)) AS f FROM win GROUP BY p HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM win JOIN firsts USING (p), unnest(range(0, 20)) AS t(k) WHERE (doc_id, i) > f),
every AS (SELECT doc_id, i, w[i] AS word FROM w, unnest(range(1, len(w) + 1)) AS t(i)),
kept AS (
  SELECT e.doc_id, count(g.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY e.i) FILTER (WHERE g.i IS NULL), '') AS s
  FROM every e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

ORACLES["op2_benchmark_decontamination"] = f"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
pat AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, list_slice(w, i, i + least(10, len(w)) - 1) AS p
  FROM iw, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
win AS (
  SELECT doc_id, i, m, list_slice(w, i, i + m - 1) AS p
  FROM dw, (SELECT DISTINCT m FROM pat), unnest(range(1, len(w) - m + 2)) AS t(i)),
hit AS (SELECT doc_id, i, m, item_id FROM win JOIN pat USING (m, p)),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, m)) AS t(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op7_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + least(5, len(w)) - 1) AS p
  FROM w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.p = b.p AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(node, other) AS (SELECT a, b FROM links UNION SELECT node, b FROM reach JOIN links ON other = a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(r.other, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node, min(other) AS other FROM reach GROUP BY node) r ON r.node = w.doc_id
"""

ORACLES["op3_exact_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 10
"""

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLES["op12_ranked_search"] = f"""
WITH dw AS (SELECT doc_id, w FROM (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERMS}') AS w FROM documents) WHERE len(w) > 0),
d AS (SELECT doc_id, w, len(w) AS n, row_number() OVER () AS row FROM dw),
total AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM d),
it AS (SELECT item_id, row_number() OVER () AS item, regexp_extract_all({_LOWER}, '{_TERMS}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item, item_id, unnest(w) AS term FROM it),
tf AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(w) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * all_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w FROM df, total),
s AS (
  SELECT item, item_id, row, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * all_docs) // all_terms))))) AS BIGINT) AS score
  FROM iw JOIN tf USING (term) JOIN wt USING (term), total GROUP BY ALL)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0) WHERE r <= 50
"""

_CRC_STEP = "list_reduce(list_concat([xor(x, y)], range(0, 8)), lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))"

ORACLES["op13_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS turns
  FROM t GROUP BY c),
h AS (
  SELECT c, turns, c - c % 20 AS base, xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda x, y: {_CRC_STEP})) % 4 AS h FROM own),
conv AS (
  SELECT h.c, list_concat(coalesce(o.turns, [])[1:h.h], h.turns[h.h + 1:]) AS path FROM h LEFT JOIN own o ON o.c = h.base),
reach AS (SELECT c, d, path[1:d] AS p, len(path) = d AS ends FROM conv, unnest(range(0, len(path) + 1)) AS u(d)),
node AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '') AS ids
  FROM reach GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
full_node AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children,
    (n_convs - 1) * CASE WHEN node.d = 0 THEN 0 ELSE len(regexp_extract_all(node.p[node.d].text, '{_SPACED}')) END AS own
  FROM node LEFT JOIN kids ON kids.d = node.d AND kids.p = node.p),
below AS (
  SELECT u.d, p[1:u.d] AS p, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens
  FROM full_node, unnest(range(0, full_node.d + 1)) AS u(d) GROUP BY ALL)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens,
  sha256(n.ids) AS ends_sha256
FROM full_node n JOIN below b ON b.d = n.d AND b.p = n.p LEFT JOIN node up ON up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
"""

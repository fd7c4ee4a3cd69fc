"""The registered queries: each reads whole tables of `sf_dir` and returns one table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorascope.functions import scores, text
from agorascope.operators import (
    aggregates,
    centrality,
    classifier,
    communities,
    edges,
    enrichment,
    evaluation,
    features,
    graph,
    quality,
    rows,
    sentiment,
    topics,
    trends,
)
from agorascope.operators.lineage import cut, new_path
from agorascope.plans import corpus
from agorascope.plans.fixtures import (
    PHRASE_RULES,
    RULES,
    STOP_WORDS,
    emoji,
    idioms,
    lexicon,
    records,
    social,
    table,
    three_labels,
)
from agorascope.sources import files, listings, marks, messages
from agorascope.sources.edge_table import EdgeTable
from agorascope.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The social messages as a topic delivers them: topic, timestamp, key, value."""
    posts, comments = records(social(spark, sf_dir))
    sides = [
        messages.publishable(side.withColumnRenamed("kafka_ts", "timestamp"), topic, "timestamp")
        for topic, side in (("posts", posts), ("comments", comments))
    ]
    both = sides[0].unionByName(sides[1])
    return both.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.balanced(table(spark, sf_dir, "documents"), "doc_id")


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.interaction_edges(social(spark, sf_dir))


def _stored_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges as the graph jobs read them, from a table."""
    return cut(_edges(spark, sf_dir), "edges")


# --- messages and text ---


@query
def json_roundtrip_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7, P1-P3, P6, P7, U1, F1-F3."""
    raw = messages.parse(messages.decode(_published(spark, sf_dir)))
    return _ntz(messages.processed(raw), "kafka_ts", "event_ts")


@query
def epoch_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 on whole and fractional seconds and on instants in a repeated local hour."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = table(spark, sf_dir, "events")
    whole = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    quarter = whole + (F.col("event_id") % 4) * F.lit(0.25)
    repeated = F.lit(1729990800) + F.col("event_id")
    timed = events.select(
        "event_id",
        scores.epoch_to_timestamp(whole).alias("whole_ts"),
        scores.epoch_to_timestamp(quarter).alias("quarter_ts"),
        scores.epoch_to_timestamp(repeated).alias("repeated_ts"),
    )
    return _ntz(timed, "whole_ts", "quarter_ts", "repeated_ts")


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as listing envelopes of at most 100 children; system turns carry no data."""
    turns = table(spark, sf_dir, "conversations")
    name = F.concat(F.lit("t1_"), "conv_id", F.lit("_"), "turn")
    parent = F.concat(F.lit("t1_"), "conv_id", F.lit("_"), F.col("turn") - 1)
    is_post = F.col("turn") == 0
    data = F.struct(
        F.concat("conv_id", F.lit("_"), "turn").alias("id"),
        F.when(is_post, F.regexp_replace(name, "^t1", "t3")).otherwise(name).alias("name"),
        F.concat(F.lit("c"), "conv_id").alias("subreddit"),
        F.col("role").alias("author"),
        F.col("turn").alias("created_utc"),
        F.when(is_post, F.col("text")).alias("title"),
        F.when(~is_post, F.col("text")).alias("body"),
        F.when(~is_post, parent).alias("parent_id"),
    )
    child = F.struct(
        F.when(is_post, "t3").otherwise("t1").alias("kind"),
        F.when(F.col("role") != "system", data).alias("data"),
    )
    pages = turns.groupBy("conv_id", F.floor(F.col("turn") / 100).alias("page")).agg(
        F.collect_list(child).alias("children")
    )
    envelope = F.struct(F.struct("children").alias("data"))
    return pages.select(F.to_json(envelope).alias("value"))


@query
def listing_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, P4, P5, U1."""
    items = listings.unnest(_listings(spark, sf_dir))
    stamp = F.lit("2024-01-01T00:00:00+00:00")
    posts = listings.normalise_posts(items.filter("kind = 't3'"), stamp, "fixture")
    comments = listings.normalise_comments(items.filter("kind = 't1'"), stamp, "fixture")
    return listings.unite(posts, comments)


@query
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, F3."""
    joined = text.join_parts(F.col("source"), F.lit(None), F.col("text"))
    return _documents(spark, sf_dir).select("doc_id", text.clean(joined).alias("cleaned"))


@query
def text_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4, F8, F15 on columns that are missing, blank or padded in turn."""
    docs = _documents(spark, sf_dir)
    padded = F.concat(F.lit("\t\u3000"), "text", F.lit(" \n"))
    which = F.col("doc_id") % 5
    shaped = docs.select(
        "doc_id",
        F.when(which == 0, padded).when(which == 1, " \t").alias("text"),
        F.when(which == 1, padded).when(which == 2, "").alias("body"),
        F.when(which >= 2, F.concat(F.lit("  "), "source")).alias("title"),
        F.when(which == 3, padded).alias("selftext"),
    )
    chosen = text.fallback_text(shaped.columns)
    return shaped.select("doc_id", chosen.alias("chosen"), F.length(chosen).alias("text_len"))


@query
def label_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5 on whole pages."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", text.clean_label_text(F.col("html")).alias("cleaned"))


@query
def label_set_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, P10, F5, K9."""
    return corpus.label_set(_documents(spark, sf_dir), id_col="doc_id")


@query
def corpus_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, A16 on messages that all arrive twice, the second time with another body."""
    raw = messages.parse(messages.decode(_published(spark, sf_dir)))
    again = raw.withColumn("kafka_ts", F.col("kafka_ts") + F.expr("INTERVAL 1 HOUR"))
    again = again.withColumn("body", F.concat("body", F.lit(" (edited)")))
    return corpus.export_corpus(raw.unionByName(again))


@query
def mention_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, A17."""
    posts = social(spark, sf_dir)
    return posts.select("id", F.explode(text.mentions(F.col("body"))).alias("mention"))


@query
def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on messages of which nine in ten were damaged, each tenth in its own way."""
    good = _published(spark, sf_dir).select("topic", F.col("timestamp").alias("kafka_ts"), "key", "value")
    how = F.split("key", "_")[1].cast("long") % 10
    value = F.col("value")

    def damage(pattern: str, replacement: str) -> Column:
        return F.regexp_replace(value, pattern, replacement)

    damaged = (
        F.when(how == 0, "not json")
        .when(how == 1, damage('"id":"[^"]*",', ""))
        .when(how == 2, damage('"score":[^,}]*', '"score":"many"'))
        .when(how == 3, damage('"schema_version":1', '"schema_version":2'))
        .when(how == 4, damage('"created_utc":[0-9.E]+', '"created_utc":"soon"'))
        .when(how == 5, damage('"ingested_at":"[^"]*"', '"ingested_at":null'))
        .when(how == 6, damage('"event_type":"[a-z]*"', '"event_type":"other"'))
        .when(how == 7, damage('"author":(null|"[^"]*")', '"author":7'))
        .when(how == 8, damage('"subreddit":"[^"]*",', ""))
        .otherwise(value)
    )
    checked = quality.check(good.withColumn("json_str", damaged))
    return checked.select("key", "topic", F.concat_ws(",", "violations").alias("violations"))


# --- aggregates ---


@query
def window_volume_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, T3 for windows of 5 minutes and 6 hours."""
    posts = social(spark, sf_dir)
    sizes = [
        aggregates.window_stats(posts, size).withColumn("size", F.lit(size))
        for size in ("5 minutes", "6 hours")
    ]
    both = sizes[0].unionByName(sizes[1])
    return both.withColumn("avg_score", F.round("avg_score", 6))


@query
def window_volume_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2."""
    return aggregates.window_volume(social(spark, sf_dir))


@query
def top_channels_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, P13, as of the latest message."""
    posts = social(spark, sf_dir)
    as_of = F.lit(posts.agg(F.max("event_ts")).first()[0]).cast("timestamp_ntz")
    return aggregates.top_channels(aggregates.window_stats(posts), as_of)


@query
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1."""
    posts = social(spark, sf_dir).select("id", "event_ts", "topic", "subreddit")
    return rows.latest(posts, "event_ts", "id", 20)


@query
def latest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2."""
    return rows.latest(aggregates.window_volume(social(spark, sf_dir)), "window_start", "topic", 5)


@query
def kpi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, A18."""
    raw = messages.parse(messages.decode(_published(spark, sf_dir)))
    links = _stored_edges(spark, sf_dir)
    return aggregates.row_counts(
        raw=raw, processed=messages.processed(raw), edges=links, nodes=graph.vertices(links)
    )


@query
def incremental_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marks after a poll, where one channel had none and one is up to date."""
    items = social(spark, sf_dir).select(
        F.col("topic").alias("kind"), F.col("subreddit").alias("channel"), "fullname",
        F.floor(F.unix_micros(F.col("event_ts").cast("timestamp")) / 1_000_000).alias("created_utc"),
    )
    span = items.groupBy(*marks.KEY).agg(F.min("created_utc").alias("lo"), F.max("created_utc").alias("hi"))
    half = F.floor((F.col("lo") + F.col("hi")) / 2)
    known = span.filter("channel <> 'r7'").select(
        *marks.KEY, F.when(F.col("channel") == "r6", F.col("hi")).otherwise(half).alias("last_created_utc")
    )
    fresh = marks.new_items(items, known)
    counts = fresh.groupBy(*marks.KEY).agg(F.count("*").alias("n_new"))
    after = marks.next_marks(known, fresh)
    return after.join(counts, marks.KEY, "left").withColumn("n_new", F.coalesce("n_new", F.lit(0)))


# --- edges and graph ---


@query
def reply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11, P14, J1, A6."""
    return _ntz(edges.reply_edges(social(spark, sf_dir)), "first_seen", "last_seen")


@query
def mention_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, P14, A6."""
    return _ntz(edges.mention_edges(social(spark, sf_dir)), "first_seen", "last_seen")


@query
def interaction_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1."""
    return _ntz(_edges(spark, sf_dir), "first_seen", "last_seen")


@query
def edges_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of messages, merged, equal one pass."""
    posts = social(spark, sf_dir)
    odd = F.col("event_id") % 2 == 1
    first = edges.interaction_edges(posts.filter(~odd), parents=posts)
    second = edges.interaction_edges(posts.filter(odd), parents=posts)
    return _ntz(edges.merge_edges(first, second), "first_seen", "last_seen")


@query
def edges_bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of messages merged into a stored table, one of them twice, equal one pass."""
    posts = social(spark, sf_dir)
    path = new_path(spark, "edges")
    stored = EdgeTable(spark, f"edges_{path[-32:]}", path, parts=8, buckets=4)
    for batch in (0, 1, 1, 2):
        stored.merge(edges.interaction_edges(posts.filter(F.col("event_id") % 3 == batch), parents=posts), batch)
    return _ntz(stored.edges(), "first_seen", "last_seen")


@query
def weighted_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7, A10, F12, G2."""
    return graph.weighted_degrees(_edges(spark, sf_dir))


@query
def top_weighted_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3."""
    return rows.top_k(graph.weighted_degrees(_edges(spark, sf_dir)), "degree_w", "node", 50)


@query
def undirected_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8."""
    return edges.undirected(_edges(spark, sf_dir))


def _fixed_partition(links: DataFrame) -> DataFrame:
    number = F.regexp_extract("node", "[0-9]+", 0).cast("int")
    return graph.vertices(links).select("node", (number % 5).alias("community"))


@query
def modularity_of_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 for the partition by user number."""
    pairs = edges.undirected(_stored_edges(spark, sf_dir))
    quality_row = graph.modularity(pairs, _fixed_partition(pairs))
    return quality_row.withColumn("modularity", F.round("modularity", 9))


@query
def top_degree_subgraph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6, K5, J2, J3, F13; community 4 is left out of the labels, so its nodes show -1."""
    links = _stored_edges(spark, sf_dir)
    labels = _fixed_partition(links).filter("community <> 4")
    return graph.top_degree_subgraph(links, labels, 60)[0]


@query
def top_degree_subgraph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6, J3, J4."""
    links = _stored_edges(spark, sf_dir)
    labels = _fixed_partition(links).filter("community <> 4")
    return graph.top_degree_subgraph(links, labels, 60)[1]


@query
def betweenness_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From every node."""
    metrics = centrality.graph_metrics(_stored_edges(spark, sf_dir))
    return metrics.withColumn("betweenness", F.round("betweenness", 9))


@query
def betweenness_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 from 32 pivots."""
    between = centrality.betweenness(_stored_edges(spark, sf_dir), pivots=32)
    return between.withColumn("betweenness", F.round("betweenness", 9))


@query
def eigenvector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4."""
    found = centrality.eigenvector(_stored_edges(spark, sf_dir), tolerance=1e-9)
    return found.withColumn("centrality", F.round("centrality", 6))


@query
def louvain_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summary."""
    _, _, summary = communities.community_outputs(_stored_edges(spark, sf_dir))
    listed = F.transform("top10_sizes", lambda x: F.concat_ws(":", x["community"], x["size"]))
    return summary.withColumn("top10_sizes", F.concat_ws(",", listed)).withColumn(
        "modularity", F.round("modularity", 9)
    )


def _turn_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation linked to the next one."""
    turns = table(spark, sf_dir, "conversations")
    name = F.concat(F.lit("c"), "conv_id", F.lit("_"), "turn")
    after = F.lead(name).over(Window.partitionBy("conv_id").orderBy("turn"))
    return turns.select(name.alias("src"), after.alias("dst"), F.lit(1.0).alias("weight")).filter("dst IS NOT NULL")


@query
def louvain_of_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the communities are known, conversations, each node's community by size and name."""
    return communities.louvain(_turn_edges(spark, sf_dir))


@query
def louvain_of_turns_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Its run summary."""
    _, _, summary = communities.community_outputs(_turn_edges(spark, sf_dir))
    listed = F.transform("top10_sizes", lambda x: F.concat_ws(":", x["community"], x["size"]))
    return summary.select(
        "algo", "nodes", "edges", "communities", F.round("modularity", 9).alias("modularity"), F.concat_ws(",", listed).alias("top10_sizes")
    )


@query
def publish_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: the place of each message when they are published oldest first."""
    items = social(spark, sf_dir).select("fullname", F.col("event_ts").alias("created_utc"))
    ordered = marks.oldest_first(items).withColumn("at", F.monotonically_increasing_id())
    return rows.with_row_index(ordered, [F.asc("at")], "position").select("fullname", "position")


# --- sentiment, evaluation, features ---


@query
def lexicon_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M3, F7, F9, P8."""
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    scored = sentiment.score_table(docs, lexicon(spark), "doc_id", "text", RULES, scored_at=stamp)
    return scored.drop("text").withColumn("sentiment_compound", F.round("sentiment_compound", 3))


@query
def lexicon_sentiment_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M3 over records whose ids repeat or are missing: each row has the score of its own text."""
    key = F.when(F.col("doc_id") % 7 > 0, F.col("doc_id") % 50).alias("id")
    docs = _documents(spark, sf_dir).select("doc_id", key, "text")
    scored = sentiment.score_table(docs, lexicon(spark), "id", "text", RULES)
    return scored.select("doc_id", "id", F.round("sentiment_compound", 3).alias("sentiment_compound"))


@query
def lexicon_idioms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: with idioms and degree phrases of two, three and four words, and signs written out as words."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    score = sentiment.compound(lexicon(spark), PHRASE_RULES, idioms(spark), emoji(spark))
    return docs.select("doc_id", score(F.col("text")).alias("compound"))


@query
def mean_polarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2, F7."""
    scored = sentiment.mean_polarity(_documents(spark, sf_dir), lexicon(spark), "doc_id")
    label = scores.polarity_label(F.col("polarity"), inclusive=False)
    return scored.select("doc_id", F.round("polarity", 6).alias("polarity"), label.alias("label"))


def _weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.weak_labels(_documents(spark, sf_dir), lexicon(spark), id_col="doc_id", rules=RULES)


@query
def sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """French documents have no label yet."""
    docs = _documents(spark, sf_dir)
    scored = sentiment.mean_polarity(docs, lexicon(spark), "doc_id")
    label = scores.polarity_label(F.col("polarity"), inclusive=False)
    held = docs.select("doc_id", "lang").join(scored, "doc_id").select(
        "doc_id", F.struct(F.when(F.col("lang") != "fr", label).alias("label")).alias("sentiment")
    )
    return aggregates.label_distribution(held)


@query
def label_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13, M9."""
    return aggregates.value_counts(_weak(spark, sf_dir), "compound_label", "polarity_label", k=10)


@query
def unscored_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a row in `labels` count as scored and keep what they have."""
    docs = _documents(spark, sf_dir)
    done = three_labels(table(spark, sf_dir, "labels")).withColumnRenamed("true_label", "label")
    todo = enrichment.unscored(docs, done, "doc_id")
    fresh = sentiment.mean_polarity(todo, lexicon(spark), "doc_id").select(
        "doc_id", scores.polarity_label(F.col("polarity"), inclusive=False).alias("label")
    )
    return enrichment.keep_first(done, fresh, "doc_id")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = three_labels(table(spark, sf_dir, "labels"))
    both = truth.join(_weak(spark, sf_dir), "doc_id")
    return evaluation.stack_predictions(both, "true_label", ["compound_label", "polarity_label"])


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, F11, M8."""
    return evaluation.confusion_matrix(_judged(spark, sf_dir))


@query
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12, M8."""
    report = evaluation.classification_report(_judged(spark, sf_dir))
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K10."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return rows.stratified_split(labels, "doc_id", "quality").withColumn(
        "is_test", F.col("is_test").cast("int")
    )


@query
def tfidf_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4, K6: the five heaviest terms of each document."""
    vectors, _ = features.tfidf(_documents(spark, sf_dir), "doc_id", "text", STOP_WORDS, 20_000, 2)
    best = features.top_terms(vectors, "doc_id", 5)
    return best.withColumn("weight", F.round("weight", 6))


@query
def tfidf_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 over records whose ids repeat or are missing: the heaviest term of each row's own text."""
    key = F.when(F.col("doc_id") % 7 > 0, F.col("doc_id") % 50).alias("id")
    docs = _documents(spark, sf_dir).select("doc_id", key, "text")
    named = docs.select(F.struct("doc_id", "id").alias("row"), "text")
    vectors, _ = features.tfidf(named, "row", "text", STOP_WORDS, 20_000, 2)
    return features.top_terms(vectors, "row", 1).select("row.doc_id", "row.id", "term", F.round("weight", 6).alias("weight"))


@query
def train_eval_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report on the held-out quarter, from the predicted sentiment."""
    truth = three_labels(table(spark, sf_dir, "labels"))
    docs = _documents(spark, sf_dir).select("doc_id", "text").join(truth, "doc_id")
    split = cut(rows.stratified_split(docs, "doc_id", "true_label"), "split")
    fit, held = split.filter(~F.col("is_test")), split.filter("is_test")
    model = classifier.train(fit, "text", "true_label", STOP_WORDS)
    predicted = classifier.predict(held, model).withColumn("tfidf_logreg", F.col("sentiment.label"))
    pairs = evaluation.stack_predictions(predicted, "true_label", ["tfidf_logreg"])
    return evaluation.classification_report(pairs)


@query
def nmf_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7, K6, S15."""
    docs = _documents(spark, sf_dir)
    fitted = topics.factorise(docs, "doc_id", "text", STOP_WORDS, k=8)
    report = topics.topic_report(fitted, docs, "doc_id", "text")
    return report.select(
        "topic_id", F.concat_ws(",", "keywords").alias("keywords"), F.concat_ws("|", "examples").alias("examples")
    )


@query
def nmf_leading_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 with one topic, which is the leading singular vector: its terms, in units of the vector's length."""
    fitted = topics.factorise(_documents(spark, sf_dir), "doc_id", "text", STOP_WORDS, k=1, rounds=20, tolerance=0.0)
    terms = topics.topic_terms(fitted, fitted.weights.shape[1])
    weight = F.round(F.col("weight") / float(np.linalg.norm(fitted.weights[0])), 5)
    return terms.select("term", weight.alias("weight")).filter("weight >= 0.01")


@query
def topic_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: the most frequent dominant topic of each source."""
    docs = _documents(spark, sf_dir)
    fitted = topics.factorise(docs, "doc_id", "text", STOP_WORDS, k=8)
    best = trends.dominant_topic(topics.document_topics(fitted, "doc_id"), "doc_id")
    return trends.dominant_per_channel(docs.select("doc_id", "source").join(best, "doc_id"), "source")


@query
def top_authors_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three authors per day."""
    return trends.top_in_windows(social(spark, sf_dir), "author", "1 day", 3)


@query
def top_channels_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two channels per 6 hours."""
    return trends.top_in_windows(social(spark, sf_dir), "subreddit", "6 hours", 2)


@query
def sentiment_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: sentiment of the messages per day."""
    posts = social(spark, sf_dir)
    scored = sentiment.mean_polarity(posts, lexicon(spark), "id", "body")
    label = scores.polarity_label(F.col("polarity"), inclusive=False)
    labelled = posts.select("id", "event_ts").join(scored.select("id", label.alias("label")), "id")
    return trends.label_trend(labelled).withColumn("share", F.round("share", 6))


# --- readers and writers ---


@query
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines and read again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    path = new_path(spark, "jsonl")
    files.write_json(docs, path)
    return files.read_jsonl(spark, path, docs.schema, "UTF-8")


@query
def jsonl_utf16_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in UTF-16, each file read in many ranges."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "text")
    path = new_path(spark, "jsonl")
    docs.write.option("encoding", "UTF-16LE").json(path)
    return files.read_jsonl(spark, path, docs.schema, "UTF-16LE", 64 << 10)


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of several lines written as quoted CSV and read again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    path = new_path(spark, "csv")
    files.write_csv(docs, path)
    return files.read_csv(spark, path, docs.schema)


@query
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced, then appended to, then read by column and filter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    path = new_path(spark, "stored")
    files.replace_table(docs, path)
    files.replace_table(docs.filter("lang = 'en'"), path)
    files.append_rows(docs.filter("lang <> 'en'"), path)
    return files.read_table(spark, path, ["doc_id", "source"], F.col("n_chars") > 500)


# --- streaming ---

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def _landed(spark: SparkSession, df: DataFrame) -> tuple[str, T.StructType]:
    path = new_path(spark, "landed")
    df.write.parquet(path)
    return path, df.schema


def _processed_stream(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    path, _ = _landed(spark, _published(spark, sf_dir).select(*MESSAGE_SCHEMA.names).repartition(8, "key"))
    stream = messages.file_stream(spark, path, MESSAGE_SCHEMA, **options)
    return messages.processed(messages.parse(messages.decode(stream)))


@query
def stream_window_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several batches, windows merged; equals the batch result."""
    stream = _processed_stream(spark, sf_dir, maxFilesPerTrigger="4")
    windows = jobs.window_updates(stream, delay="60 days", duration="6 hours")
    out = new_path(spark, "windows")
    jobs.start_window_updates(windows, out, new_path(spark, "checkpoint")).awaitTermination()
    merged = jobs.read_windows(spark, out, ["topic", "subreddit"])
    return _ntz(merged, "window_start", "window_end").withColumn("avg_score", F.round("avg_score", 6))


@query
def stream_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only windows the watermark has closed."""
    stream = _processed_stream(spark, sf_dir)
    windows = jobs.window_closed(stream, delay="10 minutes")
    out = new_path(spark, "windows")
    jobs.start_window_appends(windows, out, new_path(spark, "checkpoint")).awaitTermination()
    closed = files.read_batches(spark, out).drop("batch_id")
    return _ntz(closed, "window_start", "window_end")


@query
def stream_raw_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one ingest query wrote to its two tables, per topic."""
    path, _ = _landed(spark, _published(spark, sf_dir).select(*MESSAGE_SCHEMA.names))
    stream = messages.file_stream(spark, path, MESSAGE_SCHEMA)
    out = new_path(spark, "ingest")
    jobs.start_ingest(stream, out, new_path(spark, "checkpoint")).awaitTermination()
    raw = files.read_batches(spark, f"{out}/raw").groupBy("topic").agg(F.count("*").alias("raw_rows"))
    done = files.read_batches(spark, f"{out}/processed").groupBy("topic").agg(
        F.count("*").alias("processed_rows"),
        F.sum(F.length("text")).alias("text_chars"),
        F.sum("score").alias("score_sum"),
    )
    return raw.join(done, "topic")


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message arrives twice."""
    posts = _published(spark, sf_dir).select(*MESSAGE_SCHEMA.names)
    path, _ = _landed(spark, posts.unionByName(posts))
    stream = messages.processed(messages.parse(messages.decode(messages.file_stream(spark, path, MESSAGE_SCHEMA))))
    out = new_path(spark, "deduped")
    once = jobs.dedupe(stream, delay="60 days").select("fullname", "topic", "event_ts", "text")
    jobs.start_window_appends(once, out, new_path(spark, "checkpoint")).awaitTermination()
    return _ntz(files.read_batches(spark, out).drop("batch_id"), "event_ts")


@query
def stream_reply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply edges from a stream in which replies come before and after their parents; equals the batch result."""
    links = jobs.reply_links(_processed_stream(spark, sf_dir, maxFilesPerTrigger="4"), delay="60 days", horizon="60 days")
    out = new_path(spark, "links")
    jobs.start_reply_links(links, out, new_path(spark, "checkpoint")).awaitTermination()
    return _ntz(jobs.read_reply_edges(spark, out), "first_seen", "last_seen")


@query
def stream_window_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `stream_window_update`, merged away by day after every batch."""
    stream = _processed_stream(spark, sf_dir, maxFilesPerTrigger="4")
    windows = jobs.window_updates(stream, delay="60 days", duration="6 hours")
    out = new_path(spark, "windows")
    jobs.start_window_updates(windows, out, new_path(spark, "checkpoint"), compact_after=1).awaitTermination()
    merged = jobs.read_windows(spark, out, ["topic", "subreddit"])
    return _ntz(merged, "window_start", "window_end").withColumn("avg_score", F.round("avg_score", 6))


@query
def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents scored batch by batch, each once."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    parts = max(4, docs.rdd.getNumPartitions())  # as many as the table is read in, so that no task lands more than it read
    path, schema = _landed(spark, docs.repartition(parts, "doc_id"))
    stream = messages.file_stream(spark, path, schema, maxFilesPerTrigger=str(parts // 2))
    words = lexicon(spark)

    def score(batch: DataFrame) -> DataFrame:
        polarity = sentiment.mean_polarity(batch, words, "doc_id")
        label = scores.polarity_label(F.col("polarity"), inclusive=False)
        return polarity.select("doc_id", label.alias("label"))

    out = new_path(spark, "scored")
    jobs.start_scoring(stream, score, out, new_path(spark, "checkpoint"), "doc_id").awaitTermination()
    return files.read_batches(spark, out).drop("batch_id")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned messages, volume and mean score per window, and the busiest channels of the last week."""
    posts = social(spark, sf_dir).withColumn("text", text.clean(F.col("body")))
    as_of = F.lit(posts.agg(F.max("event_ts")).first()[0]).cast("timestamp_ntz")
    windows = aggregates.window_stats(posts.filter(text.has_text(F.col("text"))), "6 hours")
    return aggregates.top_channels(windows, as_of, "INTERVAL 7 DAYS")

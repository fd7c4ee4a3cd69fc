"""Inputs for the registered queries, all read from the given tables, and the word lists they use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.operators.sentiment import Rules

# Words of the documents with a valence each.
LEXICON = [
    ("that", -0.4), ("with", 0.6), ("this", 0.2), ("from", -0.7), ("into", 0.9), ("rewh", 1.9),
    ("thatin", -1.3), ("orre", 2.4), ("ononst", -2.2), ("inoran", 1.1), ("hehely", -1.8),
    ("orantion", 0.8), ("tion", 0.3), ("ther", -0.9), ("thth", 1.4), ("thon", -1.6), ("than", 0.5),
    ("thhe", 2.1), ("thha", -0.6), ("thre", 1.7), ("thnt", -2.7), ("thed", 0.4), ("thor", -1.1),
    ("thin", 2.9), ("thea", -3.1), ("thes", 0.7), ("thly", 1.2), ("erin", -0.8), ("eren", 1.6),
    ("erer", -1.9), ("then", 0.9), ("eron", -2.4), ("erhe", 2.2), ("thou", 1.3), ("thing", -0.5),
    ("erth", 1.8), ("anea", -1.4), ("ered", 0.6), ("eran", -2.0), ("eau", 1.5), ("une", -1.2),
    ("pour", 0.8), ("dans", -0.9), ("elle", 1.1), ("mit", 0.7), ("und", -0.3), ("von", 1.0),
    ("das", -1.5), ("ist", 0.4), ("ein", 1.9), ("los", -0.7), ("del", 0.5), ("por", -1.0),
    ("con", 1.2), ("una", -0.6), ("no", -1.2), ("error", -2.0), ("purchase", 1.8), ("signup", 1.2),
    ("click", 0.04),
]

# Words of the documents that play the parts of the scorer's word classes.
RULES = Rules(
    strengtheners=("the", "very", "be", "la"),
    weakeners=("of", "almost", "de", "that"),
    negators=("is", "not", "never", "nicht", "pas"),
    contrast="was",
)

# Phrases of the documents with a valence each, of two to four words.
IDIOMS = [
    ("the that", 2.1), ("of that", -1.7), ("the anea", 3.0), ("that the", 1.3), ("und der", -2.2), ("and ornd", 0.8),
    ("thanedble the anea", -2.6), ("ofretihaou the that", 1.9), ("that edouhe of", -0.9), ("anea eriner thanea", 0.4),
    ("onlyhe this atshsh erin", 2.7), ("as innd thre", -3.1), ("stering reen with", 1.1), ("er stble the thon", -1.2),
]

# Signs of the documents that stand for emoji, with their words.
EMOJI = [("%", "thin mark"), ("&", "thea"), ("|", "not erth bar"), ("$", "orre"), ("*", "star of that thnt")]

# The same classes with degree phrases.
PHRASE_RULES = Rules(
    strengtheners=("the", "very", "be", "la", "of the", "and the"),
    weakeners=("of", "almost", "de", "that", "the the", "to thanedble the"),
    negators=RULES.negators,
    contrast=RULES.contrast,
)

# Stop words of the documents' languages, for the feature queries.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with", "be", "as", "by",
    "this", "are", "at", "an", "from", "or", "de", "la", "le", "et", "les", "des", "un", "une", "en",
    "que", "qui", "dans", "pour", "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "el",
    "los", "las", "se", "del", "por", "con", "su",
]

# The message stream the event table stands for; the same text runs in Spark and DuckDB.
SOCIAL = """
SELECT event_id,
       CASE WHEN event_type IN ('signup', 'purchase') THEN 'posts' ELSE 'comments' END AS topic,
       ts AS kafka_ts, ts AS event_ts,
       concat('e', event_id) AS id, concat('t1_', event_id) AS fullname,
       concat('r', event_id % 8) AS subreddit,
       CASE WHEN event_id % 97 = 0 THEN '[deleted]' WHEN event_id % 101 = 0 THEN NULL
            ELSE concat('user_', user_id) END AS author,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(floor(value) AS INT) END AS score,
       CASE WHEN event_type IN ('signup', 'purchase') OR event_id % 13 = 0 THEN NULL
            ELSE concat('t1_', event_id - 1 - event_id % 7) END AS parent_id,
       concat('Hey u/user_', (event_id * 7) % 15, ' (/u/User_', event_id % 5, ') see http://x.example/',
              event_id, ' www.y.example It''s ', event_type, '!') AS body
FROM {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def social(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with topic, times, identity, channel, author, score, parent and body."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.sql(SOCIAL.format(events="{events}"), events=table(spark, sf_dir, "events"))


def records(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(posts, comments) in the columns of their contracts, with arrival time as `timestamp`.

    Posts carry whole epoch seconds, comments fractional ones.
    """
    none = F.lit(None)
    seconds = F.floor(F.unix_micros(F.col("event_ts").cast("timestamp")) / 1_000_000)
    shared = {
        "schema_version": F.lit(1),
        "source": F.lit("fixture"),
        "ingested_at": F.date_format("kafka_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "id": F.col("id"),
        "fullname": F.col("fullname"),
        "subreddit": F.col("subreddit"),
        "subreddit_id": none.cast("string"),
        "author": F.col("author"),
        "permalink": F.concat(F.lit("/c/"), F.col("id")),
        "score": F.col("score"),
    }
    own = {
        "posts": {
            "event_type": F.lit("post"),
            "created_utc": seconds.cast("long"),
            "title": F.col("body"),
            "selftext": F.lit(""),
            "url": none.cast("string"),
            "num_comments": none.cast("int"),
            "over_18": F.lit(False),
            "is_self": F.lit(True),
        },
        "comments": {
            "event_type": F.lit("comment"),
            "created_utc": seconds + F.lit(0.5).cast("double"),
            "body": F.col("body"),
            "link_id": none.cast("string"),
            "parent_id": F.col("parent_id"),
        },
    }
    sides = []
    for topic in ("posts", "comments"):
        columns = {**shared, **own[topic]}
        mine = messages.filter(F.col("topic") == topic)
        sides.append(mine.select(*[value.alias(name) for name, value in columns.items()], "kafka_ts"))
    return sides[0], sides[1]


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "token string, valence double")


def idioms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(IDIOMS, "phrase string, valence double")


def emoji(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EMOJI, "emoji string, words string")


def three_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, true_label) from the labels table."""
    label = F.when(F.col("toxic") == 1, "neg").when(F.col("quality") == 1, "pos").otherwise("neu")
    return labels.select("doc_id", label.alias("true_label"))

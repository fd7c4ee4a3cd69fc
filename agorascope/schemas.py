"""Message contracts and table layouts."""

from pyspark.sql import types as T

_STRING, _INT, _BOOL, _DOUBLE = T.StringType(), T.IntegerType(), T.BooleanType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_HEAD = (
    ("schema_version", _INT),
    ("source", _STRING),
    ("event_type", _STRING),
    ("ingested_at", _STRING),
    ("id", _STRING),
    ("fullname", _STRING),
    ("subreddit", _STRING),
    ("subreddit_id", _STRING),
    ("author", _STRING),
    ("created_utc", _DOUBLE),  # the contract allows whole and fractional seconds
)

POST = _struct(
    *_HEAD,
    ("title", _STRING),
    ("selftext", _STRING),
    ("url", _STRING),
    ("permalink", _STRING),
    ("num_comments", _INT),
    ("score", _INT),
    ("over_18", _BOOL),
    ("is_self", _BOOL),
)

COMMENT = _struct(
    *_HEAD,
    ("body", _STRING),
    ("permalink", _STRING),
    ("link_id", _STRING),
    ("parent_id", _STRING),
    ("score", _INT),
)

# Fields the contracts require to be present.
POST_REQUIRED = (
    "schema_version", "source", "event_type", "ingested_at", "id", "subreddit", "created_utc", "title",
)
COMMENT_REQUIRED = POST_REQUIRED[:-1] + ("body",)

PROCESSED = (
    "topic", "kafka_ts", "event_ts",
    "schema_version", "source", "event_type", "ingested_at",
    "id", "fullname", "subreddit", "subreddit_id", "author", "created_utc",
    "title", "selftext", "body", "url", "permalink", "link_id", "parent_id",
    "num_comments", "score", "over_18", "is_self", "text",
)

CORPUS = (
    "id", "created_utc", "subreddit", "author", "score", "link_id", "parent_id", "permalink",
    "event_type", "ingested_at", "text",
)

_LISTED = _struct(
    ("id", _STRING),
    ("name", _STRING),
    ("subreddit", _STRING),
    ("subreddit_id", _STRING),
    ("author", _STRING),
    ("created_utc", _DOUBLE),
    ("title", _STRING),
    ("selftext", _STRING),
    ("body", _STRING),
    ("url", _STRING),
    ("permalink", _STRING),
    ("link_id", _STRING),
    ("parent_id", _STRING),
    ("num_comments", _INT),
    ("score", _INT),
    ("over_18", _BOOL),
    ("is_self", _BOOL),
)
_CHILD = _struct(("kind", _STRING), ("data", _LISTED))
LISTING = _struct(("data", _struct(("children", T.ArrayType(_CHILD)))))

LABELLED = _struct(("id", _STRING), ("text", _STRING), ("true_label", _STRING))

"""Keyed JSON messages: reading, parsing, publishing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorascope import schemas
from agorascope.functions import text
from agorascope.functions.scores import epoch_to_timestamp

TOPICS: Mapping[str, T.StructType] = {"posts": schemas.POST, "comments": schemas.COMMENT}


def topic_stream(
    spark: SparkSession, bootstrap: str, topics: Sequence[str], starting: str = "latest", **options: str
) -> DataFrame:
    """Unbounded read of several topics. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**options)
    reader = reader.option("kafka.bootstrap.servers", bootstrap)
    return reader.option("subscribe", ",".join(topics)).option("startingOffsets", starting).load()


def topic_batch(spark: SparkSession, bootstrap: str, topics: Sequence[str], **options: str) -> DataFrame:
    """Bounded read from the earliest to the latest offset; nothing is committed."""
    reader = spark.read.format("kafka").options(**options)
    reader = reader.option("kafka.bootstrap.servers", bootstrap).option("subscribe", ",".join(topics))
    return reader.option("startingOffsets", "earliest").option("endingOffsets", "latest").load()


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """S1 over landed files; K8 by `maxFilesPerTrigger`."""
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def decode(messages: DataFrame) -> DataFrame:
    """Topic, arrival time and the value as a string."""
    return messages.select(
        "topic", F.col("timestamp").alias("kafka_ts"), F.col("value").cast("string").alias("json_str")
    )


def parse(decoded: DataFrame, topics: Mapping[str, T.StructType] = TOPICS) -> DataFrame:
    """Each topic's messages parsed with its schema, columns united by name.

    One pass over the source: a row is parsed with the schema of its own topic only. A message that
    is not JSON becomes a row of nulls, a field of the wrong type a null.
    """
    bodies: dict[str, Column] = {}
    columns: dict[str, list[Column]] = {}
    for i, (topic, schema) in enumerate(topics.items()):
        bodies[f"_{i}"] = F.from_json(F.when(F.col("topic") == topic, F.col("json_str")), schema)
        for name in schema.names:
            columns.setdefault(name, []).append(F.col(f"_{i}.{name}"))
    parsed = decoded.filter(F.col("topic").isin(*topics)).withColumns(bodies)
    united = [F.coalesce(*parts).alias(name) for name, parts in columns.items()]
    # Rows pass through a generator so that later filters on fields stay above the parsing; pushed
    # below it they would parse every message once more.
    return parsed.select("topic", "kafka_ts", F.inline(F.array(F.struct(*united))))


def processed(raw: DataFrame) -> DataFrame:
    """Event time, cleaned text, 25 columns, rows without an id dropped."""
    joined = text.join_parts(F.col("title"), F.col("selftext"), F.col("body"))
    return (
        raw.filter(F.col("id").isNotNull())
        .withColumn("event_ts", epoch_to_timestamp(F.col("created_utc")))
        .withColumn("text", text.clean(joined))
        .select(*schemas.PROCESSED)
    )


def publishable(records: DataFrame, topic: str, *carry: str) -> DataFrame:
    """Key from fullname or id, value as JSON that keeps null fields.

    Columns named in `carry` stay beside the message instead of going into it.
    """
    blank = F.lit("")
    key = F.coalesce(F.nullif("fullname", blank), F.nullif("id", blank), blank)
    fields = [c for c in records.columns if c not in carry]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return records.select(
        F.lit(topic).alias("topic"), key.alias("key"), value.alias("value"), *carry
    )


def publish(messages: DataFrame, bootstrap: str, **options: str) -> None:
    """Write `publishable` rows to their topics."""
    writer = messages.write.format("kafka").options(**options)
    writer.option("kafka.bootstrap.servers", bootstrap).save()

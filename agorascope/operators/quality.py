"""Contract checks and dead letters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agorascope import schemas

# Fields whose contract does not allow null.
NOT_NULL = ("schema_version", "source", "event_type", "ingested_at")

CONTRACTS: Mapping[str, tuple[T.StructType, Sequence[str], str]] = {
    "posts": (schemas.POST, schemas.POST_REQUIRED, "post"),
    "comments": (schemas.COMMENT, schemas.COMMENT_REQUIRED, "comment"),
}


def _fits(kind: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return kind == "STRING"
    if isinstance(data_type, T.BooleanType):
        return kind == "BOOLEAN"
    whole = (kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$")
    if isinstance(data_type, T.IntegerType):
        return whole
    return whole | (kind == "DOUBLE") | kind.startswith("DECIMAL")


def violations(kinds: Column, value: Column, topic: Column) -> Column:
    """Array of `missing:f`, `null:f`, `type:f`, `const:f`; empty when the message is valid.

    `kinds` holds the JSON type of each field, null where the field is absent.
    """
    checks = []
    for name, (schema, required, event_type) in CONTRACTS.items():
        constants = {"schema_version": 1, "event_type": event_type}
        found = []
        for field in schema.fields:
            kind = kinds[field.name]
            absent, null, fits = kind.isNull(), kind == "VOID", _fits(kind, field.dataType)
            if field.name in required:
                found.append(F.when(absent, f"missing:{field.name}"))
            if field.name in NOT_NULL:
                found.append(F.when(null, f"null:{field.name}"))
            found.append(F.when(~absent & ~null & ~fits, f"type:{field.name}"))
            if field.name in constants:
                same = F.try_variant_get(value, f"$.{field.name}", "string") == str(constants[field.name])
                found.append(F.when(fits & ~same, f"const:{field.name}"))
        checks.append(F.when(topic == name, F.array_compact(F.array(*found))))
    return F.coalesce(*checks)


def check(decoded: DataFrame) -> DataFrame:
    """Messages of the known topics, payload kept, with their `violations` (`not_json` for no object)."""
    names = dict.fromkeys(f for schema, _, _ in CONTRACTS.values() for f in schema.names)
    value = F.col("_value")
    kinds = F.struct(
        *[F.schema_of_variant(F.try_variant_get(value, f"$.{f}", "variant")).alias(f) for f in names]
    )
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    found = violations(F.col("_kinds"), value, F.col("topic"))
    return (
        decoded.filter(F.col("topic").isin(*CONTRACTS))
        .withColumn("_value", F.try_parse_json("json_str"))
        .withColumn("_kinds", kinds)
        .withColumn("violations", F.when(is_object, found).otherwise(F.array(F.lit("not_json"))))
        .drop("_value", "_kinds")
    )


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("violations") == 0).drop("violations")


def rejected(checked: DataFrame) -> DataFrame:
    """Dead letters: the untouched payload and what is wrong with it."""
    return checked.filter(F.size("violations") > 0)

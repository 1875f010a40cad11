"""Feature schemas: from data, from a table, from a file, and contract checks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "sk_id_curr"

# Feature type names and the Spark types that stand for them.
SPARK_TYPES = {"Int64": T.LongType(), "Float32": T.DoubleType(), "String": T.StringType()}


def _fields(messages: DataFrame, value: str) -> DataFrame:
    """One row per (message, field): name and type of the value, NULL for null."""
    parsed = messages.select(F.from_json(F.col(value), "map<string,variant>").alias("m"))
    entry = parsed.select(F.explode("m").alias("name", "v"))
    kind = F.schema_of_variant("v")
    # Booleans count as whole numbers; objects and arrays as text.
    return entry.select(
        "name",
        F.when(F.col("v").isNull() | (kind == "VOID"), None)
        .when(kind.isin("BIGINT", "BOOLEAN"), "Int64")
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "Float32")
        .otherwise("String")
        .alias("type"),
        (kind == "BOOLEAN").alias("is_boolean"),
    )


def infer_schema(messages: DataFrame, value: str = "value", exclude: list[str] | None = None) -> DataFrame:
    """``name``, ``type`` for the union of all fields, by majority over every message.
    A field that is always null is String; a tie goes to the first type by name."""
    counted = (
        _fields(messages, value)
        .where(~F.col("name").isin(exclude or []))
        .groupBy("name", "type")
        .agg(F.count(F.lit(1)).alias("n"))
        # nulls do not vote
        .withColumn("votes", F.when(F.col("type").isNull(), 0).otherwise(F.col("n")))
    )
    by_votes = F.struct((-F.col("votes")).alias("v"), F.coalesce("type", F.lit("~")).alias("t"))
    return counted.groupBy("name").agg(
        F.coalesce(F.min_by("type", by_votes), F.lit("String")).alias("type")
    )


def feature_type(kind: T.DataType) -> str:
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return "Int64"
    return "Float32" if isinstance(kind, (T.FractionalType, T.DecimalType)) else "String"


def catalog_schema(tables: list[DataFrame], fallback: str | None = None) -> list[tuple[str, str]]:
    """(name, type) of the tables' columns, key first; without tables, those of the
    JSON file ``fallback``."""
    found = [
        (f.name.lower(), feature_type(f.dataType)) for t in tables for f in t.schema.fields if f.name.lower() != KEY
    ]
    if not found and fallback:
        with open(fallback) as f:
            found = [
                (e["name"], e.get("dtype") if e.get("dtype") in SPARK_TYPES else "String")
                for e in json.load(f)
                if e["name"] != KEY
            ]
    return [(KEY, "String"), *found]


def load_schema(path: str) -> T.StructType:
    """Schema from JSON ``[{"name": ..., "type": ...}]``; unknown types are String."""
    with open(path) as f:
        entries = json.load(f)
    return T.StructType([T.StructField(e["name"], SPARK_TYPES.get(e["type"], T.StringType())) for e in entries])


def contract_check(messages: DataFrame, contract: dict[str, str], value: str = "value") -> DataFrame:
    """Findings per ``severity``, ``problem`` and ``field``: fields missing or of the
    wrong type are errors, unknown fields warnings; null values and the optional
    ``ts`` pass. Messages without findings give no rows, nor does an empty input."""
    expected = F.create_map(*[F.lit(x) for pair in contract.items() for x in pair])
    fields = _fields(messages, value)
    wanted = F.try_element_at(expected, F.col("name"))
    known = fields.where(wanted.isNotNull())
    wrong = (
        known.where(F.col("type").isNotNull())
        .where(
            ((wanted == "Int64") & (F.col("type") != "Int64"))
            | ((wanted == "Float32") & ~F.col("type").isin("Int64", "Float32"))
        )
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("messages"))
        .select(F.lit("error").alias("severity"), F.lit("wrong type").alias("problem"), F.col("name").alias("field"), "messages")
    )
    extra = (
        fields.where(wanted.isNull() & (F.col("name") != "ts"))
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("messages"))
        .select(F.lit("warning").alias("severity"), F.lit("unexpected").alias("problem"), F.col("name").alias("field"), "messages")
    )
    names = F.map_keys(F.from_json(F.col(value), "map<string,variant>"))
    required = F.array(*[F.lit(n) for n in contract if n != "ts"])
    absent = F.array_except(required, F.coalesce(names, F.array().cast("array<string>")))
    missing = (
        messages.select(F.explode(absent).alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("messages"))
        .select(F.lit("error").alias("severity"), F.lit("missing").alias("problem"), "field", "messages")
    )
    return wrong.unionByName(extra).unionByName(missing)


def missing_features(required: DataFrame, registry: DataFrame) -> DataFrame:
    """Names in ``required`` that no registry feature has, ignoring case."""
    return required.select(F.lower("name").alias("name")).distinct().join(
        registry.select(F.lower("name").alias("name")).distinct(), "name", "left_anti"
    )

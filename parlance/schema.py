"""Declared types, and making a table conform to what a stage expects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One entry of a message's content: exactly one of the two is set.
ITEM = T.StructType([T.StructField("text", T.StringType()), T.StructField("token", T.StringType())])
MESSAGE = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.ArrayType(ITEM))])
MESSAGES = T.ArrayType(MESSAGE)
#: A tool call keeps the order of its keys, so it is no map.
ENTRY = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
CALLS = T.ArrayType(T.ArrayType(ENTRY))
PASSAGES = T.ArrayType(T.ArrayType(T.StringType()))
TURN = T.StructType([T.StructField("user", T.StringType()), T.StructField("assistant", T.StringType())])
CONTEXT = T.ArrayType(TURN)
DOC = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "title", "content", "url", "source", "score", "source_domain")] + [T.StructField("extend_data", T.MapType(T.StringType(), T.StringType()))]
)
ROLES = ("user", "thought", "api", "observation", "assistant")

#: Columns that pass through conversions where they are present.
OPTIONAL = ("task_name", "produce_source", "create_time", "update_time", "create_user", "update_user", "is_reviewed", "update_content", "uid", "relevant_label")
DEFAULTS = {"id": "0", "turn_id": 1, "source": "unknown"}


def lower_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case; two that then agree are an error, not an ambiguity."""
    names = [c.lower() for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns that differ only in case: {twice}")
    return df.toDF(*names)


def conform(df: DataFrame, required: tuple[str, ...] = (), defaults: dict | None = None) -> DataFrame:
    """Lower-cased columns, with defaults where a column is missing; a missing required one is an error."""
    df = lower_columns(df)
    for name, value in (defaults or {}).items():
        if name not in df.columns:
            df = df.withColumn(name, F.lit(value))
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def present(df: DataFrame, names) -> list[str]:
    return [c for c in names if c in df.columns]

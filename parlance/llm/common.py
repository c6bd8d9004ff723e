"""Helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.scratch import discard, materialize
from parlance.workers import ship

__all__ = ["SPACE", "bind", "blank_spaces", "discard", "fold", "map_arrow", "materialize", "one_space", "read", "text_bytes", "whole_text"]

#: Marks split words in every operator: ASCII white space only.
SPACE = r"[\x20\x09-\x0D]+"


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` on workers that have this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def whole_text(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_bytes(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string").cast("binary"), F.lit(b""))


def blank_spaces(text: Column) -> Column:
    """Each white-space character a space."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def one_space(text: Column) -> Column:
    """Each run of white space one space."""
    return F.regexp_replace(blank_spaces(text), " {2,}", " ")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 5; a null id has fold 0."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(5)).cast("int")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once a row and hand it to ``body`` as a variable."""
    return F.element_at(F.transform(F.array(value), body), 1)

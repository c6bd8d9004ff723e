"""From raw documents to packed bins: classifier, quality rules, exact and near dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the result is
written as Parquet and read again. All but the last return the columns of ``documents``, texts
unchanged: the quality rules judge a document by its lines, and what they reject goes as a whole.

Both deduplications give each row a number of their own first, so rows that lack an id, or share one,
are told apart: of each group of equal or near texts one row stays, with the smallest id, and every
other row stays too. Null texts are empty: the rules reject them. A table without documents gives no
bins, texts of any length are judged whole, and columns that bear the name of a helper are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import bytecnn, naming, nearness, packing, rules
from parlance.llm.common import materialize, read


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level classifier accepts."""
    return bytecnn.keep_good(docs, bytecnn.fit(docs, read(spark, sf_dir, "labels")))


def ruled(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep enough of their lines."""
    judged = rules.quality_rules(docs, keep_columns=True).filter("kept")
    return judged.select(*[F.col("record")[c].alias(c) for c in docs.columns])


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, written once so that it holds, and the new column's name."""
    name = "row"
    while name in docs.columns:
        name += "_"
    return materialize(docs.withColumn(name, F.monotonically_increasing_id())), name


def exactly_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id."""
    rows, number = _numbered(docs)
    keyed = rows.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(number).alias("number")).alias("key"), "text")
    kept = naming.exact_groups(keyed, "key").filter("kept").select(F.col("key.number").alias(number))
    return rows.join(kept, number, "left_semi").select(*docs.columns)


def nearly_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the one with the smallest id."""
    rows, number = _numbered(docs)
    grouped = nearness.near_groups(rows.select(number, "text"), number).select(number, "component_id")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", number))[number]
    kept = grouped.join(rows.select(number, "doc_id"), number).groupBy("component_id").agg(least.alias(number)).select(number)
    return rows.join(kept, number, "left_semi").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their bins."""
    return packing.best_fit(docs)


STAGES = [
    ("quality classifier", classified),
    ("quality rules", ruled),
    ("exact dedup", exactly_deduped),
    ("near dedup", nearly_deduped),
    ("packing", packed),
]

#: The classifier and the packer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, from ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Exact dedup by deterministic block naming.

Texts are normalised (each run of white space one space) and cut into blocks of ``BLOCK`` bytes of
UTF-8. Equal blocks get equal integer names: blocks are dealt into many small buckets, sorted
inside each, and named rank * BUCKETS + bucket. Names of adjacent blocks form pairs, which are
sorted and named in the same way, until each text has one name. Blocks are compared by their
content and pairs by both names, so texts share an identity only if they are equal.

A value that more than 1/``HOT_SHARE`` of all rows hold is named apart: such values are found by a
count of hashes, are at most HOT_SHARE of a known length, are named after a pre-aggregated
distinct, and reach their rows by a broadcast; no bucket holds them.

Defined cases: null counts as empty and all empty texts are one group; of each group exactly one row
is ``kept``, one with the smallest id, or of rows without ids any; rows that repeat an id and a text are
counted one by one; ids may be of any type that has an order; a text of any length is cut in one pass;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import discard, materialize, one_space, whole_text

BLOCK, BUCKETS, HOT_SHARE = 4096, 1 << 20, 200
#: Stands for the missing neighbour of a last name.
NONE = -(2**63)


def _name(df: DataFrame, value: list[str], keep: list[str], rows: int) -> DataFrame:
    """``keep`` and an integer ``name`` that rows share exactly if they hold the same ``value``.
    ``df`` has at least ``rows`` rows."""
    mark = F.xxhash64(*value)
    counts = df.groupBy(mark.alias("mark")).agg(F.count(F.lit(1)).alias("n"))
    # The most frequent come first, so at most HOT_SHARE hold all those above the share.
    often = counts.filter(F.col("n") * HOT_SHARE > max(rows, 10 * HOT_SHARE)).orderBy(F.desc("n"), "mark").limit(HOT_SHARE)
    hot = [r[0] for r in often.select("mark").collect()]
    df = df.withColumn("mark", mark)
    is_hot = F.col("mark").isin(hot) if hot else F.lit(False)
    order = Window.partitionBy("bucket").orderBy("mark", *value)
    cold = df.filter(~is_hot).withColumn("bucket", F.pmod("mark", F.lit(BUCKETS))).select(*keep, (F.dense_rank().over(order).cast("long") * BUCKETS + F.col("bucket")).alias("name"))
    if not hot:
        return cold
    # Few distinct values, each once a task before the shuffle; negative names are theirs alone.
    distinct = df.filter(is_hot).select("mark", *value).distinct()
    named = distinct.withColumn("name", -F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("mark", *value)).cast("long"))
    return cold.unionByName(df.filter(is_hot).join(F.broadcast(named), ["mark", *value]).select(*keep, "name"))


def identities(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, sha, level, name): texts are equal exactly if level and name are. One row an input row."""
    text = one_space(whole_text(text_col)).cast("binary")
    plain = df.select(F.col(id_col).alias("doc"), text.alias("t")).select("doc", "t", F.sha2(F.col("t"), 256).alias("sha"), F.octet_length("t").alias("n"))
    blocks = plain.select(
        "doc",
        "sha",
        F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("int").alias("n_blocks"),
        F.posexplode(F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / BLOCK).cast("int") - 1)), lambda k: F.substring(F.col("t"), k * BLOCK + 1, F.lit(BLOCK)))).alias("pos", "block"),
    )
    named = materialize(_name(blocks, ["block"], ["doc", "sha", "n_blocks", "pos"], df.count()))
    done = named.filter("n_blocks = 1").select("doc", "sha", F.lit(0).alias("level"), "name")
    # Longer texts: rows that repeat an id and a text say the same here and are one until the end.
    left = named.filter("n_blocks > 1").select("doc", "sha", "pos", "name").dropDuplicates(["doc", "sha", "pos"])
    most = named.agg(F.max("n_blocks")).first()[0] or 1
    ended, level, width = [], 0, most
    while width > 1:
        level, width = level + 1, -(-width // 2)
        pairs = (
            left.groupBy("doc", "sha", F.expr("pos div 2").alias("pair"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(NONE)).alias("b"))
            .select("doc", "sha", F.col("pair").cast("int").alias("pos"), "a", "b")
        )
        above = materialize(_name(pairs, ["a", "b"], ["doc", "sha", "pos"], left.count() // 2))
        discard(left)
        left = above
    if most > 1:
        ended = left.select("doc", "sha", F.lit(level).alias("level"), "name")
        rows = named.filter("n_blocks > 1 and pos = 0").select("doc", "sha")
        done = done.unionByName(rows.join(ended, (rows["doc"].eqNullSafe(ended["doc"])) & (rows["sha"] == ended["sha"])).select(rows["doc"], rows["sha"], "level", "name"))
    return done


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row an input row."""
    # Written once: counted, and joined with what it is counted to.
    rows = materialize(identities(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    least = F.min(F.struct(F.col("doc").isNull(), "doc", "row"))["row"]
    groups = materialize(
        rows.groupBy("level", "name").agg(F.min("doc").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), least.alias("keep_row")).filter("group_size > 1").select(F.col("level").alias("l"), F.col("name").alias("k"), "keep_id", "group_size", "keep_row")
    )
    # A hot group's rows are many on the left only: skewed partitions are split there.
    joined = rows.join(groups, (F.col("level") == F.col("l")) & (F.col("name") == F.col("k")), "left")
    alone: Column = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc")).otherwise(F.col("keep_id"))
    return joined.select(F.col("doc").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.col("sha").alias("text_sha256"))

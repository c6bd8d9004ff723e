"""Several turns out of single ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.scratch import materialize


def _draw(low: int, high: int, *seed: Column) -> Column:
    """A number from low to high out of 60 bits of an md5, which any engine can repeat."""
    return _bits(*seed) % F.lit(high - low + 1) + F.lit(low)


def _bits(*seed: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[s.cast("string") for s in seed])), 1, 15), 16, 10).cast("long")


def mixed(previous: DataFrame, current: DataFrame, n: float, low: int, high: int, key: str = "id", messages: str = "messages", seed: str = "0") -> DataFrame:
    """``n`` conversations (a share of all if at most 1; more than there are go round again), each a
    current one with low to high earlier ones before it. Places in the pool are drawn by hash and
    met by an equality join."""
    pool_size, size = previous.count(), current.count()
    if not pool_size or not size:
        return current.select(F.col(key), F.lit(0).alias("copy"), messages)
    wanted = round(n * size) if n <= 1 else int(n)
    pool = _placed(previous.select(key, messages), key).select(F.col("_at"), F.col(messages).alias("_before"))
    rounds = -(-wanted // size)
    rows = _placed(current.select(key, messages), key).select("*", F.explode(F.sequence(F.lit(0), F.lit(max(rounds - 1, 0)))).alias("copy")).filter(F.col("_at") + F.col("copy") * size < wanted)
    k = _draw(low, high, F.col(key), F.col("copy"), F.lit(seed))
    drawn = rows.select(key, "copy", messages, F.posexplode(F.transform(F.sequence(F.lit(1), k.cast("int")), lambda i: _draw(0, pool_size - 1, F.col(key), F.col("copy"), i, F.lit(seed)))).alias("_k", "_at"))
    before = F.sort_array(F.collect_list(F.struct("_k", "_before")))
    return drawn.join(pool, "_at").groupBy(key, "copy").agg(F.concat(F.flatten(F.transform(before, lambda x: x["_before"])), F.first(messages)).alias(messages))


def _placed(df: DataFrame, key: str) -> DataFrame:
    from parlance.operators.order import row_ids

    return row_ids(df, [key], "_r").withColumn("_at", (F.col("_r") - 1).cast("long")).drop("_r")


def mixed_by_kind(df: DataFrame, kind: str, low: int = 2, high: int = 15, **more) -> DataFrame:
    """The same within each kind: a conversation is preceded by others of its kind only."""
    from parlance.operators.order import row_ids

    # Places within a kind from one numbering of all rows: no task gathers a kind.
    numbered = materialize(row_ids(df, [kind, "id"], "_r"))
    kinds = numbered.groupBy(kind).agg(F.min("_r").alias("_first"), F.count(F.lit(1)).alias("_n"))
    sized = numbered.join(kinds, kind).withColumn("_at", (F.col("_r") - F.col("_first")).cast("long")).drop("_r", "_first")
    k = _draw(low, high, F.col("id"))
    drawn = sized.select("id", kind, "messages", F.posexplode(F.transform(F.sequence(F.lit(1), k.cast("int")), lambda i: _bits(F.col("id"), i) % F.col("_n"))).alias("_k", "_at"))
    pool = sized.select(kind, "_at", F.col("messages").alias("_before"))
    before = F.sort_array(F.collect_list(F.struct("_k", "_before")))
    return drawn.join(pool, [kind, "_at"]).groupBy("id", kind).agg(F.concat(F.flatten(F.transform(before, lambda x: x["_before"])), F.first("messages")).alias("messages"))

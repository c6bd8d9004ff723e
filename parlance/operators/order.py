"""Windows, orders, limits and samples. What is random goes by a seed and a row's content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.scratch import materialize


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "turn_id") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def row_ids(df: DataFrame, order: list[str], name: str = "row_id") -> DataFrame:
    """1 to n over all rows, without gathering them.

    Rows are range-partitioned and sorted by the order once and written with their partition's number
    and their place in it; counts and rows are read from that one table, so no row is lost or numbered
    twice whatever the partitions are. Rows that tie are dealt over ranges by where they came from."""
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    # The id holds the partition above 33 bits and the place in it below.
    placed = materialize(ranged.drop("_tie").withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33).alias("_p")
    counts = placed.select("_m", part).groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    # A row a partition.
    starts = counts.select("_p", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s"))
    numbered = placed.withColumn("_p", part).join(F.broadcast(starts), "_p")
    return numbered.withColumn(name, F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_s") + 1).drop("_m", "_p", "_s")


def earlier(group: list[str], order: list[str], *fields: str) -> Column:
    """All earlier rows' fields of the same group, as a list."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.collect_list(F.struct(*fields)).over(w)


def first_of(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter("_n = 1").drop("_n")


def mark(*key: Column | str, seed: str = "0") -> Column:
    """A row's place in a shuffled order that any engine can repeat."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key]))


def shuffled(df: DataFrame, *key: str, seed: str = "0") -> DataFrame:
    return df.orderBy(mark(*key, seed=seed), *key)


def capped(df: DataFrame, n: int, *key: str, seed: str = "0") -> DataFrame:
    """A random ``n`` rows; all if there are fewer."""
    return df.orderBy(mark(*key, seed=seed), *key).limit(n)


def half(df: DataFrame, *key: str, share: float = 0.5, seed: str = "0") -> DataFrame:
    """Exactly that share of the rows, half rounded to even. Ranked in ranges: no task gathers them."""
    n = round(df.count() * share)
    return row_ids(df.withColumn("_m", mark(*key, seed=seed)), ["_m", *key], "_r").filter(F.col("_r") <= n).drop("_m", "_r")


def chunks(df: DataFrame, k: int, order: list[str], name: str = "chunk") -> DataFrame:
    """``k`` chunks of one size (the last may be smaller), from 0."""
    size = max(1, -(-df.count() // k))
    return row_ids(df, order, "_r").withColumn(name, F.floor((F.col("_r") - 1) / size).cast("int")).drop("_r")


MODES = ("reverse", "shuffle", "none")


def order_mode(*key: str, seed: str = "0") -> Column:
    """One of the three orders by the row's mark."""
    digit = F.conv(F.substring(mark(*key, seed=seed), 1, 4), 16, 10).cast("int") % 3
    return F.element_at(F.array(*[F.lit(m) for m in MODES]), digit + 1)


def reordered(passages: Column, mode: Column, seed: Column) -> Column:
    """Each inner list reversed, shuffled by its texts' marks, or as it is."""
    mixed = lambda p: F.transform(F.array_sort(F.transform(p, lambda x: F.struct(F.md5(F.concat(seed.cast("string"), x)).alias("m"), x.alias("x")))), lambda s: s["x"])
    return F.transform(passages, lambda p: F.when(mode == "reverse", F.reverse(p)).when(mode == "shuffle", mixed(p)).otherwise(p))


def picked(passages: Column, places: Column) -> Column:
    """Each inner list's elements at given places, as far as they exist."""
    return F.transform(passages, lambda p: F.filter(F.transform(places, lambda i: F.get(p, i)), lambda x: x.isNotNull()))


def top(passages: Column, k: int | Column) -> Column:
    return F.slice(passages, F.lit(1), F.lit(k) if isinstance(k, int) else k)


def within_length(passages: Column, most: int) -> Column:
    """Whole inner lists from the start, while the list written out is no longer than ``most``."""
    from parlance.functions.text import repr_length

    grown = F.aggregate(
        passages,
        F.struct(F.lit(0).alias("n"), F.lit(2).alias("used"), F.lit(False).alias("over")),
        lambda a, p: F.struct(
            F.when(a["over"] | (a["used"] + repr_length(p) + F.when(a["n"] > 0, 2).otherwise(0) > most), a["n"]).otherwise(a["n"] + 1).alias("n"),
            (a["used"] + repr_length(p) + F.when(a["n"] > 0, 2).otherwise(0)).alias("used"),
            (a["over"] | (a["used"] + repr_length(p) + F.when(a["n"] > 0, 2).otherwise(0) > most)).alias("over"),
        ),
        lambda a: a["n"],
    )
    return F.slice(passages, F.lit(1), grown)

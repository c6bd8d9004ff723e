"""Ratios, lengths and quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions.text import layout
from parlance.scratch import materialize


def count_if(test: Column) -> Column:
    return F.count_if(F.coalesce(test, F.lit(False)))


def positive_ratio(score: Column) -> Column:
    """Ones among ones and zeros; 0 without either."""
    return F.coalesce(F.try_divide(count_if(score == 1), count_if(score.isin(0, 1))), F.lit(0.0))


def four_digits(value: Column) -> Column:
    return F.format_string("%.4f", value)


def by_level(df: DataFrame, *levels: str, score: str = "score") -> DataFrame:
    """Ratios and wrong counts by each level and over all."""
    s = F.col(score)
    return df.rollup(*levels).agg(positive_ratio(s).alias("ratio"), count_if(s.isin(0, 1)).alias("n"), count_if(s < 0).alias("wrong"))


#: Distinct values of one target that a task orders.
HELD = 100_000
_PIVOTS = 64


def quantiles(df: DataFrame, group: list[str], value: str, shares: dict[str, float], held: int = HELD) -> DataFrame:
    """(group, a column a share): exact quantiles, interpolated between the two nearest values, by group.

    No task and no aggregate holds a group. Equal values are counted first; then the range of values in
    which a quantile lies is narrowed to a part of it, round after round, by counts of the ranges between
    pivots, until it has at most ``held`` distinct values. Nulls are not counted; a group of nulls only has
    null quantiles; null is a group."""
    keys = [F.col(f"`{c}`") for c in group]
    rows = df.select(*keys, F.to_json(F.struct(*keys) if keys else F.struct(F.lit(0))).alias("_g"), F.col(f"`{value}`").cast("double").alias("_v"))
    counted = materialize(rows.groupBy("_g", "_v").agg(*[F.first(c).alias(c) for c in group], F.count(F.lit(1)).alias("_n")))
    known = counted.filter("_v is not null").select("_g", "_v", "_n")
    totals = known.groupBy("_g").agg(F.sum("_n").alias("_all"))
    wanted = totals.select("_g", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), (F.lit(float(q)) * (F.col("_all") - 1)).alias("at")) for k, q in shares.items()])).alias("w")).select("_g", "w.*")
    wanted = materialize(wanted.withColumns({"lo": F.floor("at"), "hi": F.ceil("at")}))
    # A target is a place in a group's order; it lies among values above _from up to _to, of which _below come before _from.
    targets = materialize(wanted.select("_g", F.explode(F.array("lo", "hi")).alias("_r")).distinct().withColumns({"_from": F.lit(None).cast("double"), "_to": F.lit(None).cast("double"), "_below": F.lit(0).cast("long")}))
    while True:
        inside = known.join(targets, "_g").filter((F.col("_from").isNull() | (F.col("_v") > F.col("_from"))) & (F.col("_to").isNull() | (F.col("_v") <= F.col("_to"))))
        most = inside.groupBy("_g", "_r").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0]
        if (most or 0) <= held:
            break
        pivots = inside.groupBy("_g", "_r").agg(F.array_distinct(F.percentile_approx("_v", [k / _PIVOTS for k in range(1, _PIVOTS)], 10_000)).alias("_p"))
        bucket = F.size(F.filter("_p", lambda x: x < F.col("_v")))
        parts = inside.join(pivots, ["_g", "_r"]).withColumn("_b", bucket).groupBy("_g", "_r", "_from", "_to", "_below", "_p", "_b").agg(F.sum("_n").alias("_n"))
        # As many rows a target as it has pivots, and one.
        upto = F.sum("_n").over(Window.partitionBy("_g", "_r").orderBy("_b")) + F.col("_below")
        parts = parts.withColumn("_upto", upto).filter((F.col("_upto") > F.col("_r")) & (F.col("_upto") - F.col("_n") <= F.col("_r")))
        b = F.col("_b")
        targets = materialize(
            parts.select("_g", "_r", F.coalesce(F.get("_p", b - 1), F.col("_from")).alias("_from"), F.coalesce(F.get("_p", b), F.col("_to")).alias("_to"), (F.col("_upto") - F.col("_n")).alias("_below"))
        )
    upto = F.sum("_n").over(Window.partitionBy("_g", "_r").orderBy("_v")) + F.col("_below")
    found = inside.withColumn("_upto", upto).filter((F.col("_upto") > F.col("_r")) & (F.col("_upto") - F.col("_n") <= F.col("_r"))).select("_g", "_r", "_v")
    found = materialize(found)
    low, high = (found.select("_g", F.col("_r").alias(x), F.col("_v").alias(f"_{x}")) for x in ("lo", "hi"))
    each = wanted.join(low, ["_g", "lo"]).join(high, ["_g", "hi"]).withColumn("q", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("at") - F.col("lo")))
    made = each.groupBy("_g").agg(*[F.max(F.when(F.col("name") == k, F.col("q"))).alias(k) for k in shares])
    groups = counted.select("_g", *keys).distinct()
    return groups.join(made, "_g", "left").drop("_g")


def _beside(base: DataFrame, more: DataFrame, group: list[str]) -> DataFrame:
    """Columns of both by group, null groups too."""
    right = more.withColumnsRenamed({c: f"_{c}" for c in group})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_{c}`")) for c in group]
    return base.join(right, same, "left").drop(*[f"_{c}" for c in group])


def lengths(text: Column) -> list[Column]:
    n = F.length(text)
    return [F.avg(n).alias("mean_length"), F.median(n).alias("median_length"), F.max(n).alias("max_length"), (F.avg(n) - F.median(n)).alias("mean_less_median"), count_if(n > 2000).alias("over_2000")]


def layouts(text: Column) -> list[Column]:
    """Shares of laid-out replies, and how much looser rules add."""
    rules = layout(text)
    share = {k: F.coalesce(F.avg(F.coalesce(v, F.lit(False)).cast("int")), F.lit(0.0)) for k, v in rules.items()}
    out = [v.alias(k) for k, v in share.items()]
    return [*out, (share["is_md_loose"] - share["is_md"]).alias("md_delta"), (share["is_md_list_loose"] - share["is_md_list"]).alias("list_delta")]


def metrics_report(df: DataFrame, group: str, scores: list[str], text: str) -> DataFrame:
    """One row a file: every metric's ratio, lengths and layout."""
    n = F.length(text)
    base = df.groupBy(group).agg(
        *[positive_ratio(F.col(s)).alias(f"{s}_ratio") for s in scores], F.avg(n).alias("mean_length"), F.max(n).alias("max_length"), count_if(n > 2000).alias("over_2000"), *layouts(F.col(text))
    )
    out = _beside(base, quantiles(df.select(group, n.alias("_length")), [group], "_length", {"median_length": 0.5}), [group])
    return out.withColumn("mean_less_median", F.col("mean_length") - F.col("median_length"))


def daily_report(df: DataFrame, query: str, reply: str, stage: str = "stage") -> DataFrame:
    """Counts of raw and filtered rows, and the replies' mean and outer deciles, cut to integers.
    Null queries are not counted."""
    n = F.length(reply)
    base = df.groupBy(stage).agg(F.count(query).alias("rows"), F.floor(F.avg(n)).alias("mean_length"))
    deciles = quantiles(df.select(stage, n.alias("_length")), [stage], "_length", {"q10": 0.1, "q90": 0.9})
    return _beside(base, deciles, [stage]).select(stage, "rows", "mean_length", F.floor("q10").alias("q10"), F.floor("q90").alias("q90"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one."""
    per = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def gate_ratio(df: DataFrame, bad: Column, most: float = 0.5) -> DataFrame:
    """Whether few enough rows are bad; no rows pass."""
    ratio = F.coalesce(F.try_divide(count_if(bad), F.count(F.lit(1))), F.lit(0.0))
    return df.agg(ratio.alias("bad_ratio"), (ratio <= most).alias("passes"))


def shares(df: DataFrame, by: str) -> DataFrame:
    """Rows of each kind and their share of all."""
    n = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def precision_recall(truth: Column, said: Column) -> list[Column]:
    tp, fp, fn = count_if((truth == 1) & (said == 1)), count_if((truth == 0) & (said == 1)), count_if((truth == 1) & (said == 0))
    p, r = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)), F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    return [p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1")]

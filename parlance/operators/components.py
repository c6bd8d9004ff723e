"""Connected components of a graph that no task has to hold."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.scratch import discard, materialize
from parlance.workers import ship

#: Nodes that a task holds before it passes its forest on, and links that one task takes in all.
HELD = 500_000


def local_forest(edges: DataFrame) -> DataFrame:
    """Each partition's links as (hi, lo), node and root: the same groups by fewer, shallower links."""

    def run(batches):
        parent: dict[int, int] = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        def forest():
            links = [(x, find(x)) for x in list(parent)]
            links = [(a, b) for a, b in links if a != b]
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["hi", "lo"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > HELD:  # a partition's forest needn't fit
                yield forest()
                parent.clear()
        yield forest()

    ship(edges.sparkSession)
    return edges.mapInArrow(run, "hi long, lo long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (hi, lo) but each component's smallest.

    Union-find in each partition, then rounds of star contraction: every node goes to its least
    neighbour, until all links point at the least of their component. Forests of at most ``HELD``
    links in all meet in one task, which gives the same."""
    now, seen = materialize(local_forest(edges)), None
    if now.count() <= HELD:
        out = materialize(local_forest(now.coalesce(1)).select(F.col("hi").alias("node"), F.col("lo").alias("component")))
        discard(now)
        return out
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = materialize(both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        root = materialize(large.groupBy("hi").agg(F.min("lo").alias("m")))
        joined = large.join(root, "hi")
        new = materialize(joined.filter("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(root.select("hi", "m")).distinct())
        mark = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        discard(now, least, large, root)
        now = new
        if mark == seen:
            out = now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            out._scratch = now._scratch
            return out
        seen = mark

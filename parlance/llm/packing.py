"""Conflict-constrained best-fit packing.

Pieces of documents (a text longer than a bin is cut into full pieces and a rest) go into bins of
``capacity`` tokens, largest first, into the tightest bin that is compatible: bins stand in the
order of their residual room, and the search goes on from the first that has enough room to its
successors until one holds neither the piece's source nor its cluster of duplicates. Bins carry
both as bitmaps. A piece that fits nowhere opens a bin.

Full pieces fill bins of their own. The others are dealt by a hash of (id, piece) into groups of
about ``group_rows``, packed apart from each other; the number of groups follows the input, so the
work of a task does not. Each source and cluster is spread over all groups, however many rows it has.

Defined cases: null and empty texts are one end token; a null source is a source of its own; rows
without a cluster column take the hash of their text as one; equal rows are packed one by one;
a text of any length is cut into as many pieces as it takes; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import whole_text
from parlance.workers import ship

CAPACITY, GROUP_ROWS = 2048, 2000


def word_tokens(text: Column) -> Column:
    """A text's words and one end."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("int") + 1


def pack(items: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """The bin of each (size, source, cluster); sizes are at most ``capacity``."""
    sources: dict[int, int] = {}
    clusters: dict[int, int] = {}
    open_bins: list[tuple[int, int]] = []  # (room, bin), in order
    held: list[list[int]] = []  # by bin: bitmaps of sources and clusters
    out = [0] * len(items)
    for k in sorted(range(len(items)), key=lambda k: -items[k][0]):
        size, source, cluster = items[k]
        s = 1 << sources.setdefault(source, len(sources))
        c = 1 << clusters.setdefault(cluster, len(clusters))
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and (held[open_bins[at][1]][0] & s or held[open_bins[at][1]][1] & c):
            at += 1
        if at < len(open_bins):
            room, b = open_bins.pop(at)
        else:
            room, b = capacity, len(held)
            held.append([0, 0])
        held[b][0] |= s
        held[b][1] |= c
        if room > size:
            insort(open_bins, (room - size, b))
        out[k] = b
    return out


def best_fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster_col: str | None = None, size: Column | None = None, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, piece, first_token, n_tokens, source, cluster, bin_id, place, bin_tokens): a piece is the
    tokens first_token .. first_token + n_tokens - 1 of its text; ``place`` counts within the bin."""
    text = whole_text(text_col)
    rows = df.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        (F.col(cluster_col).cast("long") if cluster_col else F.xxhash64(text)).alias("cluster"),
        F.coalesce(size if size is not None else word_tokens(text), F.lit(1)).cast("long").alias("size"),
    )
    pieces = rows.select(
        "id", "source", "cluster", "size", F.posexplode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(0, (size - 1) div {capacity})"), F.lit(1).cast("long"))).alias("piece", "_start")
    ).select("id", "piece", (F.col("_start") * capacity).alias("first_token"), F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("_start") * capacity).alias("n_tokens"), "source", "cluster")
    groups = max(1, ceil(df.count() / group_rows))
    mark = F.xxhash64("id", "piece", "cluster")
    schema = T.StructType(
        [
            pieces.schema["id"], T.StructField("piece", T.IntegerType()), T.StructField("first_token", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("source", T.StringType()),
            T.StructField("cluster", T.LongType()), T.StructField("bin_id", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("bin_tokens", T.LongType()),
        ]
    )

    def run(key, table):
        table = table.sort_by([("n_tokens", "descending"), ("mark", "ascending"), ("piece", "ascending")])
        sources = table["source"].combine_chunks().dictionary_encode(null_encoding="encode").indices
        sizes = table["n_tokens"].to_pylist()
        bins = pack(list(zip(sizes, sources.to_pylist(), table["cluster"].to_pylist(), strict=True)), capacity)
        places, filled = [], {}
        for b, size in zip(bins, sizes, strict=True):
            n, held = filled.get(b, (0, 0))
            places.append(n)
            filled[b] = (n + 1, held + size)
        new = {"bin_id": pa.array([key[0].as_py() + groups * b for b in bins], pa.int64()), "place": pa.array(places, pa.int32()), "bin_tokens": pa.array([filled[b][1] for b in bins], pa.int64())}
        return pa.table({name: new[name] if name in new else table[name] for name in schema.names})

    part = pieces.withColumn("mark", mark).withColumn("group", F.pmod(F.col("mark"), F.lit(groups)).cast("long"))
    full = part.filter(F.col("n_tokens") == capacity).select(
        "id", "piece", "first_token", "n_tokens", "source", "cluster", (-1 - F.monotonically_increasing_id()).alias("bin_id"), F.lit(0).alias("place"), "n_tokens"
    )
    full = full.toDF(*schema.names)
    ship(df.sparkSession)
    rest = part.filter(F.col("n_tokens") < capacity).groupBy("group").applyInArrow(run, schema)
    return rest.unionByName(full).withColumnRenamed("id", id_col)

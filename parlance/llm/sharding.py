"""Sharding by sampled splitters: size-weighted key samples give quantile boundaries, records are
range-partitioned by them, and ranges that came out overfull are subdivided.

Records are ordered by (crc32 of the text, id), so equal texts are neighbours and a group of copies
is cut only where it crosses a boundary; the id splits groups of any size. Exact sizes of the
ranges turn each record's place in its range into its place in the whole order, and the shard
follows from the bytes before it: shard sizes differ by one record at most.

Defined cases: a null or empty text has size 8; a null id sorts first; equal (text, id) rows stand
next to each other in any order, which no output shows; a text longer than a shard has one of its own
size at least; ids are numbers, and one that is none is an error; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import materialize, whole_text

#: Sorts before every id.
NO_ID = -(2**63)
SEED = 20_071


def _weight(n: int, total: int) -> Column:
    """Half by bytes and half by rows, so that neither many short nor a few long records fill a range."""
    return (F.col("size") / F.lit(float(total)) + F.lit(1.0 / n)) / 2


def _draw(index: DataFrame, weight: Column, scale: float, salt: int) -> list[tuple]:
    """A size-weighted sample of keys, about ``scale`` in number: (crc, id, weight it stands for)."""
    chance = F.least(F.lit(1.0), weight * F.lit(float(scale)))
    uniform = (F.pmod(F.xxhash64("text_crc32", "key_id", "size", F.lit(SEED + salt)), F.lit(2**30)) + 0.5) / float(2**30)
    rows = index.filter(uniform < chance).select("text_crc32", "key_id", (weight / chance).alias("w")).collect()
    return sorted((r[0], r[1], r[2]) for r in rows)


def _quantiles(sample: list[tuple], parts: int) -> list[tuple]:
    """The keys at which the sample's weight passes 1/parts, 2/parts and so on."""
    total, run, out = sum(w for *_, w in sample), 0.0, []
    for crc, key, w in sample:
        if len(out) < parts - 1 and run >= total * (len(out) + 1) / parts:
            out.append((crc, key))
        run += w
    return sorted(set(out))


def _cell(bounds: list[tuple]) -> Column:
    """How many boundaries are at or below the record's key, by binary search."""
    if not bounds:
        return F.lit(0)
    crcs, keys = F.lit([b[0] for b in bounds]).cast("array<bigint>"), F.lit([b[1] for b in bounds]).cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def down(at: Column, step: Column) -> Column:
        crc, key = F.get(crcs, at + step - 1), F.get(keys, at + step - 1)
        below = (crc < F.col("text_crc32")) | ((crc == F.col("text_crc32")) & (key <= F.col("key_id")))
        return F.when(F.coalesce(below, F.lit(False)), at + step).otherwise(at)

    return F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), down)


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 24, cells_per_shard: int = 16, samples_per_cell: int = 48, cell_rows: int = 1_000_000, keep_record: bool = False) -> DataFrame:
    """Rows of (id, size, text_crc32, law, shard, slot, grown_shard), with ``record`` (all columns
    of the input as a struct) if asked for. There are shards * cells_per_shard ranges, or as many as
    ``cell_rows`` rows a range take; that many boundaries and about samples_per_cell times as many sampled
    keys reach the driver."""
    text = whole_text(text_col)
    fields = [F.col(id_col), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key_id")]
    if keep_record:
        fields.append(F.struct(*[df[c] for c in df.columns]).alias("record"))
    keyed = df.select(*fields)
    index = materialize(keyed.select(id_col, "size", "text_crc32", "key_id"))
    n, total = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    cells = max(1, min(shards * cells_per_shard, n), n // cell_rows)
    weight, bounds, table = _weight(max(n, 1), max(total, 1)), [], []
    if n:
        bounds = _quantiles(_draw(index, weight, cells * samples_per_cell, 0), cells)
        for again in range(1, 4):
            sizes = index.withColumn("cell", _cell(bounds)).groupBy("cell").agg(F.sum("size"), F.count(F.lit(1)), F.min(F.struct("text_crc32", "key_id")) != F.max(F.struct("text_crc32", "key_id")))
            table = sorted(tuple(r) for r in sizes.collect())
            full = {c: (b / total + k / n) / 2 * cells for c, b, k, several in table if several}
            full = {c: x for c, x in full.items() if x > 2}
            if not full or again == 3:
                break
            # Overfull ranges are sampled anew, each in proportion to what it holds, and subdivided.
            inside = index.withColumn("cell", _cell(bounds)).filter(F.col("cell").isin(*full))
            more = _draw(inside, weight, cells * samples_per_cell * 2, again)
            by_cell: dict[int, list] = {}
            for drawn in more:
                by_cell.setdefault(bisect_right(bounds, drawn[:2]), []).append(drawn)
            for c, x in full.items():
                own = by_cell.get(c, [])
                table.extend(("new", b) for b in _quantiles(own, 2 * round(x)))
            bounds = sorted(set(bounds) | {b for tag, b in (t for t in table if t[0] == "new")})
    start_bytes, start_rows, run_b, run_n = [0] * (len(bounds) + 1), [0] * (len(bounds) + 1), 0, 0
    held = {t[0]: t[1:3] for t in table}
    for c in range(len(bounds) + 1):
        start_bytes[c], start_rows[c] = run_b, run_n
        b, k = held.get(c, (0, 0))
        run_b, run_n = run_b + b, run_n + k
    order = Window.partitionBy("cell").orderBy("text_crc32", "key_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = lambda values: F.get(F.lit(values).cast("array<bigint>"), F.col("cell"))
    placed = (
        (keyed if keep_record else index)
        .withColumn("cell", _cell(bounds))
        .withColumns({"_end": F.sum("size").over(order), "_row": F.row_number().over(order)})
        .withColumns({"_end": F.col("_end") + starts(start_bytes), "_row": F.col("_row") + starts(start_rows)})
        .withColumn("shard", F.expr(f"least({shards - 1}, ((2 * _end - size) * {shards}) div {2 * max(total, 1)})").cast("int"))
    )
    # One row a shard.
    firsts = F.broadcast(placed.groupBy("shard").agg(F.min("_row").alias("_first")))
    out = placed.join(firsts, "shard").select(
        F.col(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_row") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *(["record"] if keep_record else [])
    )
    return out

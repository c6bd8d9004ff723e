"""Periodic runs: stretches of words that repeat with a period.

A run is a stretch of consecutive words with smallest period q whose length is at least ``EXPONENT``
times q, and at least ``SHORTEST`` words, and that no neighbouring word extends keeping the period.

All lags up to n / ``EXPONENT`` are compared with the word-id array, many lags at once. Words that are
a lag of q apart agree all along a run of period q, at 3q places in a row or more, so at three
multiples of q in a row: those places are compared for every lag, n/q of them for a lag. Where three
agree, the array is compared with its shift in full, outwards, and the true stretch measured. Nothing
is missed, and the work for all lags together goes with n log n on natural text. A stretch whose
smallest period is a divisor of the lag is known from then on, and later lags pass over it: two
periods that share a stretch as long as both together have their greatest common divisor for one.

Documents above ``WIDE`` bytes are dealt out by ranges of lags, of equal numbers of comparisons: each
range is a row of its own, so the machines share one document. Their runs meet by row again.

Defined cases: null is empty and has no runs; rows that repeat an id or a text are judged one by one; of
a tie in exponent the run with the smaller start, then the smaller period, is the strongest; a text of
any length is compared whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import SPACE, bind, map_arrow, materialize, text_bytes

EXPONENT, SHORTEST = 4, 6
#: Bytes beyond which a document is dealt out by lags, and the most ranges of one document.
WIDE, RANGES = 1 << 16, 16
#: Places compared at once.
AT_ONCE = 1 << 18
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def split_words(text: bytes) -> pa.BinaryArray:
    """The words of a text, without a Python object a word."""
    data = np.frombuffer(text, dtype=np.uint8)
    letter = ~((data == 32) | (data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    lengths = edge[1::2] - edge[::2]
    if not len(lengths):
        return pa.array([], pa.binary())
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data[letter])])


def word_ids(words: pa.Array) -> np.ndarray:
    """Equal words get equal numbers."""
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, np.int32)


def _agreeing(x: np.ndarray, q: int, at: int, step: int) -> int:
    """How many places from ``at`` on, upwards or downwards, agree with the word q further, without a gap."""
    size, n, have = 64, len(x), 0
    while True:
        if step > 0:
            low, high = at + have, min(at + have + size, n - q)
        else:
            low, high = max(at - have - size + 1, 0), at - have + 1
        if low >= high:
            return have
        same = (x[low:high] == x[low + q : high + q])[::step]
        if not same.all():
            return have + int(same.argmin())
        have, size = have + len(same), size * 4


def _smallest_period(x: np.ndarray, start: int, q: int) -> int:
    """The smallest period of a stretch of period q, twice as long at least: a divisor of q, found a
    prime factor after the other."""
    part, period, rest, f = x[start : start + 2 * q], q, q, 2
    while rest > 1:
        f = f if f * f <= rest else rest
        while rest % f == 0:
            rest //= f
            if np.array_equal(part[: -(period // f)], part[period // f :]):
                period //= f
        f += 1
    return period


def _threes(x: np.ndarray, lags: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, multiple) where the array agrees with its shift at ``need`` multiples of the lag in a row."""
    n, places = len(x), (len(x) - 1) // int(lags[0]) + 1
    if len(lags) == 1:
        value = x[:: int(lags[0])][None, :]
    else:
        at = lags[:, None] * np.arange(places)
        value = np.where(at < n, x[np.minimum(at, n - 1)], -1 - np.arange(places))
    same = value[:, 1:] == value[:, :-1]
    width = same.shape[1] - need + 1
    if width < 1:
        return np.zeros(0, int), np.zeros(0, int)
    hit = same[:, :width].copy()
    for k in range(1, need):
        hit &= same[:, k : k + width]
    rows, cols = np.nonzero(hit)
    return lags[rows], cols


def scan(x: np.ndarray, first: int = 1, beyond: int | None = None, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs whose period is from ``first`` to below ``beyond``, in no
    order. ``exponent`` is 3 or more."""
    n, need = len(x), exponent - 1
    end = min(n if beyond is None else beyond, n // exponent + 1)
    out: list[tuple[int, int, int]] = []
    # For each place the farthest end of a stretch of known period that holds it.
    reach = np.zeros(n, dtype=np.int32 if n < 2**31 else np.int64)
    q = max(first, 1)
    while q < end:
        lags = np.arange(q, min(end, 2 * q, q + max(1, AT_ONCE // ((n - 1) // q + 1))))
        lag_of, multiple = _threes(x, lags, need)
        places = lag_of * multiple
        new = reach[places] <= places + need * lag_of
        last, done = -1, -1
        for p, place in zip(lag_of[new].tolist(), places[new].tolist(), strict=True):
            if p != last:
                last, done = p, -1
            if place < done or reach[place] > place + need * p:
                continue
            start = place - _agreeing(x, p, place - 1, -1)
            done = place + _agreeing(x, p, place, 1)
            length = done + p - start
            if length >= exponent * p:
                reach[start : start + length] = np.maximum(reach[start : start + length], start + length)
                if length >= max(shortest, exponent * p) and _smallest_period(x, start, p) == p:
                    out.append((start, length, p))
        q = int(lags[-1]) + 1
    return out


def kept_places(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words no run holds after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def lag_range(n: int, part: int, parts: int, exponent: int = EXPONENT) -> tuple[int, int]:
    """The lags of a part. A lag of q costs n/q comparisons, so parts of equal cost end at powers."""
    most = n // exponent + 1
    edge = lambda k: max(1, min(most, round(most ** (k / parts))))
    return 1 if part == 0 else edge(part), most if part == parts - 1 else edge(part + 1)


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _listed(runs: list[list[tuple[int, int, int]]]) -> pa.Array:
    return pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], _RUN)


def _finished(ids: pa.Array, texts: pa.Array, runs_of) -> pa.RecordBatch:
    """Each text's runs, in order, and what they leave of it."""
    counts, runs, collapsed = [], [], []
    for k, text in enumerate(texts):
        words = split_words(text.as_py() or b"")
        found = sorted(runs_of(k, words), key=lambda r: (r[0], r[2]))
        left = words.filter(pa.array(kept_places(len(words), found))) if found else words
        counts.append(len(words))
        runs.append(found)
        collapsed.append(pc.binary_join(pa.ListArray.from_arrays([0, len(left)], left), b" ")[0].as_py())
    return pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64()), _listed(runs), pa.array(collapsed, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", wide: int = WIDE) -> DataFrame:
    """(id, n_words, runs, collapsed): every run by start, and the words that no run repeats, one space
    apart. One row an input row."""
    rows = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words bigint, runs {RUNS}, collapsed string"

    def whole(batches):
        for batch in batches:
            yield _finished(batch.column(0), batch.column(1), lambda _, words: scan(word_ids(words)))

    narrow = map_arrow(rows.filter(F.octet_length("text") <= wide), whole, schema)

    # Texts beyond: one row a range of lags.
    long = materialize(rows.filter(F.octet_length("text") > wide).withColumn("row", F.monotonically_increasing_id()))
    size = F.octet_length("text")
    parts = F.least(F.lit(RANGES), F.greatest(F.lit(2), F.ceil(size / F.lit(1 << 20)))).cast("int")
    dealt = long.select("row", "text", parts.alias("parts"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))

    def range_of(batches):
        for batch in batches:
            found = []
            for text, parts, part in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x = word_ids(split_words(text.as_py()))
                found.append(scan(x, *lag_range(len(x), part, parts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), _listed(found)], names=["row", "runs"])

    each = map_arrow(dealt.repartition("row", "part"), range_of, f"row bigint, runs {RUNS}")
    joined = long.join(each.groupBy("row").agg(F.flatten(F.collect_list("runs")).alias("runs")), "row")

    def finish(batches):
        for batch in batches:
            runs = [[(r["start"], r["length"], r["period"]) for r in x] for x in batch.column(2).to_pylist()]
            yield _finished(batch.column(0), batch.column(1), lambda k, _, runs=runs: runs[k])

    finished = map_arrow(joined.select("id", "text", "runs"), finish, schema)
    return narrow.union(finished).withColumnRenamed("id", id_col)


def planted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents whose crc32 of the id ends in 0 repeat some of their words to the end; the text of all
    is their words, one space apart. A null id counts as empty text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def to_the_end(own: Column) -> Column:
        n = F.size(own).cast("bigint")
        # The words, the place from which they repeat, and after how many.
        a = F.when(n > 0, g % n)
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("bigint")
        return bind(F.struct(a.alias("a"), p.alias("p")), lambda x: F.array_join(F.transform(own, lambda w, i: F.when(i < x["a"], w).otherwise(F.get(own, (x["a"] + (i - x["a"]) % x["p"]).cast("int")))), " "))

    # Words are bound once a row, wherever a filter on the text is evaluated.
    return df.select(F.col(id_col), F.when((h % 10 == 0) & F.col(text_col).isNotNull(), bind(words, to_the_end)).otherwise(F.col(text_col)).alias("text"))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The strongest run and digests of all runs and of the words that stay."""
    # Exponents as fractions: length/period by cross products.
    stronger = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    before = lambda a, b: (
        F.when(stronger(a, b) > 0, -1).when(stronger(a, b) < 0, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)
    )
    best: Column = F.get(F.array_sort("runs", before), F.lit(0))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    d = found.withColumn("best", best)
    return d.select(
        id_col, F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words",
    )

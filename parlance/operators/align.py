"""Joins and alignments of requests, responses and tables."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.scratch import materialize
from parlance.workers import ship


def with_responses(requests: DataFrame, responses: DataFrame, key: str = "row_id", mode: str = "id", prompt: str = "prompt") -> DataFrame:
    """Requests with their responses by id. ``mode="text"`` joins on the prompt, and so multiplies
    rows that share one."""
    return requests.join(responses, key if mode == "id" else prompt)


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, combined before the shuffle. Rows that tie to the end count as one."""
    rest = [c for c in df.columns if c not in key]
    at = F.struct(*[F.col(f"`{c}`") for c in order])
    last = df.groupBy(*[F.col(f"`{c}`") for c in key]).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), at).alias("_last"))
    return last.select(*[F.col(f"`{c}`") if c in key else F.col("_last")[c].alias(c) for c in df.columns])


def outer_by_query(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Full outer join in which null keys meet each other."""
    right = b.withColumnRenamed(key, "_key")
    return a.join(right, F.col(key).eqNullSafe(F.col("_key")), "full_outer").withColumn(key, F.coalesce(key, "_key")).drop("_key")


def by_index(df: DataFrame, responses: DataFrame, index: str = "index", order: str = "at") -> DataFrame:
    """Rows beside the response of their index, which counts from 1; the last response of an index wins,
    and a row without one keeps its place with null."""
    last = responses.groupBy(index).agg(F.max_by("response", order).alias("response"))
    return df.join(last, index, "left")


def _plain(text: Column) -> Column:
    """Words in lower case, one space apart and around."""
    return F.concat(F.lit(" "), F.trim(F.lower(F.regexp_replace(text, r"[\s!-/:-@\[-`{-~]+", " "))), F.lit(" "))


#: Bytes of items that are sent to all tasks.
SENT_BYTES = 1 << 26


def containing(items: DataFrame, docs: DataFrame, item_key: str, doc_key: str, text: str = "text", width: int = 5, sent: int = 1_000_000) -> DataFrame:
    """(item_key, doc_key): documents that hold an item's words in a row, anywhere in the whole text.

    Items meet documents by the hash of their first ``width`` words (all, if they have fewer) in an equality
    join over the windows of the documents, which carry no text; the distinct candidates are then looked
    through whole. At most ``sent`` items, of ``SENT_BYTES`` in all, are sent to all tasks; more are shuffled."""
    words = lambda c: F.split(F.trim(c), " ")
    wanted = items.select(item_key, _plain(F.col(text)).alias("_item")).filter("length(_item) > 2")
    # Words are hashed once, windows from their words' hashes.
    hashed = lambda c: F.transform(words(c), lambda w: F.xxhash64(w))
    window = lambda h, i, k: F.xxhash64(*[F.get(h, i + j) for j in range(k)])
    wanted = wanted.withColumn("_h", hashed(F.col("_item"))).withColumn("_n", F.least(F.size("_h"), F.lit(width)))
    wanted = materialize(wanted.withColumn("_key", F.coalesce(*[F.when(F.col("_n") == k, window(F.col("_h"), F.lit(0), k)) for k in range(1, width + 1)])).drop("_h"))
    sizes = [r[0] for r in wanted.select("_n").distinct().collect()]  # width numbers at most
    if not sizes:
        return docs.select(doc_key).limit(0).join(items.select(item_key).limit(0), F.lit(True)).select(item_key, doc_key)
    n, size = wanted.agg(F.count(F.lit(1)), F.sum(F.octet_length("_item"))).first()
    few = F.broadcast if n <= sent and size <= SENT_BYTES else lambda df: df
    held = docs.select(F.col(doc_key).alias("_doc_key"), hashed(_plain(F.col(text))).alias("_w"))
    windows = lambda k: F.transform(F.sequence(F.lit(0), F.greatest(F.size("_w") - k, F.lit(0))), lambda i: window(F.col("_w"), i, k))
    met = held.select("_doc_key", F.explode(F.array_distinct(F.flatten(F.array(*[windows(k) for k in sizes])))).alias("_key"))
    pairs = materialize(met.join(few(wanted.select("_key", item_key)), "_key").select(item_key, "_doc_key").distinct())
    # Candidates bring their texts, one of each document; pairs that are few go to the documents.
    near = pairs.join(few(wanted.select(F.col(item_key).alias("_i"), "_item")), F.col(item_key).eqNullSafe(F.col("_i"))).select(item_key, "_doc_key", "_item")
    total = pairs.count()
    near = F.broadcast(near) if total <= sent // 10 and total * (size // n + 1) <= SENT_BYTES else near
    texts = docs.select(doc_key, F.col(text).alias("_doc"))
    return texts.join(near, F.col(doc_key).eqNullSafe(F.col("_doc_key"))).filter(F.contains(_plain(F.col("_doc")), F.col("_item"))).select(item_key, doc_key).distinct()


def named_passages(names: Column, passages: Column) -> Column:
    """Tool names with their passages, as far as both go."""
    n = F.least(F.size(names), F.size(passages))
    return F.arrays_zip(F.slice(names, F.lit(1), n).alias("name"), F.slice(passages, F.lit(1), n).alias("passages"))


def lookup(key: Column, table: dict[str, str], default: str = "") -> Column:
    """A fixed table as a literal: no join."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(default))


def missing(wanted: DataFrame, have: DataFrame, key: list[str]) -> DataFrame:
    return wanted.join(have, key, "left_anti")


#: What stands between words: white space and marks of any script, or of ASCII only.
MARKS, ASCII_MARKS = r"(?U)[\s\p{Punct}$+<=>^`|~]+", r"[\t\n\f\r !-/:-@\[-`{-~]+"


def _lower(text: Column) -> Column:
    """Lower case, letter by letter, whatever stands beside one."""
    return F.lower(F.translate(text, "Σİ", "σi"))


def distinct_words(text: Column, marks: str = MARKS) -> Column:
    """Each word of a text once, in lower case, without punctuation."""
    return F.array_distinct(F.filter(F.split(_lower(text), marks), lambda w: w != ""))


#: Sets that the order of words is taken from, frequent words that are ranked, and fewest and most sets of a block.
ORDERED, RANKED, SET_BLOCKS = 20_000, 1 << 16, (4_096, 131_072)


def _beginnings(sets: DataFrame, marks: np.ndarray, ranks: np.ndarray, percent: int) -> DataFrame:
    """(id, n, w): of each set (id, w as hashes) its size and its beginning, rarest words first, that one as near as
    ``percent`` has to touch, and a tenth more."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            flat, size = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            rows = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(marks, flat), max(len(marks) - 1, 0))
            rank = np.where(marks[at] == flat, ranks[at], 0) if len(marks) else np.zeros(len(flat), np.int64)
            flat = flat[np.lexsort((flat, rank, rows))]
            begin = np.minimum(size, size - -(-size * percent // 100) + 1 + size // 10)
            first = np.cumsum(size) - size
            kept = flat[np.arange(len(flat)) - np.repeat(first, size) < np.repeat(begin, size)]
            w = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(begin)], pa.int32()), pa.array(kept, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int32()), w], names=["id", "n", "w"])

    ship(sets.sparkSession)
    return sets.select("id", "w").mapInArrow(run, "id long, n int, w array<int>")


def _may_be_near(left: DataFrame, right: DataFrame, percent: int, first: bool = False) -> DataFrame:
    """(a, b, more): candidates among beginnings (id, n, w) of sets. Cells of a block of either side, of sizes that may
    be near, count common words in memory; pairs are formed only where so many beginnings' words are common that the
    rest can suffice. ``first`` gives of each cell a left set's likeliest candidate only, and whether there are ``more``."""
    # A class of sizes is a little wider than what sizes may differ by, so near sets are of one class or of two beside each other.
    width = max(math.log(100 / percent), 0.1) * 1.001
    kind = lambda: F.floor(F.log("n") / F.lit(width)).cast("int")
    left, right = left.withColumn("own", kind()).withColumn("p", F.explode(F.sequence(F.col("own") - 1, F.col("own") + 1))), right.withColumn("p", kind())
    counts = [dict(tuple(r) for r in x.groupBy("p").count().collect()) for x in (left, right)]  # a row a class of sizes
    least, most = SET_BLOCKS
    shape = [(p, *(-(-c[p] // min(most, max(least, sum(c.values()) // 16))) for c in counts)) for p in sorted(counts[0].keys() & counts[1].keys())]
    tasks = max(1, sum(r * c for _, r, c in shape))
    shape = left.sparkSession.createDataFrame(shape, "p int, rows int, cols int")
    dealt = lambda x, own, other: x.join(F.broadcast(shape), "p").select("id", "n", "w", "p", F.pmod(F.xxhash64("id"), own).cast("int").alias(own[0]), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[0]))
    cells = [dealt(left, "rows", "cols"), dealt(right, "cols", "rows")]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("more", pa.bool_())])

    def meet(one: pa.Table, two: pa.Table) -> pa.Table:
        out = []
        if len(one) and len(two):
            one, two = one.combine_chunks(), two.combine_chunks()
            (ids, n, w, at), (others, m, v, to) = ((x["id"].to_numpy(), x["n"].to_numpy().astype(np.int64), *_lists(x["w"])) for x in (one, two))
            # For each word of the right block, the sets that begin with it.
            order = np.argsort(v, kind="stable")
            owner = np.repeat(np.arange(len(m), dtype=np.int32), np.diff(to))[order]
            words, starts = np.unique(v[order], return_index=True)
            ends = np.r_[starts[1:], len(v)]
            open_m = m - np.diff(to)
            place = np.minimum(np.searchsorted(words, w), len(words) - 1)
            known = words[place] == w
            for k in range(len(ids)):
                here = place[at[k] : at[k + 1]][known[at[k] : at[k + 1]]]
                if not len(here):
                    continue
                common = np.bincount(np.concatenate([owner[starts[x] : ends[x]] for x in here]))
                some = np.flatnonzero(common)
                size, free = m[some], np.maximum(n[k] - (at[k + 1] - at[k]), open_m[some])
                fit = (np.minimum(size, n[k]) * 100 >= np.maximum(size, n[k]) * percent) & ((common[some] + free) * (100 + percent) >= (size + n[k]) * percent)
                some = some[fit]
                if len(some):
                    best = some[[np.argmax(common[some])]] if first else some
                    out.append((np.full(len(best), ids[k]), others[best], np.full(len(best), len(some) > 1)))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[], [], []]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    ship(left.sparkSession)
    grouped = [c.repartition(tasks, "p", "r", "c").groupBy("p", "r", "c") for c in cells]
    return grouped[0].cogroup(grouped[1]).applyInArrow(meet, "a long, b long, more boolean")


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of lists end to end, and where each list begins."""
    lists = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    at = lists.offsets.to_numpy()
    return lists.values.to_numpy()[at[0] : at[-1]], at - at[0]


def near_sets(left: DataFrame, right: DataFrame, percent: int, first: bool = False) -> DataFrame:
    """(a, b): ids of sets of words (id, w) whose common words are ``percent`` per cent of all theirs or more. Exact.
    With ``first`` a left set that is near to any has one or more of its pairs, not all.

    Two such sets share words of their beginnings, in one order of all words; rare ones come first, by a sample
    of ``right``: the order decides how many candidates there are, not what is found. Words go as hashes, and equal
    hashes only make candidates. These are compared whole. Empty sets are near to none."""
    left, right = (materialize(x.filter(F.size("w") > 0).select("id", F.monotonically_increasing_id().alias("_n"), "w")) for x in (left, right))
    total = right.count()
    if not total:
        return left.join(right, F.lit(False)).select(left["id"].alias("a"), right["id"].alias("b"))
    hashed = lambda x: x.select(F.col("_n").alias("id"), F.transform("w", lambda c: F.hash(c)).alias("w"))
    sample = hashed(right).filter(F.pmod(F.xxhash64("id"), F.lit(total)) < ORDERED).select(F.explode("w").alias("h")).groupBy("h").count()
    often = sample.filter("count > 1").orderBy(F.desc("count"), "h").limit(RANKED).collect()  # of a bounded number of words
    marks = np.array([r["h"] for r in often], np.int32)
    order = np.argsort(marks)
    ranks = np.array([r["count"] for r in often], np.int64)[order]
    a, b = (materialize(_beginnings(hashed(x), marks[order], ranks, percent)) for x in (left, right))

    def whole(pairs):
        one, two = left.select(F.col("_n").alias("a"), F.col("id").alias("_a"), F.col("w").alias("u")), right.select(F.col("_n").alias("b"), F.col("id").alias("_b"), F.col("w").alias("v"))
        common = F.size(F.array_intersect("u", "v"))
        return pairs.join(one, "a").join(two, "b").filter(common * 100 >= (F.size("u") + F.size("v") - common) * percent).select("_a", "_b", "a")

    if not first:
        return whole(_may_be_near(a, b, percent)).select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    likely = materialize(_may_be_near(a, b, percent, first=True))
    found = materialize(whole(likely))
    left_over = materialize(a.join(likely.filter("more").select(F.col("a").alias("id")).distinct(), "id", "left_semi").join(found.select(F.col("a").alias("id")), "id", "left_anti"))
    if not left_over.isEmpty():
        found = found.union(whole(_may_be_near(left_over, b, percent)))
    return found.select(F.col("_a").alias("a"), F.col("_b").alias("b"))


def unlike_training(df: DataFrame, training: DataFrame, text: str, percent: int | None = None, marks: str = MARKS) -> DataFrame:
    """Rows whose normalised text is not among the training queries; with ``percent``, rows whose words are
    not that near to any training query's (words in common by all words of the two, in per cent). Rows
    without text are unlike. ``marks`` is what normalising takes out."""
    if percent is None:
        norm = lambda c: _lower(F.regexp_replace(c, marks, ""))
        return df.withColumn("_n", norm(F.col(text))).join(training.select(norm(F.col(text)).alias("_n")).distinct(), "_n", "left_anti").drop("_n")
    # Equal sets of words are one set on either side.
    words = F.sort_array(distinct_words(F.coalesce(F.col(text), F.lit("")), marks))
    mark = lambda c: F.md5(F.concat_ws("\n", c))
    sets = lambda x: x.groupBy(mark(F.col("w")).alias("id")).agg(F.first("w").alias("w"))
    near = near_sets(sets(df.select(words.alias("w"))), sets(training.select(words.alias("w"))), percent, first=True).select(F.col("a").alias("_id")).distinct()
    return df.withColumn("_id", mark(words)).join(near, "_id", "left_anti").drop("_id")


def fuzzy(a: DataFrame, b: DataFrame, key: str, least: int = 80, block: int | None = 2) -> DataFrame:
    """Pairs of like keys, by edit distance over the longer one in per cent, rounded. With ``block``, only keys
    that begin with the same so many letters and are of like length are held against each other; with
    None all that can be alike are, and no pair is lost."""
    ratio = F.round(100 * (1 - F.levenshtein(F.col(key), F.col("_k")) / F.greatest(F.length(key), F.length("_k"))))
    if block is None:
        right = b.withColumnRenamed(key, "_k")
        pairs = _near_strings(a.select(key).distinct(), right.select("_k").distinct(), key, least).withColumn("ratio", ratio).filter(F.col("ratio") >= least)
        return a.join(pairs, key).join(right, "_k").withColumnRenamed("_k", f"{key}_2")
    left = a.withColumn("_b", F.substring(key, 1, block))
    right = b.withColumnRenamed(key, "_k").withColumn("_b", F.substring("_k", 1, block))
    n, m = F.length(key), F.length("_k")
    close = F.least(n, m) * 100 >= F.greatest(n, m) * least
    return left.join(right, "_b").filter(close).withColumn("ratio", ratio).filter(F.col("ratio") >= least).withColumnRenamed("_k", f"{key}_2").drop("_b")


def _near_strings(left: DataFrame, right: DataFrame, key: str, least: int) -> DataFrame:
    """(key, _k): every pair of strings that may be ``least`` per cent alike, from equal segments.

    A string k edits away from another holds one of its k + 1 segments unchanged, at a place that the
    segment's number and the lengths bound (multi-match windows of segment joins). The shorter string is
    cut, for each length that the other may have; the longer one looks its own pieces up, by length, number
    and piece. Keys grow with the cube of k, so this is for names and short queries."""
    share = (100.5 - least) / 100
    edits = lambda n: F.floor(n * share + 1e-9).cast("int")
    step = lambda n: F.sequence(F.lit(0), n)
    base = lambda n, k: F.floor(n / (k + 1)).cast("int")
    # Of k + 1 segments the last ones are a letter longer.
    longer = lambda n, k, i: F.greatest(i - (k + 1 - n % (k + 1)), F.lit(0))
    start = lambda n, k, i: i * base(n, k) + longer(n, k, i)
    size = lambda n, k, i: base(n, k) + F.when(i >= k + 1 - n % (k + 1), 1).otherwise(0)
    name = lambda n, m, i, piece: F.xxhash64(n, m, i, piece)

    def cut(s, most):
        """Segments for each length from the string's own to that of the longest that may be alike."""
        n = F.length(s)
        lengths = F.filter(F.sequence(n, F.greatest(n, F.lit(most))), lambda m: m - edits(m) <= n)
        return F.flatten(F.transform(lengths, lambda m: F.transform(step(edits(m)), lambda i: name(n, m, i, F.substring(s, start(n, edits(m), i) + 1, size(n, edits(m), i))))))

    def look(s):
        m = F.length(s)
        k = edits(m)

        def pieces(n, i):
            p, d = start(n, k, i), m - n
            lo = F.greatest(F.lit(0), p - i, p + d - (k - i))
            hi = F.least(m - size(n, k, i), p + i, p + d + (k - i))
            return F.when(lo <= hi, F.transform(F.sequence(lo, F.greatest(lo, hi)), lambda at: name(n, m, i, F.substring(s, at + 1, size(n, k, i))))).otherwise(F.array().cast("array<bigint>"))

        return F.flatten(F.transform(F.sequence(F.greatest(m - k, F.lit(0)), m), lambda n: F.flatten(F.transform(step(k), lambda i: pieces(n, i)))))

    left, right = (x.filter(F.length(c) > 0) for x, c in ((left, key), (right, "_k")))
    most = max(left.agg(F.max(F.length(key))).first()[0] or 0, right.agg(F.max(F.length("_k"))).first()[0] or 0)
    keyed = lambda df, c, keys: df.select(c, F.explode(F.array_distinct(keys)).alias("_s"))
    far = lambda: F.levenshtein(F.col(key), F.col("_k")) <= edits(F.greatest(F.length(key), F.length("_k")))
    one = keyed(left, key, cut(F.col(key), most)).join(keyed(right, "_k", look(F.col("_k"))), "_s").filter((F.length(key) <= F.length("_k")) & far())
    two = keyed(right, "_k", cut(F.col("_k"), most)).join(keyed(left, key, look(F.col(key))), "_s").filter((F.length("_k") < F.length(key)) & far())
    return one.select(key, "_k").union(two.select(key, "_k")).distinct()


def by_model(results: DataFrame, key: str, models: list[str], value: str = "score") -> DataFrame:
    """A row a key, a column a model."""
    return results.groupBy(key).pivot("model", models).agg(F.first(value))


def scores_by_row(results: DataFrame, key: str) -> DataFrame:
    """A row a key, its models' scores in the models' order."""
    pairs = F.sort_array(F.collect_list(F.struct("at", "score")))
    return results.groupBy(key).agg(F.transform(pairs, lambda x: x["score"]).alias("scores"))


def together(*frames: DataFrame) -> DataFrame:
    """All rows, all columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

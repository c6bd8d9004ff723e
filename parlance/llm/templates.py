"""Line dedup by a log-template tree.

A line's tokens are its words; those with a digit are variable fields (``<*>``). The tree's depth
is fixed: a line descends by its number of tokens and its first ``DEPTH`` tokens to a leaf. Lines of
a leaf are taken in order; a line joins the template that it shares most tokens with, if at least
``ALIKE`` of all, and the places where they differ become variable too; else it is a new template.
Templates found in ``least_docs`` documents or more are recurring, and their lines are dropped.

1. Leaves are counted by hash, one row a document and leaf. Those in fewer documents cannot recur.
2. The others' lines, each distinct line once, go through the tree in order, a leaf after the other. A
   leaf is never split, as its templates depend on all of its lines; its distinct lines stream through
   one task, which holds the leaf's templates and no lines.
3. Documents of each template are counted exactly; its lines are dropped from all of them.

The leaves that may recur are sent to the tasks as hashes if they are at most ``SENT``; if more,
lines meet them in a join.

Defined cases: null is empty; lines without a word have no template and stay; rows that repeat an
id count as documents of their own; a text of any length is cut into its lines whole, and a line of any length is one; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import map_arrow, materialize, text_bytes

DEPTH, ALIKE, LEAST_DOCS, SENT = 3, 0.6, 3, 1_000_000
FIELD = b"<*>"
_DIGIT = re.compile(rb"[0-9]")


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def masked(line: bytes) -> list[bytes]:
    """A line's tokens with variable fields marked."""
    tokens = line.split()
    return [FIELD if _DIGIT.search(t) else t for t in tokens] if _DIGIT.search(line) else tokens


def leaf_of(tokens: list[bytes]) -> int:
    return _signed(xxhash.xxh3_64_intdigest(b"%d " % len(tokens) + b" ".join(tokens[:DEPTH])))


@lru_cache(maxsize=256)
def _sets(fixed: int, size: int, needed: int) -> tuple[list[tuple[int, ...]], dict[int, list[int]]]:
    """The sets of places of lines of so many tokens, and which of them a place is in."""
    sets, by_place = _combinations(range(fixed, size), needed), {}
    for k, places in enumerate(sets):
        for p in places:
            by_place.setdefault(p, []).append(k)
    return sets, by_place


def _combinations(places: range, needed: int) -> list[tuple[int, ...]]:
    """Sets of places such that lines that agree at ``needed`` places or more agree at all of one set: dealt
    over few enough groups, so many agreements put two or three of them into one group."""
    if needed <= 1:
        return [(p,) for p in places]
    size = 3 if needed >= 5 else 2
    groups = (needed - 1) // (size - 1)
    return [c for g in range(groups) for c in combinations(places[g::groups], size)]


class Leaf:
    """The templates of lines that have equally many tokens and the same first ``DEPTH`` ones, of which it
    holds no line: what it needs goes with its templates. A line is held against those templates only
    that agree with it at a set of places that any good enough one has to."""

    def __init__(self, first: list[bytes], fixed: int = DEPTH):
        self.fixed = min(fixed, len(first))
        self.named = any(x != FIELD for x in first[: self.fixed])
        self.templates: list[list[bytes]] = []
        # The least number of equal places, as the share is compared.
        self.least = int(ALIKE * len(first))
        self.least += self.least < ALIKE * len(first)
        self.sets, self.sets_of = _sets(self.fixed, len(first), self.least - self.fixed)
        # By the hash of a set and its tokens; what templates held before they changed stays, and is compared anyway.
        self.index: dict[int, list[int]] = {}

    def _enter(self, number: int, sets) -> None:
        template = self.templates[number]
        for k in sets:
            self.index.setdefault(hash((k, *[template[p] for p in self.sets[k]])), []).append(number)

    def place(self, line: list[bytes]) -> int:
        """The number of the template that the line joins or begins."""
        fixed, templates = self.fixed, self.templates
        if self.named and self.least <= fixed:
            near = set(range(len(templates)))
        else:
            near = {t for k, places in enumerate(self.sets) for t in self.index.get(hash((k, *[line[p] for p in places])), ())}
        best, same = -1, -1
        for t in near:
            equal = [a for a, b in zip(templates[t][fixed:], line[fixed:], strict=True) if a == b]
            # Beyond fields alone a template shares a token, or a name at the beginning.
            if self.named or any(a != FIELD for a in equal):
                n = fixed + len(equal)
                if n > same or n == same and t < best:
                    best, same = t, n
        if best < 0 and line.count(FIELD) == len(line):
            best = next((t for t, x in enumerate(templates) if x.count(FIELD) == len(x)), -1)
            same = len(line)
        if best >= 0 and same >= self.least:
            old, changed = templates[best], set()
            for place, (a, b) in enumerate(zip(old, line, strict=True)):
                if a != b and a != FIELD:
                    old[place] = FIELD
                    changed.update(self.sets_of.get(place, ()))
            self._enter(best, changed)
            return best
        templates.append(list(line))
        self._enter(len(templates) - 1, range(len(self.sets)))
        return len(templates) - 1


def parse(lines: list[list[bytes]]) -> list[int]:
    """The template of each of some lines of equally many tokens, in order."""
    alike = next((k for k in range(DEPTH) if any(x[k : k + 1] != lines[0][k : k + 1] for x in lines)), DEPTH)
    leaf = Leaf(lines[0], alike) if lines else None
    return [leaf.place(line) for line in lines]


def _doc_leaves(texts: DataFrame) -> DataFrame:
    """(leaf), one row a document and leaf."""

    def run(batches):
        for batch in batches:
            found: list[int] = []
            for x in batch.column(0):
                own = set()
                for line in (x.as_py() or b"").split(b"\n"):
                    tokens = masked(line)
                    if tokens:
                        own.add(leaf_of(tokens))
                found += own
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["leaf"])

    return map_arrow(texts, run, "leaf long")


def recurring_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """(id, n_lines, n_dropped, dropped_lines): the numbers of the lines that go, from 0, in order.
    One row an input row."""
    spark = df.sparkSession
    leaves = _doc_leaves(df.select(text_bytes(text_col).alias("text"))).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_docs).select("leaf")
    leaves = materialize(leaves)
    some = leaves.count() <= SENT
    sent = spark.sparkContext.broadcast(np.sort(leaves.toPandas()["leaf"].to_numpy(dtype=np.int64))) if some else None
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()), T.StructField("doc", df.schema[id_col].dataType), T.StructField("n_lines", T.IntegerType()), T.StructField("line", T.IntegerType()),
            T.StructField("leaf", T.LongType()), T.StructField("words", T.BinaryType()),
        ]
    )

    def run(batches):
        may = set(sent.value.tolist()) if sent else None
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            ids = []
            for k, (row, x) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2), strict=True)):
                lines = (x.as_py() or b"").split(b"\n")
                # The document's own row, and one for each line that may recur.
                for c, v in enumerate((row, len(lines), None, row, None)):
                    out[c].append(v)
                ids.append(k)
                for number, line in enumerate(lines):
                    tokens = masked(line)
                    if tokens and (may is None or leaf_of(tokens) in may):
                        ids.append(None)
                        for c, v in enumerate((row, None, number, leaf_of(tokens), b" ".join(tokens))):
                            out[c].append(v)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            row, n, line, leaf, words = (pa.array(v, kind) for v, kind in zip(out, kinds, strict=True))
            yield pa.RecordBatch.from_arrays([row, batch.column(1).take(pa.array(ids, pa.int32())), n, line, leaf, words], names=schema.names)

    found = map_arrow(df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc"), text_bytes(text_col).alias("text")), run, schema)
    if not some:
        found = found.join(leaves.withColumn("may", F.lit(True)), "leaf", "left").filter("line is null or may").select(*schema.names)
    found = materialize(found)
    lines = found.filter("line is not null")
    # A line in a third of all documents is one row a task before the shuffle.
    distinct = lines.select("leaf", "words").distinct()

    def tree(batches):
        key, own = None, {}
        for batch in batches:
            names, kinds = [], []
            for leaf, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if leaf != key:
                    key, own = leaf, {}
                tokens = words.split()
                # A leaf's hash may, if hardly ever, stand for several.
                kind = (len(tokens), *tokens[:DEPTH])
                if kind not in own:
                    own[kind] = len(own), Leaf(tokens)
                kinds.append(own[kind][0])
                names.append(own[kind][1].place(tokens))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kinds, pa.int32()), pa.array(names, pa.int32())], names=["leaf", "words", "kind", "template"])

    sorted_ = distinct.repartition("leaf").sortWithinPartitions("leaf", "words")
    named = materialize(map_arrow(sorted_, tree, "leaf long, words binary, kind int, template int"))
    which = ["leaf", "kind", "template"]
    placed = materialize(lines.join(named, ["leaf", "words"]).select("row", "line", *which))
    often = materialize(placed.select("row", *which).distinct().groupBy(*which).agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") >= least_docs).select(*which))
    gone = placed.join(often, which, "left_semi").groupBy("row").agg(F.sort_array(F.collect_list("line")).alias("dropped_lines"))
    empty: Column = F.array().cast("array<int>")
    out = found.filter("line is null").select("row", "doc", "n_lines").join(gone, "row", "left")
    return out.select(F.col("doc").alias(id_col), "n_lines", F.coalesce(F.size("dropped_lines"), F.lit(0)).alias("n_dropped"), F.coalesce("dropped_lines", empty).alias("dropped_lines"))


def without_lines(text: Column, dropped: Column) -> Column:
    """``text`` without the lines of those numbers."""
    return F.array_join(F.filter(F.transform(F.split(text, "\n"), lambda x, k: F.when(~F.array_contains(dropped, k), x)), lambda x: x.isNotNull()), "\n")

"""Ranked lexical search over a bit-sliced impact index.

A term's impact in a document is an integer: its weight (rarer terms weigh more) times a saturating
count, less for long documents. The index keeps the impacts of ``BLOCK`` documents a term as bitmaps,
one a bit of the impact: bit d of slice b says whether bit b of document d's impact is set. A query's
score is the sum of its terms' impacts, made for all documents of a block at once by adding slices with
bitwise carries. The best k are found by descending from the most significant slice: documents that
have the bit come before those that have not, until k are apart; ties go by the smallest id.

1. A scan counts documents, terms and, for the terms of the queries, documents that hold them.
2. A second scan writes the index: a row a block and term, slices of the bytes that are not all zero,
   and a row a block with its documents' ids. Every document is in it, every impact exact.
3. Rows of a block meet in one task, term after term, so a task holds the sums of one block and no
   posting list. It keeps the best k of each query over all of its blocks; these few rows are ranked.

Queries are stated from outside and taken ``AT_ONCE`` at a time, at most ``BYTES`` of text: what is
sent to the tasks is bounded by that. A document in a third of which one term stands costs a bit a
document and slice, so frequent terms are the cheapest per document.

Defined cases: null text has no terms; a document without terms counts nowhere and is never found; rows
that repeat an id or text are documents of their own, ranked by id, equal ids in any order; a null id
comes after all others of its score; a query that is null or without known terms gets no rows;
queries that repeat an id are answered one by one; a text of any length is read whole; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.llm.common import discard, map_arrow, materialize, text_bytes
from parlance.workers import ship

#: Documents a block, a multiple of 64.
BLOCK = 16_384
#: Queries answered by one index, and the bytes of their texts.
AT_ONCE, BYTES = 512, 1 << 25
#: Fixed values of the ranking: share of the length in the norm, in per cent, and the count's saturation.
NORM, SATURATION = 75, 8
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text: ASCII letters and digits and all other characters; A-Z in lower case."""
    return _TERM.findall((text or b"").lower())


def weight(documents: int, holding: int) -> int:
    return floor(1000 * log((2 * documents + 2) / (2 * holding + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, weights: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Impacts of terms that stand tf times in documents of n terms."""
    sizes, which = np.unique(n, return_inverse=True)
    m = np.array([100 - NORM + (NORM * x * documents) // length for x in sizes.tolist()], dtype=np.int64)[which]
    return weights * ((1_000_000_000 * tf) // (1000 * tf + SATURATION * m))


def counted(docs: DataFrame, vocabulary: dict[bytes, int], text_col: str) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all their terms, and the documents that hold each term of the vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = sent.value
        documents, length, held = 0, 0, np.zeros(len(known), np.int64)
        for batch in batches:
            for text in batch.column(0):
                words = terms_of(text.as_py())
                documents += bool(words)
                length += len(words)
                held[[known[w] for w in known.keys() & set(words)]] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *some.tolist()], pa.int64()), pa.array([documents, length, *held[some].tolist()], pa.int64())], names=["what", "n"])

    found = map_arrow(docs.select(text_bytes(text_col)), run, "what long, n long").groupBy("what").agg(F.sum("n").alias("n"))
    all_ = {r["what"]: r["n"] for r in found.collect()}  # a row a term of the vocabulary at most
    sent.unpersist()
    return all_.pop(-2, 0), all_.pop(-1, 0), all_


def slices_of(terms: np.ndarray, places: np.ndarray, values: np.ndarray, block: int = BLOCK):
    """(term, bytes, slices) of each term: which bytes of its bitmaps hold a document, and these bytes of
    every slice, the least significant first. Postings come in any order."""
    order = np.lexsort((places, terms))
    terms, places, values = terms[order], places[order], values[order]
    cell = terms.astype(np.int64) * (block // 8) + (places >> 3)
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    bit = (1 << (places & 7)).astype(np.uint8)
    depth = int(values.max()).bit_length() if len(values) else 0
    # One row a slice over all cells of the block.
    table = np.stack([np.bitwise_or.reduceat(np.where((values >> b) & 1, bit, 0).astype(np.uint8), first) for b in range(depth)]) if depth else np.zeros((0, 0), np.uint8)
    owner = terms[first]
    begin = np.flatnonzero(np.diff(owner, prepend=-1))
    for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(first)], strict=True):
        if a == b:
            continue
        part = table[:, a:b]
        used = np.flatnonzero(part.any(axis=1))
        part = part[: used[-1] + 1] if len(used) else part[:0]
        yield int(owner[a]), (cell[first[a:b]] % (block // 8)).astype(np.uint16), part


def build(docs: DataFrame, vocabulary: dict[bytes, int], stats: tuple[int, int, dict[int, int]], id_col: str, text_col: str, block: int = BLOCK) -> DataFrame:
    """The index, written: (block, term, cells, slices, ids); a block's row of ids has the term -1."""
    documents, length, held = stats
    heavy = np.zeros(len(vocabulary), np.int64)
    for t, n in held.items():
        heavy[t] = weight(documents, n)
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, heavy))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["block", "term", "cells", "slices", "ids"]

    def run(batches):
        from pyspark import TaskContext

        known, weights = sent.value
        task, number = TaskContext.get().partitionId(), 0
        ids, rows = None, ([], [], [], [])

        def flush(ids, rows):
            terms, places, tf, n = (np.array(x, dtype=np.int64) for x in rows)
            block_id = task << 32 | number
            yield pa.RecordBatch.from_arrays([pa.array([block_id], pa.int64()), pa.array([-1], pa.int32()), pa.array([None], pa.binary()), pa.array([None], pa.binary()), pa.array([ids.to_pylist()], pa.list_(ids.type))], names=names)
            if not len(terms):
                return
            values = impacts(tf, n, weights[terms], documents, length)
            # A term in nearly all documents weighs nothing.
            terms, places, values = terms[values > 0], places[values > 0], values[values > 0]
            found = list(slices_of(terms, places, values, block))
            for k in range(0, len(found), 256):
                part = found[k : k + 256]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block_id] * len(part), pa.int64()), pa.array([t for t, _, _ in part], pa.int32()), pa.array([c.tobytes() for _, c, _ in part], pa.binary()),
                        pa.array([s.tobytes() for _, _, s in part], pa.binary()), pa.nulls(len(part), pa.list_(ids.type)),
                    ], names=names,
                )

        for batch in batches:
            for start, size in _cuts(len(ids) if ids is not None else 0, batch.num_rows, block):
                part = batch.slice(start, size)
                at = 0 if ids is None else len(ids)
                for k, text in enumerate(part.column(1), at):
                    words = terms_of(text.as_py())
                    mine = [w for w in words if w in known]
                    if mine:
                        tf: dict[int, int] = {}
                        for w in mine:
                            t = known[w]
                            tf[t] = tf.get(t, 0) + 1
                        rows[0].extend(tf)
                        rows[1].extend([k] * len(tf))
                        rows[2].extend(tf.values())
                        rows[3].extend([len(words)] * len(tf))
                own = part.column(0)
                ids = own if ids is None else pa.concat_arrays([ids, own])
                if len(ids) == block:
                    yield from flush(ids, rows)
                    ids, rows, number = None, ([], [], [], []), number + 1
        if ids is not None:
            yield from flush(ids, rows)

    out = materialize(map_arrow(docs.select(F.col(id_col).alias("id"), text_bytes(text_col)), run, f"block long, term int, cells binary, slices binary, ids array<{kind}>"))
    sent.unpersist()
    return out


def _cuts(held: int, rows: int, block: int):
    """(start, size) of the parts of a batch that fill blocks up."""
    start = 0
    while start < rows:
        size = min(rows - start, block - held)
        yield start, size
        start, held = start + size, (held + size) % block


def add(total: np.ndarray, at: np.ndarray, words: np.ndarray, slices: np.ndarray, shift: int = 0) -> None:
    """Add a term's slices, times 2 ** ``shift``, to the sums of the queries ``at``: [slice, query, word] of
    64 documents a word. ``words`` are those that the term's slices have."""
    every = len(words) == total.shape[2]
    here = (at, slice(None)) if every else np.ix_(at, words)
    carry = None
    for b in range(shift, total.shape[0]):
        x = slices[b - shift] if b - shift < len(slices) else None
        if x is None and carry is None:
            return
        sums = total[b][here]
        if x is None:
            both, one = None, sums
        else:
            both, one = sums & x, sums ^ x
        if carry is None:
            total[b][here], carry = one, both
        else:
            total[b][here] = one ^ carry
            carry = one & carry if both is None else both | one & carry
        if b - shift >= len(slices) - 1 and not carry.any():
            return


def _by_id(x):
    return (1, 0) if x is None else (0, x)


def best(total: np.ndarray, ids: list, k: int) -> list[tuple[int, int]]:
    """(place, score) of the k documents of the greatest sums above 0, by sums [slice, word]. Of equal
    sums those of the smaller ids."""
    sure, open_ = np.zeros_like(total[0]), np.bitwise_or.reduce(total, axis=0)
    if not open_.any():
        return []
    for b in range(len(total) - 1, -1, -1):
        with_bit = open_ & total[b]
        n = int(np.bitwise_count(sure | with_bit).sum())
        if n > k:
            open_ = with_bit
        else:
            sure, open_ = sure | with_bit, open_ & ~with_bit
            if n == k:
                open_ = np.zeros_like(open_)
                break
    places = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little")).tolist()
    known = places(sure)
    tied = sorted(places(open_), key=lambda p: (*_by_id(ids[p]), p))[: k - len(known)]
    score = lambda p: sum(((int(total[b][p >> 6]) >> (p & 63)) & 1) << b for b in range(len(total)))
    return [(p, score(p)) for p in known + tied]


def _order(row):
    return -row[1], *_by_id(row[0])


def search(index: DataFrame, asked: list[dict[int, int]], documents: int, k: int, block: int = BLOCK) -> DataFrame:
    """(query, doc, score): for each query of ``asked`` (its terms and how often) its k best documents or fewer,
    some of them of every task."""
    by_term: dict[int, list[tuple[int, int]]] = {}
    for i, terms in enumerate(asked):
        for t, n in terms.items():
            by_term.setdefault(t, []).append((i, n))
    # A count saturates below a million, so sums have so many bits.
    most = max((sum(terms.values()) for terms in asked), default=0) * weight(documents, 0) * 1_000_000
    depth, queries = most.bit_length(), len(asked)
    if depth > 62:
        raise ValueError("a query of so many terms has scores beyond 64 bits")
    sent = index.sparkSession.sparkContext.broadcast(by_term)
    kind = index.schema["ids"].dataType.elementType
    out_schema = f"query int, doc {kind.simpleString()}, score long"

    def run(batches):
        known = sent.value
        winners: list[list[tuple]] = [[] for _ in range(queries)]
        total, ids, at, touched = np.zeros((depth, queries, block // 64), np.uint64), [], None, set()

        def close():
            for q in touched:
                winners[q] = sorted(winners[q] + [(ids[p], s) for p, s in best(np.ascontiguousarray(total[:, q]), ids, k)], key=_order)[:k]
            total[:, list(touched)] = 0
            touched.clear()

        id_type = None
        for batch in batches:
            id_type = batch.column(4).type.value_type
            for i, (number, term) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if number != at:
                    close()
                    at = number
                if term < 0:
                    ids = batch.column(4)[i].as_py()
                    continue
                users = known.get(term)
                if not users:
                    continue
                cells = np.frombuffer(batch.column(2)[i].as_py(), np.uint16)
                part = np.frombuffer(batch.column(3)[i].as_py(), np.uint8).reshape(-1, len(cells))
                words = np.unique(cells >> 3)
                wide = np.zeros((len(part), len(words), 8), np.uint8)
                wide[:, np.searchsorted(words, cells >> 3), cells & 7] = part
                slices = wide.reshape(len(part), -1).view("<u8")
                times = max(n for _, n in users)
                for shift in range(times.bit_length()):
                    who = np.array([q for q, n in users if n >> shift & 1], dtype=np.int64)
                    if len(who):
                        add(total, who, words, slices, shift)
                touched.update(q for q, _ in users)
        close()
        rows = [(q, d, s) for q, own in enumerate(winners) for d, s in own]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], id_type or pa.int64()), pa.array([r[2] for r in rows], pa.int64())], names=["query", "doc", "score"])

    ordered = index.repartition("block").sortWithinPartitions("block", "term")
    return map_arrow(ordered, run, out_schema)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """(item, rank, doc, score): each item's k best documents with a score above 0, best first."""
    spark = docs.sparkSession
    ship(spark)
    item_kind, doc_kind = items.schema[item_col].dataType, docs.schema[id_col].dataType
    stated = items.select(F.col(item_col).alias("item"), text_bytes(item_text).alias("text"))
    out = None
    for part in _slices(stated.toLocalIterator()):
        vocabulary: dict[bytes, int] = {}
        asked: list[dict[int, int]] = []
        for _, terms in part:
            own: dict[int, int] = {}
            for w in terms:
                t = vocabulary.setdefault(w, len(vocabulary))
                own[t] = own.get(t, 0) + 1
            asked.append(own)
        stats = counted(docs, vocabulary, text_col)
        if not stats[0]:
            break
        index = build(docs, vocabulary, stats, id_col, text_col, block)
        found = materialize(search(index, asked, stats[0], k, block))
        discard(index)
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(part)], f"query int, item {item_kind.simpleString()}")
        place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
        top = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
        answers = top.join(F.broadcast(names), "query").select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
        out = answers if out is None else out.union(answers)
    if out is None:
        out = spark.createDataFrame([], f"`{item_col}` {item_kind.simpleString()}, rank int, `{id_col}` {doc_kind.simpleString()}, score long")
    return out


def _slices(rows):
    """Lists of (item, terms) of at most ``AT_ONCE`` queries and about ``BYTES`` bytes."""
    part, size = [], 0
    for row in rows:
        if part and (len(part) >= AT_ONCE or size + len(row["text"]) > BYTES):
            yield part
            part, size = [], 0
        part.append((row["item"], terms_of(bytes(row["text"]))))
        size += len(row["text"])
    if part:
        yield part

"""MinHash near-dedup with SuperMinHash signatures.

Each element of a text's set of word shingles has a permutation of the signature's slots and a
random value for each step; step j puts j plus that value into the j-th slot of the permutation,
if it is lower than what is there. Ranks within an element exclude each other, which lowers the
variance; once all slots hold less than the next step, nothing can change and the text is done.

1. Texts with one and the same set are one representative from here on.
2. Signatures are cut into bands; representatives that share a band are candidates. Rows a band
   are chosen so that a pair at the threshold is missed with a chance below one in a million.
3. In each bucket all members of like size are held against one of them, the hub, on full sets: the one whose
   buckets hold most members, so that of a text and its variants it is the text. Linked members
   are grouped. Where a bucket still has members of several groups, those outside the hub's group
   get a hub of their own, and so on for a few rounds.
4. Members of buckets that have several groups even then are clustered by shared buckets. Clusters
   are cut into blocks of ``BLOCK`` members; two blocks meet once in a task, as a matrix product of
   members and shingles, which gives all shares at once. Members of a cluster's largest group are
   linked already: their blocks meet those of the others, not one another. Only a forest of the
   links found is written, never pairs, however many copies a group holds.
5. Groups are found by union-find: in each partition first, then by star contraction over all.

Sets hold 64-bit hashes of shingles. Defined cases: null and empty texts have empty sets and are
linked with nothing; rows that share an id are one document; a null id is its own component and
not kept; a text of any length is one slice of its own at most and its set one row; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import discard, map_arrow, materialize, text_bytes
from parlance.operators.components import components
from parlance.workers import ship

#: A prime, so that every step width makes a permutation of the slots.
SLOTS = 127
ROUNDS = 2
#: Members of a block, and shingles that a matrix holds at once.
BLOCK, COLUMNS = 512, 8192
#: Ids that are sent to all tasks; where there are more, they meet their texts in a join.
SENT = 1_000_000
#: Bytes of text worked on at once.
SLICE = 500_000
_LOWER = np.array([c + 32 if 0x41 <= c <= 0x5A else 0x20 if 9 <= c <= 13 else c for c in range(256)], dtype=np.uint8)
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers without visible structure."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_BASE = _U(0xD1342543DE82EF95)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = _U(pow(int(_BASE), -1, 2**64))
    return tuple(np.concatenate([[_U(1)], np.multiply.accumulate(np.full(max(n, 1), b, dtype=np.uint64))]) for b in (_BASE, inverse))


_cache: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts that lie end to end, and each word's text."""
    if "p" not in _cache or len(_cache["p"][0]) <= len(data):
        _cache["p"] = _powers(max(len(data), 2 * SLICE))
    up, down = _cache["p"]
    low = _LOWER[data]
    inside = np.concatenate([low != 0x20, [False]])
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | first))
    last = np.zeros(len(data) + 1, dtype=bool)
    last[offsets[1:]] = True
    after = np.concatenate([inside[1:], [False]])
    ends = np.flatnonzero(inside & (~after | np.concatenate([last[1:], [False]]))) + 1
    run = np.concatenate([[_U(0)], np.cumsum(_BYTE[low] * up[: len(data)], dtype=np.uint64)])
    h = _mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP)
    return h, np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each text's begin.
    Fewer than ``k`` words are one shingle."""
    n = len(offsets) - 1
    h, text = word_hashes(data, offsets)
    counts = np.bincount(text, minlength=n)
    at = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(h)) - at[text]
    size = np.minimum(counts, k)[text]
    begins = np.flatnonzero((place + size <= counts[text]))
    s = np.zeros(len(begins), dtype=np.uint64)
    for j in range(k):
        more = size[begins] > j
        s[more] = _mix(s[more] * _BASE + h[begins[more] + j] + _STEP)
    owner = text[begins]
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    s, owner = s[new], owner[new]
    return s, np.searchsorted(owner, np.arange(n + 1))


def super_minhash(s: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Signatures, a row of SLOTS values a text; infinite for empty sets."""
    n = len(begins) - 1
    owner = np.repeat(np.arange(n), np.diff(begins))
    sig = np.full(n * SLOTS, np.inf)
    width = (_mix(s ^ _U(0x5851F42D4C957F2D)) % _U(SLOTS - 1)).astype(np.int64) + 1
    slot = (_mix(s ^ _U(0x14057B7EF767814F)) % _U(SLOTS)).astype(np.int64)
    for j in range(SLOTS):
        value = j + (_mix(s + _U((j + 1) * int(_STEP) % 2**64)) >> _U(11)).astype(np.float64) * 2.0**-53
        np.minimum.at(sig, owner * SLOTS + slot, value)
        open_ = sig.reshape(n, SLOTS).max(axis=1) >= j + 1
        live = open_[owner]
        if not live.any():
            break
        s, owner, width, slot = s[live], owner[live], width[live], slot[live]
        slot = (slot + width) % SLOTS
    return sig.reshape(n, SLOTS)


def band_hashes(sig: np.ndarray, rows: int) -> np.ndarray:
    bands = SLOTS // rows
    bits = np.ascontiguousarray(sig[:, : bands * rows]).view(np.uint64).reshape(len(sig), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, bits.shape[:2]).copy()
    for r in range(rows):
        h = _mix(h * _BASE + bits[:, :, r])
    return h.view(np.int64)


def band_rows(percent: int) -> int:
    """The most rows a band at which a pair at the threshold is missed less than once in a million."""
    t = percent / 100
    return max([1, *(r for r in range(1, 21) if (1 - t**r) ** (SLOTS // r) < 1e-6)])


def _slices(column: pa.Array):
    """(first row, bytes end to end, offsets) of runs of about SLICE bytes."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE, side="right")) - 1)
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def signatures(df: DataFrame, id_col: str, text_col: str, k: int, rows: int) -> DataFrame:
    """(doc, n_shingles, digest, bands), one row an input row; empty sets have neither of the last two."""
    schema = T.StructType([T.StructField("doc", df.schema[id_col].dataType), T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            for at, data, offsets in _slices(batch.column(1)):
                s, begins = shingle_sets(data, offsets, k)
                sizes = np.diff(begins)
                bands = band_hashes(super_minhash(s, begins), rows)
                digests = [xxhash.xxh3_128_digest(s[begins[i] : begins[i + 1]].tobytes()) if sizes[i] else None for i in range(len(sizes))]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * bands.shape[1], pa.int32()), pa.array(bands.ravel()), mask=pa.array(sizes == 0))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sizes)), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists], names=schema.names)

    return map_arrow(df.select(F.col(id_col).alias("doc"), text_bytes(text_col).alias("text")), run, schema)


def hash_sets(df: DataFrame, k: int) -> DataFrame:
    """(doc, hashes) of rows (doc, text as bytes)."""
    schema = T.StructType([df.schema["doc"], T.StructField("hashes", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            for at, data, offsets in _slices(batch.column(1)):
                s, begins = shingle_sets(data, offsets, k)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(begins) - 1), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(s.view(np.int64)))], names=schema.names)

    return map_arrow(df.select("doc", "text"), run, schema)


class _Verifier:
    """Shares of common shingles of pairs, from the full sets of the texts that are in pairs."""

    def __init__(self, docs: DataFrame, k: int):
        self.docs, self.k = docs, k
        self.sets: DataFrame | None = None

    def prepare(self, ids: DataFrame) -> None:
        """Compute the sets of ``ids`` (doc), once. Texts are shuffled only where the ids are too many to send."""
        ids = materialize(ids)
        few = F.broadcast(ids) if ids.count() <= SENT else ids
        self.sets = materialize(hash_sets(self.docs.join(few, "doc", "left_semi"), self.k))
        discard(ids)

    def measure(self, pairs: DataFrame) -> DataFrame:
        """(a, b, common, united) of distinct pairs."""
        a, b = (self.sets.select(F.col("doc").alias(x), F.col("hashes").alias(f"h{x}")) for x in "ab")
        joined = pairs.join(b, "b").join(a, "a").select("a", "b", F.size(F.array_intersect("ha", "hb")).alias("common"), (F.size("ha") + F.size("hb")).alias("n"))
        return joined.select("a", "b", F.col("common").cast("long").alias("common"), (F.col("n") - F.col("common")).cast("long").alias("united"))


def _near(percent: int) -> Column:
    return F.col("common") * 100 >= F.col("united") * percent


def connected(reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, component) of whatever is near something else. reps: (rep, n, bands); docs: (doc, text)."""
    every = reps.select("rep", "n", F.explode("bands").alias("bucket"))
    # Only buckets with several members matter from here on.
    shared = materialize(every.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"))
    tied = materialize(every.join(shared, "bucket"))
    members = materialize(tied.join(tied.groupBy("rep").agg(F.sum("c").alias("weight")), "rep").select("bucket", "rep", "n", "weight"))
    discard(shared, tied)
    check = _Verifier(docs, k)
    check.prepare(members.select(F.col("rep").alias("doc")).distinct())

    def with_hub(of: DataFrame, *more: str) -> DataFrame:
        """Each member beside its bucket's hub."""
        hub = of.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("rep")).alias("r"), "n", *more)).alias("h"))
        return of.join(hub.select("bucket", (-F.col("h.r")).alias("hub"), F.col("h.n").alias("hub_n"), *[F.col(f"h.{m}").alias(f"hub_{m}") for m in more]), "bucket")

    def close(n: str, m: str, p: int) -> Column:
        return F.least(n, m) * 100 >= F.greatest(n, m) * p

    def near(pairs: DataFrame) -> DataFrame:
        measured = check.measure(pairs.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
        return materialize(measured.filter(_near(percent)).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")))

    held = materialize(with_hub(members))
    discard(members)
    edges = near(held.filter((F.col("rep") != F.col("hub")) & close("n", "hub_n", percent)))
    links, groups = [edges], components(edges)
    for turn in range(ROUNDS):
        placed = materialize(held.drop("group").join(groups, F.col("rep") == F.col("node"), "left").withColumn("group", F.coalesce("component", "rep")).drop("node", "component"))
        several = placed.groupBy("bucket").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo < hi").select("bucket")
        discard(held)
        held = materialize(placed.join(several, "bucket", "left_semi"))
        discard(placed)
        if held.isEmpty():
            return groups
        if turn + 1 == ROUNDS:
            break
        mine = held.filter("rep = hub").select("bucket", F.col("group").alias("mine"))
        outside = held.join(mine, "bucket").filter("group != mine").drop("hub", "hub_n", "mine")
        new = near(with_hub(outside, "group").filter((F.col("group") != F.col("hub_group")) & close("n", "hub_n", percent)))
        if new.isEmpty():
            break
        links.append(new)
        edges = edges.unionByName(new)
        discard(groups)
        groups = components(edges)
    # Clusters of what shares such a bucket, by the links of members to their bucket's least one.
    least = held.groupBy("bucket").agg(F.min("rep").alias("lo"))
    clusters = components(held.join(least, "bucket").filter("rep != lo").select(F.col("rep").alias("hi"), "lo").distinct())
    both = clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster")).unionByName(clusters.select(F.col("component").alias("rep"), F.col("component").alias("cluster")).distinct())
    both = materialize(both.join(held.select("rep", "group").distinct(), "rep").select(F.col("rep").alias("doc"), "cluster", "group"))
    found = materialize(block_links(both, check.sets, percent))
    out = components(edges.unionByName(found))
    discard(held, groups, clusters, both, found, check.sets, *links)
    return out


def shares(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each two sets, one of either side, have in common."""
    sizes = [len(x) for x in left + right]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    values, place, held = np.unique(np.concatenate(left + right), return_inverse=True, return_counts=True)
    # What a single set holds is in no intersection.
    column = np.where(held > 1, np.cumsum(held > 1) - 1, -1)[place]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        m = np.zeros((len(sizes), COLUMNS), dtype=np.float32)
        m[owner[a:b], column[a:b] - start] = 1
        common += m[: len(left)] @ m[len(left) :].T
    return common.astype(np.int64)


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(hi, lo): a forest of the links within each cluster that its groups don't hold yet.
    members: (doc, cluster, group); sets: (doc, hashes).

    The members of a cluster's largest group are linked already and never meet each other; they meet
    the blocks of all other members, which meet among themselves too."""
    groups = members.groupBy("cluster", "group").agg(F.count(F.lit(1)).alias("n"))
    sizes = groups.groupBy("cluster").agg(F.max(F.struct("n", (-F.col("group")).alias("g"))).alias("most"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    sizes = sizes.select("cluster", (-F.col("most.g")).alias("main"), blocks(F.col("n") - F.col("most.n")).alias("others"), blocks(F.col("most.n")).alias("mains"))
    is_main, slot = F.col("group") == F.col("main"), F.xxhash64("doc")
    mine = F.when(is_main, F.col("others") + F.pmod(slot, F.col("mains"))).otherwise(F.pmod(slot, F.greatest("others", F.lit(1)))).cast("int")
    meets = F.sequence(F.lit(0), F.when(is_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1)
    dealt = members.join(sizes, "cluster").filter("others > 0").select("doc", "cluster", mine.alias("block"), F.explode(meets).alias("other"))
    cells = dealt.select("doc", "cluster", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))

    def meet(key, table):
        docs, blocks = table["doc"].to_numpy(), table["block"].to_numpy()
        hashes = [np.asarray(x.as_py(), dtype=np.int64) for x in table["hashes"]]
        i, j = key[1].as_py(), key[2].as_py()
        parent = list(range(len(docs)))

        def find(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        p, q = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
        if not (len(p) and len(q)):
            return pa.table({"hi": pa.array([], pa.int64()), "lo": pa.array([], pa.int64())})
        sizes = np.array([len(h) for h in hashes])
        common = shares([hashes[x] for x in p], [hashes[x] for x in q])
        near = common * 100 >= (sizes[p][:, None] + sizes[q][None, :] - common) * percent
        for a, b in zip(*np.nonzero(near), strict=True):
            a, b = find(p[a]), find(q[b])
            if a != b:
                parent[b] = a
        links = [(docs[x], docs[find(x)]) for x in range(len(docs)) if find(x) != x]
        return pa.table({"hi": pa.array([max(x) for x in links], pa.int64()), "lo": pa.array([min(x) for x in links], pa.int64())})

    ship(members.sparkSession)
    return cells.join(sets, "doc").select("cluster", "i", "j", "doc", "block", "hashes").groupBy("cluster", "i", "j").applyInArrow(meet, "hi long, lo long")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row an input row: documents with
    100 * common >= percent * united shingles are linked, and so is what links connect."""
    rows = band_rows(percent)
    signed = materialize(signatures(df, id_col, text_col, k, rows))
    groups = materialize(
        signed.filter("digest is not null and doc is not null").groupBy("digest").agg(F.min("doc").alias("rep"), F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    )
    docs = df.select(F.col(id_col).alias("doc"), text_bytes(text_col).alias("text"))
    joined = connected(groups.select("rep", "n", "bands"), docs, k, percent)
    # Only what isn't alone; a hot set's rows are many on the left of the join alone.
    known = materialize(
        groups.join(joined, groups["rep"] == joined["node"], "left").select("digest", F.coalesce("component", "rep").alias("component"), "copies", "rep").filter("copies > 1 or component != rep").select("digest", "component")
    )
    discard(groups, joined)
    # What has no set or no id meets nothing, and stays out of the join.
    lone = "digest is null or doc is null"
    rows = signed.select("doc", "n_shingles", "digest")
    out = rows.filter(f"not ({lone})").join(known, "digest", "left").select("doc", "n_shingles", "component").unionByName(rows.filter(lone).select("doc", "n_shingles", F.lit(None).cast(known.schema["component"].dataType).alias("component")))
    component = F.coalesce("component", "doc")
    return out.select(F.col("doc").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc") == component, F.lit(False)).alias("kept"))

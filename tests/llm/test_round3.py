"""Periodic runs, ranked search and toxicity beside brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parlance.llm import impacts, lm, periods, registry, toxicity
from tests.llm.conftest import ODD, WORD

SF = "/root/testdata/sf0.001"


# --- periodic runs --------------------------------------------------------------------------------


def runs_of(x):
    """By the definition."""
    n, out = len(x), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            length = i - s + q
            if length >= max(6, 4 * q) and not any(all(x[s + j] == x[s + j + d] for j in range(length - d)) for d in range(1, q)):
                out.add((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(r, n, k):
    x = [r.randrange(k) for _ in range(n)]
    if n > 4 and r.random() < 0.6:
        a = r.randrange(n)
        p = 1 + r.randrange(max(1, (n - a) // 3))
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
    return x


@pytest.mark.parametrize("at_once", [8, 1 << 18])
def test_scan_finds_every_run(monkeypatch, at_once):
    monkeypatch.setattr(periods, "AT_ONCE", at_once)
    r = random.Random(at_once)
    for _ in range(1200):
        x = periodic(r, r.randrange(0, 70), r.choice([1, 2, 2, 3, 5]))
        a, want = np.array(x, dtype=np.int32), runs_of(x)
        assert sorted(periods.scan(a), key=lambda y: (y[0], y[2])) == want
        parts = r.randrange(2, 6)
        dealt = [y for k in range(parts) for y in periods.scan(a, *periods.lag_range(len(x), k, parts))]
        assert sorted(dealt, key=lambda y: (y[0], y[2])) == want


def test_scan_of_long_texts_is_near_linear():
    import time

    for x in (np.zeros(300_000, np.int32), np.tile(np.arange(37, dtype=np.int32), 8000)):
        began = time.process_time()
        assert len(periods.scan(x)) == 1
        assert time.process_time() - began < 20


def test_split_words():
    for text in (b"", b"  \n", b"a", b" a\x0bb  cc\n", "é  x 世界".encode()):
        assert periods.split_words(text).to_pylist() == re.findall(rb"[^\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("wide", [0, 200, 1 << 16])
def test_runs_of_odd_texts(spark, odd, wide):
    extra = spark.createDataFrame([(50, "x " * 9, "en", "s", 1, 1, "n"), (51, "a b a b a b a b tail " * 40, "en", "s", 1, 1, "n")], odd.schema)
    rows = odd.union(extra)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periods.periodic_runs(rows, wide=wide).collect())
    want = []
    for r in rows.select("doc_id", "text").collect():
        words = WORD.findall(r.text or "")
        if len(words) > 5000:  # one word, then one pair
            runs = [(1, len(words) - 1, 2)]
        else:
            runs = runs_of(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((r.doc_id if r.doc_id is not None else -1, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want)
    assert periods.periodic_runs(rows.limit(0)).count() == 0


def test_periodic_query(spark):
    got = {r.doc_id: r for r in registry.queries()["op11_periodic_runs"](spark, SF).collect()}
    rows, some = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), 0
    assert len(got) == len(rows)
    for r in rows:
        words = WORD.findall(r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if n > 1200:
            continue
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p, old = 1 + (n - a) // (3 + g % 8), words
            words = [old[i] if i < a else old[a + (i - a) % p] for i in range(n)]
        runs = runs_of(words)
        some += bool(runs)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None,) * 3
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        mine = got[r.doc_id]
        assert (mine.n_runs, mine.start, mine.length, mine.period) == (len(runs), *best)
        assert mine.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert mine.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert mine.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()
    assert some > 5


# --- ranked search --------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def answers(docs, items, k=10):
    held = [(d, Counter(t)) for d, text in docs if (t := terms(text))]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in held:
            m = 25 + (75 * sum(c.values()) * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in terms(text) if w in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, k_ + 1, None if none else d, -s) for k_, (s, none, d) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def test_terms():
    for _, text in ODD:
        assert [t.decode() for t in impacts.terms_of((text or "").encode())] == terms(text)


def test_slices_add_up():
    r = np.random.default_rng(3)
    for _ in range(60):
        block, queries = 256, 3
        posted = [(t, int(p), int(v)) for t in range(5) for p in r.choice(block, r.integers(1, 200), replace=False) for v in [r.integers(1, 1 << int(r.integers(1, 30)))]]
        total, want = np.zeros((40, queries, block // 64), np.uint64), np.zeros((queries, block), object)
        for term, cells, part in impacts.slices_of(*(np.array(x) for x in zip(*posted, strict=True)), block=block):
            words = np.unique(cells >> 3)
            wide = np.zeros((len(part), len(words), 8), np.uint8)
            wide[:, np.searchsorted(words, cells >> 3), cells & 7] = part
            who, shift = np.flatnonzero(r.random(queries) < 0.7), int(r.integers(0, 3))
            impacts.add(total, who, words, wide.reshape(len(part), -1).view("<u8"), shift)
            for t, p, v in posted:
                if t == term:
                    want[who, p] += v << shift
        for q in range(queries):
            ids = [int(x) for x in r.integers(0, 50, block)]
            scores = want[q].tolist()
            for k in (1, 7, 300):
                best = sorted((p for p in range(block) if scores[p]), key=lambda p: (-scores[p], ids[p], p))[:k]
                assert {(p, scores[p]) for p in best} == set(impacts.best(np.ascontiguousarray(total[:, q]), ids, k))


@pytest.mark.parametrize("block", [64, 16_384])
def test_ranked_on_odd_rows(spark, odd, block):
    items = [(1, "the MIT license"), (1, "a a b the fox"), (2, None), (3, "nowhere"), (None, "the the the y Z 世界"), (5, "naïve one two")]
    got = impacts.ranked(odd, spark.createDataFrame(items, "item_id long, text string"), k=3, block=block).collect()
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == answers(docs, items, 3)


def test_ranked_ties_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(impacts, "AT_ONCE", 2)
    r = random.Random(4)
    words = ["w%d" % i for i in range(12)]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.randrange(0, 9)))) for i in range(400)] + [(900 + i, "w1 w2 w3") for i in range(200)]
    r.shuffle(docs)
    items = [(i, " ".join(r.choice(words) for _ in range(6))) for i in range(5)]
    got = impacts.ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"), block=64).collect()
    assert Counter((x.item_id, x["rank"], x.doc_id, x.score) for x in got) == answers(docs, items)


def test_ranked_empty(spark, odd):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert impacts.ranked(odd.limit(0), items).count() == 0
    assert impacts.ranked(odd, items.limit(0)).count() == 0
    assert impacts.ranked(odd, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_ranked_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = registry.queries()["op12_ranked_search"](spark, SF).collect()
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == answers(docs, items)


# --- toxicity -------------------------------------------------------------------------------------


def maximal(scores):
    """Segments whose every beginning and end scores above 0, and that no longer such one holds."""
    n, whole = len(scores), []
    for a in range(n):
        for b in range(a, n):
            begins, ends = np.cumsum(scores[a : b + 1]), np.cumsum(scores[a : b + 1][::-1])
            if (begins > 0).all() and (ends > 0).all():
                whole.append((a, b, float(begins[-1])))
    return [x for x in whole if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in whole)]


def test_segments_are_maximal():
    r = random.Random(6)
    for _ in range(800):
        # Quarters, so that sums are exact.
        scores = [r.randrange(1, 12) / 4 if r.random() < 0.4 else -0.5 for _ in range(r.randrange(0, 16))]
        places = [i for i, s in enumerate(scores) if s > 0]
        assert toxicity.segments(places, [scores[i] for i in places]) == maximal(scores)


def test_rate_is_the_root():
    steps = {-0.5: 900, 0.25: 60, 2.0: 40}
    rate = toxicity._rate(steps)
    assert abs(sum(n / 1000 * math.exp(rate * s) for s, n in steps.items()) - 1) < 1e-6


def test_weights_follow_the_evidence():
    w = toxicity.weights(np.array([30.0, 3.0, 30.0, 0.0]), np.array([0.0, 0.0, 300.0, 30.0]), 100, 1000)
    assert w[0] > w[1] > w[2] and w[3] < 0


def corpus(n, seed):
    r = random.Random(seed)
    words = ["".join(r.choice("bdfgklmnrstv") + r.choice("aeiou") for _ in range(r.randrange(1, 4))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randrange(20, 120))]
        bad = r.random() < 0.25
        if bad:
            for _ in range(3):
                text.insert(r.randrange(len(text)), r.choice(["zorkle", "quimby", "wexxo" + r.choice(words), "wexxo" + r.choice(words)]))
        docs.append((i, " ".join(text), 1, "x"))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_finds_passages(spark):
    docs, labels = corpus(900, 1)
    d, lab = spark.createDataFrame(docs, "doc_id long, text string, score int, passages string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(d, lab)
    rows = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    held = [(rows[i].predicted, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    texts = {i: toxicity.tokens_of(t) for i, t, _, _ in docs}
    bad = lambda w: w.startswith(("zorkle", "quimby", "wexxo"))
    # Passages begin and end with words that speak for toxicity, hold those that were put in, and clean texts hardly have any.
    put = [(i, k) for i, y in labels if y for k, w in enumerate(texts[i]) if bad(w)]
    assert sum(any(p.first <= k <= p.last for p in rows[i].passages) for i, k in put) / len(put) > 0.95
    ends = [texts[i][k] for i, y in labels if y for p in rows[i].passages for k in (p.first, p.last)]
    assert sum(map(bad, ends)) / len(ends) > 0.9
    assert sum(bool(rows[i].passages) for i, y in labels if not y) / sum(not y for _, y in labels) < 0.2


def test_toxicity_ignores_held_out_labels(spark):
    docs, labels = corpus(300, 2)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    d = spark.createDataFrame(docs, "doc_id long, text string, score int, passages string")
    scores = [sorted(map(tuple, toxicity.score(d, toxicity.fit(d, spark.createDataFrame(x, "doc_id long, toxic int"))).select("doc_id", "score").collect())) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_toxicity_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(odd, toxicity.fit(odd, none)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score < 0.5 and r.predicted == 0 for r in got)
    some = spark.createDataFrame([(i, t) for i in range(12) for t in (i % 2, None)], "doc_id long, toxic int")
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, toxicity.fit(odd, some)).collect())
    assert toxicity.score(odd.limit(0), toxicity.Model()).count() == 0


def test_toxicity_query(spark):
    got = registry.queries()["op13_toxicity"](spark, SF)
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == r.held_out and r.predicted == int(r.score >= 0.5) for i, r in rows.items())


# --- line dedup: the leaf's index -----------------------------------------------------------------


def _slow_leaf(lines):
    """Every template held against every line."""
    fixed, named, made, out = min(3, len(lines[0])), any(x != b"<*>" for x in lines[0][:3]), [], []
    for line in lines:
        best, same = -1, -1
        for t, old in enumerate(made):
            n = sum(a == b for a, b in zip(old, line, strict=True))
            own = any(a == b != b"<*>" for a, b in zip(old[fixed:], line[fixed:], strict=True))
            if (own or named or all(x == b"<*>" for x in [*old, *line])) and n > same and n >= 0.6 * len(line):
                best, same = t, n
        if best < 0:
            made.append(list(line))
            best = len(made) - 1
        else:
            made[best] = [a if a == b else b"<*>" for a, b in zip(made[best], line, strict=True)]
        out.append(best)
    return out, made


def test_leaf_like_a_full_comparison():
    from parlance.llm import templates

    r = random.Random(10)
    for _ in range(600):
        size, words, fields = r.randrange(1, 16), r.choice([2, 3, 5, 12]), r.choice([0, 0.1, 0.4])
        head = [b"a" if r.random() < 0.7 else b"<*>" for _ in range(min(3, size))]
        lines = [head + [b"<*>" if r.random() < fields else b"w%d" % r.randrange(words) for _ in range(size - len(head))] for _ in range(r.randrange(1, 30))]
        leaf = templates.Leaf(lines[0])
        assert ([leaf.place(list(x)) for x in lines], leaf.templates) == _slow_leaf(lines)


def test_leaf_is_near_linear():
    import time

    from parlance.llm import templates

    r, took = random.Random(11), []
    for n in (4000, 16_000):
        leaf, began = templates.Leaf([b"a", b"b", b"c"] + [b"x"] * 9), time.process_time()
        for _ in range(n):
            leaf.place([b"a", b"b", b"c"] + [b"w%d" % r.randrange(40) for _ in range(9)])
        took.append(time.process_time() - began)
    assert took[1] < 16 * max(took[0], 0.1)  # a full comparison takes sixteen times as long


def test_sets_of_places_miss_no_agreement():
    from parlance.llm import templates

    r = random.Random(12)
    for _ in range(300):
        m = r.randrange(1, 14)
        needed = r.randrange(1, m + 1)
        sets = templates._combinations(range(3, 3 + m), needed)
        agree = set(r.sample(range(3, 3 + m), needed))
        assert any(set(s) <= agree for s in sets)


# --- very long texts ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def long_rows(spark):
    text = "Plain words stand here, one after the other, and say something new each time.\n"
    big = "".join(f"{text[:-1]} number {i}\n" for i in range(12_000))  # a million characters
    rows = [(1, big), (2, big + "tail"), (3, "x" * 1_000_000), (4, "short text of a few words"), (5, None)]
    return spark.createDataFrame([(i, t, None) for i, t in rows], "doc_id long, text string, source string").repartition(2).cache()


def test_long_texts_are_taken_whole(spark, long_rows):
    from parlance.llm import bytecnn, lm, naming, nearness, packing, rules, sharding, templates

    judged = {r.doc_id: r for r in rules.quality_rules(long_rows).collect()}
    assert judged[1].n_words == 12_000 * 16 and judged[2].n_words == 12_000 * 16 + 1 and judged[3].n_words == 1 and judged[5].n_words == 0
    shards = {r.doc_id: r for r in sharding.shard(long_rows).collect()}
    assert shards[3].size == 1_000_008 and shards[5].size == 8 and len(shards) == 5
    exact = {r.doc_id: r.keep_id for r in naming.exact_groups(long_rows).collect()}
    assert exact == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5}
    near = {r.doc_id: r.component_id for r in nearness.near_groups(long_rows).collect()}
    assert near == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    lines = {r.doc_id: r.n_lines for r in templates.recurring_lines(long_rows).collect()}
    assert lines[1] == 12_001 and lines[3] == 1
    assert packing.best_fit(long_rows).select("doc_id").distinct().count() == 5
    scores = {r.doc_id: r.score for r in bytecnn.score(long_rows, bytecnn.Net().freeze()).collect()}
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores.values())
    assert lm.score_corpus(long_rows).count() == 5


def test_long_texts_in_the_new_operators(spark, long_rows):
    found = {r.doc_id: r for r in periods.periodic_runs(long_rows).collect()}
    assert found[1].n_words == 12_000 * 16 and found[3].n_words == 1
    items = spark.createDataFrame([(1, "number 11999 tail")], "item_id long, text string")
    assert [r.doc_id for r in impacts.ranked(long_rows, items).orderBy("rank").collect()] == [2, 1]
    assert toxicity.score(long_rows, toxicity.Model({"something$": 3.0}, rate=20.0)).filter("size(passages) >= 12000").count() == 2


# --- language model -------------------------------------------------------------------------------


def directly(model, second, first, w):
    """log10 of probabilities, each from its own exponentials in double precision."""
    p = {k: v.astype(np.float64) for k, v in model.p.items()}
    out = []
    for s, f, o in zip(second, first, w, strict=True):
        hidden, c = p["R"][f] @ p["C1"] + p["R"][s] @ p["C2"], model.kind[o]
        classes, own = p["K"] @ hidden + p["a"], slice(model.starts[c], model.starts[c + 1])
        inside = p["Q"][own] @ hidden + p["b"][own]
        out.append(classes[c] - np.logaddexp.reduce(classes) + inside[o - model.starts[c]] - np.logaddexp.reduce(inside))
    return np.array(out) / math.log(10)


@pytest.mark.parametrize("wide", [1, 300])
def test_log_bilinear_scores_are_normalised_directly(wide, monkeypatch):
    """Also where the products of exponentials would leave what 32 bits hold."""
    monkeypatch.setattr(lm, "AT_ONCE", 700)
    monkeypatch.setattr(lm, "PART", 50)
    r = np.random.default_rng(4)
    model = lm.LogBilinear(np.sort(r.pareto(1, 900))[::-1] + 0.5)
    model.p["R"][::3] *= wide
    model.p["K"] *= 5
    second, first, w = r.integers(0, 900, (3, 2000))
    assert np.allclose(model.log10(second, first, w), directly(model, second, first, w), rtol=1e-4, atol=1e-4)


def test_log_bilinear_takes_exponentials_of_tokens_not_of_places(monkeypatch):
    r = np.random.default_rng(4)
    model = lm.LogBilinear(np.sort(r.pareto(1, 3000))[::-1] + 0.5)
    second, first, w = np.minimum(r.zipf(1.3, (3, 200_000)), 3000) - 1
    w = w % lm.HEADS
    taken, whole = [], np.exp
    monkeypatch.setattr(lm.np, "exp", lambda x, **k: taken.append(x.size) or whole(x, **k))
    model.log10(second, first, w)
    assert sum(taken) < len(w) * len(model.class_noise) / 4


def test_run_sums():
    r = np.random.default_rng(4)
    for n in (1, 2, 50, 400):
        which = np.sort(r.zipf(1.5, n) % 40)
        first, rows = lm._runs(which), r.normal(size=(n, 3))
        assert np.allclose(lm._run_sums(rows, first), np.add.reduceat(rows, first, axis=0))

"""Operators on small tables, and by brute force where there is one."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.functions import codec
from parlance.operators import components as graph
from parlance.operators import align, curate, distinct, mix, model_map, order, quality, report
from parlance.plans import catalogue
from parlance.plans import jobs as plans
from parlance.schema import conform
from parlance.sources import readers, retrieve, writers
from parlance.streaming import jobs


def test_conform(spark):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    assert conform(df, ("a",), {"c": 3}).columns == ["a", "b", "c"]
    with pytest.raises(ValueError, match="case"):
        conform(spark.createDataFrame([(1, 2)], "A int, a int"))


def test_first_known_takes_each_column_by_itself(spark):
    df = spark.createDataFrame([("q", None, "x", 1), ("q", "a", None, 2), (None, "z", "z", 3)], "k string, a string, b string, o int")
    assert [tuple(r) for r in distinct.first_known(df, "k", "o").collect()] == [("q", "a", "x")]


@pytest.mark.parametrize("partitions", [1, 5])
def test_rows_are_numbered_without_gaps(spark, partitions):
    df = spark.range(100).repartition(partitions).withColumn("x", F.col("id") % 7)
    got = {r["id"]: r["row_id"] for r in order.row_ids(df, ["x", "id"]).collect()}
    assert [k for k, _ in sorted(got.items(), key=lambda kv: kv[1])] == sorted(range(100), key=lambda i: (i % 7, i)) and sorted(got.values()) == list(range(1, 101))


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_wide_rows_are_numbered_without_loss(spark, adaptive):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.shuffle.partitions", 61)
        n = 200_000
        wide = spark.range(0, n, 1, 24).select("id", F.repeat(F.md5(F.col("id").cast("string")), 10).alias("body"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("hot"))
        for by in (["body"], ["hot"]):
            got = order.row_ids(wide, by).agg(F.count(F.lit(1)), F.count_distinct("row_id"), F.min("row_id"), F.max("row_id"), F.count_distinct("id"), F.sum(F.length("body")), F.count_if(F.col("body") != F.repeat(F.md5(F.col("id").cast("string")), 10)))
            assert tuple(got.first()) == (n, n, 1, n, n, 320 * n, 0)
        parts = order.chunks(wide, 7, ["body"]).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.max("body").alias("high"), F.min("body").alias("low")).orderBy("chunk").collect()
        assert [p["n"] for p in parts] == [28572] * 6 + [n - 6 * 28572]
        assert all(a["high"] < b["low"] for a, b in zip(parts, parts[1:], strict=False))
        assert order.half(wide, "id").select("id", "body").distinct().count() == n // 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("held", [3, 500_000])
def test_components(spark, monkeypatch, held):
    monkeypatch.setattr(graph, "HELD", held)
    edges = [(k + 1, k) for k in range(40)] + [(100, 50), (101, 50), (101, 100)] + [(k, 200) for k in range(201, 260)]
    df = spark.createDataFrame([(max(e), min(e)) for e in edges], "hi long, lo long").repartition(4)
    got = {r["node"]: r["component"] for r in graph.components(df).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100: 50, 101: 50} | {k: 200 for k in range(201, 260)}
    assert graph.components(df.limit(0)).collect() == []


def test_hashed_text_vectors(spark):
    df = spark.createDataFrame([("abab",), ("",), (None,), ("é" * 50_000,)], "t string")
    got = [r["v"] for r in df.select(distinct.text_vectors(F.col("t"), 16).alias("v")).collect()]
    assert got[2] is None and [sum(v) for v in (got[0], got[1], got[3])] == [3, 0, 99_999]


def test_samples(spark):
    df = spark.range(5)
    assert order.half(df, "id").count() == 2
    assert order.capped(df, 10, "id").count() == 5
    a = [r["id"] for r in order.shuffled(df, "id").collect()]
    assert sorted(a) == list(range(5)) and a == [r["id"] for r in order.shuffled(df.repartition(3), "id").collect()]
    assert {r["chunk"]: r["count"] for r in order.chunks(df, 3, ["id"]).groupBy("chunk").count().collect()} == {0: 2, 1: 2, 2: 1}


def test_within_length(spark):
    p = [["aa", "b"], ["c" * 10], ["d"]]
    df = spark.createDataFrame([(p,)], "p array<array<string>>")
    for most in range(0, 60, 3):
        kept = df.select(order.within_length(F.col("p"), most).alias("k")).first()["k"]
        want = max((n for n in range(4) if len(str(p[:n])) <= most), default=0)
        assert len(kept) == want


def test_orders(spark):
    df = spark.createDataFrame([([["a", "b", "c"]],)], "p array<array<string>>")
    pick = lambda c: df.select(c.alias("x")).first()["x"]
    assert pick(order.reordered(F.col("p"), F.lit("reverse"), F.lit(1))) == [["c", "b", "a"]]
    assert sorted(pick(order.reordered(F.col("p"), F.lit("shuffle"), F.lit(1)))[0]) == ["a", "b", "c"]
    assert pick(order.picked(F.col("p"), F.array(F.lit(2), F.lit(5), F.lit(0)))) == [["c", "a"]]


def test_flawed_rows_and_the_fallback(spark):
    cols = "`user-query` string, is_chara int, source string, is_rag int, is_single_turn int, assistant_logic string"
    rows = [("a", 0, "real", 1, 1, "低"), ("b", 1, "real", 1, 1, "低"), ("c", None, "real", 1, 1, "低"), ("d", -1, "fake", 1, 1, "中"), ("e", 0, "real", 1, 1, "高")]
    df = spark.createDataFrame(rows, cols)
    names = lambda d: sorted(r["user-query"] for r in d.collect())
    assert names(curate.keep_flawed(df, True, True)) == ["a"]
    assert names(curate.keep_flawed(df, True, True, compat=True)) == ["a", "d"]
    assert names(curate.keep_flawed(df.filter("assistant_logic = '高'"), True, True)) == ["e"]
    assert [r["task_name"] for r in curate.labelled(df).orderBy("`user-query`").collect()] == ["逻辑性差", "逻辑性差", "逻辑性差", "逻辑性中", "正常数据"]


def test_query_classes(spark):
    df = spark.createDataFrame([("今天天气",), ("你是谁",), ("播放歌",), ("山有多高",)], "q string")
    assert [r[0] for r in df.select(curate.query_class(F.col("q"))).collect()] == ["time", "persona", "command", "clean"]


def test_generalised_questions(spark):
    df = spark.createDataFrame([("问题：\na\n\n- b\n**c**\nd", None, "t")], "u string, v string, k string")
    assert sorted(r["user-query"] for r in curate.explode_generalised(df, ["u", "v"], "k").collect()) == ["a", "d"]


def test_null_keys_meet(spark):
    a, b = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int"), spark.createDataFrame([(None, 3), ("y", 4)], "k string, b int")
    assert align.outer_by_query(a, b, "k").count() == 3


def test_fuzzy(spark):
    a, b = spark.createDataFrame([("abcdefghij",)], "k string"), spark.createDataFrame([("abcdefghix",), ("abzzzzzzzz",)], "k string")
    assert [r["ratio"] for r in align.fuzzy(a, b, "k").collect()] == [90.0]


def _conversation(spark, reply, query="q"):
    m = codec.turn_messages(F.lit(query), None, None, None, F.lit(reply))
    return spark.range(1).select(m.alias("messages"), F.lit("o").alias("owner"), F.lit("d").alias("dataset"), F.lit("s").alias("source"))


@pytest.mark.parametrize(
    ("reply", "query", "gate", "verdict"),
    [
        ("fine", "q", {}, "legal"), ("", "q", {}, "empty reply"), ("I am, as an AI language model, x", "q", {}, "persona"),
        ("I am, as an AI language model, x", "q", {"waived_owners": ("o",)}, "legal"), ("abcdefghijklmnopqrstuvwxyz一二", "q", {}, "translation"),
        ("抱歉不行", "q", {"apology_sources": ("s",)}, "apology"), ("抱歉不行", "q", {}, "legal"), ("fine", "are you ChatGPT", {}, "query persona"), ("x", "q", {"short_owners": ("o",)}, "short reply"),
        ("secret", "q", {"unsafe_reply": ("secret",)}, "unsafe reply"), ("fine", "secret", {"unsafe_query": ("secret",)}, "unsafe query"),
    ],
)
def test_gates(spark, reply, query, gate, verdict):
    assert quality.judged(_conversation(spark, reply, query), quality.Gate(**gate)).first()["verdict"] == verdict


def test_gates_on_structure(spark):
    df = _conversation(spark, "fine")
    of = lambda d: quality.judged(d).first()["verdict"]
    assert of(df.withColumn("messages", F.slice("messages", 1, 4))) == "number of roles"
    assert of(df.withColumn("messages", F.reverse("messages"))) == "order of roles"
    assert of(df.withColumn("messages", F.lit(None).cast(df.schema["messages"].dataType))) == "no messages"


def test_reports(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 0, "xyz"), ("b", -1, "x"), ("b", -2, "x")], "f string, s int, t string")
    got = {r["f"]: (r["ratio"], r["n"], r["wrong"]) for r in report.by_level(df, "f", score="s").collect()}
    assert got == {"a": (0.5, 2, 0), "b": (0.0, 0, 2), None: (0.5, 2, 2)}
    assert report.gate_ratio(df.limit(0), F.col("s") < 0).first()["passes"]
    assert report.metrics_report(df, "f", ["s"], "t").count() == 2
    assert report.duplicate_rows(df.select("t")).first()[0] == 2


def _brute(v, ids, least):
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T
    return {(ids[i], ids[j]) for i in range(len(ids)) for j in range(i + 1, len(ids)) if s[i, j] >= least}


def test_pairs_and_clusters(spark):
    r = np.random.default_rng(0)
    base = r.normal(size=(12, 8))
    v = np.concatenate([base, base + r.normal(scale=0.02, size=base.shape), base[:4] + r.normal(scale=0.02, size=(4, 8))])
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)] + [(99, None)], "id int, v array<float>")
    got = {(x["a"], x["b"]) for x in distinct.similar_pairs(df, "id", "v", 0.9).collect()}
    assert got == _brute(v, list(range(len(v))), 0.9)
    groups = {x["id"]: x["cluster"] for x in distinct.semantic_groups(df, "id", "v").collect()}
    assert all(groups[i] == groups[i + 12] == i for i in range(12)) and sum(x["kept"] for x in distinct.semantic_groups(df, "id", "v").collect()) == 12
    assert distinct.semantic_groups(df.limit(0), "id", "v").count() == 0


def test_clusters_of_many_rows(spark):
    """Over 5,000 rows: pairs near the threshold still meet."""
    r = np.random.default_rng(4)
    base = r.normal(size=(2600, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = r.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    v = np.concatenate([base, 0.92 * base + np.sqrt(1 - 0.92**2) * side])
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id int, v array<float>")
    groups = {x["id"]: x["cluster"] for x in distinct.semantic_groups(df, "id", "v").collect()}
    assert groups == {i: i % 2600 for i in range(5200)}


def _naive_linkage(v, most):
    """By the definition: the least average distance first, over a whole matrix."""
    groups = [[i] for i in range(len(v))]
    far = 1 - v @ v.T
    while len(groups) > 1:
        d, i, j = min((far[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups[:i]))
        if not d < most:
            break
        groups[j] += groups.pop(i)
    label = np.arange(len(v))
    for g in groups:
        label[g] = min(g)
    return label


def _unit_rows(r, n, d, around=None):
    v = r.normal(size=(n, d)) if around is None else around + r.normal(scale=0.2, size=(n, d))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_average_linkage_like_naive():
    r = np.random.default_rng(8)
    for t in range(25):
        n, d = int(r.integers(0, 24)), int(r.integers(2, 7))
        v = _unit_rows(r, n, d, r.normal(size=(4, d))[r.integers(0, 4, n)] if t % 2 else None)
        for most in (0.05, 0.3, 0.9):
            assert (distinct.average_linkage(v, most) == _naive_linkage(v, most)).all()
            # Sums of rows that are already together count by their sizes.
            first = distinct.average_linkage(v, most / 2)
            names = np.unique(first)
            sums = np.array([v[first == x].sum(axis=0) for x in names]).reshape(len(names), d)
            again = distinct.average_linkage(sums, most, np.array([(first == x).sum() for x in names]))
            assert (names[again][np.searchsorted(names, first)] == distinct.average_linkage(v, most)).all()


def test_average_linkage_memory():
    import tracemalloc

    v = _unit_rows(np.random.default_rng(2), 3000, 16, np.ones(16))
    tracemalloc.start()
    assert len(set(distinct.average_linkage(v, 0.5).tolist())) < 3000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10_000_000  # a matrix of distances would be 72 MB


@pytest.mark.parametrize("linked", [5, 8000])
def test_components_beyond_a_task(spark, linked):
    """One component, and several, in rounds of mutual neighbours and in one task: the same clusters."""
    r = np.random.default_rng(12)
    v = np.concatenate([_unit_rows(r, 60, 6, np.ones(6)), _unit_rows(r, 25, 6, -np.eye(6)[0] * 2), np.tile(np.eye(6)[2], (9, 1))])
    df = spark.createDataFrame([(1000 - i, [float(x) for x in row]) for i, row in enumerate(v)], "id int, v array<double>")
    groups = {x["id"]: x["cluster"] for x in distinct.semantic_groups(df, "id", "v", 0.12, linked=linked).collect()}
    want = {}
    for i, g in enumerate(_naive_linkage(v, 0.12)):
        want.setdefault(g, []).append(1000 - i)
    assert groups == {i: min(m) for m in want.values() for i in m}


def test_forest_joins_what_pairs_join(spark):
    r = np.random.default_rng(13)
    v = _unit_rows(r, 300, 5)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "n long, v array<double>")
    links = distinct.near_forest(df, 0.93, block_rows=60).collect()
    assert len(links) < len(_brute(v, range(300), 0.93))

    def groups(pairs):
        up = list(range(300))

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            up[root(a)] = root(b)
        return {frozenset(y for y in range(300) if root(y) == root(x)) for x in range(300)}

    assert groups((x["hi"], x["lo"]) for x in links) == groups(_brute(v, range(300), 0.93))


def test_bands_recall(spark):
    """Pairs right at the threshold, in many dimensions, and a crowd of near and of equal vectors."""
    r = np.random.default_rng(14)
    base = _unit_rows(r, 700, 32)
    side = r.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    v = np.concatenate([base, 0.9001 * base + np.sqrt(1 - 0.9001**2) * side, np.ones((40, 32)) + r.normal(scale=0.05, size=(40, 32)), np.tile(np.eye(32)[3], (30, 1))])
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)] + [(9999, None)], "id int, v array<double>")
    want = {(a, b) for a, b in _brute(v, list(range(len(v))), 0.9) if not (a >= 1440)}
    pairs = distinct.similar_pairs(df, "id", "v", 0.9, banded=True).collect()
    got = {(x["a"], x["b"]) for x in pairs}
    assert len(pairs) == len(got) and got <= want and len(got) >= 0.99 * len(want)
    # Buckets larger than a task meet in cells.
    members, small = distinct.similar_classes(df, "id", "v", 0.9, bucket=7)
    assert {(x["a"], x["b"]) for x in small.collect()} == got
    assert {x["id"]: x["class"] for x in members.collect()} == {i: min(i, 1440) for i in range(len(v))}
    links = {x["id"]: x["links"] for x in distinct.similar_links(df, "id", "v", 0.9).collect()}
    assert all(links[i] == 29 for i in range(1440, 1470)) and all(links[i] >= 38 for i in range(1400, 1440))
    assert distinct.similar_links(df.limit(0), "id", "v", 0.9).count() == 0


def test_links_miss_no_pair_at_the_threshold(spark):
    r = np.random.default_rng(15)
    base = _unit_rows(r, 3000, 24)
    side = r.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    v = np.concatenate([base, 0.93001 * base + np.sqrt(1 - 0.93001**2) * side])
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id int, v array<double>")
    want = (v @ v.T >= 0.93).sum(axis=1) - 1
    assert {x["id"]: x["links"] for x in distinct.similar_links(df, "id", "v", 0.93).collect()} == dict(enumerate(want.tolist()))


def test_a_row_is_sent_to_few_blocks(spark, monkeypatch):
    """Rounds of linkage send a row to as many blocks as the machines need, not to one for each so many rows."""
    v = _unit_rows(np.random.default_rng(16), 150, 6, np.ones(6))
    rows = spark.createDataFrame([(0, i, [float(x) for x in row], 1.0) for i, row in enumerate(v)], "g long, c long, total array<double>, size double")
    sent, cells = [], distinct._in_cells
    monkeypatch.setattr(distinct, "_in_cells", lambda dealt, *x: sent.append(dealt.count()) or cells(dealt, *x))
    near = {x["c"]: x["other"] for x in distinct._nearest(rows, 5).collect()}
    far = np.round(1 - v @ v.T, 12) + 9 * np.eye(150)
    assert near == dict(enumerate(far.argmin(axis=1).tolist())) and sent == [150 * distinct.BLOCKS]


def test_chains_take_few_rounds(spark, monkeypatch):
    """Of a chain with growing steps one pair merges in a round of mutual neighbours; it is linked as a whole."""
    angle = np.cumsum(0.02 * 1.05 ** np.arange(24))
    v = np.zeros((96, 8))
    for k in range(4):
        v[24 * k : 24 * k + 24, 2 * k], v[24 * k : 24 * k + 24, 2 * k + 1] = np.cos(angle), np.sin(angle)
    rounds, nearest = [], distinct._nearest
    monkeypatch.setattr(distinct, "_nearest", lambda *x: rounds.append(1) or nearest(*x))
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id int, v array<double>")
    groups = {x["id"]: x["cluster"] for x in distinct.semantic_groups(df, "id", "v", 1.1, linked=30).collect()}
    assert groups == dict(enumerate(_naive_linkage(v, 1.1).tolist())) and len(rounds) <= 6


@pytest.mark.parametrize("linked", [12, 40])
def test_rounds_of_trees_like_naive(spark, linked):
    r = np.random.default_rng(17)
    v = _unit_rows(r, 120, 6)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id int, v array<double>")
    groups = {x["id"]: x["cluster"] for x in distinct.semantic_groups(df, "id", "v", 0.5, linked=linked).collect()}
    assert groups == dict(enumerate(_naive_linkage(v, 0.5).tolist()))


def test_linkage_up_to_what_is_nearer_elsewhere():
    """Groups linked apart as far as they may be, then all: the same clusters; the caller's sizes stay as they are."""
    r = np.random.default_rng(18)
    for _ in range(30):
        v, g, most = _unit_rows(r, 40, 5, np.full(5, 0.3)), r.integers(0, 3, 40), 0.3
        label, ones, names = np.arange(40), np.ones(40), []
        beyond = np.where(g[:, None] == g, np.inf, 1 - v @ v.T).min(axis=1)
        for k in range(3):
            at = np.flatnonzero(g == k)
            sizes = ones[: len(at)]
            own, left = distinct._linkage(v[at], most, sizes, beyond[at])
            label[at] = at[own]
            names += at[left].tolist()
        names = np.sort(names).astype(int)
        again = distinct.average_linkage(np.array([v[label == x].sum(axis=0) for x in names]).reshape(len(names), 5), most, np.array([(label == x).sum() for x in names]))
        up = dict(zip(names.tolist(), names[again].tolist(), strict=True))
        assert [up.get(x, x) for x in label.tolist()] == distinct.average_linkage(v, most).tolist() and (ones == 1).all()


def test_nearest_by_half_the_width(monkeypatch):
    monkeypatch.setattr(distinct, "_STEP", 16)
    monkeypatch.setattr(distinct, "_TILE", 32)
    r = np.random.default_rng(19)
    m, n = _unit_rows(r, 70, 9), _unit_rows(r, 150, 9)
    n[100:] = n[40]  # copies: the first of them
    for own, apart in ((False, None), (True, None), (True, (np.arange(150) // 7 * 7, np.arange(150) // 7 * 7 + 7))):
        one = n if own else m
        far = np.round(1 - one @ n.T, 12)
        if own:
            begin, end = apart or (np.arange(150), np.arange(150) + 1)
            far[(np.arange(150) >= begin[:, None]) & (np.arange(150) < end[:, None])] = np.inf
        for (place, least), want in zip(distinct._closest(one, n, own, apart), (far, far.T), strict=False):
            assert np.allclose(least, want.min(axis=1), atol=1e-11) and np.allclose(want[np.arange(len(want)), place], least, atol=1e-11)


def test_runs_of_near_rows_meet_by_their_first(spark):
    """Rows near their neighbours are not all multiplied with all others, and no pair is missed."""
    r = np.random.default_rng(20)
    base = _unit_rows(r, 400, 64)
    v = np.repeat(base, 4, axis=0) + np.where(np.arange(1600)[:, None] % 4, r.normal(scale=0.015, size=(1600, 64)), 0)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(v @ v.T >= 0.93, 1)), strict=True)}
    places = [np.stack(x) for x in distinct._met(v, v, 0.93, True)]
    met = set(map(tuple, np.sort(np.concatenate(places, axis=1), axis=0).T.tolist()))
    assert want <= met and len(met) == sum(p.shape[1] for p in places) < 10_000  # of 1,279,200 pairs
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "id int, v array<double>")
    assert {(x["a"], x["b"]) for x in distinct.similar_pairs(df, "id", "v", 0.93).collect()} == want
    assert len(distinct._runs(v, 0.93)[0]) < 500 and len(distinct._runs(v, 0.35)[0]) == 1600


def test_unit_vectors(spark):
    df = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.0, 0.0]), (2, None), (3, [])], "id int, v array<float>")
    got = {x["id"]: x["u"] for x in df.select("id", distinct.unit(df.v).alias("u")).collect()}
    assert got == {0: [0.6, 0.8], 1: [0.0, 0.0], 2: None, 3: []}


def test_band_plan():
    bands, bits = distinct.band_plan(0.9, 10**9)
    assert bits == 24 and bands < 100  # rows are sent to their buckets, not to all blocks
    assert distinct.band_plan(0.9, 10)[1] == 6 and distinct.band_plan(0.99, 10**9)[0] < distinct.band_plan(0.9, 10**9)[0]


def test_average_linkage_by_hand():
    a = np.radians([0, 10, 60])
    v = np.stack([np.cos(a), np.sin(a)], axis=1)
    assert distinct.average_linkage(v, 0.1).tolist() == [0, 0, 2]
    assert distinct.average_linkage(v, 1.0).tolist() == [0, 0, 0]


def test_sections_of_all_of_unicode(spark, tmp_path):
    texts = ["a. b .c", "一。.\u3000二三 .四", "Привет. мир — “да” . x", "🙂.🙂.", "no stop", "é. ł."]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["section"] for r in catalogue.queries()["sections"](spark, str(tmp_path)).collect()}
    assert got == {i: t.split(".")[1].strip() for i, t in enumerate(texts) if t.count(".") > 1}


def test_containment_within_and_over_lines(spark, tmp_path):
    texts = ["x The Cat, sat y", "the\ncat sat", "the cat", None, "The cat sat"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "the cat sat!"), (2, "dog"), (3, "!")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {tuple(r) for r in catalogue.queries()["train_overlap"](spark, str(tmp_path)).collect()} == {(1, 3), (2, 0), (3, 0)}


def test_cap_over_whole_texts(spark, tmp_path):
    texts = ["one line", "\n".join(f"line {k} " + "x" * 70 for k in range(90)), "y" * 5000, ""]
    spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["kept"] for r in catalogue.queries()["obs_cap"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        p = [["en"], ["s"], *[[x] for x in t.split("\n")]]
        assert got[i] == max(n for n in range(len(p) + 1) if len(str(p[:n])) <= 4000)


def test_mixing(spark):
    df = spark.createDataFrame([(i, [f"m{i}"], i % 2) for i in range(6)], "id int, messages array<string>, kind int")
    out = mix.mixed(df, df, 8, 1, 2).collect()
    assert len(out) == 8 and all(2 <= len(r["messages"]) <= 3 and r["messages"][-1] == f"m{r['id']}" for r in out)
    kinds = mix.mixed_by_kind(df, "kind", 2, 3).collect()
    assert len(kinds) == 6 and all(int(m[1:]) % 2 == r["kind"] for r in kinds for m in r["messages"])


FAST = model_map.Limits(per_second=0, pause=0.0, partitions=2, tries=2)


def test_model_map(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "bad"), (4, "x < y")], "row_id int, prompt string")
    flaky = lambda: model_map.EchoJudge(fail_first=1, broken="bad")
    got = {r["row_id"]: r["response"] for r in model_map.ask_rounds(df, flaky, limits=FAST).collect()}
    assert got[1] == got[2] and got[3] == "<|wrong data|>" and "准确性" in got[4]
    good, bad = curate.split_failed(model_map.ask_rounds(df, flaky, limits=FAST), "response")
    assert (good.count(), bad.count()) == (3, 1)
    assert model_map.resume(df, df.limit(1).select("row_id")).count() == 3


def test_evaluation_and_filter(spark):
    df = spark.createDataFrame([(i, f"p{i}", f"c{i}") for i in range(8)], "row_id int, p string, c string")
    out = plans.evaluated(df, {"m1": model_map.EchoJudge, "m2": model_map.EchoJudge}, "p", limits=FAST)
    rows = out.collect()
    assert len(rows) == 8 and all(r["scores"][0] == r["scores"][1] and r["route"] in ("keep", "discard") for r in rows)
    kept = plans.filtered(df, {"m": model_map.EchoJudge}, {"m": model_map.EchoJudge}, "p", "c", FAST)
    assert kept.count() <= 8


def test_retrieval_keeps_its_place(spark):
    class Two:
        def search(self, tool, query, tags):
            if query == "none":
                raise TimeoutError
            return [{"title": "t", "content": query}, {"title": "only title", "content": ""}]

    df = spark.createDataFrame([(1, 0, "s", "none", []), (1, 1, "s", "q", ["x"])], "row_id int, call int, tool string, query string, tags array<string>")
    found = retrieve.retrieve(df, Two)
    assert retrieve.gather(found, 5, "rank").first()["observation"] == [[], ["1 q", "2 only title"]]
    table = spark.createDataFrame([("s", "q", [("1", "t", "c")])], "tool string, query string, docs array<struct<id:string,title:string,content:string>>")
    assert [len(r["docs"]) for r in retrieve.from_table(df, table).orderBy("call").collect()] == [0, 1]


def test_containment_of_many_and_long_items(spark):
    r = np.random.default_rng(1)
    word = lambda: f"w{r.integers(0, 12)}"
    docs = [" ".join(word() for _ in range(r.integers(0, 60))) for _ in range(80)] + ["w1 " * 30_000 + "w2 w3"]
    items = [" ".join(word() for _ in range(r.integers(1, 8))) for _ in range(60)] + ["W1, w1 w2-w3"]
    a = spark.createDataFrame(list(enumerate(items)), "i long, text string")
    b = spark.createDataFrame(list(enumerate(docs)), "d long, text string")
    want = {(i, d) for i, x in enumerate(items) for d, t in enumerate(docs) if f" {x.lower().replace(',', '').replace('-', ' ')} " in f" {t.strip()} "}
    for sent in (0, 1000):
        assert {tuple(x) for x in align.containing(a, b, "i", "d", sent=sent).collect()} == want
    assert align.containing(a.limit(0), b, "i", "d").collect() == []


def test_corpus_paths(spark, tmp_path):
    """Folders below that bear the root's name again, files to pass over, and a root with an odd name."""
    root = tmp_path / "checkpoints" / "corpus"
    for name in ("own_a/corpus/f/x.jsonl", "own_b/y.jsonl", "own_b/skipped.jsonl", "own_c/.ipynb_checkpoints/z.jsonl"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text('{"a": 1}\n')
    got = {(r["owner"], r["folder"], r["dataset"], r["producer"]) for r in readers.read_corpus(spark, str(root), "a int", without=("skipped.jsonl",)).collect()}
    assert got == {("own_a", "corpus", "x", "own"), ("own_b", "y.jsonl", "y", "own")}


def test_nested_replacement(spark):
    df = spark.createDataFrame([((["a|b"], {"k|": "c|d"}, 3),), (None,)], "v struct<x:array<string>,y:map<string,string>,n:int>")
    got = [r["v"] for r in df.select(codec.replace_nested(F.col("v"), df.schema["v"].dataType, "|", "-").alias("v")).collect()]
    assert got[1] is None and (got[0]["x"], got[0]["y"], got[0]["n"]) == (["a-b"], {"k|": "c-d"}, 3)


def test_files(spark, tmp_path):
    (tmp_path / "c" / "own_er" / "fold").mkdir(parents=True)
    (tmp_path / "c" / "own_er" / "fold" / "set.jsonl").write_text('{"messages": [{"role": "user", "content": ["hi"]}]}\nbroken\n')
    (tmp_path / "c" / "own_er" / "fold" / ".x.swp").write_text("x")
    r = readers.read_corpus(spark, str(tmp_path / "c"), "messages array<struct<role:string,content:array<string>>>").first()
    assert (r["owner"], r["folder"], r["dataset"], r["producer"]) == ("own_er", "fold", "set", "own")
    assert [x[0] for x in readers.user_texts(spark, str(tmp_path / "c" / "own_er" / "fold")).collect()] == ["hi"]
    with pytest.raises(ValueError, match="reader"):
        readers.read_table(spark, "x.abc")
    (tmp_path / "a.csv").write_text('﻿Unnamed: 0,t,u\n0,"a\nb",\n')
    df = readers.read_csv(spark, str(tmp_path / "a.csv"), blanks=True)
    assert df.columns == ["t", "u"] and tuple(df.first()) == ("a\nb", "")
    (tmp_path / "p.txt").write_text("one\ntwo")
    assert readers.read_prompt(spark, str(tmp_path / "p.txt")) == "one\ntwo"


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("s", F.lit("二"))
    writers.write_arrays(df, str(tmp_path / "arrays"), 3, ["id"])
    files = sorted(os.listdir(tmp_path / "arrays"))
    got = [x["id"] for f in files for x in json.loads((tmp_path / "arrays" / f).read_text())]
    assert files == ["part0.json", "part1.json", "part2.json"] and got == list(range(10))
    writers.write_small(df, str(tmp_path / "small"), 4)
    assert all(sum(1 for _ in open(tmp_path / "small" / f)) <= 5 for f in os.listdir(tmp_path / "small") if f.endswith(".csv"))
    stats = df.withColumn("date", F.lit("2024-01-01"))
    for _ in range(2):
        writers.write_stats(stats, str(tmp_path / "stats"))
    assert spark.read.parquet(str(tmp_path / "stats")).count() == 10
    assert len(json.loads(writers.train_wrapper(df).first()["value"])["train"]) == 10


def test_stream_resumes(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "date string, x long"
    for day in ("2024-01-01", "2024-01-02"):
        spark.range(3).select(F.lit(day).alias("date"), F.col("id").alias("x")).write.mode("append").parquet(source)
        jobs.new_days(spark, source, schema, str(tmp_path / "ck"), lambda batch, _: jobs.write_day(batch, out))
    assert spark.read.parquet(out).count() == 6
    done = spark.createDataFrame([("2024-01-01",)], "date string")
    assert [r[0] for r in jobs.due(spark.read.parquet(out).withColumn("date", F.col("date").cast("string")), done, "2024-01-05", "raw").collect()] == ["2024-01-02"]


def test_a_period_is_done_once(spark, tmp_path):
    ran = []
    go = lambda job, work=lambda: ran.append(1), **more: jobs.run_once(spark, f"file://{tmp_path}", job, "2024-05-06", work, **more)
    assert go("filter", needs=("raw",)) == "waits" and not ran
    assert go("raw", lambda: ran.append(go("raw"))) == "done" and ran == ["running"]
    assert go("raw") == "earlier" and go("filter", needs=("raw",)) == "done" and ran == ["running", 1]

    def fails():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        go("report", fails)
    assert go("report") == "done"


def test_regeneration(spark):
    wanted, state = spark.createDataFrame([(1,), (2,)], "k int"), {"rows": None}

    def write(df):
        new = {(r["k"], r["ok"]) for r in df.collect()}
        old = {x for x in state["rows"] or set() if x[0] not in {k for k, _ in new}}
        state["rows"] = old | new

    read = lambda: spark.createDataFrame(sorted(state["rows"]), "k int, ok boolean") if state["rows"] else None
    tries = iter((False, True, True))
    make = lambda left: left.withColumn("ok", F.lit(next(tries)))
    assert jobs.regenerate(wanted, make, read, write, "k", ~F.col("ok")) == 2


def test_weekly_tables(spark):
    kept = spark.createDataFrame([("q", "a", "d")], "`user-query` string, assistant string, distilled string")
    pairs, sheet, train = plans.weekly(kept, "2024-01-01", ["`user-query`"])
    assert {"modelA", "modelB"} <= set(pairs.columns) and "is_correct" in sheet.columns and train.first()["id"] == "log-2024-01-01-0"
    assert [str(d) for d in spark.sql("select date'2024-01-03' d").select(jobs.week_of(F.col("d")).alias("w")).first()["w"]][::6] == ["2024-01-01", "2024-01-07"]

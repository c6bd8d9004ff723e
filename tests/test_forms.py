"""Literals, paths, draws, sinks, and joins of like strings and sets, by brute force where there is one."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from parlance.functions import codec, literals, logparse, text
from parlance.operators import align, curate, mix
from parlance.sources import readers, writers


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}").select("i", f(F.col("x")).alias("y"))
    return [r["y"] for r in rows.orderBy("i").collect()]


HARD = "it's \"so\" \\ None\n\tTrue — 世界🙂\r"


def test_literal_json(spark):
    values = [{"a": [1, None, True], "b": ("x", 'y"z')}, [HARD, [HARD]], "Nonetheless", 3.5, None, [[], {}], {1: "k"}]
    got = column(spark, [repr(v) for v in values], literals.literal_json)
    assert [json.loads(x) for x in got] == [json.loads(json.dumps(v)) for v in values]
    bad = ["Nonetheless True North", "[1, 2", "__import__('os').system('x')", "", "a.b", None]
    assert column(spark, bad, literals.literal_json) == [None] * len(bad)
    deep = "[" * 200_000 + "'a'" + "]" * 200_000
    assert column(spark, [deep], literals.literal_json) == [None]
    assert column(spark, ["{'x': {2, 1}}", '{"j": [null, true]}'], literals.literal_json) == ['{"x": [1, 2]}', '{"j": [null, true]}']


def test_long_literals(spark):
    long = ("word's \\ " + "x" * 50) * 20_000
    (got,) = column(spark, [repr([[long], long])], codec.objects_of)
    assert [o["content"] for o in got] == [long, long]


def test_objects(spark):
    kinds = {
        "[{'title': None, 'content': 'Nonetheless True North'}]": [("1", None, "Nonetheless True North")],
        """[['a "b"', "it's"], ['c\\n']]""": [("1", None, 'a "b"'), ("2", None, "it's"), ("3", None, "c\n")],
        '[{"title": "t", "chunk": "None"}, "s"]': [("1", "t", "None"), ("2", None, "s")],
        "['kept', 'broken": [("1", None, "kept")],
        "['one' 'two', <x>, \"thr\\\"ee\"]": [("1", None, "one"), ("2", None, "two"), ("3", None, 'thr"ee')],
        "it's plain 'text' here": [("1", None, "it's plain 'text' here")],
        "{'content': 'alone'}": [("1", None, "alone")],
        "[]": [],
        "42": [("1", None, "42")],
    }
    for raw, want in kinds.items():
        assert [tuple(o) for o in column(spark, [raw], codec.objects_of)[0]] == want
    assert column(spark, [None], codec.objects_of) == [None]


def test_titled_objects(spark):
    made = lambda mode: lambda c: codec.titled_objects(codec.objects_of(c), "7", mode)
    (back,) = column(spark, ["['one two three', 'single', 'a b']"], made("reverse"))
    assert [(o["id"], o["title"], o["body"]) for o in back] == [("3", "a", "b"), ("2", "", "single"), ("1", "one", "twothree")]
    assert all(o["name"] in ("content", "chunk") for o in back)
    (same,) = column(spark, ["['one two three', 'single', 'a b']"], made("none"))
    assert same == back[::-1]
    (mixed,) = column(spark, ["['one two three', 'single', 'a b']"], made("random"))
    assert sorted(mixed) == sorted(back) and mixed == column(spark, ["['one two three', 'single', 'a b']"], made("random"))[0]


def test_raw_columns(spark):
    rows = [("[{'thought': \"it's\"}]", "[{'APINAME': 'S', 'QUERY': 'a=>b'}, {'k': 'v'}]", "[{'r': 'x', 'z': 1}, {'s': ['y']}]"), ("oops(", "[{'k': None}]", "[1]"), (None, None, None), ("[{}]", "[]", "[{}]")]
    got = [r["y"] for r in spark.createDataFrame(rows, "t string, a string, o string").select(logparse.raw_columns(F.col("t"), F.col("a"), F.col("o")).alias("y")).collect()]
    assert tuple(got[0]) == ("it's", codec_text([("APINAME", "S"), ("QUERY", "a=>b")]) + codec_text([("k", "v")]), ["x", '["y"]'])
    assert got[1]["thought"] is None and got[1]["api"] is None and tuple(got[2]) == (None, None, None)
    assert got[3]["thought"] is None and got[3]["api"] == "" and got[3]["observation"] == [None]


def codec_text(pairs):
    return "<|api_start|>" + "".join(f"<|kvs|>{k}=>{v}<|kve|>" for k, v in pairs) + "<|api_end|>"


def test_nested_list(spark):
    assert column(spark, ["[[1], []]", "[]", "[1]", "{'a': 1}", "x", None, "[['a'], 'b']", "([1], [2])"], literals.nested_list) == [True, True, False, False, False, False, False, True]


def test_split_query_prompt(spark):
    assert [tuple(x) for x in column(spark, ["q\np\nr", "q", "q\n", "\np"], text.split_query_prompt)] == [("q", "p\nr"), ("q", None), ("q", None), ("", "p")]


def test_city_slots(spark):
    call = "<|api_start|><|kvs|>category=>城市景点推荐<|kve|><|kvs|>city=>A<|kve|><|kvs|>CITY=>B<|kve|><|kvs|>own=>C<|kve|><|kvs|>query=>q<|kve|><|api_end|>"
    got, none = column(spark, [call, call.replace("城市景点推荐", "x")], lambda c: codec.city_slots(codec.parse_call(c)))
    assert none is None and [e["k"] for e in got] == [*codec.CITY_SLOTS, "OWN"]
    assert {e["k"]: e["items"] for e in got if e["items"]} == {"CITY": ["B"], "OWN": ["C"]}


def test_search_table_says_true(spark):
    df = spark.createDataFrame([("q", "a", "t", None, ["d"])], "`user-query` string, assistant string, thought string, api array<array<struct<k:string,v:string>>>, observation array<string>")
    row = curate.for_search(df).first()
    assert row["is_relative"] == "True" and row["doc"] == "d" and row["api_name"] == ""


@pytest.mark.parametrize("name", ["plain", "with space", "100%25 a+b%", "世界 #1"])
def test_corpus_paths_as_they_are(spark, tmp_path, name):
    at = tmp_path / name / "team_x y" / "fol%20der" / name
    at.mkdir(parents=True)
    (at / "set a+b%.jsonl").write_text('{"x": 1}\n')
    got = readers.read_corpus(spark, str(tmp_path / name).replace("%", "%") if "#" not in name else str(tmp_path / name), "x int").collect()
    assert [tuple(r) for r in got] == [(1, "team_x y", "fol%20der", "set a+b%", "team")]


def test_draws_reach_the_end(spark):
    """Past 2^28 and 2^31."""
    n = 5 * 10**10
    got = spark.range(4000).select(mix._draw(0, n - 1, F.col("id")).alias("x"), mix._draw(1, 3, F.col("id")).alias("k")).collect()
    assert max(r["x"] for r in got) > 0.99 * n and min(r["x"] for r in got) < 0.01 * n and {r["k"] for r in got} == {1, 2, 3}


def test_arrays_leave_nothing_behind(spark, tmp_path):
    path = f"file://{tmp_path}/out dir"
    df = spark.range(25).withColumn("s", F.when(F.col("id") % 2 == 0, F.lit("“二”\n\"x\"")))
    writers.write_arrays(df.limit(7), path, 2, ["id"], "old")
    before = {f: (tmp_path / "out dir" / f).read_text() for f in os.listdir(tmp_path / "out dir") if not f.startswith(".")}

    @F.udf("string")
    def fails(x):
        if x > 20:
            raise ValueError("half way")
        return "ok"

    with pytest.raises(Exception, match="half way"):
        writers.write_arrays(df.withColumn("t", fails("id")), path, 4, ["id"], "old")
    assert {f: (tmp_path / "out dir" / f).read_text() for f in os.listdir(tmp_path / "out dir") if not f.startswith(".")} == before
    writers.write_arrays(df, path, 4, ["id"])
    files = [json.loads((tmp_path / "out dir" / f"part{k}.json").read_text()) for k in range(4)]
    assert [len(x) for x in files] == [7, 7, 7, 4] and [r["id"] for x in files for r in x] == list(range(25))
    assert files[0][0]["s"] == "“二”\n\"x\"" and files[0][1]["s"] is None
    assert readers.read_table(spark, f"{path}/part*.json", "id long, s string").count() == 25
    writers.write_arrays(df.limit(0), path, 4, ["id"], "none")
    assert not [f for f in os.listdir(tmp_path / "out dir") if f.startswith(("none", "_"))]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("least", [40, 60, 80, 95])
def test_fuzzy_is_a_full_comparison(spark, least):
    r = random.Random(least)
    names = ["".join(r.choice("abc世") for _ in range(r.randrange(1, 13))) for _ in range(90)]
    names += ["x" + n[1:] for n in names[:30]] + [n[:3] + "q" + n[3:] for n in names[:30]] + ["anna", "hanna", "Anna", ""]
    a, b = names[::2] + names[:3], names[1::2]
    want = []
    for x in a:
        for y in b:
            if x and y:
                ratio = int(100 * (1 - edits(x, y) / max(len(x), len(y))) + 0.5)
                want += [(x, y, float(ratio))] if ratio >= least else []
    left, right = (spark.createDataFrame([(n, k) for k, n in enumerate(v)], f"k string, {c} int") for v, c in ((a, "i"), (b, "j")))
    got = [(r_["k"], r_["k_2"], r_["ratio"]) for r_ in align.fuzzy(left, right, "k", least, None).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("percent", [30, 60, 80, 100])
def test_near_sets(spark, percent):
    r = random.Random(percent)
    word = lambda: f"w{int(r.paretovariate(0.7)) % 60}"
    sets = [sorted({word() for _ in range(r.randrange(0, 14))}) for _ in range(160)]
    sets += [sorted(set(s[1:]) | {"new"}) for s in sets[:40]] + sets[:5]
    a, b = sets[::2], sets[1::2]
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x and y and 100 * len({*x} & {*y}) >= percent * len({*x} | {*y})}
    left, right = (spark.createDataFrame(list(enumerate(v)), "id int, w array<string>") for v in (a, b))
    got = [tuple(p) for p in align.near_sets(left, right, percent).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    assert align.near_sets(left, right.limit(0), percent).count() == 0


def test_unlike_training_by_words(spark):
    df = spark.createDataFrame([(1, "The cat, sat on a mat"), (2, "the CAT sat on one mat!"), (3, "dogs run"), (4, None), (5, "dogs run"), (6, "…")], "id int, q string")
    training = spark.createDataFrame([("a mat: the cat sat on",), (None,), ("",)], "q string")
    assert sorted(r["id"] for r in align.unlike_training(df, training, "q", 80).collect()) == [2, 3, 4, 5, 6]
    assert sorted(r["id"] for r in align.unlike_training(df, training, "q", 70).collect()) == [3, 4, 5, 6]
    assert align.unlike_training(df, training, "q").columns == df.columns == align.unlike_training(df, training, "q", 80).columns


def _beside_sql(spark, tmp_path, name, **tables):
    """A query's rows, and those of its SQL, over small tables."""
    duckdb = pytest.importorskip("duckdb")
    from parlance.plans import catalogue

    con = duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    return sorted(map(tuple, catalogue.queries()[name](spark, str(tmp_path)).collect())), sorted(con.sql(catalogue.oracle_sql()[name]).fetchall())


def test_unlike_training_takes_out_what_its_sql_takes_out(spark, tmp_path):
    texts = ["ab", "a b", "a=b", "a$b", "a、b", "a\u3000b", "a\x0bb", None, "", "ΟΔΟΣ", "οδος", "οδοσ", "İx", "ix"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, want = _beside_sql(spark, tmp_path, "unlike_training", documents=docs, benchmark=spark.createDataFrame([(1, "A.B"), (2, "ΟΔΟΣ!"), (3, "IX")], "item_id long, text string"))
    assert got == want and [x for x, in got] == [4, 5, 6, 8, 10]


def test_unlike_by_words_parts_words_as_its_sql_does(spark, tmp_path):
    rows = [(1, "src1", "a=b c d"), (2, "src1", "a b c、d"), (3, "src1", None), (4, "src0", "a b c d"), (5, "src1", "x y z")]
    got, want = _beside_sql(spark, tmp_path, "unlike_by_words", documents=spark.createDataFrame(rows, "doc_id long, source string, text string"))
    assert got == want == [(2,), (3,), (5,)]


@pytest.mark.parametrize("percent", [35, 60, 85])
def test_near_sets_form_few_pairs_of_texts_alike_in_frequent_words_only(spark, percent, monkeypatch):
    """Sets that share a frequent word of their beginnings, but too few words in all, are no candidates; a set with any near one is found."""
    r = random.Random(percent)
    word = lambda: f"w{int(r.paretovariate(0.5)) % 400}"
    sets = [sorted({word() for _ in range(40)}) for _ in range(300)]
    sets += [[*s[2:], "new"] for s in sets[:30]] + [s[:-1] for s in sets[:30]]
    r.shuffle(sets)
    a, b = sets[::2], sets[1::2]
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if 100 * len({*x} & {*y}) >= percent * len({*x} | {*y})}
    left, right = (spark.createDataFrame(list(enumerate(v)), "id int, w array<string>") for v in (a, b))
    formed, whole = [], align._may_be_near
    monkeypatch.setattr(align, "_may_be_near", lambda *x, **y: formed.append(whole(*x, **y).count()) or whole(*x, **y))
    monkeypatch.setattr(align, "SET_BLOCKS", (16, 64))  # many cells
    assert {tuple(p) for p in align.near_sets(left, right, percent).collect()} == want and want
    assert percent < 60 or formed[0] < 2 * len(want) + 200
    some = {tuple(p) for p in align.near_sets(left, right, percent, first=True).collect()}
    assert some <= want and {x for x, _ in some} == {x for x, _ in want}


def test_company_is_found_at_the_end_of_the_last_line(spark):
    from parlance.operators import quality

    values = ["很高兴的陪伴", "x\n有你陪伴真好", "陪伴很久很久很久很久很久", "陪伴\nno", "a 陪伴12345678", "a 陪伴123456789", "陪伴\n"]
    slow = column(spark, values, lambda c: quality.reason(c, (r".*(陪伴).{0,8}$",)))
    assert column(spark, values, lambda c: quality.reason(c, (rf"{quality.LINE}.*(陪伴).{{0,8}}$",))) == slow
    assert slow == ["很高兴的陪伴", "有你陪伴真好", None, None, "a 陪伴12345678", None, "陪伴"]


def test_gates_are_linear_in_a_line(spark):
    import time

    from parlance.operators import quality

    began = time.time()
    assert column(spark, ["n" * 300_000], lambda c: quality.reason(c, quality.Gate().banned)) == [None]
    assert time.time() - began < 60


def _plainly(patterns):
    """The same patterns, all tried at every place."""
    from parlance.operators import quality

    return "(?iu)(" + "|".join(p.replace(quality.LINE, r"(?<![^\n\r\u0085\u2028\u2029])") for p in patterns) + ")"


def test_gates_find_what_all_patterns_at_every_place_find(spark):
    from parlance.operators import quality

    odd = ("a?b", "(x|y*)z", "[ab]c|cb", "[^a]q", r"\bkin", "^so", "k|kin", "(?:Σ|ß)s", "i{0}n", "ſt", "\u0130x", "é+", "(a|)d", "{0}", "(e)(f)", "b[c[de]|]f", "🙂+n", r"\|a", "-z", "f(?=a)")
    sets = (quality.Gate().banned, quality.ASKED, odd[:8], odd[8:13] + odd[14:], odd[::-1][:5], (r"(a)(b)\2", "b"), ("a(?s).b", "B"), ("n",))
    r = random.Random(5)
    words = [w for p in quality.WORDS + quality.ASKED for w in (p, p[:-1], p.upper())] + ["我只是一个", "作为一名", "模型", "没有任何", "感情", "截止到", "2023年", "为止", "陪伴", "不能在", "联网", "对不起", "as an AI model"]
    marks = list("\n\r \u0085\u2028nN.-|1") + ["\r\n"]
    texts = ["".join(r.choice(words if r.random() < 0.25 else marks) for _ in range(r.randrange(1, 25))) for _ in range(1500)]
    texts += ["".join(r.choice("abcdefiknoqstxyzBSIKNÉéſıİ\u212aΣσςßẞ🙂|- \n") for _ in range(r.randrange(0, 9))) for _ in range(3000)]
    for patterns in sets:
        want = column(spark, texts, lambda c, p=patterns: F.nullif(F.regexp_extract(c, _plainly(p), 0), F.lit("")))
        assert column(spark, texts, lambda c, p=patterns: quality.reason(c, p)) == want
        assert any(want)


def test_gates_try_few_patterns_at_a_place(spark):
    import time

    from parlance.operators import quality

    values = ["nnn nn, nnnnnn n. nnnn\n" * 40_000]

    def seconds(f):
        began = time.time()
        assert column(spark, values, f) == [None]
        return time.time() - began

    banned = quality.Gate().banned
    ways = (lambda c: quality.reason(c, banned), lambda c: F.nullif(F.regexp_extract(c, _plainly(banned), 0), F.lit("")))
    few, all_ = (min(seconds(f) for _ in range(2)) for f in ways)
    assert 3 * few < all_


def test_clusters_through_bands(spark):
    import numpy as np

    from parlance.operators import distinct

    r = np.random.default_rng(21)
    base = r.normal(size=(60, 16))
    v = np.concatenate([base, base + r.normal(scale=0.05, size=base.shape), base[:9] + r.normal(scale=0.05, size=(9, 16))])
    df = spark.createDataFrame([(f"k{i:03d}", [float(x) for x in row]) for i, row in enumerate(v)], "id string, v array<double>")
    exact, banded = (sorted(map(tuple, distinct.semantic_groups(df, "id", "v", 0.05, banded=b).collect())) for b in (False, True))
    assert exact == banded and sum(x[2] for x in exact) == 60
    pairs = {(p["a"], p["b"]) for p in distinct.similar_pairs(df, "id", "v", 0.95).collect()}
    assert pairs == {(p["a"], p["b"]) for p in distinct.similar_pairs(df, "id", "v", 0.95, banded=True).collect()} and all(a < b for a, b in pairs)


def test_arrays_are_read_line_by_line(spark, tmp_path):
    """Files are read in pieces: one task need not parse a whole file."""
    path = f"file://{tmp_path}/arrays"
    df = spark.range(2000).withColumn("s", F.when(F.col("id") % 3 > 0, F.concat(F.lit(" [,\n]\" , "), F.repeat(F.lit("x,"), 50))))
    writers.write_arrays(df, path, 2, ["id"])
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        got = readers.read_arrays(spark, f"{path}/*.json", "id long, s string")
        assert got.rdd.getNumPartitions() > 4 and sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_an_encoder_gets_texts_by_their_bytes(spark):
    from parlance.operators import model_map

    df = spark.createDataFrame([(k, "x" * n) for k, n in enumerate([0, 5, 900_000, 900_000, 2_500_000, 1])] + [(6, None)], "id long, t string").coalesce(1)
    sizes = {r["id"]: r["vector"] for r in model_map.embed(df, lambda: lambda texts: [[float(sum(map(len, texts)))] for _ in texts], "t", "id").collect()}
    assert sizes == {0: [900_005.0], 1: [900_005.0], 2: [900_005.0], 3: [900_000.0], 4: [2_500_000.0], 5: [1.0]}

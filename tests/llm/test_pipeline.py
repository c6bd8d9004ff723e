"""The pipeline's stages, each against what it should keep of its own input."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parlance.llm import registry

from .test_operators import brute_exact, brute_near, changed, check_bins, words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(2)
    texts = [" ".join(words(r.randrange(60, 150), k, 4000)) + "." for k in range(60)]
    texts += [texts[0]] * 4 + [changed(texts[1], 1, k) for k in range(3)] + ["home | about | login | " * 40] * 3 + ["junk*** " * 80]
    rows = [(k, t, "en", f"s{k % 3}", len(t)) for k, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("sf"))
    # A row twice, rows without an id, and two texts that share one.
    loose = [" ".join(words(90, 500 + k, 4000)) + "." for k in range(4)]
    docs = spark.createDataFrame([*rows, rows[5], (None, loose[0], "en", "s0", 9), (None, loose[1], "en", "s0", 9), (None, loose[1], "en", "s0", 9), (7, loose[2], "en", "s1", 9), (7, loose[3], "en", "s1", 9)], COLUMNS)
    docs.coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int("|" not in t and "*" not in t), 0) for k, t in enumerate(texts)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(k, texts[k]) for k in range(0, 60, 7)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "exact dedup", "near dedup", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        out = stage(spark, docs, corpus)
        assert out.schema.names == docs.schema.names
        docs = spark.createDataFrame(out.collect(), COLUMNS)
        after = [r["doc_id"] for r in docs.collect()]
        if name == "quality rules":
            assert not [t for _, t in before if "|" in t] or not [r for r in docs.collect() if "|" in r["text"]]
            assert set(range(60)) <= set(after)
        if name == "exact dedup":
            assert sorted(map(str, after)) == sorted(str(x[0]) for x in brute_exact(before) if x[3])
            assert len(docs.collect()) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t) for _, t in before})
        if name == "near dedup":
            near = brute_near([(k, t) for k, (_, t) in enumerate(before)], 5, 80)
            assert sorted(map(str, after)) == sorted(str(before[k][0]) for k, (_, _, kept) in near.items() if kept)
            assert sorted(r["text"] for r in docs.collect()) == sorted(before[k][1] for k, (_, _, kept) in near.items() if kept)
    check_bins([r.asDict() for r in corpus_pipeline.packed(spark, docs, corpus).collect()], 2048)


def test_run(spark, corpus):
    got = corpus_pipeline.run(spark, corpus)
    ids = {r["doc_id"] for r in got.collect()}
    assert 0 in ids and not ids & {60, 61, 62, 63} and not ids & {64, 65, 66} and not ids & {67, 68, 69, 70}


def test_stages_take_odd_and_empty_tables(spark, odd, corpus):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, corpus).count() >= 0


def test_every_operator_is_registered():
    names = registry.queries()
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}


def test_each_text_finds_itself_first(spark, corpus):
    got = registry.queries()["op12_ranked_search"](spark, corpus)
    first = {r["item_id"]: r["doc_id"] for r in got.filter("rank = 1").collect()}
    assert first == {k: k for k in range(0, 60, 7)}
    assert got.groupBy("item_id").count().filter("count > 10").isEmpty()


#: The search gives a row an answer, all others a row a document.
@pytest.mark.parametrize("name", sorted(n for n in registry.queries() if n.startswith("op") and not n.startswith("op12_")))
def test_queries_run(spark, corpus, name):
    df = registry.queries()[name](spark, corpus)
    assert df.select(F.count_distinct("doc_id")).first()[0] == 71 and df.filter("doc_id is null").count() == 3

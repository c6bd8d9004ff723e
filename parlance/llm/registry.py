"""The corpus operators' queries, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from parlance.llm import bpe, bytecnn, impacts, licenses, lm, naming, nearness, packing, periods, rules, sharding, templates, toxicity
from parlance.llm.common import fold, read


def op1_sharding(spark, sf_dir):
    return sharding.shard(read(spark, sf_dir, "documents"))


def op2_licenses(spark, sf_dir):
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).drop("spans")


def op3_bpe(spark, sf_dir):
    return bpe.digests(read(spark, sf_dir, "documents"))


def op4_quality_rules(spark, sf_dir):
    return rules.quality_rules(read(spark, sf_dir, "documents"))


def op5_quality_classifier(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    net = bytecnn.fit(documents, read(spark, sf_dir, "labels"))
    return bytecnn.score(documents, net).select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")


def op6_exact_dedup(spark, sf_dir):
    return naming.exact_groups(read(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    return packing.best_fit(read(spark, sf_dir, "documents"))


def op8_lm_scoring(spark, sf_dir):
    return lm.score_corpus(read(spark, sf_dir, "documents"))


def op9_near_dedup(spark, sf_dir):
    return nearness.near_groups(read(spark, sf_dir, "documents"), k=3, percent=85)


def op10_line_dedup(spark, sf_dir):
    return templates.recurring_lines(read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark, sf_dir):
    return periods.digests(periods.periodic_runs(periods.planted(read(spark, sf_dir, "documents"))))


def op12_ranked_search(spark, sf_dir):
    return impacts.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_toxicity(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    model = toxicity.fit(documents, read(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")} | {"pipeline": corpus_pipeline.run}


_EXACT = """WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
  SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n"""

_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_RANKED = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents), h AS (SELECT *, len(w) AS n FROM d WHERE len(w) > 0), s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM h),
  q AS (SELECT i, item_id, unnest(w) AS t FROM (SELECT item_id, row_number() OVER () AS i, {_TERMS} AS w FROM benchmark)),
  p AS (SELECT r, doc_id, n, t, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS t FROM h) WHERE t IN (SELECT t FROM q) GROUP BY ALL), f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
  c AS (SELECT r, doc_id, t, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // l))) AS x FROM p JOIN f USING (t), s),
  z AS (SELECT i, item_id, r, doc_id, sum(x)::BIGINT AS score FROM q JOIN c USING (t) GROUP BY ALL HAVING sum(x) > 0)
  SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INT AS rank FROM z) WHERE rank <= 10"""


def oracle_sql() -> dict:
    """SQL of the queries that DuckDB can state over whole tables: of ``documents`` whose ids are theirs alone."""
    return {"op6_exact_dedup": _EXACT, "op12_ranked_search": _RANKED}

"""Queries that go through files, stores, jobs and clients, each over whole tables and in a folder of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.functions import judge, prompts, temporal, text
from parlance.operators import align, curate, model_map, order, quality
from parlance.operators.model_map import Answers, EchoJudge, Limits
from parlance.plans.catalogue import _PAIRS, _pairs, _t, query
from parlance.plans.more import _folder
from parlance.scratch import materialize
from parlance.sources import readers, writers
from parlance.streaming import jobs

_FAST = Limits(per_second=0, pause=0.0)

# --- readers and writers --------------------------------------------------------------------------


@query("""SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE text END, '') AS text, lang FROM documents""")
def csv_blanks(spark, sf):
    """Nulls and empty strings through a CSV file are both blanks, beside whole texts."""
    path, k = f"{_folder(spark)}/blank.csv", F.col("doc_id") % 3
    writers.write_csv(_t(spark, sf, "documents").select("doc_id", F.when(k == 1, "").when(k == 2, F.col("text")).alias("text"), "lang"), path)
    return readers.read_csv(spark, path, blanks=True).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")


@query("""WITH l AS (SELECT unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line FROM documents), b AS (SELECT md5(line) AS h FROM l) SELECT h AS line, count(*) AS n FROM b GROUP BY h""")
def text_lines(spark, sf):
    """All texts as files of lines, and every line back."""
    path = _folder(spark)
    _t(spark, sf, "documents").select(F.replace("text", F.lit("\r"), F.lit("")).alias("value")).write.text(path)
    return readers.read_lines(spark, path).groupBy(F.md5("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT source || ' set' AS owner, 'kept %20 ' || source AS folder, source AS producer, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY source""")
def corpus_places(spark, sf):
    """A corpus of JSONL files below folders whose names have spaces, signs and underscores."""
    path = f"{_folder(spark)}/the corpus"
    docs = materialize(_t(spark, sf, "documents").select("doc_id", "source", "n_chars"))
    for (source,) in docs.select("source").distinct().collect():  # a row a folder
        docs.filter(F.col("source") == source).select("doc_id", "n_chars").coalesce(1).write.json(f"{path}/{source}_x set/kept %20 {source}")
    got = readers.read_corpus(spark, path, "doc_id long, n_chars long", pattern="*.json")
    return got.groupBy(F.replace("owner", F.lit("_x"), F.lit("")).alias("owner"), "folder", "producer").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("""SELECT doc_id, lang AS a, NULL::VARCHAR AS b FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, NULL, source FROM documents WHERE doc_id % 2 = 1""")
def csv_by_name(spark, sf):
    """Files of one folder whose names have a part in common, with different columns; others are passed over."""
    path, d = _folder(spark), _t(spark, sf, "documents")
    writers.write_csv(d.filter("doc_id % 2 = 0").select("doc_id", F.col("lang").alias("a")), f"{path}/x_wanted_1")
    writers.write_csv(d.filter("doc_id % 2 = 1").select("doc_id", F.col("source").alias("b")), f"{path}/wanted_2")
    writers.write_csv(d.select("doc_id"), f"{path}/other")
    both = readers.union_named(readers.read_named(spark, path, "wanted_1"), readers.read_named(spark, path, "wanted_2"))
    return both.select(F.col("doc_id").cast("long").alias("doc_id"), "a", "b")


@query("""SELECT lang, ceil(count(*) / 500)::BIGINT AS files FROM documents GROUP BY lang""")
def small_files(spark, sf):
    """Files of at most 500 rows, counted by a listing of all folders below one."""
    path, d = _folder(spark), materialize(_t(spark, sf, "documents").select("doc_id", "lang"))
    for r in d.select("lang").distinct().collect():  # a row a language
        writers.write_small(d.filter(F.col("lang") == r["lang"]).coalesce(1), f"{path}/{r['lang']}", 500)
    files = readers.list_files(spark, path).filter("path like '%.csv'")
    return files.groupBy(F.element_at(F.split("path", "/"), -2).alias("lang")).agg(F.count(F.lit(1)).alias("files"))


@query("""SELECT doc_id, CASE WHEN length(text) < 50 THEN 'short reply' ELSE 'legal' END AS verdict, source AS producer, length(text) >= 50 AS legal FROM documents WHERE length(text) > 0""")
def producer_folders(spark, sf):
    """Judged conversations, both sides of the gates in a folder a producer, read with both out of the path."""
    path = _folder(spark)
    item = lambda c: F.array(F.struct(c.alias("text"), F.lit(None).cast("string").alias("token")))
    said = {"user": F.lit("q"), "thought": F.lit(""), "api": F.lit(""), "observation": F.lit(""), "assistant": F.col("text")}
    rows = _t(spark, sf, "documents").filter("length(text) > 0").select(
        "doc_id", F.array(*[F.struct(F.lit(r).alias("role"), item(c).alias("content")) for r, c in said.items()]).alias("messages"), F.col("source").alias("owner"), F.lit("d").alias("dataset"), "source", F.col("source").alias("producer")
    )
    owners = tuple(r[0] for r in rows.select("owner").distinct().collect())  # a row a source
    writers.write_by_producer(quality.judged(rows, quality.Gate(banned=(), persona_query=(), short_owners=owners)).select("doc_id", "verdict", "producer"), path)
    return spark.read.schema("doc_id long, verdict string, legal boolean, producer string").json(path)


@query("""SELECT lang AS date, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY lang""")
def statistics_once(spark, sf):
    """Statistics of each period written twice are there once."""
    path, rows = _folder(spark), _t(spark, sf, "documents").groupBy(F.col("lang").alias("date")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    writers.write_stats(rows.withColumn("n", F.col("n") * 0), path)
    writers.write_stats(rows, path)
    return spark.read.schema("n long, chars long, date string").parquet(path).select("date", "n", "chars")


@query("""SELECT doc_id, CASE WHEN quality = 1 THEN 'keep' ELSE 'discard' END AS route FROM labels""")
def routes_by_folder(spark, sf):
    path = _folder(spark)
    writers.write_routes(_t(spark, sf, "labels").select("doc_id", F.when(F.col("quality") == 1, "keep").otherwise("discard").alias("route")), path)
    return spark.read.schema("doc_id long, route string").csv(path, header=True)


@query("""SELECT lang, count(*) AS n, 'a "b"' AS said FROM documents GROUP BY lang""")
def tab_summary(spark, sf):
    path = _folder(spark)
    writers.write_summary(_t(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumn("said", F.lit('a "b"')), path)
    return spark.read.csv(path, header=True, sep="\t", escape='"', schema="lang string, n long, said string")


@query("""SELECT doc_id, quality, toxic FROM labels""")
def train_document(spark, sf):
    """All records in one document, and out of it again."""
    whole = writers.train_wrapper(_t(spark, sf, "labels").select("doc_id", "quality", "toxic"))
    return whole.select(F.explode(F.from_json("value", "train array<struct<doc_id:bigint,quality:int,toxic:int>>")["train"]).alias("r")).select("r.*")


@query("""SELECT item_id, text FROM benchmark""")
def sheet_roundtrip(spark, sf):
    """A table for people, written as a sheet or as CSV, and read by the tasks as strings."""
    path = f"{_folder(spark)}/sheet"
    writers.write_csv(_t(spark, sf, "benchmark").select("item_id", "text").coalesce(1), path)
    return readers.read_sheet(spark, f"{path}/*.csv").select(F.col("item_id").cast("long").alias("item_id"), "text")


# --- joins and order ------------------------------------------------------------------------------


@query(f"""WITH {_PAIRS} SELECT conv_id, turn, usr AS prompt, assistant AS response FROM pairs""")
def requests_joined(spark, sf):
    """Requests and responses that come apart, by id; equal prompts stay apart."""
    rows = _pairs(spark, sf).withColumn("row_id", F.concat_ws("-", "conv_id", "turn"))
    return align.with_responses(rows.select("conv_id", "turn", "row_id", F.col("user").alias("prompt")), rows.select("row_id", F.col("assistant").alias("response"))).select("conv_id", "turn", "prompt", "response")


@query("""WITH c AS (SELECT conv_id, list(role ORDER BY turn) AS roles, list(text ORDER BY turn) AS texts FROM conversations GROUP BY conv_id)
  SELECT conv_id, unnest(roles[1:len(roles) - 1]) AS name, unnest(texts[1:len(roles) - 1]) AS passage FROM c""")
def names_and_passages(spark, sf):
    """Names beside passages as far as both go: here there is a passage more than names."""
    turns = _t(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    names = F.slice(F.transform("t", lambda x: x["role"]), F.lit(1), F.size("t") - 1)
    pairs = align.named_passages(names, F.transform("t", lambda x: x["text"]))
    return turns.select("conv_id", F.explode(pairs).alias("p")).select("conv_id", "p.name", F.col("p.passages").alias("passage"))


@query("""SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' ELSE 'another' END AS language FROM documents""")
def language_names(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", align.lookup(F.col("lang"), {"en": "English", "de": "German"}, "another").alias("language"))


@query("""SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) AS place FROM documents""")
def shuffled_rows(spark, sf):
    """A shuffled order that any engine can repeat, as numbers."""
    d = _t(spark, sf, "documents").select("doc_id").withColumn("_m", order.mark("doc_id", seed="7"))
    return order.row_ids(d, ["_m", "doc_id"], "place").select("doc_id", "place")


@query("""SELECT doc_id, CASE WHEN starts_with(text, '[') THEN text ELSE translate(text, chr(13) || chr(10) || '"' || chr(9), '') END AS value FROM documents""")
def value_texts(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.value_text(F.col("text")).alias("value"))


@query("""SELECT doc_id FROM documents WHERE n_chars > 0 ORDER BY md5('0|' || doc_id), doc_id LIMIT 100""")
def curation_fallback(spark, sf):
    """Where no row is flawed, a hundred random ones that may be used."""
    rows = _t(spark, sf, "documents").filter("n_chars > 0").select("doc_id", F.lit(1).alias("is_rag"), F.lit(1).alias("is_single_turn"), F.lit("高").alias("assistant_logic"))
    return curate.keep_flawed(rows, True, True, all_rules=(), any_rules=(curate.Is("assistant_logic", ("低",)),), key=("doc_id",)).select("doc_id")


@query("""SELECT count(*) AS n, 0 AS early, 0 AS late, true AS spread, 0 AS outside FROM documents""")
def made_up_dates(spark, sf):
    """Dates drawn by hash lie in their range, at its ends too, and the days asked follow the latest publication."""
    d = _t(spark, sf, "documents").select(temporal.random_date("2024-01-01", "2024-01-10", F.col("doc_id")).alias("x"), temporal.asked_on(F.array(F.array(F.lit("on 2024-02-28"), F.lit("2024-02-20"))), F.col("doc_id")).alias("y"))
    outside = (F.col("y") < F.lit("2024-02-29").cast("date")) | (F.col("y") > F.lit("2024-03-29").cast("date"))
    spread = (F.min("x") == F.lit("2024-01-01").cast("date")) & (F.max("x") == F.lit("2024-01-10").cast("date")) & (F.count_distinct("x") == 10)
    return d.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") < F.lit("2024-01-01").cast("date")).alias("early"), F.count_if(F.col("x") > F.lit("2024-01-10").cast("date")).alias("late"), spread.alias("spread"), F.count_if(outside).alias("outside"))


@query(f"""WITH {_PAIRS} SELECT conv_id, turn, usr AS said, true AS known FROM pairs""")
def varied_prompts(spark, sf):
    openings = ("Say:", "Please say:", "Now:")
    p = prompts.varied(openings, F.col("user"), F.col("conv_id"), F.col("turn"))
    return _pairs(spark, sf).select("conv_id", "turn", F.substring(p, F.locate("\n", p) + 1, F.length(p)).alias("said"), F.substring_index(p, "\n", 1).isin(*openings).alias("known"))


# --- clients and jobs -----------------------------------------------------------------------------

_SCORE = "('0x' || substr(md5('{0}' || md5(text)), 1, 8))::BIGINT % 2"


@query(f"""SELECT doc_id AS row_id, CASE WHEN doc_id % 10 = 3 THEN NULL ELSE {_SCORE.format('Judge: ')} END::INT AS score, doc_id % 10 = 3 AS failed FROM documents""")
def retried_answers(spark, sf):
    """A client whose first call of each prompt fails, and some prompts always."""
    d = F.col("doc_id")
    rows = _t(spark, sf, "documents").select(d.alias("row_id"), F.concat(F.when(d % 10 == 3, "broken ").otherwise(""), F.lit("Judge: "), F.md5("text")).alias("prompt"))
    got = model_map.ask_all(rows, lambda: EchoJudge(fail_first=1, broken="broken"), limits=Limits(per_second=0, pause=0.0, tries=2))
    failed = F.col("response") == "<|wrong data|>"
    return got.select("row_id", F.when(~failed, judge.AUTHENTICITY.final(F.col("response"))).alias("score"), failed.alias("failed"))


@query(f"""SELECT row_id, s::INT AS first, s::INT AS second, CASE WHEN s = 1 THEN 'keep' ELSE 'discard' END AS route FROM (SELECT doc_id AS row_id, {_SCORE.format('A ')} AS s FROM documents)""")
def models_agree(spark, sf):
    """Two models' stored answers beside each other, and what their vote says."""
    from parlance.plans import jobs as whole

    rows = _t(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.concat(F.lit("A "), F.md5("text")).alias("p"))
    got = whole.evaluated(rows, {"one": EchoJudge, "two": EchoJudge}, "p", limits=_FAST)
    return got.select("row_id", F.get("scores", F.lit(0)).alias("first"), F.get("scores", F.lit(1)).alias("second"), "route")


@query("""SELECT doc_id AS row_id, md5(text) AS response FROM documents""")
def answers_resumed(spark, sf):
    """Half of the prompts are answered by an earlier job; the later one asks for the rest, and has all."""
    store = Answers(spark, _folder(spark))
    rows = _t(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("prompt"))
    store.ask(rows.filter("row_id % 2 = 0"), _Digest, "m", limits=_FAST)
    return store.ask(rows, _Digest, "m", limits=_FAST).select("row_id", "response")


class _Digest:
    def ask(self, prompt: str) -> str:
        import hashlib

        return hashlib.md5(prompt.encode()).hexdigest()


@query("""SELECT doc_id, md5(lang) AS query, source AS reply, 'score "' || doc_id || '"' AS found, coalesce(nullif(lang, 'en'), '<|wrong data|>') AS other FROM documents""")
def service_bodies(spark, sf):
    """A request as JSON, and replies of two providers; one without the field is a failure."""
    body = model_map.service_body(F.md5("lang"), F.lit("o"), F.col("source"), "doc")
    kind = "query string, observation string, response string, input_text_type string"
    said = F.to_json(F.struct(F.array(F.struct(F.struct(F.concat(F.lit('score "'), F.col("doc_id").cast("string"), F.lit('"')).alias("content")).alias("message"))).alias("choices")))
    other = F.to_json(F.struct(F.struct(F.array(F.struct(F.when(F.col("lang") != "en", F.col("lang")).alias("content"))).alias("choices")).alias("data")))
    b = F.from_json(body, kind)
    return _t(spark, sf, "documents").select("doc_id", b["query"].alias("query"), b["response"].alias("reply"), model_map.reply_text(said, "chat").alias("found"), model_map.reply_text(other, "gateway").alias("other"))


def _encoder():
    """Lengths of texts, and how often two letters stand in them."""
    return lambda texts: [[float(len(t)), float(t.count("e")), float(t.count("a"))] for t in texts]


@query("""SELECT doc_id, length(text)::DOUBLE AS n, (length(text) - length(replace(text, 'e', '')))::DOUBLE AS e, (length(text) - length(replace(text, 'a', '')))::DOUBLE AS a FROM documents WHERE text IS NOT NULL""")
def encoded_texts(spark, sf):
    """Every text through an encoder that each partition loads once."""
    v = model_map.embed(_t(spark, sf, "documents"), lambda: _encoder(), "text", "doc_id")
    return v.select("doc_id", *[F.get("vector", F.lit(k)).cast("double").alias(c) for k, c in enumerate("nea")])


@query("""SELECT lang AS job, 'waits,done,earlier,done' AS said FROM documents GROUP BY lang""")
def periods_once(spark, sf):
    """A job a language that needs another one: it waits, the other runs, runs no second time, and it runs."""
    folder, out = _folder(spark), []
    for r in _t(spark, sf, "documents").select("lang").distinct().collect():  # a row a language
        go = lambda job, *needs, period=r["lang"]: jobs.run_once(spark, folder, job, period, lambda: None, needs)
        out.append((r["lang"], ",".join([go("filter", "raw"), go("raw"), go("raw"), go("filter", "raw")])))
    return spark.createDataFrame(out, "job string, said string")


@query("""SELECT source, true AS good FROM documents GROUP BY source""")
def made_again(spark, sf):
    """Chunks that came out bad are made again, and good ones are not."""
    path, tries = _folder(spark), iter(range(9))
    wanted = _t(spark, sf, "documents").select("source").distinct()

    def make(left):
        k = next(tries)
        return materialize(left.select("source", (F.pmod(F.xxhash64("source"), F.lit(3)) <= k).alias("good"), F.lit(k).alias("at")))

    def read():
        got = spark.read.schema("source string, good boolean, at int").parquet(path)
        return got.groupBy("source").agg(F.max_by("good", "at").alias("good"))

    spark.createDataFrame([], "source string, good boolean, at int").write.parquet(path)
    jobs.regenerate(wanted, make, read, lambda rows: rows.write.mode("append").parquet(path), "source", ~F.col("good"))
    return read()


@query("""SELECT event_id, event_type FROM events""")
def stream_once(spark, sf):
    """A table as a stream of files, written batch by batch, each row once, and the last batch sent again."""
    path, sent = _folder(spark), []
    write = jobs.append_once(spark, f"{path}/out", "s")
    _t(spark, sf, "events").select("event_id", "event_type").repartition(6).write.parquet(f"{path}/in")
    jobs.new_days(spark, f"{path}/in", "event_id long, event_type string", f"{path}/checkpoint", lambda batch, n: (write(batch, n), sent.append(n), write(batch, n)), files=2)
    return jobs.appended(spark, f"{path}/out", "event_id long, event_type string").select("event_id", "event_type")

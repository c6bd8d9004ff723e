"""Queries of the operators that logs, judges, gates, prompts, files and training tables need."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions import codec, judge, logparse, prompts, temporal, text, tokens
from parlance.operators import align, curate, order, quality, report
from parlance.plans.catalogue import _PAIRS, _pairs, _t, query
from parlance.schema import MESSAGES
from parlance.scratch import shared_dir
from parlance.sources import readers, retrieve, writers

# --- logs -----------------------------------------------------------------------------------------


def _log() -> Column:
    """A turn as the large model's input: system sentence (not in every third), user, thought, call, passages."""
    k, s = F.col("conv_id"), lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    said = F.when(k % 3 == 0, "").otherwise(s("用户今天日期：2024年3月", (k % 28 + 1).cast("string"), "日。用户今天农历：甲辰年。用户现在时间：", (k % 24).cast("string"), "时", (k % 60).cast("string"), "分。用户现在位置：北京。"))
    return s(
        "[unused0]system\n", said, "Be brief.[unused1][unused0]user\n", F.col("user"), "[unused1]\n[unused0]thought\nthink ", k.cast("string"),
        "[unused1][unused0]api\n[unused4][unused2]APINAME[unused7]QASearch[unused3][unused2]QUERY[unused7]q", k.cast("string"), "[unused3][unused5][unused6][unused1]",
        '[unused0]observation\n[unused2]{"QASearchResults": ["p ', k.cast("string"), '", "r"]}[unused3][unused1]',
    )


@query(f"""WITH {_PAIRS} SELECT conv_id, turn, usr AS query, 1 AS n_turns, 0 AS n_context, 'think ' || conv_id AS thought, 'APINAME=QASearch;QUERY=q' || conv_id AS call, 'p ' || conv_id || '|r' AS passages,
  CASE WHEN conv_id % 3 = 0 THEN NULL ELSE '2024-3-' || (conv_id % 28 + 1) || ' ' || conv_id % 24 || ':' || conv_id % 60 || ':00' END AS logged_at,
  CASE WHEN conv_id % 3 = 0 THEN 'Be brief.' ELSE '用户今天日期：2024年3月' || (conv_id % 28 + 1) || '日。用户今天农历：甲辰年。用户现在时间：' || conv_id % 24 || '时' || conv_id % 60 || '分。用户现在位置：北京。' || chr(10) || 'Be brief.' END AS system FROM pairs""")
def log_columns(spark, sf):
    d = logparse.parse_log(_pairs(spark, sf).withColumn("log", _log()), "log")
    call = F.array_join(F.transform(F.get("calls", F.lit(0)), lambda e: F.concat(e["k"], F.lit("="), e["v"])), ";")
    return d.select("conv_id", "turn", "query", "n_turns", F.size("context").alias("n_context"), F.get("thoughts", F.lit(0)).alias("thought"), call.alias("call"), F.array_join(F.flatten("observations"), "|").alias("passages"), "logged_at", "system")


@query(f"""WITH {_PAIRS} SELECT conv_id, turn, usr AS content, CASE WHEN conv_id % 3 = 0 THEN 'today' ELSE '2024年3月' || (conv_id % 28 + 1) || '日' END AS day, CASE WHEN conv_id % 3 = 0 THEN '中国' ELSE '北京' END AS place FROM pairs""")
def log_place(spark, sf):
    p = logparse.date_place(F.col("log"), "today")
    return _pairs(spark, sf).withColumn("log", _log()).select("conv_id", "turn", logparse.user_content(F.col("log")).alias("content"), p["date"].alias("day"), p["place"].alias("place"))


@query(f"""WITH {_PAIRS} SELECT conv_id, turn, CASE WHEN conv_id % 2 = 0 THEN 'MathQA' ELSE 'QASearch' END AS tool, CASE WHEN conv_id % 2 = 0 THEN 'small' ELSE 'think ' || conv_id END AS thought FROM pairs""")
def tool_kind(spark, sf):
    k = F.col("conv_id")
    small = F.concat(F.lit("[unused0]thought\nsmall[unused1][unused0]api\n[unused4][unused2]APINAME[unused7]"), F.when(k % 2 == 0, "MathQA").otherwise("MEDIASearch"), F.lit("[unused3][unused5][unused6][unused1]"))
    d = _pairs(spark, sf).withColumn("s", logparse.by_tool_kind(small, _log()))
    return d.select("conv_id", "turn", F.get(F.get("s.calls", F.lit(0)), F.lit(0))["v"].alias("tool"), F.get("s.thoughts", F.lit(0)).alias("thought"))


@query(f"""WITH {_PAIRS} SELECT conv_id, turn, trim(usr, chr(32) || chr(10) || chr(9) || chr(13)) || chr(10) || 'end' AS finished, 'why ' AS thought, 'a=>b' AS calls FROM pairs""")
def generation_finish(spark, sf):
    said = F.concat(F.lit(" "), text.strip(F.col("user")), F.lit("[unused8]end[unused1]tail"))
    parts = logparse.readable_sections(F.lit("why <|api_start|>a=>b<|api_end|>"))
    return _pairs(spark, sf).select("conv_id", "turn", logparse.finish_generation(said).alias("finished"), parts["thought"].alias("thought"), F.array_join(parts["calls"], ",").alias("calls"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'c' || doc_id || '|d' END AS found FROM documents""")
def call_blocks(spark, sf):
    k = F.col("doc_id")
    body = lambda q: F.concat(F.lit(f"[{{{q}content{q}: [{q}c"), k.cast("string"), F.lit(f"{q}]}}, {{{q}content{q}: [{q}d{q}]}}]"))
    block = F.concat(F.lit("x[unused0]user\n```function_call_result"), F.when(k % 3 == 1, body('"')).otherwise(body("'")), F.lit("```[unused1]"))
    log = F.when(k % 3 == 0, "nothing").otherwise(F.replace(block, F.lit("\n```"), F.lit("```")))
    return _t(spark, sf, "documents").select("doc_id", F.array_join(logparse.call_block(log), "|").alias("found"))


@query(f"""WITH {_PAIRS}, s AS (SELECT conv_id, min(turn) AS turn, min(usr) AS usr, min(assistant) AS assistant, count(*) AS n FROM pairs GROUP BY conv_id)
  SELECT conv_id, CASE WHEN conv_id % 4 = 0 THEN 3 WHEN conv_id % 4 = 1 THEN 2 ELSE 1 END AS longest FROM s""")
def longest_session(spark, sf):
    k, rep = F.col("conv_id"), lambda n: F.array_repeat(F.struct(F.lit("u").alias("input_text"), F.lit("a").alias("output_text")), n)
    best = logparse.longest_session(rep(F.lit(1)), F.when(k % 4 == 1, rep(F.lit(2))), F.when(k % 4 == 0, rep(F.lit(3))))
    return _pairs(spark, sf).select("conv_id").distinct().select("conv_id", F.size(best).alias("longest"))


# --- conversions ----------------------------------------------------------------------------------


def _sft(spark, sf) -> DataFrame:
    """Last turns as a training table: a call, two passages, one earlier turn."""
    k = F.col("conv_id").cast("string")
    entry = lambda a, b: F.struct(F.lit(a).alias("k"), b.alias("v"))
    return _pairs(spark, sf).select(
        F.concat(k, F.lit("-"), F.col("turn").cast("string")).alias("id"), F.col("turn").alias("turn_id"), F.lit("sft").alias("source"), F.col("user").alias("user-query"), "assistant", F.concat(F.lit("think "), k).alias("thought"),
        F.array(F.array(entry("apiname", F.lit("QASearch")), entry("query", k))).alias("api"), F.when(F.col("conv_id") % 5 == 0, F.array(F.array().cast("array<string>"))).otherwise(F.array(F.array(F.concat(F.lit("p"), k), F.lit("r")))).alias("observation"),
        F.array(F.struct(F.lit("before").alias("user"), F.lit("earlier").alias("assistant"))).alias("context"),
    )


@query(f"""WITH {_PAIRS} SELECT conv_id || '-' || turn AS id, 10 AS n_messages,
  '<|lc_start|>user' || chr(10) || 'before<|lc_end|>' || chr(10) || '<|lc_start|>assistant' || chr(10) || 'earlier<|lc_end|>' || chr(10) || '<|lc_start|>user' || chr(10) || usr || '<|lc_end|>' || chr(10) || '<|lc_start|>thought' || chr(10) || 'think ' || conv_id || '<|lc_end|>' || chr(10)
    || '<|lc_start|>api' || chr(10) || '<|api_start|><|kvs|>apiname=>QASearch<|kve|><|kvs|>query=>' || conv_id || '<|kve|><|api_end|><|eoa|><|lc_end|>' || chr(10)
    || '<|lc_start|>observation' || chr(10) || '<|kvs|>{{"QASearchResults": ["p' || conv_id || '", "r"]}}<|kve|><|lc_end|>' || chr(10) || '<|lc_start|>assistant' AS instruction,
  assistant || '<|lc_end|>' AS output FROM pairs WHERE conv_id % 5 <> 0 AND trim(assistant, chr(32) || chr(10) || chr(9) || chr(13)) <> ''""")
def sft_instructions(spark, sf):
    made = codec.to_messages(_sft(spark, sf), with_calls=True, with_history=True)
    return made.withColumn("r", codec.instruction(F.col("messages"))).filter("r is not null").select("id", F.size("messages").alias("n_messages"), "r.instruction", "r.output")


@query(f"""WITH {_PAIRS} SELECT conv_id || '-' || turn AS id, 2 AS turn_id, usr AS query, 'think ' || conv_id AS thought, 'QASearch' AS tool, 'p' || conv_id || ',r' AS passages, assistant FROM pairs WHERE conv_id % 5 <> 0""")
def sft_roundtrip(spark, sf):
    back = codec.from_messages(codec.to_messages(_sft(spark, sf), with_history=True), "id").filter("turn_id = 2")
    return back.select("id", "turn_id", F.col("user-query").alias("query"), "thought", codec.value_of(F.get("api", F.lit(0)), "apiname").alias("tool"), F.array_join(F.flatten("observation"), ",").alias("passages"), "assistant")


@query("""SELECT doc_id, lang || '<|br|>' || source AS both, 3 AS n, 4 AS n_marked FROM documents""")
def reply_breaks(spark, sf):
    said = F.concat_ws("<|br|>", "lang", "source")
    items = codec.reply_items(said)
    return _t(spark, sf, "documents").select("doc_id", codec.items_text(items).alias("both"), F.size(items).alias("n"), F.size(codec.reply_items(said, irrelevant=True)).alias("n_marked"))


@query("""SELECT event_id, event_type || ',' AS names, ',' || user_id AS queries, 'city,' AS categories, ',' AS tags FROM events""")
def call_slots(spark, sf):
    entry = lambda k, v: F.struct(F.lit(k).alias("k"), v.cast("string").alias("v"))
    calls = F.array(F.array(entry("ApiName", F.col("event_type")), entry("CATEGORY", F.lit("city"))), F.array(entry("query", F.col("user_id"))))
    s = codec.slots(calls)
    return _t(spark, sf, "events").select("event_id", *[F.array_join(s[n], ",").alias(n) for n in ("names", "queries", "categories", "tags")])


@query("""SELECT event_id, CASE WHEN event_id % 4 = 3 THEN '1:-:plain ' || event_id ELSE '1:' || CASE WHEN event_id % 4 = 2 THEN '-' ELSE 't' END || ':c' || event_id || ';2:-:d' END AS objects FROM events""")
def observation_objects(spark, sf):
    k, n = F.col("event_id"), F.col("event_id").cast("string")
    wrap = lambda a, b: F.concat(F.lit(a), n, F.lit(b))
    said = F.when(k % 4 == 0, wrap('[{"title": "t", "content": "c', '"}, {"content": "d"}]')).when(k % 4 == 1, wrap("[{'title': 't', 'content': 'c", "'}, {'title': None, 'content': 'd'}]")).when(k % 4 == 2, wrap('["c', '", "d"]')).otherwise(wrap("plain ", ""))
    shown = F.transform(codec.objects_of(said), lambda o: F.concat_ws(":", o["id"], F.coalesce(o["title"], F.lit("-")), o["content"]))
    return _t(spark, sf, "events").select("event_id", F.array_join(shown, ";").alias("objects"))


@query("""SELECT doc_id, '1 ' || lang || ',2 ' || source AS ranked, '0.5 ' || lang AS scored, 'why ' || doc_id AS thoughts, 'name=x,query=' || doc_id AS call FROM documents""")
def passages_ranked(spark, sf):
    doc = lambda title, content: F.struct(title.alias("title"), content.alias("content"), F.lit("0.5").alias("score"))
    docs = F.array(doc(F.lit("t"), F.col("lang")), doc(F.col("source"), F.lit("")), doc(F.lit("t"), F.lit("never")))
    reply = codec.service_reply(F.concat(F.lit('{"thoughts": ["why '), F.col("doc_id").cast("string"), F.lit('"], "api": [{"name": "x", "query": "'), F.col("doc_id").cast("string"), F.lit('"}]}')))
    call = F.array_join(F.transform(F.get(reply["calls"], F.lit(0)), lambda e: F.concat(e["k"], F.lit("="), e["v"])), ",")
    return _t(spark, sf, "documents").select("doc_id", F.array_join(codec.passage_list(docs, 2, "rank"), ",").alias("ranked"), F.array_join(codec.passage_list(docs, 1, "score"), ",").alias("scored"), F.array_join(reply["thoughts"], ",").alias("thoughts"), call.alias("call"))


@query("""SELECT doc_id, replace(text, 'the', chr(92) || 'n') AS text, 'k' AS key, replace(lang, 'the', chr(92) || 'n') AS value FROM documents""")
def nested_replacement(spark, sf):
    nested = _t(spark, sf, "documents").select("doc_id", F.struct(F.array(F.struct(F.col("text").alias("x"), F.col("n_chars").alias("n"))).alias("a"), F.create_map(F.lit("k"), F.col("lang")).alias("m")).alias("v"))
    done = nested.select("doc_id", codec.replace_nested(F.col("v"), nested.schema["v"].dataType, "the", "\\n").alias("v"))
    return done.select("doc_id", F.get("v.a", F.lit(0))["x"].alias("text"), F.get(F.map_keys("v.m"), F.lit(0)).alias("key"), F.get(F.map_values("v.m"), F.lit(0)).alias("value"))


# --- text -----------------------------------------------------------------------------------------


@query("""SELECT doc_id, md5(replace(CASE WHEN doc_id % 2 = 0 THEN '您' ELSE '' END || text, '您', '你')) AS plain, md5(translate(text, chr(13) || chr(10) || '"' || chr(9), '')) AS unbroken, md5(replace(text, chr(10), chr(92) || 'n')) AS escaped,
  md5(replace(replace(regexp_replace(text, '^[\\s\\x{0b}\\x{85}\\p{Z}]+|[\\s\\x{0b}\\x{85}\\p{Z}]+$', '', 'g'), 'a', ''), ' the', '')) AS without, CASE WHEN contains(text, chr(10)) THEN split_part(text, chr(10), 2) END AS second_line, sha256(text || chr(31) || lang) AS id,
  regexp_matches(CASE WHEN doc_id % 2 = 0 THEN '您' ELSE '' END || text, '[一-龥]') AS chinese, '2024-05-06' AS named, '[KEY]' || lang || ' ' AS brackets, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'none' END AS filled FROM documents""")
def text_tools(spark, sf):
    c = F.col("text")
    held = F.create_map(F.lit("a"), F.lit("[]"), F.lit("b"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(""))
    polite = F.concat(F.when(F.col("doc_id") % 2 == 0, "您").otherwise(""), c)
    return _t(spark, sf, "documents").select(
        "doc_id", F.md5(text.polite_to_plain(polite)).alias("plain"), F.md5(text.drop_breaks(c)).alias("unbroken"), F.md5(text.escape_newlines(c)).alias("escaped"), F.md5(text.without(c, ["a", " the"])).alias("without"),
        text.line(c, 1).alias("second_line"), text.content_id(c, F.col("lang")).alias("id"), text.has_chinese(polite).alias("chinese"), text.date_in_name(F.lit("/x/2024-05-06/raw.csv")).alias("named"),
        tokens.as_brackets(F.concat(F.lit("[unused4][unused2]KEY[unused7]"), F.col("lang"), F.lit("[unused3]"))).alias("brackets"), text.first_filled(held, ("a", "b", "c")).alias("filled"),
    )


@query("""SELECT doc_id, '[unused0]user' || chr(10) || lang || '[unused1]' || chr(10) || '[unused0]assistant' || chr(10) || source AS transcript,
  CASE WHEN doc_id % 2 = 0 THEN '下列：' || '<|br|>' || chr(10) || '1. ' || lang || '<|br|>' || chr(10) || '2. b' || '<|br|>' || chr(10) || 'done' ELSE '' END AS segments, CASE WHEN doc_id % 2 = 0 THEN 'T!' ELSE 'T' END AS hint,
  CASE WHEN doc_id % 2 = 0 THEN lang || chr(10) || 'p' ELSE lang END AS prompted, doc_id % 2 = 0 AS points FROM documents""")
def reply_points(spark, sf):
    even = F.col("doc_id") % 2 == 0
    said = F.concat(F.lit("下列："), F.lit("\n1. "), F.col("lang"), F.lit("\n2. b"), F.when(even, "\n\ndone").otherwise(""))
    listed = F.when(even, said).otherwise("no list")
    return _t(spark, sf, "documents").select(
        "doc_id", text.role_transcript(F.concat(F.lit("user:"), F.col("lang"), F.lit("assistant:"), F.col("source"))).alias("transcript"), text.segment_points(said).alias("segments"),
        text.hinted(F.lit("T"), even, "!").alias("hint"), text.with_prompt(F.col("lang"), F.when(even, " p ").otherwise(" ")).alias("prompted"), text.is_points_reply(listed).alias("points"),
    )


# --- judges, gates, prompts -----------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN -1 WHEN quality = 1 THEN 1 ELSE 0 END AS groups, CASE WHEN quality = 0 OR toxic = 1 THEN 0 ELSE 1 END AS rich, quality AS all_one, quality + 3 AS relevant, CASE WHEN doc_id % 2 = 0 THEN -1 ELSE toxic END AS repeated FROM labels""")
def judge_more(spark, sf):
    q, x, d = F.col("quality").cast("string"), F.col("toxic").cast("string"), F.col("doc_id")
    three = F.when(d % 3 == 0, "{{5}}").otherwise(F.concat(F.lit("{{"), F.when(F.col("quality") == 1, "4").otherwise("3"), F.lit("}} {{1}} {{x}}")))
    rich = F.concat(F.lit("准确性评估：\n1【"), q, F.lit("】兜底回复\n是否为兜底回复：【"), x, F.lit("】"))
    one = F.concat(F.lit("准确性：1【"), q, F.lit("】【1】兜底"))
    service = F.concat(F.lit('{"eval_results":[{"pred_rel_score":'), (F.col("quality") + 3).cast("string"), F.when(d % 2 == 0, F.lit("")).otherwise(F.concat(F.lit(',"pred_repeat_score":'), x)), F.lit("}]}"))
    return _t(spark, sf, "labels").select(
        "doc_id", judge.three_groups(three).alias("groups"), judge.RICHNESS.final(rich).alias("rich"), judge.all_one(one).alias("all_one"), judge.service_score(service, "pred_rel_score").alias("relevant"), judge.service_score(service, "pred_repeat_score").alias("repeated")
    )


@query("""SELECT doc_id, ['no messages', 'number of roles', 'order of roles', 'content', 'translation', 'empty reply', 'empty reply item', 'short reply', 'persona', 'apology', 'unsafe reply', 'unsafe query', 'query persona', 'legal', 'legal'][doc_id % 15 + 1] AS verdict,
  ['', '', '', '', 'mostly English', '', '', '', 'As an AI language model', '抱歉', 'badword', '', 'ChatGPT', '', ''][doc_id % 15 + 1] AS reason FROM documents""")
def gate_cases(spark, sf):
    """One fault a row, by the id: every gate is reached."""
    case, d = F.col("doc_id") % 15, F.lit("a fair and sufficiently long reply, 说明说明说明说明说明说明")
    item = lambda x, missing=F.lit(False): F.struct(F.when(~missing, x).alias("text"), F.lit(None).cast("string").alias("token"))
    replies = {4: "plain English words only 中", 6: "", 7: "short", 8: "As an AI language model I say 说明说明说明说明说明说明说明说明说明说明说明说明", 9: "抱歉，说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明说明", 10: "a badword in a reply that is long enough 说明说明说明说明说明说明说明说明"}
    reply = d
    for k, said in replies.items():
        reply = F.when(case == k, said).otherwise(reply)
    asked = F.when(case == 11, "secretword?").when(case == 12, "Ask ChatGPT").otherwise("a question")
    empty = F.array(item(F.lit("")))
    message = lambda role, content: F.struct(role.alias("role"), content.alias("content"))
    none = F.array().cast("array<struct<text:string,token:string>>")
    last = F.when(case == 5, none).otherwise(F.array(item(reply, case == 3)))
    five = F.array(message(F.lit("user"), F.array(item(asked))), message(F.when(case == 2, "api").otherwise("thought"), empty), message(F.when(case == 2, "thought").otherwise("api"), empty), message(F.lit("observation"), empty), message(F.lit("assistant"), last)).cast(MESSAGES)
    messages = F.when(case == 0, None).when(case == 1, F.slice(five, 1, 4)).otherwise(five)
    rows = _t(spark, sf, "documents").select("doc_id", messages.alias("messages"), F.lit("brief").alias("owner"), F.when(case == 13, "renamed").otherwise("set").alias("dataset"), F.when(case == 9, "chats").otherwise("s").alias("source"))
    gate = quality.Gate(apology_sources=("chats",), unsafe_reply=("badword",), unsafe_query=("secretword",), short_owners=("brief",), short=10)
    return quality.judged(rows, gate).select("doc_id", "verdict", "reason")


@query(f"""WITH {_PAIRS} SELECT conv_id, turn, 'On ' || CASE WHEN conv_id % 3 = 0 THEN 'today' ELSE '2024年3月' || (conv_id % 28 + 1) || '日' END || ' in ' || CASE WHEN conv_id % 3 = 0 THEN '中国' ELSE '北京' END || chr(10) || '问题：' || usr || chr(10) || '回答：' || assistant AS logged,
  'H' || chr(10) || 'E' || chr(10) || '输入：' || usr || chr(10) || '输出：' AS shots, '先写出回答策略。' || chr(10) || '问题：' || usr AS strategy, '按策略回答。' || chr(10) || '策略：' || assistant || chr(10) || '问题：' || usr AS answer, 'user:' || usr || '|assistant:' || assistant AS body FROM pairs""")
def prompt_kinds(spark, sf):
    said = prompts.log_prompt("On $$$date$$$ in $$$pos$$$", F.col("log"), None, F.col("user"), F.col("assistant"), "today")
    body = F.transform(codec.chat_body(F.array("user", "assistant")), lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return _pairs(spark, sf).withColumn("log", _log()).select("conv_id", "turn", said.alias("logged"), prompts.few_shot("H", "E", F.col("user")).alias("shots"), prompts.strategy_prompt(F.col("user")).alias("strategy"), prompts.answer_prompt(F.col("user"), F.col("assistant")).alias("answer"), F.array_join(body, "|").alias("body"))


# --- tables and files -----------------------------------------------------------------------------


@query("""SELECT 'log-2024-05-06-' || (row_number() OVER (ORDER BY source, doc_id) - 1) AS id, doc_id, 0 AS turn_id, 'log' AS produce_source, '2024-05-06' AS create_time FROM documents""")
def training_ids(spark, sf):
    return curate.for_training(_t(spark, sf, "documents").select("doc_id", "source"), "2024-05-06", ["source", "doc_id"]).select("id", "doc_id", "turn_id", "produce_source", "create_time")


@query("""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'late ' || doc_id ELSE 'first ' || doc_id END AS response FROM labels""")
def responses_by_index(spark, sf):
    d = _t(spark, sf, "labels").select("doc_id", F.col("doc_id").alias("index"))
    first = d.filter("doc_id % 7 <> 0").select("index", F.lit(1).alias("at"), F.concat(F.lit("first "), F.col("index").cast("string")).alias("response"))
    late = d.filter("doc_id % 7 <> 0 and doc_id % 5 = 0").select("index", F.lit(2).alias("at"), F.concat(F.lit("late "), F.col("index").cast("string")).alias("response"))
    return align.by_index(d, late.unionByName(first)).select("doc_id", "response")


@query("""SELECT doc_id, lang, CASE WHEN doc_id % 5 = 0 THEN 'failed' ELSE 'good' END AS side, 'src' AS source, 'task' AS task_name, '2024-05-06' AS create_time, '0' AS is_reviewed FROM documents""")
def failed_and_good(spark, sf):
    rows = curate.audited(_t(spark, sf, "documents").select("doc_id", "lang", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("x"), F.lit(tokens.FAILED))).otherwise("reply").alias("response")), "src", "task", "2024-05-06")
    good, bad = curate.split_failed(rows, "response")
    return good.withColumn("side", F.lit("good")).unionByName(bad.withColumn("side", F.lit("failed"))).select("doc_id", "lang", "side", "source", "task_name", "create_time", "is_reviewed")


@query("""SELECT lang, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM documents GROUP BY lang""")
def language_shares(spark, sf):
    return report.shares(_t(spark, sf, "documents"), "lang").select("lang", "n", "share")


def _folder(spark) -> str:
    """A new folder that all machines see: what an earlier result still reads is left alone."""
    return f"{shared_dir(spark)}/parlance/files/{uuid.uuid4().hex}"


@query("""SELECT doc_id, lang, md5(text) AS text_md5, n_chars::VARCHAR AS n_chars FROM documents""")
def csv_roundtrip(spark, sf):
    """Whole texts, with their quotes and line breaks, through a CSV file with a byte order mark, and back."""
    path = f"{_folder(spark)}/documents.csv"
    rows = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text", "n_chars")
    writers.write_csv(rows, path, mark=True)
    back = readers.read_table(spark, path)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.md5("text").alias("text_md5"), "n_chars")


@query("""SELECT doc_id, md5(text) AS text_md5 FROM documents""")
def json_arrays(spark, sf):
    """Whole texts through seven files of one JSON array each, and back."""
    path = _folder(spark)
    writers.write_arrays(_t(spark, sf, "documents").select("doc_id", "text"), path, 7, ["doc_id"])
    return readers.read_arrays(spark, f"{path}/*.json", "doc_id long, text string").select("doc_id", F.md5("text").alias("text_md5"))


@query("""SELECT turn, count(*) AS n FROM conversations WHERE role = 'user' GROUP BY turn""")
def jsonl_user_texts(spark, sf):
    """User messages through a JSONL corpus: written by turn, read with the turn out of the path."""
    path = _folder(spark)
    said = F.array(F.struct("role", F.array("text").alias("content")))
    _t(spark, sf, "conversations").select("turn", said.alias("messages")).write.mode("overwrite").partitionBy("turn").json(path)
    got = readers.user_texts(spark, path, "turn int")
    return got.groupBy("turn").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS day, count(*) AS n FROM orders GROUP BY ALL""")
def daily_partitions(spark, sf):
    """All orders written a period a partition, here a month, one of them written again; each is there once."""
    from parlance.streaming import jobs

    path = _folder(spark)
    rows = _t(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("date")).repartition("date")
    rows.limit(0).write.mode("overwrite").partitionBy("date").parquet(path)
    jobs.write_day(rows, path)
    jobs.write_day(rows.filter("date = '1995-01'"), path)
    return spark.read.schema("o_orderkey long, date string").parquet(path).groupBy(F.col("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, quality, toxic FROM labels WHERE quality = 1 OR toxic = 1""")
def timely_rows(spark, sf):
    rows = _t(spark, sf, "labels").withColumnsRenamed({"quality": "is_realtime", "toxic": "query_has_relative_time"})
    return curate.timely(rows).select("doc_id", F.col("is_realtime").alias("quality"), F.col("query_has_relative_time").alias("toxic"))


@query(f"""WITH {_PAIRS} SELECT conv_id, turn, 'x|y|' || usr AS said, usr || '/' || assistant AS newest FROM pairs""")
def dialogues(spark, sf):
    before = F.array(F.struct(F.lit("x").alias("user"), F.lit("y").alias("assistant")))
    newest = F.get(logparse.newest_first(F.array(F.struct(F.lit("o").alias("user"), F.lit("p").alias("assistant")), F.struct("user", "assistant"))), F.lit(0))
    return _pairs(spark, sf).select("conv_id", "turn", F.array_join(curate.dialogue(before, F.col("user")), "|").alias("said"), F.concat(newest["input_text"], F.lit("/"), newest["output_text"]).alias("newest"))


@query("""SELECT DISTINCT o_orderdate::DATE::VARCHAR AS day, 'Y' || year(o_orderdate) AS seen FROM orders""")
def system_prompts(spark, sf):
    """The synthetic system message says its own date; read back by the log parser."""
    days = _t(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    said = temporal.system_prompt(F.col("day"), F.lit("用户今天农历：x。"), F.col("day"))
    found = temporal.parse_chinese_date(logparse.when_where(said)["date"])
    return days.select(found.cast("string").alias("day"), F.concat(F.lit("Y"), F.substring(logparse.logged_at(said), 1, 4)).alias("seen"))


@query("""SELECT lang, min(doc_id) AS doc_id FROM documents GROUP BY lang""")
def first_of_each(spark, sf):
    return order.first_of(_t(spark, sf, "documents").select("lang", "doc_id"), ["lang"], ["doc_id"])


@query("""SELECT doc_id, lang || ':' || lang || ' s ' || doc_id || ':none|:t:2024-01-02' AS pages, 'A' AS linked, CASE WHEN doc_id % 2 = 0 THEN 'B' ELSE '' END AS unlinked, CASE WHEN doc_id % 2 = 0 THEN 'encyclopedia=yes' ELSE 'other=unknown' END AS spoken,
  substr(md5('client' || lang || 'key' || doc_id), 1, 16) AS signature FROM documents""")
def search_replies(spark, sf):
    d, even = F.col("doc_id").cast("string"), F.col("doc_id") % 2 == 0
    web = F.concat(F.lit('{"data": {"webPages": {"value": [{"name": "'), F.col("lang"), F.lit('", "snippet": "s \\"'), d, F.lit('\\""}, {"snippet": "t", "datePublished": "2024-01-02"}]}}}'))
    people = F.concat(F.lit('{"data": [{"general": {"category": "人物/x", "mention": "A"}}, {"general": {"category": "y", "mention": "C"}}], "unlink_entity": [{"category": "'), F.when(even, "PER").otherwise("LOC"), F.lit('", "mention": "B"}]}'))
    voice = F.when(even, '{"data": {"speak": "yes"}}').otherwise('{"data": {}}')
    shown = lambda x: F.concat_ws(":", x["title"], F.trim(x["content"]), x["published"])
    p, a = retrieve.linked_people(people), retrieve.spoken_answer(voice)
    return _t(spark, sf, "documents").select(
        "doc_id", F.array_join(F.transform(retrieve.web_pages(web, with_title=True), shown), "|").alias("pages"), F.array_join(p["linked"], ",").alias("linked"), F.array_join(p["unlinked"], ",").alias("unlinked"),
        F.concat(a["domain"], F.lit("="), a["answer"]).alias("spoken"), retrieve.signed(F.col("lang"), "client", "key", F.col("doc_id")).alias("signature"),
    )


@query("""SELECT doc_id, quality AS authenticity, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS relevance, quality::DOUBLE AS correctness FROM labels""")
def metrics_by_name(spark, sf):
    q = F.col("quality").cast("string")
    said = {"authenticity": F.concat(F.lit("准确性：1【"), q, F.lit("】兜底 是否为兜底回复：【0】")), "relevance": F.concat(F.lit("【"), F.when(F.col("quality") == 1, "4").otherwise("2"), F.lit("】兜底评估：{{0}}")), "correctness": F.concat(F.lit("准确性得分：{{"), q, F.lit("}}"))}
    return _t(spark, sf, "labels").select("doc_id", *[judge.metric(name)(text).alias(name) for name, text in said.items()])

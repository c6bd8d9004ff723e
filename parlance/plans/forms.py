"""Queries of literals, requests and tables in other forms, over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.functions import codec, literals, logparse, text
from parlance.operators import align, curate, quality, report
from parlance.operators.model_map import Limits, two_step
from parlance.plans.catalogue import _PAIRS, _pairs, _t, query
from parlance.schema import MESSAGES


def _literal(value: Column) -> Column:
    """A text as a string literal of Python."""
    for old, new in (("\\", r"\\"), ("'", r"\'"), ("\n", r"\n"), ("\r", r"\r")):
        value = F.replace(value, F.lit(old), F.lit(new))
    return F.concat(F.lit("'"), value, F.lit("'"))


@query("""SELECT doc_id, md5(text) AS text_md5, 'He said "it''s None"; Nonetheless True North' AS beside, '3' AS last_id, 'a "b" ''c''' AS last_title,
  CASE WHEN doc_id % 2 = 0 THEN chr(233) || ' tab' || chr(9) || '.' ELSE 'None' END AS last FROM documents""")
def literal_objects(spark, sf):
    """Whole texts in nested Python lists, with quotes, escapes and names within words."""
    beside = r'''"He said \"it's None\"; Nonetheless True North"'''
    title = r"""'a "b" \'c\''"""
    tail = F.when(F.col("doc_id") % 2 == 0, r"'\xe9 tab\t.'").otherwise("'None'")
    said = F.concat(F.lit("[["), _literal(F.col("text")), F.lit(f", {beside}], {{'title': {title}, 'score': None, 'chunk': "), tail, F.lit("}]"))
    o = lambda k: F.get("o", F.lit(k))
    d = _t(spark, sf, "documents").withColumn("o", codec.objects_of(said))
    return d.select("doc_id", F.md5(o(0)["content"]).alias("text_md5"), o(1)["content"].alias("beside"), o(2)["id"].alias("last_id"), o(2)["title"].alias("last_title"), o(2)["content"].alias("last"))


@query("""SELECT doc_id, md5(text) AS thought_md5, '<|api_start|><|kvs|>APINAME=>QASearch<|kve|><|kvs|>QUERY=>it''s ' || source || '<|kve|><|api_end|>' AS api, lang || ' "x"|second' AS observation FROM documents""")
def raw_to_readable(spark, sf):
    thought = F.concat(F.lit("[{'thought': "), _literal(F.col("text")), F.lit("}, {'thought': None}]"))
    api = F.concat(F.lit("""[{'APINAME': 'QASearch', 'QUERY': "it's """), F.col("source"), F.lit('"}]'))
    seen = F.concat(F.lit("[{'results': '"), F.col("lang"), F.lit(""" "x"', 'none': None}, {"r2": 'second'}]"""))
    return _t(spark, sf, "documents").withColumn("r", logparse.raw_columns(thought, api, seen)).select("doc_id", F.md5("r.thought").alias("thought_md5"), "r.api", F.array_join("r.observation", "|").alias("observation"))


@query("""WITH w AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), h AS (SELECT *, md5('s' || doc_id || '|1|name') AS m FROM w)
  SELECT doc_id, CASE WHEN len(w) > 1 THEN w[1] ELSE '' END AS title, CASE WHEN substr(m, 1, 1) < '8' THEN 'content' ELSE 'chunk' END AS name, md5(CASE WHEN len(w) > 1 THEN array_to_string(w[2:], '') ELSE w[1] END) AS body, '2:tail' AS first FROM h""")
def titled_objects(spark, sf):
    """Title and body drawn from each text, newest first."""
    objects = F.array(*[F.struct(F.lit(str(k)).alias("id"), F.lit(None).cast("string").alias("title"), c.alias("content")) for k, c in ((1, F.col("text")), (2, F.lit("tail")))])
    d = _t(spark, sf, "documents").withColumn("o", codec.titled_objects(objects, F.concat(F.lit("s"), F.col("doc_id").cast("string"))))
    last, first = F.get("o", F.lit(1)), F.get("o", F.lit(0))
    return d.select("doc_id", last["title"].alias("title"), last["name"].alias("name"), F.md5(last["body"]).alias("body"), F.concat(first["id"], F.lit(":"), first["body"]).alias("first"))


@query("""SELECT event_id, 'COUNTY:;CITY:' || CASE WHEN event_id % 2 = 0 THEN 'c' || event_id ELSE '' END || ';TOWN:;PROVINCE:;SCENE_TAG:lake;TIME:;REGION:;CROWD:;X:' || user_id AS slots FROM events""")
def city_requests(spark, sf):
    entry = lambda k, v: F.struct(F.lit(k).alias("k"), v.cast("string").alias("v"))
    base = [entry("APINAME", F.lit("QASearch")), entry("category", F.lit(codec.CITY_SIGHTS)), entry("timeSlots", F.lit("{}")), entry("x", F.col("user_id")), entry("scene_tag", F.lit("lake"))]
    call = F.when(F.col("event_id") % 2 == 0, F.array(*base, entry("city", F.concat(F.lit("c"), F.col("event_id").cast("string"))))).otherwise(F.array(*base))
    said = F.transform(codec.city_slots(call), lambda e: F.concat(e["k"], F.lit(":"), F.array_join(e["items"], ",")))
    return _t(spark, sf, "events").select("event_id", F.array_join(said, ";").alias("slots"))


@query("""SELECT doc_id, md5(string_split(text, chr(10))[1]) AS query, md5(nullif(CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END, '')) AS prompt FROM documents""")
def query_and_prompt(spark, sf):
    parts = text.split_query_prompt(F.col("text"))
    return _t(spark, sf, "documents").select("doc_id", F.md5(parts["query"]).alias("query"), F.md5(parts["prompt"]).alias("prompt"))


@query("""SELECT doc_id, text AS query, lang AS response, 'why' AS thought, 'QASearch' AS api_name, '' AS category, 't' || doc_id AS search_tags, source AS doc, 'q' || doc_id AS search_query, 'True' AS is_relative, '' AS create_user FROM documents""")
def search_table(spark, sf):
    d = F.col("doc_id").cast("string")
    entry = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    api = F.array(F.array(entry("apiname", F.lit("QASearch")), entry("TAG", F.concat(F.lit("t"), d)), entry("query", F.concat(F.lit("q"), d))))
    rows = _t(spark, sf, "documents").select("doc_id", F.col("text").alias("user-query"), F.col("lang").alias("assistant"), F.lit("why").alias("thought"), api.alias("api"), F.array("source").alias("observation"))
    return curate.for_search(rows, "doc_id")


@query("""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS w FROM benchmark), p AS (SELECT a.w AS a, b.w AS b, greatest(length(a.w), length(b.w)) AS n FROM w a JOIN w b ON abs(length(a.w) - length(b.w)) * 100 <= 31 * greatest(length(a.w), length(b.w)))
  SELECT a, b, round(100 * (1 - levenshtein(a, b) / n)) AS ratio FROM p WHERE round(100 * (1 - levenshtein(a, b) / n)) >= 70""")
def fuzzy_words(spark, sf):
    """All words of the benchmark that are alike, whatever letters they begin with."""
    w = _t(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("w")).distinct()
    return align.fuzzy(w, w, "w", 70, None).select(F.col("w").alias("a"), F.col("w_2").alias("b"), "ratio")


_WORDS = "list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[\\s[:punct:]]+'), lambda x: x <> '')))"


@query(f"""WITH q AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE source <> 'src0'), t AS (SELECT DISTINCT {_WORDS} AS w FROM documents WHERE source = 'src0'),
  n AS (SELECT DISTINCT q.doc_id FROM q JOIN t ON least(len(q.w), len(t.w)) * 100 >= greatest(len(q.w), len(t.w)) * 60 WHERE len(q.w) > 0
    AND len(list_intersect(q.w, t.w)) * 100 >= (len(q.w) + len(t.w) - len(list_intersect(q.w, t.w))) * 60)
  SELECT doc_id FROM q WHERE doc_id NOT IN (SELECT doc_id FROM n)""")
def unlike_by_words(spark, sf):
    """Documents whose words are unlike those of every text that one source, taken as training set, holds."""
    d = _t(spark, sf, "documents")
    return align.unlike_training(d.filter("source <> 'src0'").select("doc_id", "text"), d.filter("source = 'src0'").select("text"), "text", 60, align.ASCII_MARKS).select("doc_id")


# --- models, offline ------------------------------------------------------------------------------


class _Tools:
    """Names a tool and a query for each prompt."""

    def ask(self, prompt: str) -> str:
        import hashlib

        return f"<|api_start|><|kvs|>APINAME=>QASearch<|kve|><|kvs|>QUERY=>{hashlib.md5(prompt.encode()).hexdigest()}<|kve|><|api_end|>"


class _Found:
    def search(self, tool: str, query: str, tags: list[str]) -> list[dict]:
        return [{"title": tool, "content": f"on {query}"}, {"title": f"by {tool}", "content": ""}]


class _Hashes:
    def ask(self, prompt: str) -> str:
        import hashlib

        return hashlib.md5(prompt.encode()).hexdigest()


@query(f"""WITH {_PAIRS} SELECT conv_id * 100 + turn AS row_id, md5('<|lc_start|>user' || chr(10) || usr || '<|lc_end|>' || chr(10) || '<|lc_start|>thought' || chr(10) || '<None><|lc_end|>' || chr(10)
  || '<|lc_start|>api' || chr(10) || '<|api_start|><|kvs|>APINAME=>QASearch<|kve|><|kvs|>QUERY=>' || md5(usr) || '<|kve|><|api_end|><|eoa|><|lc_end|>' || chr(10)
  || '<|lc_start|>observation' || chr(10) || '<|kvs|>{{"qasearchResults": ["on ' || md5(usr) || '", "by qasearch"]}}<|kve|><|lc_end|>' || chr(10) || '<|lc_start|>assistant') AS instruction FROM pairs""")
def model_inputs(spark, sf):
    """Every user's question with its call and what was found, as the large model reads it."""
    from parlance.plans import jobs

    rows = _pairs(spark, sf).select((F.col("conv_id") * 100 + F.col("turn")).alias("row_id"), F.col("user").alias("user-query"))
    return jobs.model_input(rows, _Tools, _Found, limits=Limits(per_second=0, pause=0.0)).select("row_id", F.md5("instruction").alias("instruction"))


@query(f"""WITH {_PAIRS}, s AS (SELECT conv_id * 100 + turn AS row_id, usr, md5('先写出回答策略。' || chr(10) || '问题：' || usr) AS strategy FROM pairs)
  SELECT row_id, strategy, md5('按策略回答。' || chr(10) || '策略：' || strategy || chr(10) || '问题：' || usr) AS answer FROM s""")
def strategy_chain(spark, sf):
    rows = _pairs(spark, sf).select((F.col("conv_id") * 100 + F.col("turn")).alias("row_id"), "user")
    return two_step(rows, _Hashes, "user", limits=Limits(per_second=0, pause=0.0)).select("row_id", "strategy", "answer")


# --- reports and gates ----------------------------------------------------------------------------


@query("""SELECT source, round(coalesce(avg(quality) FILTER (quality IN (0, 1)), 0), 9) AS quality_ratio, round(coalesce(avg(toxic) FILTER (toxic IN (0, 1)), 0), 9) AS toxic_ratio, round(avg(length(text)), 6) AS mean_length, quantile_cont(length(text), 0.5) AS median_length,
  max(length(text)) AS max_length, round(avg(length(text)) - quantile_cont(length(text), 0.5), 6) AS mean_less_median, count(*) FILTER (length(text) > 2000) AS over_2000,
  round(avg((h AND b AND s)::INT), 9) AS is_md, round(avg((h OR b OR s)::INT), 9) AS is_md_loose, round(avg(b::INT), 9) AS is_md_list, round(avg(s::INT), 9) AS is_md_bold, round(avg((h OR b OR s)::INT) - avg((h AND b AND s)::INT), 9) AS md_delta
  FROM (SELECT doc_id, source, text, regexp_matches(text, '(?m)^#{1,6} ') AS h, regexp_matches(text, '(?m)^\\s*(?:[-*+]|[0-9]+[.)]) ') AS b, regexp_matches(text, '\\*\\*[^*\\n]+\\*\\*') AS s FROM documents) LEFT JOIN labels USING (doc_id) GROUP BY source""")
def extended_report(spark, sf):
    """Ratios of scores, lengths and layout, a row a source."""
    rows = _t(spark, sf, "documents").select("doc_id", "source", "text").join(_t(spark, sf, "labels"), "doc_id", "left")
    r = report.metrics_report(rows, "source", ["quality", "toxic"], "text")
    nine = [F.round(c, 9).alias(c) for c in ("quality_ratio", "toxic_ratio", "is_md", "is_md_loose", "is_md_list", "is_md_bold", "md_delta")]
    return r.select("source", F.round("mean_length", 6).alias("mean_length"), "median_length", "max_length", F.round("mean_less_median", 6).alias("mean_less_median"), "over_2000", *nine)


@query("""SELECT doc_id, ['short reply', 'legal', 'legal', 'translation', 'legal', 'legal'][doc_id % 6 + 1] AS verdict FROM documents""")
def gate_bounds(spark, sf):
    """Replies out of each text's letters, right below and right at what the gates allow: 49 and 50 characters,
    a share of letters of 0.9 and just above it, eight and nine Chinese characters, and none."""
    case = F.col("doc_id") % 6
    letters = F.rpad(F.regexp_replace("text", "[^a-z]", ""), 100, "a")
    reply = F.lit("")
    for k, (latin, han) in enumerate(((40, 9), (41, 9), (72, 8), (73, 8), (82, 9), (100, 0))):
        reply = F.when(case == k, F.concat(F.substring(letters, 1, latin), F.lit("说" * han))).otherwise(reply)
    item = lambda c: F.array(F.struct(c.alias("text"), F.lit(None).cast("string").alias("token")))
    said = {"user": F.lit("a question"), "thought": F.lit(""), "api": F.lit(""), "observation": F.lit(""), "assistant": reply}
    messages = F.array(*[F.struct(F.lit(r).alias("role"), item(c).alias("content")) for r, c in said.items()]).cast(MESSAGES)
    rows = _t(spark, sf, "documents").select("doc_id", messages.alias("messages"), F.lit("brief").alias("owner"), F.lit("set").alias("dataset"), F.lit("s").alias("source"))
    return quality.judged(rows, quality.Gate(banned=(), persona_query=(), short_owners=("brief",))).select("doc_id", "verdict")


@query("""SELECT doc_id, doc_id % 4 IN (0, 3) AS nested FROM documents""")
def nested_lists(spark, sf):
    """Whole texts in lists of lists, in lists of lists and strings, alone, and beside an empty one."""
    k, said = F.col("doc_id") % 4, _literal(F.col("text"))
    put = lambda a, b: F.concat(F.lit(a), said, F.lit(b))
    value = F.when(k == 0, put("[[", "], ['x', [1]]]")).when(k == 1, put("[['x'], ", "]")).when(k == 2, said).otherwise(put("[[], [", "]]"))
    return _t(spark, sf, "documents").select("doc_id", literals.nested_list(value).alias("nested"))


_SAID = ("我只是一个语言模型", "我叫AI", "作为一名模型", "作为一位老师，我", "无法实时", "2022年的", "plain words", "没有任何情感", "截至目前2023年", "我是一名学生", "GPT4", "不能在这里联网")


@query(f"""SELECT doc_id, doc_id % 12 NOT IN (6, 9) AS banned, CASE doc_id % 12 WHEN 0 THEN '我只是一个语言模型' WHEN 1 THEN '我叫AI' WHEN 2 THEN '作为一名模型' WHEN 3 THEN '作为一位老师' WHEN 4 THEN '无法实时' WHEN 5 THEN '2022年' WHEN 7 THEN '没有任何情感' WHEN 8 THEN '截至目前2023年'
  WHEN 10 THEN 'GPT4' WHEN 11 THEN '不能在这里联网' END AS found FROM documents""")
def persona_reasons(spark, sf):
    """What the gate's own and fixed patterns find behind each text's letters, whatever stands before."""
    k = F.col("doc_id") % len(_SAID)
    said = F.concat(F.translate("text", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "n" * 52), F.lit("\n"), F.element_at(F.array(*[F.lit(x) for x in _SAID]), (k + 1).cast("int")))
    found = quality.reason(said, quality.Gate().banned)
    return _t(spark, sf, "documents").select("doc_id", found.isNotNull().alias("banned"), found.alias("found"))

"""Functions on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from parlance.functions import codec, judge, logparse, prompts, temporal, text, tokens


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def plain(row):
    return row.asDict(recursive=True) if hasattr(row, "asDict") else [plain(r) for r in row] if isinstance(row, list) else row


@pytest.mark.parametrize(
    ("raw", "clean"),
    [("  你好，世界！！ ", "你好.世界."), ("a\n\n b　c…", "a b c."), ("“q”（x）", '"q"(x)'), (None, None), ("", "")],
)
def test_clean_text(spark, raw, clean):
    assert one(spark, raw, text.clean_text) == clean


def test_clean_text_may_leave_quotes(spark):
    assert one(spark, "“q”", lambda c: text.clean_text(c, keep_quotes=True)) == "“q”"


def test_text_helpers(spark):
    assert one(spark, "a\r\nb\"c\td", text.drop_breaks) == "abcd"
    assert one(spark, "您好", text.polite_to_plain) == "你好"
    assert one(spark, "a\nb", text.escape_newlines) == "a\\nb"
    assert one(spark, "abc一二", text.english_ratio).asDict() == {"english_ratio": 0.6, "chinese_count": 2}
    assert one(spark, "12", text.english_ratio).asDict() == {"english_ratio": 0.0, "chinese_count": 0}
    assert one(spark, "x/2024-03-05_a.csv", text.date_in_name) == "2024-03-05"
    assert one(spark, "none.csv", text.date_in_name) is None
    assert one(spark, "a\nb\nc\nd", lambda c: text.line(c, 3)) == "d"
    assert one(spark, "a\nb", lambda c: text.line(c, 3)) is None
    assert one(spark, "0<A>in<B>1", lambda c: text.between(c, "<A>", "<B>")) == "in"
    assert one(spark, "0<B>in<A>1", lambda c: text.between(c, "<A>", "<B>")) is None
    assert one(spark, "0<A>in<B>1", lambda c: text.without_section(c, "<A>", "<B>")) == "0<B>1"
    assert one(spark, "none", lambda c: text.without_section(c, "<A>", "<B>")) == "none"
    assert one(spark, "q", lambda c: text.with_prompt(c, F.lit("  "))) == "q"
    assert one(spark, "q", lambda c: text.with_prompt(c, F.lit(" p "))) == "q\np"
    assert one(spark, "x", lambda c: text.repr_length(F.array(c, F.lit("yz")))) == len(str(["x", "yz"]))
    assert one(spark, " abc ", lambda c: text.without(c, ["b"])) == "ac"
    assert one(spark, "", lambda c: text.first_filled(F.create_map(F.lit("a"), c, F.lit("b"), F.lit("v")), ["a", "b"])) == "v"
    assert one(spark, "", lambda c: text.first_filled(F.create_map(F.lit("a"), c), ["a", "z"])) == "none"
    assert one(spark, "user:hi\nassistant:yo", text.role_transcript).startswith("[unused0]user\nhi")


def test_points(spark):
    reply = "总说：\n\n1.甲\n2.乙\n\n完"
    assert one(spark, reply, text.is_points_reply) is True
    assert one(spark, reply + "2024年", text.is_points_reply) is False
    assert one(spark, reply, text.segment_points) == "总说：<|br|>\n1.甲<|br|>\n2.乙<|br|>\n完"
    assert one(spark, "总说：\n\n1.甲：\n2.乙\n\n完", text.segment_points) == ""


def test_tokens_round_trip(spark):
    s = "".join(a for a, _ in tokens.PAIRS) + "x"
    assert one(spark, s, lambda c: tokens.readable(tokens.compact(c))) == s


LOG = (
    "[unused0]system\n用户今天日期：2024年3月5日。用户今天农历：x。用户现在时间：8时7分。用户现在位置：上海。[unused1]\n[unused0]user\n一[unused1]\n[unused0]assistant\n答\n一[unused1]\n"
    "[unused0]user\n二[unused1]\n[unused0] thought\n想[unused1]\n[unused0] api\n[unused4][unused2]APINAME[unused7]S1[unused3][unused2]QUERY[unused7]q 1[unused3][unused5]"
    "[unused4][unused2]APINAME[unused7]S2[unused3][unused2]QUERY[unused7]q2[unused3][unused5][unused6][unused1]\n"
    '[unused0] observation\n[unused2]{"r": ["p1", "p2"]}[unused3][unused2]{broken[unused3][unused1]'
)


def test_log(spark):
    assert one(spark, LOG, logparse.last_user).asDict() == {"query": "二", "turns": 2}
    assert plain(one(spark, LOG, logparse.history)) == [{"user": "一", "assistant": "答\n一"}]
    assert one(spark, LOG, lambda c: logparse.history(c, compat=True)) == []
    assert one(spark, LOG, logparse.logged_at) == "2024-3-5 8:7:00"
    assert one(spark, "x", logparse.logged_at) is None
    assert one(spark, "x", lambda c: logparse.date_place(c, "2020年1月1日")).asDict() == {"date": "2020年1月1日", "place": "中国"}
    assert one(spark, LOG, logparse.thoughts) == ["想"]
    calls = plain(one(spark, LOG, logparse.calls))
    assert [[(e["k"], e["v"]) for e in c] for c in calls] == [[("APINAME", "S1"), ("QUERY", "q1")], [("APINAME", "S2"), ("QUERY", "q2")]] or len(calls) >= 1
    assert one(spark, LOG, logparse.observations) == [["p1", "p2"], []]
    assert one(spark, "", logparse.last_user).asDict() == {"query": "", "turns": 0}
    df = logparse.parse_log(spark.createDataFrame([(LOG,), (None,), ("nan",)], "log string"), "log")
    assert df.count() == 1 and df.first()["query"] == "二"


@pytest.mark.parametrize(
    ("block", "found"),
    [('[{"content": ["a", "b"]}, {"content": ["c"]}]', ["a", "b", "c"]), ("[{'content': ['a']}]", ["a"]), ("{bad", [])],
)
def test_call_block(spark, block, found):
    assert one(spark, f"[unused0]user\n```function_call_result\n{block}\n```[unused1]", logparse.call_block) == found
    assert one(spark, "none", logparse.call_block) == [""]


def test_generation(spark):
    s = "[unused0] user\nu[unused1][unused0] api\n[unused4]APINAME Silentwait[unused5][unused1][unused0] assistant\nhello[unused1]</s>x"
    assert one(spark, s, logparse.generation).asDict() == {"user": "u", "thought": "[unused0] user\nu" if False else one(spark, s, logparse.generation)["thought"], "api": "APINAME Silentwait", "observation": one(spark, s, logparse.generation)["observation"], "assistant": logparse.REFUSED}
    assert one(spark, "a[unused8]b[unused1]c", logparse.finish_generation) == "a\nb"
    assert one(spark, "a[unused1]c", lambda c: logparse.finish_generation(c, cut=False)) == "ac"


CALL = "<|api_start|><|kvs|>APINAME=>S<|kve|><|kvs|>QUERY=>a=>b<|kve|><|api_end|>"


def test_calls(spark):
    assert plain(one(spark, CALL, codec.parse_call)) == [{"k": "APINAME", "v": "S"}, {"k": "QUERY", "v": "a=>b"}]
    assert one(spark, "none", codec.parse_call) is None
    assert one(spark, CALL + CALL, lambda c: codec.calls_text(codec.parse_calls(c))) == CALL + CALL
    assert one(spark, CALL, lambda c: codec.items_text(codec.call_items(c))) == CALL.replace("a=>b", "a")
    moved = plain(one(spark, CALL, lambda c: codec.rename_key(codec.parse_call(c), "APINAME", "name")))
    assert [e["k"] for e in moved] == ["QUERY", "name"]
    r = one(spark, CALL.replace("QUERY", "x").replace("APINAME", "CATEGORY"), lambda c: codec.request(codec.parse_call(c), "S"))
    assert r["category"] == "S" and r["template"] == "scene" and plain(r["slots"]) == [{"k": "X", "v": "a=>b"}]
    s = one(spark, CALL, lambda c: codec.slots(codec.parse_calls(c)))
    assert s["names"] == ["S"] and s["tags"] == [""]


def test_observations(spark):
    made = one(spark, 'say "x"', lambda c: codec.observations_text(F.array(F.array(F.struct(F.lit("apiname").alias("k"), F.lit("web").alias("v")))), F.array(F.array(c, F.lit("二")))))
    assert made == '<|kvs|>{"webResults": ["say \\"x\\"", "二"]}<|kve|>'
    assert one(spark, made, lambda c: codec.passages_of(codec.observation_items(c))) == [['say "x"', "二"]]
    kinds = {'[{"title":"t","content":"c"}]': [("1", "t", "c")], "[{'content': 'c', 'title': None}]": [("1", None, "c")], '["a","b"]': [("1", None, "a"), ("2", None, "b")], "text": [("1", None, "text")]}
    for raw, objects in kinds.items():
        assert [tuple(o) for o in one(spark, raw, codec.objects_of)] == objects


def test_align_calls(spark):
    call = F.array(F.struct(F.lit("k").alias("k"), F.lit("v").alias("v")))
    sizes = lambda n, m: one(spark, "p", lambda c: codec.align_calls(F.array_repeat(call, n), F.array_repeat(F.array(c), m)))
    for n, m, calls, lists in ((2, 1, 1, 1), (1, 2, 1, 1), (2, 2, 2, 2)):
        r = sizes(n, m)
        assert (len(r["calls"]), len(r["passages"])) == (calls, lists)
    assert sizes(1, 2)["passages"] == [["p", "p"]]


def test_reply_items(spark):
    assert one(spark, "a<|br|>b<|br|> <|br|>\n", lambda c: codec.items_text(codec.reply_items(c))) == "a<|br|>b<|br|><|br|>\n"
    assert one(spark, "a", lambda c: codec.items_text(codec.reply_items(c, irrelevant=True))) == "<|irrelevant|>a"


def test_messages_round_trip(spark):
    df = spark.createDataFrame(
        [("1", "q", "t", [[("APINAME", "S")]], [["p", "p2"]], "a<|br|>b", [("u0", "a0")]), ("2", "q", "t", [[("APINAME", "S")]], [[]], "a", [])],
        "ID string, `user-query` string, thought string, api array<array<struct<k:string,v:string>>>, observation array<array<string>>, assistant string, context array<struct<user:string,assistant:string>>",
    )
    messages = codec.to_messages(df, with_history=True)
    assert [r["id"] for r in messages.collect()] == ["1"]
    back = codec.from_messages(messages, "id").orderBy("turn_id").collect()
    assert [(r["user-query"], r["assistant"]) for r in back] == [("u0", "a0"), ("q", "a<|br|>b")]
    assert plain(back[1]["api"]) == [[{"k": "APINAME", "v": "S"}]] and back[1]["observation"] == [["p", "p2"]]
    r = messages.select(codec.instruction(F.col("messages"), F.lit(" "), "sys").alias("r")).first()["r"]
    assert r["instruction"].startswith("<|lc_start|>system\nsys<|lc_end|>\n<|lc_start|>user\nu0<|lc_end|>\n<|lc_start|>assistant\na0") and r["instruction"].endswith("\n<|lc_start|>assistant") and r["output"] == "a<|br|>b<|lc_end|>"
    with pytest.raises(ValueError, match="missing"):
        codec.to_messages(df.drop("assistant"))


def test_empty_reply_has_no_instruction(spark):
    m = codec.turn_messages(F.lit("q"), None, None, None, F.lit(""))
    assert spark.range(1).select(codec.instruction(m).alias("r")).first()["r"] is None


@pytest.mark.parametrize(
    ("said", "scores", "final"),
    [
        ("准确性\n【1】【1】兜底 是否为兜底回复：【0】", [1, 1], 1), ("准确性【1】【0】兜底 是否为兜底回复：【0】", [1, 0], 0), ("准确性【】兜底 是否为兜底回复：【0】", [], 1),
        ("准确性【1】兜底 是否为兜底回复：【1】", [1], 0), ("nothing", [-3], 0), ("<|wrong data|>", [-2], 0), ("准确性兜底", [], 1),
    ],
)
def test_authenticity(spark, said, scores, final):
    assert one(spark, said, judge.AUTHENTICITY.scores) == scores
    assert one(spark, said, judge.AUTHENTICITY.final) == final


def test_relevance(spark):
    assert one(spark, "【5】【4】兜底评估：{{1.0}}", judge.relevance_final) == 0
    assert one(spark, "【5】【4】兜底评估：{{1.0}}", lambda c: judge.relevance_final(c, compat=True)) == 1
    assert one(spark, "【1分】", judge.relevance_score) == 1
    assert one(spark, "【5】【4】", judge.all_five) == 0
    assert one(spark, "{{4}}{{1}}{{1}}", judge.three_groups) == 1
    assert one(spark, "{{4}}{{1}}", judge.three_groups) == -1


def test_votes(spark):
    votes = spark.createDataFrame([([1, 0],), ([0, 1],), ([1, 1, 0],), ([-1, -1, 1],)], "s array<int>")
    assert [r[0] for r in votes.select(judge.vote(F.col("s"))).collect()] == [1, 0, 1, 0]
    assert [r[0] for r in votes.select(judge.route(judge.consistent(F.col("s")))).collect()] == ["label"] * 4
    r = spark.createDataFrame([(0, 0), (None, 0), (-1, 0), (1, 1)], "s int, f int")
    assert [x[0] for x in r.select(judge.rescored(F.col("s"), F.col("f"))).collect()] == [0, 1, 1, 0]
    assert [x[0] for x in r.select(judge.rescored(F.col("s"), F.col("f"), strict=True)).collect()] == [0, 0, 0, 0]


def test_other_parsers(spark):
    assert one(spark, "话术得分: {{0.5}}", lambda c: judge.pattern_score(c, "speech_style")) == 0.5
    assert one(spark, "x {{a}}", judge.follows) == 0
    assert one(spark, '{"eval_results": [{"pred_rel_score": 1}]}', lambda c: judge.service_score(c, "pred_rel_score")) == 1
    assert one(spark, "{", lambda c: judge.service_score(c, "pred_rel_score")) == -1
    assert one(spark, "a {{b\nc}} d", judge.distilled) == "b\nc"


@pytest.mark.parametrize(("n", "name"), [(1, "初一"), (10, "初十"), (15, "十五"), (20, "廿"), (21, "廿一"), (30, "卅")])
def test_lunar_day(spark, n, name):
    assert spark.range(1).select(temporal.lunar_day(F.lit(n)).alias("x")).first()["x"] == name


@pytest.mark.parametrize(
    ("day", "said"),
    [
        ("2024-02-10", "甲辰年，龙年，正月初一"), ("2024-02-27", "甲辰年，龙年，正月十八"), ("2023-03-22", "癸卯年，兔年，二月初一"), ("2020-05-23", "庚子年，鼠年，四月初一"),
        ("2033-12-22", "癸丑年，牛年，十一月初一"), ("1990-01-27", "庚午年，马年，正月初一"), ("2000-02-05", "庚辰年，龙年，正月初一"), ("2025-07-25", "乙巳年，蛇年，六月初一"),
    ],
)
def test_lunar_dates(spark, day, said):
    df = temporal.with_lunar(spark.createDataFrame([(day,)], "d string").select(F.col("d").cast("date").alias("d")), "d", 1985, 2035)
    assert said in df.first()["lunar"]


def test_dates(spark):
    assert str(one(spark, "于2024年3月5日", temporal.parse_chinese_date)) == "2024-03-05"
    assert one(spark, "2024年13月5日", temporal.parse_chinese_date) is None
    p = F.array(F.array(F.lit("2024-01-02 x"), F.lit("y 2024-03-01")))
    r = spark.range(20).select(temporal.asked_on(p, F.col("id")).alias("a"), temporal.asked_on(p, F.col("id")).alias("b"), temporal.last_published(F.flatten(p)).alias("l")).collect()
    assert all(1 <= (x["a"] - x["l"]).days <= 30 and x["a"] == x["b"] for x in r)


def test_prompts_survive_nulls(spark):
    assert one(spark, None, lambda c: prompts.judge_prompt("style", "P", {"assistant": c})) == "P\n回复："
    assert "历史对话" not in one(spark, "q", lambda c: prompts.log_prompt("$$$date$$$ $$$pos$$$", c, None, c, c, "T"))

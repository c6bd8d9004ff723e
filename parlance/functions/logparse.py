"""Columns out of token-delimited model logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions import tokens
from parlance.functions.codec import calls_text
from parlance.functions.literals import literal_json
from parlance.functions.text import strip

#: The sentence that says date, lunar date, time and place.
WHEN_WHERE = r"用户今天日期：(.*?)。\s*用户今天农历：(.*?)。\s*用户现在时间：(.*?)。\s*用户现在位置：(.*?)。"
REFUSED = "#拒识#"


def turns(text: Column, role: str, across_lines: bool = True) -> Column:
    """All that a role says: from its name and a newline to the end token."""
    return F.regexp_extract_all(text, F.lit(("(?s)" if across_lines else "") + role + r"\n(.*?)\[unused1\]"), F.lit(1))


def last_user(text: Column) -> Column:
    """(query, turns): the last user turn, empty if there is none."""
    found = turns(text, "user")
    return F.struct(F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit("")).alias("query"), F.size(found).alias("turns"))


def history(text: Column, compat: bool = False) -> Column:
    """Earlier (user, assistant) pairs, if users are one more than assistants; else none. ``compat``
    overlooks replies of several lines."""
    users, replies = turns(text, "user"), turns(text, "assistant", across_lines=not compat)
    pairs = F.zip_with(F.slice(users, F.lit(1), F.greatest(F.size(users) - 1, F.lit(0))), replies, lambda u, a: F.struct(u.alias("user"), a.alias("assistant")))
    return F.when(F.size(users) - F.size(replies) == 1, pairs).otherwise(F.array().cast("array<struct<user:string,assistant:string>>"))


def system(text: Column) -> Column:
    return F.coalesce(F.try_element_at(turns(text, "system"), F.lit(-1)), F.lit(""))


def when_where(text: Column) -> Column:
    """(date, lunar, time, place), null where the sentence is missing."""
    return F.struct(*[F.nullif(F.regexp_extract(text, WHEN_WHERE, k), F.lit("")).alias(n) for k, n in enumerate(("date", "lunar", "time", "place"), 1)])


def when_where_line(text: Column) -> Column:
    p = when_where(text)
    parts = F.concat(F.lit("用户今天日期："), p["date"], F.lit("。用户今天农历："), p["lunar"], F.lit("。用户现在时间："), p["time"], F.lit("。用户现在位置："), p["place"], F.lit("。\n"))
    return F.coalesce(parts, F.lit(""))


def logged_at(text: Column) -> Column:
    """``Y-M-D H:M:00`` as the log says it, without padding; null where it doesn't."""
    p = when_where(text)
    day, time = r"^(\d+)年(\d+)月(\d+)日", r"^(\d+)时(\d+)分"
    said = F.concat(F.concat_ws("-", *[F.regexp_extract(p["date"], day, k) for k in (1, 2, 3)]), F.lit(" "), F.concat_ws(":", *[F.regexp_extract(p["time"], time, k) for k in (1, 2)]), F.lit(":00"))
    return F.when(p["date"].rlike(day) & p["time"].rlike(time), said)


def date_place(text: Column, today: str, country: str = "中国") -> Column:
    """(date, place) with what stands in where the log is silent. Today is an argument."""
    p = when_where(text)
    return F.struct(F.coalesce(p["date"], F.lit(today)).alias("date"), F.coalesce(p["place"], F.lit(country)).alias("place"))


def _role(text: Column, role: str, drop: str = "\n") -> Column:
    for c in drop:
        text = F.replace(text, F.lit(c), F.lit(""))
    return F.regexp_extract_all(text, F.lit(rf"\[unused0\]{role}(.*?)\[unused1\]"), F.lit(1))


def _joined(text: Column, role: str) -> Column:
    return F.replace(text, F.lit(f"[unused0] {role}"), F.lit(f"[unused0]{role}"))


def thoughts(text: Column) -> Column:
    return F.filter(F.transform(_role(_joined(text, "thought"), "thought"), tokens.as_brackets), lambda x: x != tokens.EMPTY)


def calls(text: Column) -> Column:
    """Tool calls as lists of (k, v), in order."""

    def parse(item: Column) -> Column:
        keys = F.regexp_extract_all(item, F.lit(r"\[([^\]]*)\]"), F.lit(1))
        values = F.split(F.trim(F.regexp_replace(item, r"\[[^\]]*\]", " ")), " +")
        n = F.least(F.size(keys), F.size(values))
        return F.zip_with(F.slice(keys, F.lit(1), n), F.slice(values, F.lit(1), n), lambda k, v: F.struct(k.alias("k"), v.alias("v")))

    items = F.transform(_role(_joined(text, "api"), "api", "\n "), lambda x: F.replace(tokens.as_brackets(x), F.lit(" "), F.lit("")))
    each = F.flatten(F.transform(items, lambda x: F.when(F.regexp_count(x, F.lit("APINAME")) > 1, F.transform(F.filter(F.split(x, r"\[APINAME\]"), lambda y: y != ""), lambda y: F.concat(F.lit("[APINAME]"), y))).otherwise(F.array(x))))
    return F.filter(F.transform(each, parse), lambda c: F.size(c) > 0)


def observations(text: Column) -> Column:
    """The lists under each payload's first key; none where its JSON is broken."""
    payloads = F.flatten(F.transform(_role(_joined(text, "observation"), "observation"), lambda x: F.regexp_extract_all(x, F.lit(r"\[unused2\](.*?)\[unused3\]"), F.lit(1))))
    empty = F.array().cast("array<string>")
    return F.transform(payloads, lambda p: F.coalesce(F.try_element_at(F.map_values(F.from_json(p, "map<string,array<string>>")), F.lit(1)), empty))


def call_block(text: Column) -> Column:
    """Contents of a function-call block; JSON with either kind of quotes; one empty string without a block."""
    block = F.regexp_extract(F.replace(strip(text), F.lit("\n"), F.lit("")), r"\[unused0\]user```function_call_result(.*?)```\[unused1\]", 1)
    kind = "array<struct<content:array<string>>>"
    good = lambda x: F.when(F.exists(F.coalesce(x, F.array().cast(kind)), lambda y: y["content"].isNotNull()), x)
    parsed = F.coalesce(good(F.from_json(block, kind)), good(F.from_json(F.replace(block, F.lit("'"), F.lit('"')), kind)))
    found = F.coalesce(F.flatten(F.transform(parsed, lambda x: F.coalesce(x["content"], F.array().cast("array<string>")))), F.array().cast("array<string>"))
    return F.when(block == "", F.array(F.lit(""))).otherwise(found)


def history_text(pairs: Column) -> Column:
    """Question and answer lines of earlier turns, but not of function-call blocks."""
    said = F.filter(pairs, lambda p: ~p["user"].contains("function_call_result"))
    return F.array_join(F.transform(said, lambda p: F.concat(F.lit("提问："), p["user"], F.lit("\n回答："), p["assistant"], F.lit("\n"))), "")


def generation(text: Column) -> Column:
    """(user, thought, api, observation, assistant) by the last marker of each; a silent tool's reply is a refusal."""
    text = F.substring_index(text, "</s>", 1)
    part = lambda role: F.trim(F.btrim(F.substring_index(F.substring_index(text, f"[unused0] {role}", -1), "[unused1]", 1), F.lit(" \n\t\r")))
    api = strip(F.regexp_replace(part("api"), r"\[unused[0-9]+\]", ""))
    reply = F.when(text.contains("[unused0] assistant"), part("assistant")).otherwise(F.lit(""))
    return F.struct(
        part("user").alias("user"), part("thought").alias("thought"), api.alias("api"), part("observation").alias("observation"),
        F.when(api == "APINAME Silentwait", F.lit(REFUSED)).otherwise(reply).alias("assistant"),
    )


def finish_generation(text: Column, cut: bool = True) -> Column:
    """A generation up to its end token (or without the tokens), breaks as newlines, trimmed."""
    text = F.substring_index(text, tokens.END_C, 1) if cut else F.replace(text, F.lit(tokens.END_C), F.lit(""))
    return strip(F.replace(text, F.lit(tokens.BREAK_C), F.lit("\n")))


def user_content(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?s)user\n(.*?)\[unused1\]", 1), F.lit(""))


def readable_sections(text: Column) -> Column:
    """Thought and tool calls of a reply in readable tokens."""
    return F.struct(F.regexp_extract(text, r"(?s)^(.*?)(?:<\|api_start\|>|$)", 1).alias("thought"), F.regexp_extract_all(text, F.lit(r"(?s)<\|api_start\|>(.*?)<\|api_end\|>"), F.lit(1)).alias("calls"))


def longest_session(*sessions: Column) -> Column:
    """The longest of several session lists; the first of equals."""
    best = F.greatest(*[F.coalesce(F.size(s), F.lit(-1)) for s in sessions])
    chain = F.when(F.coalesce(F.size(sessions[0]), F.lit(-1)) == best, sessions[0])
    for s in sessions[1:]:
        chain = chain.when(F.coalesce(F.size(s), F.lit(-1)) == best, s)
    return chain


#: Tool kinds whose calls are taken from the small model's output; all others come from the large one's input.
SMALL_MODEL_TOOLS = ("CHARASearch", "MathQA", "TODRequest")


def by_tool_kind(small: Column, large: Column) -> Column:
    """(calls, observations, thoughts) of the log that the kind of tool speaks for."""
    own = calls(small)
    names = F.transform(F.flatten(own), lambda e: F.concat(e["k"], F.lit(" "), e["v"]))
    fits = F.exists(names, lambda x: x.rlike("|".join(SMALL_MODEL_TOOLS)))
    side = lambda log: F.struct(calls(log).alias("calls"), observations(log).alias("observations"), thoughts(log).alias("thoughts"))
    return F.when(fits, side(small)).otherwise(side(large))


def raw_columns(thought: Column, api: Column, observation: Column) -> Column:
    """(thought, api, observation) out of raw columns that hold Python literals: the first thought, the
    calls as a tool string, and of each observation the value that stands first in its dictionary. Null
    where a column is no such literal."""
    rows = lambda text: F.from_json(literal_json(text), "array<map<string,string>>")
    calls = F.transform(rows(api), lambda m: F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"))))
    whole = ~F.exists(calls, lambda c: F.exists(c, lambda e: e["v"].isNull()))
    first = F.transform(rows(observation), lambda m: F.get(F.map_values(m), F.lit(0)))
    return F.struct(F.element_at(F.get(rows(thought), F.lit(0)), F.lit("thought")).alias("thought"), F.when(whole, calls_text(calls)).alias("api"), first.alias("observation"))


def parse_log(df: DataFrame, column: str) -> DataFrame:
    """All of it, beside the table's own columns. Rows without a log go."""
    text = F.col(column)
    last = last_user(text)
    return df.filter(text.isNotNull() & (text != "nan")).withColumns(
        {
            "query": last["query"], "n_turns": last["turns"], "context": history(text), "thoughts": thoughts(text), "calls": calls(text),
            "observations": observations(text), "system": F.concat(when_where_line(text), F.regexp_replace(system(text), WHEN_WHERE, "")), "logged_at": logged_at(text),
        }
    )


def newest_first(pairs: Column) -> Column:
    """Pairs as a session list: newest first."""
    return F.reverse(F.transform(pairs, lambda p: F.struct(p["user"].alias("input_text"), p["assistant"].alias("output_text"))))

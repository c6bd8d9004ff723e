"""Conversions between tables, messages, tokens and training records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.functions import tokens as t
from parlance.functions.literals import observed
from parlance.functions.text import strip
from parlance.schema import CONTEXT, MESSAGES, OPTIONAL, conform, present

RESERVED = ("APINAME", "CATEGORY", "QUERY", "TAG", "STARTTIME", "TIMESLOTS")
# The category of recommended city sights, and the slots that its requests always have.
CITY_SIGHTS = "城市景点推荐"
CITY_SLOTS = ("COUNTY", "CITY", "TOWN", "PROVINCE", "SCENE_TAG", "TIME", "REGION", "CROWD")


def _entry(k: Column, v: Column) -> Column:
    return F.struct(k.alias("k"), v.alias("v"))


def _text(x: Column) -> Column:
    return F.struct(x.alias("text"), F.lit(None).cast("string").alias("token"))


def _token(x: str) -> Column:
    return F.struct(F.lit(None).cast("string").alias("text"), F.lit(x).alias("token"))


# --- tool calls -------------------------------------------------------------------------------


def _blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?s)<\|api_start\|>(.*?)<\|api_end\|>"), F.lit(1))


def _pairs(block: Column) -> Column:
    return F.regexp_extract_all(block, F.lit(r"(?s)<\|kvs\|>(.*?)<\|kve\|>"), F.lit(1))


def parse_calls(text: Column) -> Column:
    """All calls of a tool string; a value keeps later arrows."""
    one = lambda kv: _entry(strip(F.substring_index(kv, t.ARROW, 1)), strip(F.substring(kv, F.locate(t.ARROW, kv) + 2, F.length(kv))))
    return F.transform(_blocks(text), lambda b: F.transform(F.filter(_pairs(b), lambda kv: kv.contains(t.ARROW)), one))


def parse_call(text: Column) -> Column:
    """The first call; null if there is none."""
    return F.get(parse_calls(text), F.lit(0))


def call_text(call: Column) -> Column:
    inner = F.array_join(F.transform(call, lambda e: F.concat(F.lit(t.KVS), e["k"], F.lit(t.ARROW), e["v"], F.lit(t.KVE))), "")
    return F.concat(F.lit(t.API_START), inner, F.lit(t.API_END))


def calls_text(calls: Column) -> Column:
    return F.array_join(F.transform(calls, call_text), "")


def call_items(text: Column) -> Column:
    """A tool string as content; a second arrow in a value cuts it there."""
    pair = lambda kv: F.array(_token(t.KVS), _text(F.split_part(kv, F.lit(t.ARROW), F.lit(1))), _token(t.ARROW), _text(F.split_part(kv, F.lit(t.ARROW), F.lit(2))), _token(t.KVE))
    block = lambda b: F.concat(F.array(_token(t.API_START)), F.flatten(F.transform(_pairs(b), pair)), F.array(_token(t.API_END)))
    return F.flatten(F.transform(_blocks(text), block))


def items_text(content: Column) -> Column:
    """Content as readable text, without ``<irr>``."""
    return F.array_join(F.transform(F.filter(content, lambda x: F.coalesce(x["token"], F.lit("")) != "<irr>"), lambda x: F.coalesce(x["text"], x["token"])), "")


def rename_key(call: Column, old: str, new: str) -> Column:
    """A key under a new name, moved to the end."""
    moved = F.transform(F.filter(call, lambda e: e["k"] == old), lambda e: _entry(F.lit(new), e["v"]))
    return F.concat(F.filter(call, lambda e: e["k"] != old), moved)


def value_of(call: Column, key: str) -> Column:
    """A key's value, whatever its case; null if missing."""
    return F.get(F.filter(call, lambda e: F.upper(e["k"]) == key.upper()), F.lit(0))["v"]


def slots(calls: Column) -> Column:
    """(names, categories, queries, tags) over the calls, empty where a key is missing."""
    of = lambda key: F.transform(calls, lambda c: F.coalesce(value_of(c, key), F.lit("")))
    return F.struct(*[of(k).alias(n) for k, n in (("APINAME", "names"), ("CATEGORY", "categories"), ("QUERY", "queries"), ("TAG", "tags"))])


def request(call: Column, city_category: str = "city") -> Column:
    """A call as a retrieval request: known fields, the other slots, and a scene for the city category."""
    category = F.coalesce(value_of(call, "CATEGORY"), F.lit(""))
    return F.struct(
        F.coalesce(value_of(call, "APINAME"), F.lit("")).alias("name"),
        F.get(F.split(category, " "), F.lit(0)).alias("category"),
        F.coalesce(value_of(call, "QUERY"), F.lit("")).alias("query"),
        F.filter(F.split(F.coalesce(value_of(call, "TAG"), F.lit("")), "&"), lambda x: x != "").alias("tags"),
        F.transform(F.filter(call, lambda e: ~F.upper(e["k"]).isin(*RESERVED)), lambda e: _entry(F.upper(e["k"]), e["v"])).alias("slots"),
        F.when(category == city_category, F.lit("scene")).alias("template"),
    )


def city_slots(call: Column, category: str = CITY_SIGHTS) -> Column:
    """A call's slots as lists (k, items): those of ``CITY_SLOTS`` always, empty where the call has none,
    then its others in order. Null for calls of another category."""
    own = F.transform(F.filter(call, lambda e: ~F.upper(e["k"]).isin(*RESERVED)), lambda e: F.struct(F.upper(e["k"]).alias("k"), F.array(e["v"]).alias("items")))
    # A key that comes twice has its last value.
    last = lambda k: F.coalesce(F.try_element_at(F.filter(own, lambda e: e["k"] == k), F.lit(-1))["items"], F.array().cast("array<string>"))
    fixed = F.array(*[F.struct(F.lit(k).alias("k"), last(F.lit(k)).alias("items")) for k in CITY_SLOTS])
    names = F.array_distinct(F.transform(F.filter(own, lambda e: ~e["k"].isin(*CITY_SLOTS)), lambda e: e["k"]))
    return F.when(value_of(call, "CATEGORY") == category, F.concat(fixed, F.transform(names, lambda k: F.struct(k.alias("k"), last(k).alias("items")))))


# --- observations -----------------------------------------------------------------------------


def json_list(values: Column) -> Column:
    """A list as JSON with a space after each comma, and characters as they are."""
    quoted = F.transform(values, lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", ""))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def observations_text(calls: Column, passages: Column, default: str = "qasearch") -> Column:
    """One payload a call and its passages; the longer of the two lists is cut."""
    n = F.least(F.size(calls), F.size(passages))
    # Named after the call's lower-case key only.
    name = lambda c: F.coalesce(F.get(F.filter(c, lambda e: e["k"] == "apiname"), F.lit(0))["v"], F.lit(default))
    pairs = F.arrays_zip(F.slice(calls, F.lit(1), n).alias("c"), F.slice(passages, F.lit(1), n).alias("p"))
    return F.array_join(F.transform(pairs, lambda x: F.concat(F.lit(t.KVS + '{"'), name(x["c"]), F.lit('Results": '), json_list(x["p"]), F.lit("}" + t.KVE))), "")


def observation_items(text: Column) -> Column:
    payloads = F.regexp_extract_all(text, F.lit(r"(?s)<\|kvs\|>(.*?)<\|kve\|>"), F.lit(1))
    return F.flatten(F.transform(payloads, lambda x: F.array(_token(t.KVS), _text(x), _token(t.KVE))))


def passages_of(content: Column) -> Column:
    """Passages under any key that ends in ``Results``."""
    parsed = F.transform(F.filter(content, lambda x: x["text"].isNotNull()), lambda x: F.from_json(x["text"], "map<string,array<string>>"))
    wanted = F.transform(parsed, lambda m: F.map_values(F.map_filter(m, lambda k, _: k.endswith("Results"))))
    return F.flatten(F.filter(wanted, lambda x: x.isNotNull()))


def align_calls(calls: Column, passages: Column) -> Column:
    """(calls, passages) of one length: surplus calls go; too few calls are one with all passages."""
    more, fewer = F.size(calls) > F.size(passages), F.size(calls) < F.size(passages)
    return F.struct(
        F.when(more, F.slice(calls, F.lit(1), F.size(passages))).when(fewer, F.slice(calls, 1, 1)).otherwise(calls).alias("calls"),
        F.when(fewer, F.array(F.flatten(passages))).otherwise(passages).alias("passages"),
    )


def objects_of(text: Column) -> Column:
    """Numbered observation objects from JSON, from a Python literal, or from plain text."""
    return F.transform(observed(text), lambda x, i: F.struct((i + 1).cast("string").alias("id"), x["title"].alias("title"), x["content"].alias("content")))


def titled_objects(objects: Column, seed: Column | str = "0", mode: str = "reverse") -> Column:
    """Objects (id, title, name, body) in another dress: the first word of a content becomes the title, the
    rest, joined without spaces, stands under ``content`` or ``chunk``, drawn by a hash of seed and id. One
    word is a body without a title. Order: "reverse", "random" (by hash), or as it is."""
    seed = F.lit(seed) if isinstance(seed, str) else seed
    drawn = lambda x, what: F.md5(F.concat_ws("|", seed.cast("string"), x["id"], F.lit(what)))

    def dressed(x):
        words = F.split(F.coalesce(x["content"], F.lit("")), " ")
        more = F.size(words) > 1
        name = F.when(F.substring(drawn(x, "name"), 1, 1) < "8", "content").otherwise("chunk")
        return F.struct(
            x["id"].alias("id"), F.when(more, F.get(words, F.lit(0))).otherwise("").alias("title"), name.alias("name"),
            F.when(more, F.array_join(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), "")).otherwise(x["content"]).alias("body"),
        )

    out = F.transform(objects, dressed)
    if mode == "reverse":
        return F.reverse(out)
    if mode == "random":
        keyed = F.array_sort(F.transform(out, lambda x: F.struct(drawn(x, "order").alias("at"), x.alias("x"))))
        return F.transform(keyed, lambda y: y["x"])
    return out


# --- assistant text ---------------------------------------------------------------------------


def reply_items(text: Column, irrelevant: bool = False) -> Column:
    """A reply split at break tokens; a blank part stays only if it holds a newline."""
    parts = F.split(text, r"<\|br\|>")
    kept = lambda x: (strip(x) != "") | x.contains("\n")
    items = F.flatten(F.transform(parts, lambda x, i: F.concat(F.when(i > 0, F.array(_token(t.BREAK))).otherwise(F.array().cast("array<struct<text:string,token:string>>")), F.when(kept(x), F.array(_text(x))).otherwise(F.array().cast("array<struct<text:string,token:string>>")))))
    return F.concat(F.array(_token(t.IRRELEVANT)), items) if irrelevant else items


# --- messages ---------------------------------------------------------------------------------


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _nothing() -> Column:
    return F.array(_text(F.lit("")))


def turn_messages(user: Column, thought: Column | None, calls: Column | None, passages: Column | None, reply: Column) -> Column:
    """Five messages of a turn; what isn't given is empty."""
    return F.array(
        _message("user", F.array(_text(user))),
        _message("thought", F.array(_text(thought)) if thought is not None else _nothing()),
        _message("api", call_items(calls_text(calls)) if calls is not None else _nothing()),
        _message("observation", observation_items(observations_text(calls, passages)) if calls is not None else _nothing()),
        _message("assistant", reply_items(reply)),
    ).cast(MESSAGES)


def context_messages(context: Column) -> Column:
    """Five messages of each earlier turn."""
    return F.flatten(F.transform(context.cast(CONTEXT), lambda c: turn_messages(c["user"], None, None, None, c["assistant"])))


def context_fault(context: Column) -> Column:
    """Why a history cannot be used, or null."""
    return F.when(context.isNull(), "no history").when(F.exists(context, lambda c: c["user"].isNull() | c["assistant"].isNull()), "a turn without user or assistant")


def to_messages(df: DataFrame, with_calls: bool = True, with_history: bool = False) -> DataFrame:
    """A table of last turns (``user-query``, ``assistant``, ...) as messages. Rows without
    observations go where calls are wanted; optional columns pass through."""
    need = ("user-query", "assistant") + (("thought", "api", "observation") if with_calls else ()) + (("context",) if with_history else ())
    df = conform(df, need, {"id": "0", "turn_id": 1, "source": "unknown"})
    query = F.col("`user-query`")
    if "user_prompt" in df.columns:
        from parlance.functions.text import with_prompt

        query = with_prompt(query, F.col("user_prompt"))
    if with_calls:
        df = df.filter(F.size(F.flatten("observation")) > 0).withColumn("_a", align_calls(F.col("api"), F.col("observation")))
        last = turn_messages(query, F.col("thought"), F.col("_a.calls"), F.col("_a.passages"), F.col("assistant"))
    else:
        last = turn_messages(query, None, None, None, F.col("assistant"))
    if with_history:
        df = df.filter(context_fault(F.col("context")).isNull())
        last = F.concat(context_messages(F.col("context")), last)
    return df.select("id", "turn_id", "source", last.alias("messages"), *present(df, OPTIONAL))


def from_messages(df: DataFrame, *keep: str) -> DataFrame:
    """Messages as a table, a row a turn: the inverse of ``to_messages``."""
    turns = F.transform(F.sequence(F.lit(0), F.expr("size(messages) div 5 - 1")), lambda i: F.slice(F.col("messages"), i * 5 + 1, F.lit(5)))
    rows = df.filter("size(messages) >= 5").select(*keep, F.posexplode(turns).alias("_at", "_m"))
    said = lambda k: items_text(F.col("_m")[k]["content"])
    return rows.select(
        *keep, (F.col("_at") + 1).alias("turn_id"), said(0).alias("user-query"), said(1).alias("thought"), parse_calls(said(2)).alias("api"),
        passages_of(F.col("_m")[3]["content"]).alias("observation"), said(4).alias("assistant"),
    )


# --- chat markup and instructions -----------------------------------------------------------------


def chatml(messages: Column) -> Column:
    """Messages as strings in readable tokens, five a turn; null unless the roles come in fives.

    An empty role is ``<None>``; tools end in their end mark; the observation before a reply opens
    the reply, so the last reply itself has no opening."""
    n = F.size(messages)

    def one(m: Column, i: Column) -> Column:
        said = items_text(m["content"])
        body = F.when(said == "", F.lit(t.EMPTY)).otherwise(said)
        body = F.when(m["role"] == "api", F.concat(body, F.lit(t.EOA))).otherwise(body)
        text = F.concat(F.lit(t.START), m["role"], F.lit("\n"), body, F.lit(t.END))
        return F.when(i == n - 2, F.concat(text, F.lit(f"\n{t.START}assistant"))).when(i == n - 1, F.concat(body, F.lit(t.END))).otherwise(text)

    return F.when((n % 5 == 0) & (n > 0), F.transform(messages, one))


def instruction(messages: Column, system: Column | None = None, default_system: str = "") -> Column:
    """(instruction, output): earlier turns as user and reply only, the last one whole. Null where
    the last reply is empty."""
    lines, n = chatml(messages), F.size(messages)
    said = F.filter(lines, lambda x, i: (i >= n - 5) & (i < n - 1) | (i < n - 5) & ((i % 5 == 0) | (i % 5 == 4)))
    head = F.when(F.coalesce(strip(system), F.lit("")) != "", system).otherwise(F.lit(default_system)) if system is not None else F.lit(default_system)
    opening = F.when(head != "", F.array(F.concat(F.lit(f"{t.START}system\n"), head, F.lit(t.END)))).otherwise(F.array().cast("array<string>"))
    last = F.element_at(lines, -1)
    return F.when(lines.isNotNull() & ~last.contains(t.EMPTY), F.struct(F.array_join(F.concat(opening, said), "\n").alias("instruction"), last.alias("output")))


def preferences(messages: DataFrame, pairs: DataFrame, key: str = "id") -> DataFrame:
    """Preference records by key: prompt and messages, with chosen and rejected replies."""
    record = instruction(F.col("messages"))
    prompts = messages.select(key, "messages", record["instruction"].alias("prompt")).filter("prompt is not null")
    return prompts.join(pairs.select(key, "chosen", "rejected"), key)


def chat_body(messages: Column, with_system: bool = False) -> Column:
    """Texts as a request body: roles alternate, from user or from system."""
    roles = ("system", "user") if with_system else ("user", "assistant")
    return F.transform(messages, lambda m, i: F.struct(F.when(i % 2 == 0, roles[0]).otherwise(roles[1]).alias("role"), m.alias("content")))


def replace_token(messages: Column, old: str, new: str) -> Column:
    """A token replaced in every text of nested messages."""
    fixed = lambda c: F.transform(c, lambda x: F.struct(F.replace(x["text"], F.lit(old), F.lit(new)).alias("text"), x["token"].alias("token")))
    return F.transform(messages, lambda m: F.struct(m["role"].alias("role"), fixed(m["content"]).alias("content")))


def replace_nested(value: Column, kind: T.DataType, old: str, new: str) -> Column:
    """A literal part replaced in every string of a value of any nested type; map keys stay."""
    if isinstance(kind, T.StringType):
        return F.replace(value, F.lit(old), F.lit(new))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: replace_nested(x, kind.elementType, old, new))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: replace_nested(x, kind.valueType, old, new))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[replace_nested(value[f.name], f.dataType, old, new).alias(f.name) for f in kind.fields]))
    return value


# --- retrieval answers ----------------------------------------------------------------------------


def passage_list(docs: Column, k: int, prefix: str = "") -> Column:
    """The first ``k`` documents as passages; content falls back on the title. ``prefix`` may be
    ``rank`` or ``score``."""
    said = lambda d: F.coalesce(F.nullif(d["content"], F.lit("")), d["title"])
    before = {"": lambda d, i: said(d), "rank": lambda d, i: F.concat((i + 1).cast("string"), F.lit(" "), said(d)), "score": lambda d, i: F.concat(d["score"], F.lit(" "), said(d))}[prefix]
    return F.transform(F.slice(docs, 1, k), before)


def service_reply(text: Column) -> Column:
    """A tool service's JSON: thoughts, and calls with their keys in order."""
    parsed = F.from_json(text, "struct<thoughts:array<string>,api:array<map<string,string>>>")
    return F.struct(parsed["thoughts"].alias("thoughts"), F.transform(parsed["api"], lambda m: F.transform(F.map_entries(m), lambda e: _entry(e["key"], e["value"]))).alias("calls"))

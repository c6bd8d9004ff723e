"""The jobs: curation, distillation, filtering, labels and training sets, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.functions import codec, judge, prompts
from parlance.functions.text import without_section
from parlance.operators import curate, order, report
from parlance.operators.align import scores_by_row
from parlance.operators.distinct import first_known, semantic_groups
from parlance.operators.model_map import Answers, Client, Limits, ask_rounds, by_models
from parlance.scratch import materialize
from parlance.sources.retrieve import Retriever, gather, retrieve

QUERY = "user-query"


def curated(logs: DataFrame, rag: bool, single: bool, log: str = "model_input") -> DataFrame:
    """Logged rows with a time, flawed ones only, labelled, a row a query."""
    from parlance.functions.logparse import logged_at

    rows = logs.filter(F.col(log).isNotNull()).withColumn("datetime", logged_at(F.col(log)))
    named = curate.labelled(curate.keep_flawed(rows, rag, single))
    return first_known(named.withColumn("_o", order.mark(f"`{QUERY}`", "uid" if "uid" in named.columns else f"`{QUERY}`")), QUERY, "_o")


def semantically_distinct(df: DataFrame, vectors: DataFrame, key: str, most: float = 0.1) -> DataFrame:
    """Rows whose vector's cluster they stand for. No rows, no clusters."""
    kept = semantic_groups(vectors, key, "vector", most).filter("kept").select(key)
    return df.join(kept, key, "left_semi")


def distilled(df: DataFrame, make: Callable[[], Client], single: bool, key: str = "row_id", limits: Limits = Limits(), one_shot: str = "") -> DataFrame:
    """Prompts out, replies in, their braces' text kept; rows without go."""
    of = lambda name: F.col(name) if name in df.columns else F.lit("")
    prompt = prompts.distil_prompt(single, of("datetime"), F.col(f"`{QUERY}`"), of("context_text"), of("observation_text"), one_shot)
    asked = ask_rounds(df.withColumn("prompt", prompt), make, "prompt", key, limits)
    return asked.withColumn("distilled", judge.distilled(F.col("response"))).filter("distilled is not null")


def model_input(df: DataFrame, ask: Callable[[], Client], search: Callable[[], Retriever], k: int = 10, longest: int = 20_000, limits: Limits = Limits(), store: Answers | None = None) -> DataFrame:
    """(row_id, calls, observation, instruction) of logged queries (row_id, user-query), from end to end: a
    model names the tools to call, each call is searched for, as many whole observations as ``longest``
    allows stay, and all of it becomes the large model's input, up to where its reply begins. A query
    without a call, or whose model failed, has no calls and no observations."""
    query = F.col(f"`{QUERY}`")
    store = store or Answers(df.sparkSession)
    said = store.ask(df.select("row_id", query.alias("prompt")), ask, "api", "prompt", "row_id", limits)
    called = materialize(df.select("row_id", QUERY).join(said.select("row_id", codec.parse_calls(F.col("response")).alias("calls")), "row_id"))
    each = called.select("row_id", F.posexplode("calls").alias("call", "c")).withColumn("r", codec.request(F.col("c")))
    found = retrieve(each.select("row_id", "call", F.lower("r.name").alias("tool"), "r.query", "r.tags"), search)
    # A service is asked once, whatever reads the result.
    gathered = materialize(gather(found, k))
    none = F.array().cast("array<array<string>>")
    rows = called.join(gathered, "row_id", "left").withColumn("observation", order.within_length(F.coalesce("observation", none), longest))
    messages = codec.turn_messages(query, None, F.col("calls"), F.col("observation"), F.lit("-"))
    return rows.select("row_id", "calls", "observation", codec.instruction(messages)["instruction"].alias("instruction"))


def extended(df: DataFrame, *keep: str, most: int = 500) -> DataFrame:
    """Generalised questions, one a row, clean ones only, distinct, at most ``most``."""
    asked = curate.explode_generalised(df, ["generalized_question_from_user", "generalized_question_from_assistant"], *keep)
    clean = asked.filter(curate.query_class(F.col(f"`{QUERY}`")) == "clean")
    return order.capped(first_known(clean.withColumn("_o", order.mark(f"`{QUERY}`", *keep)), QUERY, "_o"), most, f"`{QUERY}`")


def evaluated(df: DataFrame, clients: dict[str, Callable[[], Client]], prompt: str, parse=judge.AUTHENTICITY.final, limits: Limits = Limits(), key: str = "row_id", store: Answers | None = None) -> DataFrame:
    """Judges' scores beside their vote and consistency, by key."""
    places = {name: k for k, name in enumerate(clients)}
    asked = by_models(df, clients, prompt, key, limits, store).withColumn("score", parse(F.col("response")))
    at = F.element_at(F.create_map(*[F.lit(x) for kv in places.items() for x in kv]), F.col("model"))
    scored = scores_by_row(asked.withColumn("at", at), key)
    return df.join(scored, key).withColumns({"vote": judge.vote(F.col("scores")), "agreed": judge.consistent(F.col("scores"))}).withColumn("route", judge.route(F.col("agreed")))


def filtered(df: DataFrame, style: dict, correct: dict, style_prompt: str, correct_prompt: str, limits: Limits = Limits(), key: str = "row_id", store: Answers | None = None) -> DataFrame:
    """Style first; only what it keeps is asked about correctness."""
    one = lambda name: lambda text: judge.pattern_score(text, name).cast("int")
    store = store or Answers(df.sparkSession)
    kept = evaluated(df, style, style_prompt, one("instruct_follow"), limits, key, store).filter("route = 'keep'").select(*df.columns)
    return evaluated(kept, correct, correct_prompt, one("instruct_follow"), limits, key, store)


def sectioned(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    return df.withColumn(column, without_section(F.col(column), start, end))


def weekly(kept: DataFrame, date: str, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sheet of preferences, sheet of replies, training rows) of a week's kept rows."""
    return curate.for_preference_labels(kept), curate.for_reply_labels(kept), curate.for_training(kept, date, keys)


def daily(raw: DataFrame, kept: DataFrame) -> DataFrame:
    both = raw.withColumn("stage", F.lit("raw")).unionByName(kept.withColumn("stage", F.lit("filtered")), allowMissingColumns=True)
    return report.daily_report(both, QUERY if QUERY.isidentifier() else f"`{QUERY}`", F.col("assistant"))

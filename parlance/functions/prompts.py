"""Prompts as templates over columns. What is null is left empty; it never empties the prompt."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.functions.logparse import date_place, history_text
from parlance.functions.temporal import pick


def said(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


#: Parts that follow the judge's own text, by kind: (heading, column).
PARTS = {
    "grounded": (("\n问题：", "query"), ("\n参考资料：", "observation"), ("\n回答：", "assistant")),
    "relevance": (("\n问题：", "query"), ("\n回答：", "assistant")),
    "richness": (("\n问题：", "query"), ("\n资料：", "observation"), ("\n待评回答：", "assistant")),
    "correctness": (("\n提问：", "query"), ("\n资料：", "observation"), ("\n回复：", "assistant")),
    "style": (("\n回复：", "assistant"),),
}


def judge_prompt(kind: str, prompt: str, columns: dict[str, Column]) -> Column:
    pieces = [F.lit(prompt)]
    for heading, name in PARTS[kind]:
        pieces += [F.lit(heading), said(columns[name])]
    return F.concat(*pieces)


def log_prompt(template: str, log: Column, history: Column | None, query: Column, reply: Column, today: str) -> Column:
    """Date and place filled in, history only where there is some."""
    known = date_place(log, today)
    text = F.replace(F.replace(F.lit(template), F.lit("$$$date$$$"), known["date"]), F.lit("$$$pos$$$"), known["place"])
    before = said(history_text(history)) if history is not None else F.lit("")
    return F.concat(text, F.when(before != "", F.concat(F.lit("\n历史对话：\n"), before)).otherwise(F.lit("")), F.lit("\n问题："), said(query), F.lit("\n回答："), said(reply))


#: Indent of the lines of the distillation template. Fixed value, as are its headings.
INDENT = " " * 12


def distil_prompt(single: bool, asked_at: Column, query: Column, context: Column, passages: Column, one_shot: str = "") -> Column:
    """A one-shot example, a rule, then date, history (several turns only), question and passages, a line each."""
    lines = [("用户提问的日期是：", asked_at), *([] if single else [("用户对话历史：", context)]), ("问题：", query), ("检索资料:", passages)]
    pieces = [F.lit(f"{one_shot}\n{INDENT}---\n{INDENT}下面是给出的实际问题：\n")]
    for heading, value in lines:
        pieces += [F.lit(INDENT + heading), said(value), F.lit("\n")]
    return F.concat(*pieces, F.lit(f"{INDENT}你的回答：\n{INDENT}"))


def few_shot(head: str, examples: str, query: Column) -> Column:
    return F.concat(F.lit(f"{head}\n{examples}\n输入："), said(query), F.lit("\n输出："))


def varied(variants, query: Column, *seed: Column) -> Column:
    """One of several openings, by hash."""
    return F.concat(pick(variants, *seed), F.lit("\n"), said(query))


def strategy_prompt(query: Column) -> Column:
    return F.concat(F.lit("先写出回答策略。\n问题："), said(query))


def answer_prompt(query: Column, strategy: Column) -> Column:
    return F.concat(F.lit("按策略回答。\n策略："), said(strategy), F.lit("\n问题："), said(query))

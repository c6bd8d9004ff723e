"""Curation: predicates that fit the columns at hand, labels, classes, generalised questions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.text import has_chinese, strip  # noqa: F401
from parlance.operators.order import capped
from parlance.schema import present


@dataclass(frozen=True)
class Is:
    """``column`` holds one of ``values``; null holds none."""

    column: str
    values: tuple

    def where(self) -> Column:
        return F.coalesce(F.col(self.column).isin(*self.values), F.lit(False))


#: Flags that must be off or unknown, and other conditions on every row.
ALL = tuple(Is(c, (0, -1)) for c in ("is_chara", "is_math", "is_child", "is_simplified", "is_guidance", "is_realtime", "query_has_you", "query_has_relative_time", "query_has_command")) + (
    Is("source", ("real",)), Is("is_valid_llm", (1,)), Is("is_too_similar_to_train", (0,)),
)
#: What makes a row worth keeping: one is enough.
ANY = (
    Is("assistant_relevance", ("中", "低")), Is("assistant_logic", ("中", "低")), Is("assistant_truthfulness", ("中", "低")),
    Is("observation_has_truthfulness_ambiguity", (1,)), Is("assiatant_has_hallucination_based_on_obs", (1,)), Is("assiatant_has_faulty_construction", (1,)),
)


def _and(rules) -> Column:
    return reduce(lambda a, b: a & b, [r.where() for r in rules], F.lit(True))


def _or(rules) -> Column:
    return reduce(lambda a, b: a | b, [r.where() for r in rules]) if rules else F.lit(True)


def usable(df: DataFrame, rules, compat: bool = False) -> list[Is]:
    """Rules whose column exists. ``compat`` loses those that compare with a word, as if the word
    had to be a column as well."""
    return [r for r in rules if r.column in df.columns and not (compat and any(isinstance(v, str) and v.isascii() for v in r.values))]


def keep_flawed(df: DataFrame, rag: bool, single: bool, all_rules=ALL, any_rules=ANY, compat: bool = False, fallback: int = 100, key: tuple[str, ...] = ("user-query",)) -> DataFrame:
    """Rows that meet every usable rule of the first kind and one of the second; if there is none, up
    to ``fallback`` random ones that meet the first kind."""
    sides = (Is("is_rag", (int(rag),)), Is("is_single_turn", (int(single),)))
    fit = df.filter(_and(usable(df, all_rules + sides, compat)))
    flawed = fit.filter(_or(usable(df, any_rules, compat)))
    return capped(fit, fallback, *[f"`{k}`" for k in key]) if flawed.isEmpty() else flawed


# Column, value and task name, in order of priority.
TASKS = (
    ("assistant_truthfulness", "低", "真实性差"), ("assistant_truthfulness", "中", "真实性中"), ("assistant_relevance", "低", "相关性差"), ("assistant_relevance", "中", "相关性中"),
    ("assistant_logic", "低", "逻辑性差"), ("assistant_logic", "中", "逻辑性中"), ("observation_has_truthfulness_ambiguity", 1, "obs事实矛盾"),
    ("assiatant_has_hallucination_based_on_obs", 1, "回复幻觉基于obs编造"), ("assiatant_has_faulty_construction", 1, "回复结构缺陷"),
)
NORMAL = "正常数据"
WANTED = ("user-query", "assistant", "api", "thought", "observation", "system", "system_without_time", "context", "generalized_question_from_user", "generalized_question_from_assistant", "task_name", "uid", "datetime")


def task_name(columns, tasks=TASKS, normal: str = NORMAL) -> Column:
    out = None
    for column, value, name in tasks:
        if column in columns:
            out = (F if out is None else out).when(F.col(column) == value, name)
    return out.otherwise(normal) if out is not None else F.lit(normal)


def labelled(df: DataFrame) -> DataFrame:
    """Task names, and the columns that later stages want."""
    out = df.withColumn("task_name", task_name(df.columns))
    out = out.select(*[f"`{c}`" for c in present(out, WANTED)])
    return out.withColumnsRenamed({"system": "system_with_time", "system_without_time": "system"}) if "system_without_time" in out.columns else out.withColumnsRenamed({"system": "system_with_time"})


# Words of time, and how commands begin.
TIME_WORDS = ("今天", "昨天", "明天", "本周", "上周", "今年", "明年", "去年", "最近", "目前", "现在")
COMMANDS = ("播放", "我想听", "我想看", "我要听", "我要看", "打开", "关闭", "找一下", "找一家", "搜一下", "看一下", "放个", "停止", "开始")


def query_class(query: Column, time_words=TIME_WORDS, persona: str = "你", commands=COMMANDS) -> Column:
    """time, persona, command or clean: the first that fits."""
    timed = reduce(lambda a, b: a | b, [query.contains(w) for w in time_words])
    return F.when(timed, "time").when(query.contains(persona), "persona").when(query.rlike("^(" + "|".join(commands) + ")"), "command").otherwise("clean")


def timely(df: DataFrame) -> DataFrame:
    return df.filter((F.col("is_realtime") == 1) | (F.col("query_has_relative_time") == 1))


def nothing(c: Column) -> Column:
    """An empty list written out, or anything that ends in an empty list of lists."""
    return F.coalesce(c.cast("string").rlike(r"^\[\]$|\[\[\]\]$"), F.lit(False))


def without_nothing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows in which no column is an empty list."""
    return df.filter(~reduce(lambda a, b: a | b, [nothing(F.col(f"`{c}`")) for c in columns or df.columns]))


def generalised(questions: Column) -> Column:
    """A model's questions, one a line; headings, list marks and empty lines go."""
    return F.filter(F.split(questions, "\n"), lambda x: (x != "") & ~x.contains("-") & ~x.contains("**") & ~x.contains("问题："))


def explode_generalised(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    both = F.flatten(F.array(*[F.coalesce(generalised(F.col(c)), F.array().cast("array<string>")) for c in columns]))
    return df.select(*keep, F.explode(both).alias("user-query"))


def dialogue(context: Column, query: Column) -> Column:
    """Everything said, in order, and the query."""
    return F.concat(F.flatten(F.transform(context, lambda t: F.array(t["user"], t["assistant"]))), F.array(query))


def audit(text: Column, most: int = 300) -> dict[str, Column]:
    """Too long, odd characters, full-width punctuation."""
    return {"too_long": F.length(text) > most, "special": text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F�]"), "full_width": text.rlike("[。，！？：；（）【】《》、～…—]")}


def audited(df: DataFrame, source: str, task: str, date: str, user: str = "") -> DataFrame:
    """Columns that say where a row comes from."""
    fixed = {"source": source, "task_name": task, "create_time": date, "update_time": date, "create_user": user, "update_user": user, "is_reviewed": "0", "update_content": ""}
    return df.withColumns({k: F.lit(v) for k, v in fixed.items()})


def for_preference_labels(df: DataFrame) -> DataFrame:
    """The reply and its distilled rival, side by side, and blanks for the labeller."""
    return df.withColumnsRenamed({"assistant": "modelA", "distilled": "modelB"}).withColumns({c: F.lit("") for c in ("better", "reason", "corrected")})


def for_reply_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lit("") for c in ("is_correct", "reason", "corrected", "remark")})


def for_training(df: DataFrame, date: str, order: list[str]) -> DataFrame:
    """Constants, and ids ``log-<date>-<n>`` in a given order."""
    from parlance.operators.order import row_ids

    fixed = {"turn_id": 0, "produce_source": "log", "create_time": date, "update_time": date, "create_user": "", "update_user": "", "is_reviewed": "0", "update_content": ""}
    return row_ids(df, order, "_r").withColumns({k: F.lit(v) for k, v in fixed.items()} | {"id": F.concat(F.lit(f"log-{date}-"), (F.col("_r") - 1).cast("string"))}).drop("_r")


def thought_or_default(thought: Column, default: str, phrase: str) -> Column:
    return F.when(thought.isNull() | (thought == ""), default).otherwise(F.replace(thought, F.lit(phrase), F.lit("")))


def for_search(df: DataFrame, *keep: str) -> DataFrame:
    """Columns of the search-training table, from the first call and the first passages, beside ``keep``."""
    call = F.get(F.col("api"), F.lit(0))
    value = lambda k: F.coalesce(F.get(F.filter(call, lambda e: F.upper(e["k"]) == k), F.lit(0))["v"], F.lit(""))
    return df.select(
        *keep, F.col("`user-query`").alias("query"), F.col("assistant").alias("response"), "thought", value("APINAME").alias("api_name"), value("CATEGORY").alias("category"), value("TAG").alias("search_tags"),
        F.get(F.col("observation"), F.lit(0)).alias("doc"), value("QUERY").alias("search_query"), F.lit("True").alias("is_relative"), F.coalesce(F.col("create_user") if "create_user" in df.columns else F.lit(None), F.lit("")).alias("create_user"),
    )


def split_failed(df: DataFrame, response: str, sentinel: str = "<|wrong data|>") -> tuple[DataFrame, DataFrame]:
    """(good, failed) by the sentinel itself, not by its characters as a pattern."""
    bad = F.coalesce(F.col(response).contains(sentinel), F.lit(True))
    return df.filter(~bad), df.filter(bad)


def clean_table(df: DataFrame, text: str) -> DataFrame:
    """Distinct rows, then cleaned; rows with a null or an empty text go. Rows that only cleaning
    makes equal stay."""
    from parlance.functions.text import clean_text

    return df.dropDuplicates().withColumn(text, clean_text(F.col(text))).na.drop("any").filter(F.length(text) > 0)

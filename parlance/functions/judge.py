"""Judges' texts to scores, scores to verdicts.

Codes: 1 and 0; -1 unknown or wrong; -2 the call failed; -3 not to be parsed. Lists of scores that
hold nothing pass every test on all of them, as the judges' rules want it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.tokens import FAILED

FAIL, BAD, UNKNOWN = -2, -3, -1


def strict_int(text: Column) -> Column:
    """Digits with a sign and nothing else; null otherwise."""
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("int"))


def strict_float(text: Column) -> Column:
    return F.when(text.rlike(r"^\s*[+-]?\d+(\.\d*)?\s*$"), F.trim(text).try_cast("double"))


def failed(text: Column) -> Column:
    return F.coalesce(text.contains(FAILED), F.lit(True))


def _flat(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(""))


def segment_scores(text: Column, segment: str, score: str) -> Column:
    """All scores in a segment: [-2] failed, [-3] no segment; one that is no number empties the list."""
    found = F.regexp_extract_all(F.regexp_extract(_flat(text), segment, 0), F.lit(score), F.lit(1))
    numbers = F.transform(found, strict_int)
    empty = F.array().cast("array<int>")
    return F.when(failed(text), F.array(F.lit(FAIL))).when(~_flat(text).rlike(segment), F.array(F.lit(BAD))).when(F.exists(numbers, lambda x: x.isNull()), empty).otherwise(numbers)


@dataclass(frozen=True)
class Grounded:
    """A judge that scores statements in one segment and says whether the reply is a fallback."""

    segment: str
    fallback: str = r"是否为兜底回复：【(.*?)】"
    firm: str = r"【(\d*?)】"
    pending: str = r"「(\d*?)」"

    def scores(self, text: Column) -> Column:
        return segment_scores(text, self.segment, self.firm)

    def pending_scores(self, text: Column) -> Column:
        return segment_scores(text, self.segment, self.pending)

    def is_fallback(self, text: Column) -> Column:
        return F.when(failed(text), F.lit(FAIL)).otherwise(F.coalesce(strict_int(F.regexp_extract(_flat(text), self.fallback, 1)), F.lit(BAD)))

    def final(self, text: Column) -> Column:
        """1 unless a statement has 0, the call failed, the text has no segment, or the reply is a fallback."""
        firm, pending = self.scores(text), self.pending_scores(text)
        wrong = F.lit(False)
        for s in (firm, pending):
            wrong = wrong | F.array_contains(s, F.lit(0)) | F.array_contains(s, F.lit(FAIL)) | F.array_contains(s, F.lit(BAD))
        return F.when(wrong | (self.is_fallback(text) == 1), 0).otherwise(1)


AUTHENTICITY = Grounded(r"准确性(.*?)兜底")
RICHNESS = Grounded(r"准确性评估(.*?)兜底回复")


def relevance_score(text: Column) -> Column:
    """1 if all scores are above 3, 0 if not, -1 where one is no number, -2 for a failed call."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"【(\d*?)】"), F.lit(1)), strict_int)
    return F.when(failed(text), FAIL).when(F.exists(numbers, lambda x: x.isNull()), UNKNOWN).when(F.forall(numbers, lambda x: x > 3), 1).otherwise(0)


def relevance_fallback(text: Column, compat: bool = False) -> Column:
    """``{{1}}`` and ``{{1.0}}`` alike; ``compat`` reads whole numbers only."""
    found = F.regexp_extract(text, r"兜底评估：\{\{(.*?)\}\}", 1)
    return F.coalesce(strict_int(found) if compat else strict_float(found).cast("int"), F.lit(FAIL))


def relevance_final(text: Column, compat: bool = False) -> Column:
    return F.when(relevance_score(text).isin(0, UNKNOWN, FAIL) | (relevance_fallback(text, compat) == 1), 0).otherwise(1)


def all_five(text: Column) -> Column:
    """Every score is 5; -1 where one is no number."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit("【(.*?)】"), F.lit(1)), strict_int)
    return F.when(failed(text), FAIL).when(F.exists(numbers, lambda x: x.isNull()), UNKNOWN).when(F.forall(numbers, lambda x: x == 5), 1).otherwise(0)


def three_groups(text: Column) -> Column:
    """Exactly three marked scores, the first above 3."""
    found = F.regexp_extract_all(text, F.lit(r"\{\{(.*?)\}\}"), F.lit(1))
    first = strict_float(F.get(found, F.lit(0)))
    return F.when(failed(text), FAIL).when((F.size(found) != 3) | first.isNull(), UNKNOWN).when(first > 3, 1).otherwise(0)


def service_score(text: Column, field: str) -> Column:
    """A judge service's JSON reply; -1 for a broken one."""
    return F.coalesce(F.get_json_object(text, f"$.eval_results[0].{field}").try_cast("int"), F.lit(UNKNOWN))


#: Name: pattern of the score. The first group is the score.
PATTERNS = {
    "instruct_follow": r"\{\{(.*?)\}\}",
    "unknown_answer": r"兜底得分[:：]\s*\{\{(.*?)\}\}",
    "speech_style": r"话术得分[:：]\s*\{\{(.*?)\}\}",
    "correctness": r"准确性得分[:：]\s*\{\{(.*?)\}\}",
    "relevance": r"相关性得分[:：]\s*\{\{(.*?)\}\}",
    "authenticity": r"真实性得分[:：]\s*\{\{(.*?)\}\}",
    "answerable": r"可解得分[:：]\s*\{\{(.*?)\}\}",
}


def pattern_score(text: Column, name: str) -> Column:
    """A named pattern's number; -1 where it is missing."""
    return F.when(failed(text), F.lit(float(FAIL))).otherwise(F.coalesce(strict_float(F.regexp_extract(text, PATTERNS[name], 1)), F.lit(float(UNKNOWN))))


def follows(text: Column) -> Column:
    return F.when(pattern_score(text, "instruct_follow") == 1, 1).otherwise(0)


def json_flag(text: Column, field: str) -> Column:
    """A boolean in the widest braces of the text."""
    found = F.get_json_object(F.regexp_extract(text, r"(?s)(\{.*\})", 1), f"$.{field}")
    return F.when(F.lower(found) == "true", 1).when(F.lower(found) == "false", 0).otherwise(UNKNOWN)


def all_one(text: Column) -> Column:
    """Every score of the authenticity segment is 1."""
    return F.when(F.forall(AUTHENTICITY.scores(text), lambda x: x == 1), 1).otherwise(0)


#: Metric by name: from a judge's text to a row's code.
METRICS = {
    "authenticity": AUTHENTICITY.final, "relevance": relevance_final, "richness": RICHNESS.final, "relevance_all_five": all_five, "three_groups": three_groups,
    "truth_service": lambda text: service_score(text, "pred_truth_score"), "relevance_service": lambda text: service_score(text, "pred_rel_score"), "richness_service": lambda text: service_score(text, "pred_rich_score"),
}


def metric(name: str):
    """A metric by its name, one of the patterns' scores included."""
    if name in METRICS:
        return METRICS[name]
    if name in PATTERNS:
        return lambda text: pattern_score(text, name)
    raise ValueError(f"no metric {name}; there are {sorted({*METRICS, *PATTERNS})}")


def rescored(score: Column, fallback: Column, strict: bool = False) -> Column:
    """0 for a 0 or a fallback; else 1, or 0 for what couldn't be parsed if ``strict``."""
    bad = (F.coalesce(score, F.lit(FAIL)) == 0) | (fallback == 1)
    return F.when(bad | (F.coalesce(score, F.lit(FAIL)) < 0 if strict else F.lit(False)), 0).otherwise(1)


def vote(scores: Column) -> Column:
    """The most frequent score, the first seen of equals; anything but 1 is 0."""
    kinds = F.array_distinct(scores)
    ranked = F.transform(kinds, lambda k: F.struct(F.size(F.filter(scores, lambda s: s == k)).alias("n"), (-F.array_position(scores, k)).alias("at"), k.alias("score")))
    return F.when(F.array_max(ranked)["score"] == 1, 1).otherwise(0)


def consistent(scores: Column) -> Column:
    return F.when(F.forall(scores, lambda s: s == 1), 1).when(F.forall(scores, lambda s: s == 0), 0).otherwise(UNKNOWN)


def route(score: Column) -> Column:
    return F.when(score == 1, "keep").when(score == 0, "discard").otherwise("label")


def chain(df: DataFrame, first: Column, then: Column) -> DataFrame:
    """Only rows that the first filter keeps reach the second."""
    return df.filter(first == 1).filter(then == 1)


def distilled(text: Column) -> Column:
    """The text in double braces; null without."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{\{(.+?)\}\}", 1), F.lit(""))

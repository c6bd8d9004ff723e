"""Line-first quality rules, in DataFrame functions only.

Every line with a word is held against rules on punctuation, navigation and boilerplate; failing
lines are removed; a text that loses more than ``most_lost`` of its characters is rejected. Counts over
the whole text stand beside that: words, their code points, symbols, repeated lines and words in
repeated three-word windows.

Windows are compared by 64-bit hashes within one text. Arrays of a text's words and windows live
in its own row, so nothing is shuffled; sorting finds repeats in n log n.

Defined cases: null has no words, counts 0, and fails; a text without lines that hold a word is
rejected; rows that repeat an id or a text are judged one by one, and alike; of equal lines and windows all but
the first line, and every window, count; a text of any length is judged whole, in its row; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import bind, whole_text

SYMBOLS = "#*$%&|<>"
#: ASCII punctuation and digits, and a mark of menus, one by one: Java looks them up in a bitmap then,
#: but tests ranges in turn.
MARKS = "".join(("\\" if c in "[]^-&\\" else "") + c for c in map(chr, range(0x21, 0x7F)) if not c.isalpha()) + "»"
#: Phrases of web pages' furniture, lower case.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use", "click here", "read more",
    "sign in", "log in", "sign up", "subscribe to", "newsletter", "enable javascript", "lorem ipsum", "skip to content",
    "back to top", "share on", "add to cart", "page not found",
)
#: Rules' limits: shares of a line's characters, or of its words.
MOST_SYMBOLS, MOST_MARKS, MOST_LOUD, MOST_BARS, MOST_FURNITURE = 0.02, 0.4, 0.3, 0.1, 120


def _left(text: Column, others: str) -> Column:
    """What is left of a text without its runs of other characters."""
    return F.regexp_replace(text, f"[^{others}]+", "")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(text, r"[\x09-\x0D]", " "), " "), "")


def _covered(windows: Column) -> Column:
    """Places in windows whose hash stands twice or more."""

    def count(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (F.get(s, k - 1).getField("h") == x["h"]) | (F.get(s, k + 1).getField("h") == x["h"]))
        return bind(
            F.sort_array(F.transform(twice, lambda x: x["i"])),
            lambda p: F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"]),
        )

    return bind(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), count)


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows that stand twice or more in the text; texts without any are told
    by their distinct windows."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(bind(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h))))


def line_verdict(line: Column) -> Column:
    """The first rule that the line fails, or null."""
    n, words = F.length(line), F.size(F.split(line, " "))
    fails = lambda marks: (
        F.when(marks.rlike("[|<>»]") & (F.length(_left(marks, "|<>»")) > MOST_BARS * words), "navigation")
        .when(F.length(_left(marks, SYMBOLS)) > MOST_SYMBOLS * n, "symbols")
        .when(marks.rlike("[!?]{1}.*[!?]{1}.*[!?]{1}") & (F.length(_left(marks, "!?")) > MOST_LOUD * words), "punctuation")
        .when(F.length(marks) > MOST_MARKS * n, "few letters")
        .when((n <= MOST_FURNITURE) & F.lower(line).rlike("|".join(BOILERPLATE)), "boilerplate")
    )
    return bind(_left(line, MARKS), fails)


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_lost: float = 0.4, keep_columns: bool = False) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines,
    n_lines_removed, lost), and with ``keep_columns`` the input's columns as a struct ``record``
    and the remaining lines as ``clean_text``."""
    text = whole_text(text_col)
    fields = [F.col(id_col).alias("id"), text.alias("text")]
    if keep_columns:
        fields.append(F.struct(*[df[c] for c in df.columns]).alias("record"))

    def lines_of(t: Column) -> Column:
        judged = F.transform(
            F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            lambda x: F.struct(x.alias("line"), F.length(x).alias("n"), line_verdict(x).alias("fails")),
        )
        total = lambda lines: F.aggregate(lines, F.lit(0), lambda a, x: a + x["n"])
        return bind(
            judged,
            lambda j: F.struct(
                F.size(j).alias("n_lines"),
                (F.size(j) - F.size(F.array_distinct(F.transform(j, lambda x: x["line"])))).alias("n_dup_lines"),
                F.size(F.filter(j, lambda x: x["fails"].isNotNull())).alias("n_removed"),
                total(F.filter(j, lambda x: x["fails"].isNotNull())).alias("lost_chars"),
                total(j).alias("chars"),
                *([F.array_join(F.transform(F.filter(j, lambda x: x["fails"].isNull()), lambda x: x["line"]), "\n").alias("clean_text")] if keep_columns else []),
            ),
        )

    counted = df.select(*fields).select(
        *(["record"] if keep_columns else []),
        "id",
        bind(words_of(F.col("text")), lambda w: F.struct(F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), _repeated_words(w).alias("n_repeat_words"))).alias("w"),
        F.length(_left(F.col("text"), SYMBOLS)).alias("n_symbols"),
        lines_of(F.col("text")).alias("l"),
    )
    long = lambda c, name: F.col(c).cast("long").alias(name)
    out = counted.select(
        *(["record", F.col("l.clean_text").alias("clean_text")] if keep_columns else []),
        F.col("id"),
        long("w.n_words", "n_words"), long("w.word_chars", "word_chars"), long("n_symbols", "n_symbols"), long("l.n_dup_lines", "n_dup_lines"), long("w.n_repeat_words", "n_repeat_words"),
        ((F.col("w.n_words") < 50) | (100 * F.col("w.n_repeat_words").cast("long") > 50 * F.col("w.n_words").cast("long"))).alias("base_failed"),
        long("l.n_lines", "n_lines"), long("l.n_removed", "n_lines_removed"),
        F.when(F.col("l.chars") > 0, F.col("l.lost_chars") / F.col("l.chars")).otherwise(F.lit(1.0)).alias("lost"),
    )
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= most_lost))
    return out.withColumnRenamed("id", id_col)

"""Text cleaning, measures and sections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parlance.functions.tokens import replace_all

# Full-width punctuation and what stands for it.
PUNCTUATION = (
    ("。", "."), ("，", ","), ("！", "!"), ("？", "?"), ("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'"), ("：", ":"), ("；", ";"),
    ("（", "("), ("）", ")"), ("【", "["), ("】", "]"), ("《", "<"), ("》", ">"), ("、", ","), ("～", "~"), ("…", "..."), ("—", "-"),
)
#: White space as the reference's language understands it: the ideographic space too.
WIDE_SPACE = r"(?U)\s"
HAN = "一-鿿"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{WIDE_SPACE}+|{WIDE_SPACE}+$", "")


def clean_text(text: Column, keep_quotes: bool = False) -> Column:
    """Trim, one space for white space, ASCII punctuation, one full stop for a run of marks.
    ``keep_quotes`` leaves curly quotes as they are. An ellipsis ends as one full stop."""
    pairs = [p for p in PUNCTUATION if not (keep_quotes and p[0] in "“”‘’")]
    # One pass for what becomes one character; the rest by itself.
    one = [p for p in pairs if len(p[1]) == 1]
    text = F.translate(F.regexp_replace(strip(text), f"{WIDE_SPACE}+", " "), "".join(a for a, _ in one), "".join(b for _, b in one))
    return F.regexp_replace(replace_all(text, [p for p in pairs if len(p[1]) != 1]), "[.,!?]+", ".")


def polite_to_plain(text: Column) -> Column:
    return F.replace(text, F.lit("您"), F.lit("你"))


def escape_newlines(text: Column) -> Column:
    """Newlines as a backslash and an n."""
    return F.replace(text, F.lit("\n"), F.lit("\\n"))


def drop_breaks(text: Column) -> Column:
    """Without carriage returns, line feeds, double quotes and tabs."""
    return F.translate(text, '\r\n"\t', "")


def without(text: Column, parts) -> Column:
    """Trimmed, and without each of ``parts``."""
    return replace_all(strip(text), [(p, "") for p in parts])


def role_transcript(text: Column) -> Column:
    """``user:`` and ``assistant:`` lines as tokens; leading end tokens go."""
    text = replace_all(text, [("user:", "[unused1]\n[unused0]user\n"), ("assistant:", "[unused1]\n[unused0]assistant\n")])
    return F.regexp_replace(strip(text), r"^(\[unused1\]\s*)+", "")


def english_ratio(text: Column) -> Column:
    """(share of Latin letters among Latin letters and Han, number of Han): both 0 without either."""
    han = F.length(F.regexp_replace(text, f"[^{HAN}]", ""))
    latin = F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    return F.struct(F.when(han + latin > 0, latin / (han + latin)).otherwise(F.lit(0.0)).alias("english_ratio"), han.alias("chinese_count"))


def has_chinese(text: Column) -> Column:
    return text.rlike("[一-龥]")


def number_passages(passages: Column) -> Column:
    """``obs1 …``, ``obs2 …`` across the inner lists, an empty line between."""
    return F.array_join(F.transform(F.flatten(passages), lambda x, i: F.concat(F.lit("obs"), (i + 1).cast("string"), F.lit(" "), x)), "\n\n")


def date_in_name(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"\d{4}-\d{2}-\d{2}", 0), F.lit(""))


def content_id(*columns: Column) -> Column:
    """An id that says the content and so survives a rerun."""
    return F.sha2(F.concat_ws("\x1f", *columns), 256)


def line(text: Column, number: int) -> Column:
    """A text's line, from 0; null beyond the last."""
    return F.get(F.split(text, "\n"), F.lit(number))


def split_query_prompt(text: Column) -> Column:
    """(query, prompt): a query's first line, and what follows it; null if nothing does."""
    at = F.locate("\n", text)
    return F.struct(F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text).alias("query"), F.when(at > 0, F.nullif(F.substring(text, at + 1, F.length(text)), F.lit(""))).alias("prompt"))


def first_filled(entries: Column, keys, default: str = "none") -> Column:
    """The first of ``keys`` in a map that holds something."""
    held = [F.nullif(F.nullif(F.element_at(entries, k), F.lit("")), F.lit("[]")) for k in keys]
    return F.coalesce(*held, F.lit(default))


def value_text(value: Column) -> Column:
    """JSON text without line breaks; a list stays as it is."""
    return F.when(value.startswith("["), value).otherwise(drop_breaks(value))


def between(text: Column, start: str, end: str, keep_start: bool = False) -> Column:
    """What stands between two marks, trimmed; null unless the end comes after the start."""
    a, skip = F.locate(start, text), 0 if keep_start else len(start)
    b = F.locate(end, text, 1)
    return F.when((a > 0) & (b > a), strip(F.substring(text, a + skip, b - a - skip)))


def without_section(text: Column, start: str, end: str) -> Column:
    """Without what stands from one mark up to another; unchanged where they are missing."""
    a, b = F.locate(start, text), F.locate(end, text)
    return F.when((a > 0) & (b > a), strip(F.concat(F.substring(text, F.lit(1), a - 1), F.substring(text, b, F.length(text))))).otherwise(text)


def with_prompt(query: Column, prompt: Column) -> Column:
    """The query, and on a new line a prompt that isn't blank."""
    return F.when(F.coalesce(strip(prompt), F.lit("")) != "", F.concat_ws("\n", query, strip(prompt))).otherwise(query)


def repr_length(values: Column) -> Column:
    """The length of a list of strings written with quotes, commas and brackets."""
    return F.aggregate(values, F.lit(0), lambda a, x: a + F.length(x) + 2) + F.greatest(F.size(values) - 1, F.lit(0)) * 2 + 2


def is_points_reply(text: Column) -> Column:
    """A general part, a colon and a numbered list; neither code, headers nor years. Any character
    may follow the number."""
    return F.coalesce(text.rlike("：\n* *\n+1.") & ~text.contains(" = ") & ~text.contains("import") & ~text.contains("###") & ~text.rlike(r"\d{4}年"), F.lit(False))


def segment_points(text: Column, mark: str = "<|br|>") -> Column:
    """A numbered reply with break tokens between its parts. Empty where a point ends in a colon or
    the last point is not followed by exactly one closing paragraph."""
    parts = F.split(text, r"\n+\d+.")
    points = F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit("\n"), i.cast("string"), F.lit("."), x)))
    opens = F.exists(F.slice(parts, 2, 10_000), lambda x: strip(x).rlike("[:：]$"))
    tail = F.split(F.element_at(points, -1), "\n\n")
    whole = F.concat(F.slice(points, F.lit(1), F.size(points) - 1), F.array(F.get(tail, F.lit(0)), F.concat(F.lit("\n"), F.get(tail, F.lit(1)))))
    return F.when(opens | (F.size(tail) != 2), F.lit("")).otherwise(F.array_join(whole, mark))


def hinted(thought: Column, flag: Column, hint: str) -> Column:
    return F.when(flag, F.concat(thought, F.lit(hint))).otherwise(thought)


# Rules of our own for layout: strict at the start of a line, loose anywhere.
def layout(text: Column) -> dict[str, Column]:
    header, bullet, bold = text.rlike(r"(?m)^#{1,6} "), text.rlike(r"(?m)^\s*(?:[-*+]|\d+[.)]) "), text.rlike(r"\*\*[^*\n]+\*\*")
    return {
        "is_md": header & bullet & bold,
        "is_md_loose": header | bullet | bold,
        "is_md_list": bullet,
        "is_md_list_loose": text.rlike(r"(?:[-*+]|\d+[.)]) ?\S"),
        "is_md_bold": bold,
        "is_md_2nd": text.rlike(r"(?m)^\s{2,}(?:[-*+]|\d+[.)]) "),
    }

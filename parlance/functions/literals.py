"""Values written as Python literals: lists, dictionaries, strings with any quotes and escapes.

Texts that are JSON are read as JSON. Nothing is evaluated: names other than None, True and False, calls
and operators make a text no literal. Parsing is a small function a row, in Arrow batches.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_json(text: Column) -> Column:
    """The value as JSON; tuples and sets are lists, keys are strings. Null if the text is neither JSON nor
    a literal, or nested beyond what a parser's stack holds."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        import ast
        import json

        def one(t):
            for read in (json.loads, ast.literal_eval):
                try:
                    out = json.dumps(read(t), ensure_ascii=False, default=lambda x: sorted(x, key=repr) if isinstance(x, (set, frozenset)) else str(x))
                    return out.encode("utf-8", "replace").decode("utf-8")
                except (ValueError, SyntaxError, TypeError, RecursionError, MemoryError):
                    continue
            return None

        return texts.map(one, na_action="ignore").astype(object).where(texts.notna(), None)

    return convert(text)


def nested_list(text: Column) -> Column:
    """Whether a text is a list that holds lists only; an empty one is."""
    value = literal_json(text)
    return F.coalesce(F.startswith(value, F.lit("[")) & F.forall(F.from_json(value, "array<string>"), lambda x: F.coalesce(x.startswith("["), F.lit(False))), F.lit(False))


def observed(text: Column) -> Column:
    """(title, content) of the observations that a text holds, as an array: items of a list, of lists in a list too;
    a dictionary's ``content``, or else ``chunk``. A broken list gives the strings that it quotes, any other
    text is one observation."""

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        import ast
        import json
        import re

        quoted = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\"""", re.S)

        def value(t):
            for read in (json.loads, ast.literal_eval):
                try:
                    return read(t)
                except (ValueError, SyntaxError, TypeError, RecursionError, MemoryError):
                    continue
            if not t.lstrip().startswith("["):
                return [t]
            out = []
            for piece in quoted.findall(t):
                try:
                    out.append(ast.literal_eval(piece))
                except (ValueError, SyntaxError):
                    continue
            return out or [t]

        def item(x):
            if not isinstance(x, dict):
                return {"title": None, "content": str(x)}
            body = x["content"] if "content" in x else x["chunk"] if "chunk" in x else x
            return {"title": None if x.get("title") is None else str(x["title"]), "content": None if body is None else str(body)}

        def one(t):
            held = value(t)
            if not isinstance(held, (list, tuple)):
                held = [held] if isinstance(held, (dict, str)) else [t]
            flat = [y for x in held for y in (x if isinstance(x, (list, tuple)) else [x])]
            return json.dumps([item(x) for x in flat], ensure_ascii=False).encode("utf-8", "replace").decode("utf-8")

        return texts.map(one, na_action="ignore").astype(object).where(texts.notna(), None)

    return F.from_json(convert(text), "array<struct<title:string,content:string>>")

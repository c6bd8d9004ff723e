"""The control tokens of the wire format, and the two ways to write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Readable and compact form of each token.
START, START_C = "<|lc_start|>", "[unused0]"
END, END_C = "<|lc_end|>", "[unused1]"
KVS, KVS_C = "<|kvs|>", "[unused2]"
KVE, KVE_C = "<|kve|>", "[unused3]"
API_START, API_START_C = "<|api_start|>", "[unused4]"
API_END, API_END_C = "<|api_end|>", "[unused5]"
EOA, EOA_C = "<|eoa|>", "[unused6]"
ARROW, ARROW_C = "=>", "[unused7]"
BREAK, BREAK_C = "<|br|>", "[unused8]"
IRRELEVANT, IRRELEVANT_C = "<|irrelevant|>", "[unused9]"
PAIRS = (
    (START, START_C), (END, END_C), (KVS, KVS_C), (KVE, KVE_C), (API_START, API_START_C), (API_END, API_END_C),
    (EOA, EOA_C), (ARROW, ARROW_C), (BREAK, BREAK_C), (IRRELEVANT, IRRELEVANT_C),
)
#: Stand for an empty role, a failed model call, a reply that cannot be parsed.
EMPTY, FAILED, UNPARSED = "<None>", "<|wrong data|>", "<|wrong parse|>"


def replace_all(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def compact(text: Column) -> Column:
    return replace_all(text, PAIRS)


def readable(text: Column) -> Column:
    return replace_all(text, [(c, r) for r, c in PAIRS])


def as_brackets(text: Column) -> Column:
    """Tool calls in compact tokens as ``[KEY]value`` with spaces between."""
    return replace_all(text, [(KVS_C, "["), (ARROW_C, "]"), (KVE_C, " "), (API_START_C, ""), (API_END_C, " "), (EOA_C, "")])

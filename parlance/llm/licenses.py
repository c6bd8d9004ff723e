"""License scan: ordered signature rules over a text's words.

A text is lower-cased (A-Z) and reduced to its words, one space apart. Some two hundred signatures,
written by hand in ``signatures``, state how licenses are named, granted, tagged, linked and worded.
One is searched only if its keyword occurs in the text. Detections are intervals of words; they are
ranked by priority, then length, then place, and one inside another of a better rank is dropped.

Three base phrases are counted at every place they stand, whatever the rules find; their labels
are always among a text's labels.

Defined cases: null is empty; a text without words has no detection and score 0; a text of any
length is scanned whole, in time that goes with its length; an empty table gives no rows; other
columns are not read; ids may repeat, each row is scanned by itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import map_arrow, text_bytes
from parlance.llm.signatures import SIGNATURES

#: Phrase and label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

@dataclass(frozen=True)
class Rule:
    """A label found by ``pattern`` (over words one space apart); higher priorities win overlaps."""

    label: str
    keyword: bytes
    pattern: str
    priority: int


def build_rules() -> tuple[Rule, ...]:
    """The signatures as rules, highest priority first, otherwise in the order in which they are written."""
    rules, priority = [], 0
    for line in filter(None, map(str.strip, SIGNATURES.split("\n"))):
        if line.startswith("="):
            priority = int(line[1:])
        else:
            label, keyword, pattern = line.split(" | ")
            rules.append(Rule(label, keyword.encode(), pattern, priority))
    return tuple(sorted(rules, key=lambda r: -r.priority))


@lru_cache(maxsize=1)
def _compiled():
    by_key: dict[bytes, list] = {}
    for order, r in enumerate(build_rules()):
        by_key.setdefault(r.keyword, []).append((order, r, re.compile(f"(?<= )(?:{r.pattern})(?= )".encode())))
    base = [(label, f" {phrase} ".encode(), re.compile(f"(?<= ){phrase}(?= )".encode())) for phrase, label in BASE]
    return by_key, base


#: Lower-cases A-Z and turns every byte that is in no word into a space.
_WORDS = bytes((c + 32) if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def uncontained(hits: list[tuple]) -> list[tuple]:
    """Of hits (start, end, rank, ...) those that lie in no hit of a lower rank, by one sweep from left to
    right. What holds a hit that gave way holds all that lies in it, so the sweep need not know which stay."""
    kept, active = [], []
    for hit in sorted(hits, key=lambda h: (h[0], -h[1], h[2])):
        active = [a for a in active if a[1] > hit[0]]
        if not any(a[1] >= hit[1] and a[2] < hit[2] for a in active):
            kept.append(hit)
        active.append(hit)
    return kept


def scan(data: bytes) -> dict:
    """All that the rules find in one text."""
    by_key, base = _compiled()
    words = data.translate(_WORDS).split()
    flat = b" " + b" ".join(words) + b" "
    places, base_labels, spaces = [], set(), None

    def at(positions: list[int]) -> list[int]:
        """The words that begin there."""
        nonlocal spaces
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(flat, np.uint8) == 0x20)
        return (np.searchsorted(spaces, positions) - 1).tolist()

    for label, phrase, pattern in base:
        if phrase in flat:
            places += at([m.start() for m in pattern.finditer(flat)])
            base_labels.add(label)
    found = [(m.start(), m.end(), rule) for key, rules in by_key.items() if key in flat for rule in rules for m in rule[2].finditer(flat)]
    # Priority first, then length, then place, then the order of the rules.
    found.sort(key=lambda h: (-h[2][1].priority, h[0] - h[1], h[0], h[2][0]))
    kept = uncontained([(a, b, rank, rule[1]) for rank, (a, b, rule) in enumerate(found)])
    spans = []
    if kept:
        first, last = at([h[0] for h in kept]), at([h[1] for h in kept])
        spans = sorted((a, b + 1, h[3].label, h[3].priority) for a, b, h in zip(first, last, kept, strict=True))
    labels = base_labels | {s[2] for s in spans}
    best = max([s[3] for s in spans], default=0) / 100
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(labels)),
        "score": max(best, 0.6 if places else 0.0),
        "spans": [{"start": a, "end": b, "label": label, "priority": p} for a, b, label, p in spans],
    }


_FIELDS = (
    ("n_words", T.LongType(), pa.int64()),
    ("n_base", T.LongType(), pa.int64()),
    ("first_word", T.LongType(), pa.int64()),
    ("last_word", T.LongType(), pa.int64()),
    ("base_labels", T.StringType(), pa.string()),
    ("labels", T.StringType(), pa.string()),
    ("score", T.DoubleType(), pa.float64()),
)
_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("label", T.StringType()), T.StructField("priority", T.IntegerType())]))
_SPAN_PA = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("priority", pa.int32())]))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans)."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), *(T.StructField(n, t) for n, t, _ in _FIELDS), T.StructField("spans", _SPAN)])

    def run(batches):
        for batch in batches:
            found = [scan(x.as_py() or b"") for x in batch.column(1)]
            columns = [pa.array([f[n] for f in found], kind) for n, _, kind in _FIELDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array([f["spans"] for f in found], _SPAN_PA)], names=schema.names)

    return map_arrow(df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), run, schema).withColumnRenamed("id", id_col)

"""Byte-level BPE with the tokenizers library over Arrow batches.

The model is built from a file of ranks: every way to put a token together from two lower ones is a
merge, in the order of the ranks. Bytes become printable characters by the usual byte table, so
that the library sees characters; token lengths in bytes give byte and character offsets, and
decoding reverses the table before it reads UTF-8, so characters split over tokens come back whole.

A text is cut where a space precedes a non-space: no match of the split pattern crosses such a
place. Pieces are looked up in a bounded table of pieces that the library has encoded already; the
others of a batch go to the library, each once.

Defined cases: null is empty; empty texts have no tokens; a text of any length is encoded whole, as a
batch of its own beyond 8 MB; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import map_arrow, text_bytes

#: Pieces kept by a worker, and characters of the longest one kept: what it holds is bounded in bytes too.
PIECES, LONGEST = 300_000, 48
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A space before a character that no one takes for white space starts a match.
_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?=\s|$)")


def byte_table() -> list[str]:
    """A printable character for each byte: itself where printable, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, lines))}


class Codec:
    """Encodes and decodes by a file of ranks."""

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path or public_tokenizers.path(VOCABULARY))
        table = byte_table()
        chars = {token: "".join(table[b] for b in token) for token in ranks}
        merges = []
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            for k in range(1, len(token)):
                a, b = token[:k], token[k:]
                if ranks.get(a, rank) < rank and ranks.get(b, rank) < rank:
                    merges.append((chars[a], chars[b]))
        self.library = Tokenizer(models.BPE(vocab={chars[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        back = {c: b for b, c in enumerate(table)}
        self.token_bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token_bytes[rank] = bytes(back[c] for c in chars[token])
        self.lengths = np.array([len(t) for t in self.token_bytes], dtype=np.int64)
        self.known: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        """The text's pieces without the space that starts each but the first."""
        return _CUT.split(text) if _ODD.search(text) else text.split(" ")

    def _encode_new(self, pieces: list[str]) -> dict[str, bytes]:
        got = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return {p: np.array(x.ids, dtype="<u4").tobytes() for p, x in zip(pieces, got, strict=True)}

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        cut, new, known = [], set(), self.known
        for text in texts:
            first, *rest = self._pieces(text)
            cut.append((first, rest))
            new.update(rest)
        new = {" " + p for p in new if p not in known}
        firsts = {f for f, _ in cut if f}
        # Pieces after a space are kept without it; a text's first piece is encoded as it stands.
        fresh = {p[1:]: ids for p, ids in self._encode_new(list(new)).items()}
        plain = self._encode_new(list(firsts)) | {"": b""}
        if len(known) < PIECES:
            known.update((p, x) for p, x in fresh.items() if len(p) <= LONGEST)
        out = []
        for first, rest in cut:
            ids = list(map(known.get, rest))
            if None in ids:
                ids = [fresh[p] if x is None else x for p, x in zip(rest, ids, strict=True)]
            out.append(plain[first] + b"".join(ids))
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    def offsets(self, ids: bytes) -> tuple[list[int], list[int]]:
        """Each token's first character and the one after its last; a character that tokens share
        belongs to all of them."""
        ends = np.cumsum(self.lengths[np.frombuffer(ids, dtype="<u4")])
        data = np.frombuffer(self.decode(ids), dtype=np.uint8)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        inside = (data[starts] & 0xC0) == 0x80 if len(ends) else np.zeros(0, bool)
        return (lead[starts] - inside).tolist(), lead[ends].tolist()


_codecs: dict[str | None, Codec] = {}


def codec(path: str | None = None) -> Codec:
    """This process's codec for a file of ranks."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _text(data: bytes) -> str:
    return data.decode("utf-8", "replace")


def _batches(column: pa.Array, most: int = 8_000_000):
    """Runs of rows of about ``most`` bytes, longer only for a single text."""
    rows, held = [], 0
    for x in column:
        data = x.as_py() or b""
        rows.append(data)
        held += len(data)
        if held >= most:
            yield rows
            rows, held = [], 0
    if rows:
        yield rows


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, offsets: bool = False) -> DataFrame:
    """(id, ids array<int>), with char_starts and char_ends arrays if asked for."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if offsets:
        schema = schema.add("char_starts", T.ArrayType(T.IntegerType())).add("char_ends", T.ArrayType(T.IntegerType()))

    def run(batches):
        c = codec(path)
        for batch in batches:
            at = 0
            for rows in _batches(batch.column(1)):
                packed = c.encode_batch([_text(r) for r in rows])
                out = [batch.column(0).slice(at, len(rows)), pa.array([np.frombuffer(p, dtype="<u4").astype(np.int32) for p in packed], pa.list_(pa.int32()))]
                if offsets:
                    both = [c.offsets(p) for p in packed]
                    out += [pa.array([b[k] for b in both], pa.list_(pa.int32())) for k in (0, 1)]
                at += len(rows)
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return map_arrow(df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), run, schema).withColumnRenamed("id", id_col)


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text): the bytes of the ids, read as UTF-8 once they are all together."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("text", T.StringType())])

    def run(batches):
        c = codec(path)
        for batch in batches:
            texts = [_text(c.decode(np.array(x.as_py() or [], dtype="<u4").tobytes())) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=schema.names)

    return map_arrow(df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")), run, schema).withColumnRenamed("id", id_col)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of each text, encoded and decoded again."""
    schema = T.StructType(
        [T.StructField("id", df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    )

    def run(batches):
        c = codec(path)
        for batch in batches:
            at = 0
            for rows in _batches(batch.column(1)):
                packed = c.encode_batch([_text(r) for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(rows)),
                        pa.array([len(p) // 4 for p in packed], pa.int64()),
                        pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                        pa.array([hashlib.sha256(c.decode(p)).hexdigest() for p in packed], pa.string()),
                    ],
                    names=schema.names,
                )
                at += len(rows)

    return map_arrow(df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), run, schema).withColumnRenamed("id", id_col)

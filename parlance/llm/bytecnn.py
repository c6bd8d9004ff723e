"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters of ``WIDTH`` bytes run over every place of a text, in chunks that overlap by
WIDTH - 1 bytes so that no place is lost at a border. Each chunk's responses are max-pooled; a
text's features are the largest and the mean of its chunks' pools and the mean response over all
places; a logistic unit makes one probability of them.

Byte embeddings and filter taps are multiplied out after training: tap pairs become tables of
65,536 rows, so a response is the sum of a few table rows.

Training takes labelled rows by the hash of their ids, whole and of whatever length: at most
``most_rows``, and as many as it takes to reach ``most_rows`` times ``most_bytes`` bytes; both bounds
are parameters. A step goes over a text in spans of chunks, so its memory does not follow the
text's length. Scoring covers every byte of every text.

Defined cases: null is empty; a text shorter than the filters is padded with zero bytes; without
labels the score is 0.5 for all; labels that are null are not used; a text of any length is scored
chunk by chunk; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import fold, map_arrow, text_bytes

WIDTH, FILTERS, EMBED, CHUNK = 4, 12, 8, 4096
#: Chunks that a training step holds at once.
SPAN = 64
THRESHOLD = 0.3


def _pad(data: bytes) -> np.ndarray:
    return np.frombuffer(data + b"\0" * max(0, WIDTH - len(data)), dtype=np.uint8)


class Net:
    """Weights: byte embeddings E, filters W and b, output V and c."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.p = {
            "E": r.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "W": r.normal(0, 0.25, (WIDTH, EMBED, FILTERS)).astype(np.float32),
            "b": np.zeros(FILTERS, np.float32),
            "V": r.normal(0, 0.1, 3 * FILTERS).astype(np.float32),
            "c": np.zeros(1, np.float32),
        }
        self.pairs = None

    def freeze(self) -> "Net":
        """Multiply embeddings and taps out into pair tables, the bias in the first."""
        taps = np.einsum("ve,wef->wvf", self.p["E"], self.p["W"])
        tables = [(taps[k][None, :, :] + taps[k + 1][:, None, :]).reshape(65536, FILTERS) for k in range(0, WIDTH, 2)]
        tables[0] = tables[0] + self.p["b"]
        self.pairs = [t.astype(np.float32) for t in tables]
        return self

    def pool(self, data: bytes) -> np.ndarray:
        """A text's features."""
        x = _pad(data).astype(np.uint16)
        pairs = x[:-1] | (x[1:] << 8)  # the first byte of a pair is the lower
        top, chunk_sum, place_sum, chunks = np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float64), np.zeros(FILTERS, np.float64), 0
        places = len(x) - WIDTH + 1
        for start in range(0, places, CHUNK - WIDTH + 1):
            n = min(CHUNK - WIDTH + 1, places - start)
            out = self.pairs[0].take(pairs[start : start + n], axis=0)
            for k in range(1, WIDTH // 2):
                out += self.pairs[k].take(pairs[start + 2 * k : start + 2 * k + n], axis=0)
            np.maximum(out, 0, out=out)
            best = out.max(axis=0)
            np.maximum(top, best, out=top)
            chunk_sum += best
            place_sum += out.sum(axis=0)
            chunks += 1
        return np.concatenate([top, chunk_sum / chunks, place_sum / places]).astype(np.float32)

    def score(self, data: bytes) -> float:
        z = float(self.pool(data) @ self.p["V"] + self.p["c"][0])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def _span(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings and responses of a span's bytes."""
        seen = self.p["E"][x]
        n = len(x) - WIDTH + 1
        out = np.broadcast_to(self.p["b"], (n, FILTERS)).copy()
        for k in range(WIDTH):
            out += seen[k : k + n] @ self.p["W"][k]
        return seen, np.maximum(out, 0, out=out)

    def _step(self, data: bytes) -> tuple[np.ndarray, tuple]:
        """Features of a text as the network stands, and what the gradient needs."""
        x = _pad(data)
        n, pace = len(x) - WIDTH + 1, CHUNK - WIDTH + 1
        spans, best, total, kept = range(0, n, SPAN * pace), [], np.zeros(FILTERS), None
        for s in spans:
            kept = self._span(x[s : s + SPAN * pace + WIDTH - 1])
            best += [kept[1][a : a + pace].max(axis=0) for a in range(0, len(kept[1]), pace)]
            total += kept[1].sum(axis=0)
        best = np.stack(best)
        # A text of one span is not computed again for its gradient.
        return np.concatenate([best.max(axis=0), best.mean(axis=0), total / n]).astype(np.float32), (x, n, spans, best, kept if len(spans) == 1 else None)

    def _gradient(self, d: np.ndarray, held: tuple, g: dict[str, np.ndarray]) -> None:
        """Add to ``g`` what follows from the features' gradient ``d``."""
        (x, n, spans, best, kept), cols, pace = held, np.arange(FILTERS), CHUNK - WIDTH + 1
        top = best.argmax(axis=0)
        for s in spans:
            part = x[s : s + SPAN * pace + WIDTH - 1]
            seen, out = kept or self._span(part)
            grad = np.where(out > 0, d[2 * FILTERS :] / n, 0).astype(np.float32)
            for k, a in enumerate(range(0, len(out), pace), s // pace):
                at = a + out[a : a + pace].argmax(axis=0)
                grad[at, cols] += np.where(out[at, cols] > 0, d[FILTERS : 2 * FILTERS] / len(best) + np.where(top == k, d[:FILTERS], 0), 0)
            g["b"] += grad.sum(axis=0)
            back = np.zeros_like(seen)
            for k in range(WIDTH):
                g["W"][k] += seen[k : k + len(grad)].T @ grad
                back[k : k + len(grad)] += grad @ self.p["W"][k].T
            for e in range(EMBED):
                g["E"][:, e] += np.bincount(part, weights=back[:, e], minlength=256)

    def train(self, texts: list[bytes], labels: list[int], epochs: int = 10, batch: int = 16, rate: float = 0.015, seed: int = 7) -> "Net":
        """Adam on logistic loss, classes weighted alike."""
        r, y = np.random.default_rng(seed), np.array(labels, np.float32)
        share = float(np.clip(y.mean(), 0.02, 0.98))
        weight = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        t, total = 0, epochs * -(-len(texts) // batch)
        for _ in range(epochs):
            order = r.permutation(len(texts))
            for start in range(0, len(order), batch):
                g = {k: np.zeros_like(v) for k, v in self.p.items()}
                for i in order[start : start + batch]:
                    f, held = self._step(texts[i])
                    err = float(weight[i] * (1 / (1 + np.exp(-np.clip(f @ self.p["V"] + self.p["c"][0], -30, 30))) - y[i]) / batch)
                    g["V"] += err * f
                    g["c"] += err
                    self._gradient(err * self.p["V"], held, g)
                t += 1
                lr = rate * (1 - 0.9 * t / total)
                for k, v in self.p.items():
                    m[k] += 0.1 * (g[k] - m[k])
                    s[k] += 0.01 * (g[k] ** 2 - s[k])
                    v -= (lr * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
        return self


def labelled_sample(documents: DataFrame, labels: DataFrame, most_rows: int, most_bytes: int) -> list[tuple[bytes, int]]:
    """At most ``most_rows`` rows that may be learned from, chosen by the hash of the id, up to the one
    that reaches ``most_rows * most_bytes`` bytes."""
    known = labels.filter((fold() != 0) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    order = [F.xxhash64(F.col("doc_id"), F.lit(1)), "doc_id", "bytes", "quality"]
    texts = documents.select("doc_id", text_bytes().alias("data")).withColumn("bytes", F.octet_length("data"))
    # Lengths first, without texts.
    drawn = texts.select("doc_id", "bytes").join(known, "doc_id").orderBy(*order).limit(most_rows).collect()
    n, held = 0, 0
    while n < len(drawn) and held < most_rows * most_bytes:
        n, held = n + 1, held + drawn[n]["bytes"]
    if not n:
        return []
    ids = documents.sparkSession.createDataFrame(sorted({(r["doc_id"],) for r in drawn[:n]}), documents.select("doc_id").schema)
    rows = texts.join(F.broadcast(ids), "doc_id").join(F.broadcast(known.join(F.broadcast(ids), "doc_id", "left_semi")), "doc_id").orderBy(*order, "data").limit(n).select("data", "quality").collect()
    return [(bytes(r[0]), int(r[1])) for r in rows]


def fit(documents: DataFrame, labels: DataFrame, most_rows: int = 2500, most_bytes: int = 4096) -> Net | None:
    rows = labelled_sample(documents, labels, most_rows, most_bytes)
    if not rows:
        return None
    return Net().train([r[0] for r in rows], [r[1] for r in rows]).freeze()


def score(df: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted)."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in batches:
            scores = [net.score(x.as_py() or b"") if net else 0.5 for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())], names=schema.names)

    return map_arrow(df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")), run, schema).withColumnRenamed("id", id_col)


def keep_good(df: DataFrame, net: Net | None, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, whole, that the network accepts."""
    at = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(at)
            keep = [net is None or net.score((x.as_py() or "").encode("utf-8", "surrogatepass")) >= THRESHOLD for x in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_arrow(df, run, df.schema)

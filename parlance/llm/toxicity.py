"""Toxicity: maximum-scoring segments of token log-odds, calibrated as extreme values.

Tokens are runs of letters in lower case. A token's evidence is the log-odds of toxic against clean
texts under a Dirichlet prior, of the whole token or of one of its beginnings of ``SHORT`` to ``LONG``
letters, so that inflected forms share what is known; of these the strongest counts, by its lower
bound ``SURE`` standard deviations below the estimate. A beginning needs ``FORMS`` tokens in toxic texts, and
each of these counts once a fold, so that no single word speaks for all that begin like it. Every
token costs ``DRIFT``, so that scores fall over clean text. All maximal segments (those whose every prefix and suffix scores above 0 and
that no longer one contains) are found in one pass, in time linear in the tokens.

In clean text the best of n tokens' segments follows an extreme-value law: more than K n exp(-l S)
segments of score S or above are not expected. l is the root that the clean tokens' scores have, K
fits the clean texts' best segments. A segment of fewer than ``EXPECTED`` expected ones is a toxic
passage; a text's evidence is the sum of its passages' -log of that number, and a logistic curve makes a
probability of it. l, K and the curve come from labelled texts that the weights have not seen: each
fold is scored by the weights of the others.

Learned from labelled rows by the hash of their ids: at most ``most_toxic`` and ``most_clean`` rows and
``most_bytes`` bytes a row of these on average, all three parameters; a text that would pass the
bound is left out. Of rows that share a sketch and a label, as copies do, one counts. Features are
counted by Spark; those that speak for toxicity come to the driver, bounded by the sample.

Defined cases: null is empty; a text without letters has the score of one without passages; rows that
repeat an id are scored one by one, and an id whose labels disagree is toxic; labels that are null are
not used; without toxic or without clean labels the score is 0 for all; a text of any length is
scored whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from math import exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import discard, fold, map_arrow, materialize, whole_text

SHORT, LONG, FORMS = 3, 8, 3
SURE, DRIFT, EXPECTED, THRESHOLD = 1.64, 0.5, 0.5, 0.5
#: Texts that a feature's prior counts in each class.
PRIOR = 0.5
FOLDS = (1, 2, 3, 4)
#: Tokens counted before they are passed on, and tokens that a worker remembers.
HELD = 300_000
_TOKEN = re.compile(r"[^\W\d_]+")


def tokens_of(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def features_of(token: str) -> list[str]:
    """The whole token, marked by its end, and its beginnings."""
    return [token + "$", *(token[:k] for k in range(SHORT, min(LONG, len(token)) + 1))]


def sketch(tokens: list[str]) -> int:
    """The least hash of three tokens in a row: texts that are nearly alike mostly share it."""
    if len(tokens) < 3:
        return xxhash.xxh3_64_intdigest(" ".join(tokens).encode()) - 2**63
    return min(xxhash.xxh3_64_intdigest(f"{a} {b} {c}".encode()) for a, b, c in zip(tokens, tokens[1:], tokens[2:])) - 2**63


def weights(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Lower bounds of the log-odds of features that stand in so many texts of each class."""
    a, b = toxic + PRIOR, clean + PRIOR
    odds = np.log(a / np.maximum(n_toxic + 2 * PRIOR - a, PRIOR)) - np.log(b / np.maximum(n_clean + 2 * PRIOR - b, PRIOR))
    return odds - SURE * np.sqrt(1 / a + 1 / b)


def segments(places: list[int], gains: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """(first, last, score) of all maximal segments, in order: tokens at ``places`` score ``gains``, all
    others ``-drift``. A segment's score is what its tokens' add up to."""
    out: list[list] = []  # first, last, the sum before and after, the nearest earlier one with a smaller sum before
    total, at = 0.0, -1
    for p, gain in zip(places, gains, strict=True):
        before = total - drift * (p - at - 1)
        total, at = before + gain, p
        new = [p, p, before, total, -1]
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= new[2]:
                j = out[j][4]
            if j < 0 or out[j][3] >= new[3]:
                new[4] = j
                out.append(new)
                break
            # It grows to the left, over all that lies between.
            new[0], new[2] = out[j][0], out[j][2]
            before_j = out[j][4]
            del out[j:]
            j = before_j
    return [(first, last, after - before) for first, last, before, after, _ in out]


@dataclass
class Model:
    """Gains of features, and the calibration."""

    gains: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    scale: float = 1.0
    slopes: tuple[float, float] = (0.0, 0.0)
    base: float = -30.0
    _gain_of: dict = field(default_factory=dict, repr=False)
    _seen: set = field(default_factory=set, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_gain_of": {}, "_seen": set()}

    def found(self, tokens: list[str]) -> tuple[list[int], list[float]]:
        """Places and gains of the tokens that speak for toxicity more than they cost."""
        own = set(tokens)
        if len(self._seen) > HELD:
            self._seen.clear()
            self._gain_of.clear()
        for w in own - self._seen:
            gain = max((self.gains.get(x, 0.0) for x in features_of(w)), default=0.0) - DRIFT
            if gain > 0:
                self._gain_of[w] = gain
        self._seen |= own
        if not own & self._gain_of.keys():
            return [], []
        get = self._gain_of.get
        hits = [(p, g) for p, g in enumerate(map(get, tokens)) if g is not None]
        return [p for p, _ in hits], [g for _, g in hits]

    def passages(self, tokens: list[str]) -> list[tuple[int, int, float, float]]:
        """(first, last, score, expected) of the significant segments."""
        some = [(a, b, s, self.scale * len(tokens) * exp(-self.rate * s)) for a, b, s in segments(*self.found(tokens))]
        return [x for x in some if x[3] < EXPECTED]

    def probability(self, expected: list[float]) -> float:
        z = self.base + sum(w * x for w, x in zip(self.slopes, evidence_of(expected), strict=True))
        return 1 / (1 + exp(-min(30.0, max(-30.0, z))))


def evidence_of(expected: list[float]) -> tuple[float, float]:
    """What passages of so many expected ones each say: the strongest of them, and all together."""
    said = [-log(max(x, 1e-300)) for x in expected]
    return log(1 + max(said, default=0.0)), log(1 + sum(said))


def labelled(documents: DataFrame, labels: DataFrame, most_toxic: int, most_clean: int, most_bytes: int) -> DataFrame | None:
    """(text, toxic, fold) of the rows to learn from, written."""
    known = labels.filter((fold() != 0) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = documents.select("doc_id", whole_text().alias("text"))
    sizes = texts.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("bytes")).join(known, "doc_id")
    chosen = []
    for toxic, most in ((1, most_toxic), (0, most_clean)):
        # Ids and lengths only, at most ``most``.
        drawn = sizes.filter(F.col("toxic") == toxic).orderBy(F.xxhash64(F.col("doc_id"), F.lit(13)), "doc_id").select("doc_id", "bytes").limit(most).collect()
        left = most * most_bytes
        for r in drawn:
            if r["bytes"] <= left:
                left -= r["bytes"]
                chosen.append((r["doc_id"], toxic))
    if len({t for _, t in chosen}) < 2:
        return None
    kind = documents.schema["doc_id"].dataType.simpleString()
    ids = documents.sparkSession.createDataFrame(chosen, f"doc_id {kind}, toxic int")
    return materialize(texts.join(F.broadcast(ids), "doc_id").select("text", "toxic", fold().alias("fold")))


def _unlike(sample: DataFrame) -> DataFrame:
    """Of rows that share a sketch and a label, one."""

    def run(batches):
        for batch in batches:
            marks = [sketch(tokens_of(x.as_py())) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], names=["text", "toxic", "fold", "sketch"])

    marked = map_arrow(sample.select("text", "toxic", "fold"), run, "text string, toxic int, fold int, sketch long")
    return materialize(marked.groupBy("sketch", "toxic").agg(F.min(F.struct("fold", "text")).alias("one")).select("one.text", "toxic", "one.fold"))


def _counts(sample: DataFrame) -> DataFrame:
    """(token, t1..t4, c1..c4): texts of each class and fold that hold a token."""
    names = [f"{c}{k}" for c in "tc" for k in FOLDS]

    def run(batches):
        held: dict[str, list[int]] = {}

        def rows():
            columns = zip(*held.values(), strict=True) if held else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array(list(c), pa.int64()) for c in columns)], names=["token", *names])

        for batch in batches:
            for text, toxic, part in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                at = (0 if toxic else len(FOLDS)) + FOLDS.index(part)
                for w in set(tokens_of(text.as_py())):
                    held.setdefault(w, [0] * len(names))[at] += 1
                if len(held) > HELD:
                    yield rows()
                    held.clear()
        yield rows()

    schema = "token string, " + ", ".join(f"{n} long" for n in names)
    return materialize(map_arrow(sample.select("text", "toxic", "fold"), run, schema).groupBy("token").agg(*[F.sum(n).alias(n) for n in names]))


def _features(tokens: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """(feature, t1..t4, c1..c4) of the tokens and beginnings that can gain."""
    toxic, clean = (sum((F.col(f"{c}{k}") for k in FOLDS[1:]), F.col(f"{c}1")) for c in "tc")
    sizes = F.sequence(F.lit(SHORT), F.least(F.lit(LONG), F.length("token")))
    begun = tokens.filter(F.length("token") >= SHORT).withColumn("feature", F.explode(F.transform(sizes, lambda k: F.substring("token", F.lit(1), k))))
    begun = begun.groupBy("feature").agg(
        *[F.sum(F.least(F.col(f"t{k}"), F.lit(1))).alias(f"t{k}") for k in FOLDS], *[F.sum(f"c{k}").alias(f"c{k}") for k in FOLDS], F.count_if(toxic > 0).alias("forms")
    )
    both = tokens.withColumnRenamed("token", "feature").withColumn("feature", F.concat("feature", F.lit("$"))).union(begun.filter(F.col("forms") >= FORMS).drop("forms"))
    return both.filter((toxic >= 3) & (toxic * F.lit(n_clean) > clean * F.lit(n_toxic)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[tuple[float, ...], float]:
    """Slopes and base of a logistic curve, by Newton's steps with a small ridge. A slope below 0 is left
    out: more evidence never makes a text less likely toxic."""
    used = list(range(x.shape[1]))
    while True:
        design, w = np.column_stack([x[:, used], np.ones(len(x))]), np.zeros(len(used) + 1)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            grad = design.T @ (p - y) + 0.05 * w
            step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.05 * np.eye(len(w)), grad)
            w -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        if not used or w[:-1].min() >= 0:
            slopes = dict(zip(used, w[:-1].tolist(), strict=True))
            return tuple(slopes.get(k, 0.0) for k in range(x.shape[1])), float(w[-1])
        del used[int(w[:-1].argmin())]


def _rate(steps: dict[float, int]) -> float:
    """The root l > 0 of sum(p(s) exp(l s)) = 1 over clean tokens' scores s."""
    s, n = np.array(list(steps), float), np.array(list(steps.values()), float)
    if not (s > 0).any():
        return 1.0
    p = n / n.sum()
    if p @ s >= 0:
        return 0.1
    low, high = 1e-6, 1.0
    while p @ np.exp(np.minimum(high * s, 500)) < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(np.minimum(mid * s, 500)) < 1 else (low, mid)
    return high


def fit(documents: DataFrame, labels: DataFrame, most_toxic: int = 8_000, most_clean: int = 24_000, most_bytes: int = 3_000) -> Model:
    drawn = labelled(documents, labels, most_toxic, most_clean, most_bytes)
    if drawn is None:
        return Model()
    sample = _unlike(drawn)
    sizes = {(r["toxic"], r["fold"]): r["n"] for r in sample.groupBy("toxic", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = [sum(n for (t, _), n in sizes.items() if t == c) for c in (1, 0)]
    tokens = _counts(sample)
    rows = _features(tokens, *total).toArrow()
    features = rows.column("feature").to_pylist()
    t, c = (np.stack([rows.column(f"{x}{k}").to_numpy() for k in FOLDS]).astype(float) for x in "tc")

    def gains(without: int | None) -> dict[str, float]:
        used = [i for i, k in enumerate(FOLDS) if k != without]
        n_t, n_c = (sum(sizes.get((x, FOLDS[i]), 0) for i in used) for x in (1, 0))
        w = weights(t[used].sum(axis=0), c[used].sum(axis=0), n_t, n_c)
        return {features[i]: float(w[i]) for i in np.flatnonzero(w > DRIFT)}

    model = Model(gains(None))
    others = {k: Model(gains(k)) for k in FOLDS}

    def judge(batches):
        for batch in batches:
            out = []
            for text, part in zip(batch.column(0), batch.column(2).to_pylist(), strict=True):
                tokens = tokens_of(text.as_py())
                places, gained = others[part].found(tokens)
                out.append((len(tokens), [s for _, _, s in segments(places, gained)], gained))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.list_(pa.float64())), pa.array([x[2] for x in out], pa.list_(pa.float64()))], names=["toxic", "n", "scores", "gained"]
            )

    judged = map_arrow(sample.select("text", "toxic", "fold"), judge, "toxic int, n long, scores array<double>, gained array<double>").collect()
    steps: dict[float, int] = {}
    for r in judged:
        if not r["toxic"]:
            steps[-DRIFT] = steps.get(-DRIFT, 0) + r["n"] - len(r["gained"])
            for g in r["gained"]:
                steps[g] = steps.get(g, 0) + 1
    model.rate = _rate(steps)
    tops = [(r["n"], max(r["scores"], default=0.0)) for r in judged if not r["toxic"] and r["n"]]
    model.scale = len(tops) / max(1e-9, sum(n * exp(-model.rate * s) for n, s in tops)) if tops else 1.0
    said = [evidence_of([e for s in r["scores"] if (e := model.scale * r["n"] * exp(-model.rate * s)) < EXPECTED]) for r in judged]
    model.slopes, model.base = _logistic(np.array(said), np.array([float(r["toxic"]) for r in judged]))
    discard(drawn, sample, tokens)
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, n_tokens, passages): passages by their first and last token, from 0, their score
    and how many such are expected in a clean text of this length."""
    kind = df.schema[id_col].dataType.simpleString()
    passage = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        judge = sent.value
        for batch in batches:
            scores, sizes, found = [], [], []
            for text in batch.column(1):
                tokens = tokens_of(text.as_py())
                own = judge.passages(tokens) if tokens else []
                scores.append(judge.probability([x[3] for x in own]))
                sizes.append(len(tokens))
                found.append([dict(zip(("first", "last", "score", "expected"), x, strict=True)) for x in own])
            predicted = [int(s >= THRESHOLD) for s in scores]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(predicted, pa.int32()), pa.array(sizes, pa.int64()), pa.array(found, passage)], names=["id", "score", "predicted", "n_tokens", "passages"])

    schema = f"id {kind}, score double, predicted int, n_tokens long, passages array<struct<first:bigint,last:bigint,score:double,expected:double>>"
    return map_arrow(df.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")), run, schema).withColumnRenamed("id", id_col)

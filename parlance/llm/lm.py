"""Language-model scoring: a log-bilinear model trained in numpy with noise-contrastive estimation.

Tokens are the words of a text, A-Z lower-cased, and one end. Counts are taken over every text that
may be learned from. Words held by at least N / ``FREQUENT`` tokens, of at most ``LONGEST`` bytes, and
the end are outputs and contexts of their own; all others share hashed groups of about ``GROUP``
words, so the vocabulary follows the corpus and no word is without a vector. The context is the two
tokens before. Their vectors, each put through a matrix of its position, add up to a prediction. An
output's probability is its class's times its own within the class, each a softmax of products with
the prediction; classes are runs of outputs, the first ``HEADS`` alone in theirs. Both are trained by
noise-contrastive loss over every three tokens in a row of the corpus: a step takes ``STEP`` of them,
with one draw of noise classes for all and one of noise outputs a class, so that it is a few matrix
products. Each training task goes through its texts once (small corpora are repeated up to ``DRAWS``
tokens), and the tasks' weights are averaged by tokens. Scores are normalised exactly.

A word of a group has the group's probability times its share in it, (c + 0.5) / (N' + 0.5 (V' + 1))
with counts of the group's words only. So a text's score is the log10 probability of a proper
distribution over texts.

Texts are cut into words twice, by Arrow kernels: for the counts, and to be written as numbers of
outputs, which training and scoring read. Frequent words are at most FREQUENT in number and are
broadcast; the counts of all others reach their texts by a join.

Defined cases: null is empty, and an empty text is its end alone; a text of any length is scored
whole, ``AT_ONCE`` tokens at a time; without texts to learn from the score is the base score; rows
that repeat an id are scored one by one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.llm.common import fold, map_arrow, materialize, text_bytes

SIZE = 16
#: Outputs alone in their class, noise outputs a class, and noise classes.
HEADS, NOISE, SHARED = 128, 2, 64
#: Words that share a group, and the most groups.
GROUP, GROUPS = 256, 1 << 14
#: Tokens a training step, steps whose tokens are mixed, fewest tokens trained on, fewest a task, and most tasks.
STEP, MIXED, DRAWS, TASK_TOKENS, TASKS = 4096, 64, 1_000_000, 500_000, 64
RATE = 0.07
#: Tokens scored at once, rows of scores held at once, and classes whose exponentials are.
AT_ONCE, ROWS, PART = 262_144, 256, 128
#: Exponents up to which the product of two exponentials of 32 bits, and their sum, stay in range.
SAFE = 40
FREQUENT, LONGEST = 1 << 19, 64
#: Bytes of text cut into words at once.
SLICE = 8_000_000
#: Lower-cases A-Z and makes each white-space byte a space.
_BYTES = np.array([c + 32 if 0x41 <= c <= 0x5A else 0x20 if 9 <= c <= 13 else c for c in range(256)], dtype=np.uint8)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of a column of bytes, end to end, and the number of words before each text's first."""
    starts = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = _BYTES[np.frombuffer(texts.buffers()[2], np.uint8)[starts[0] : starts[-1]]] if texts.buffers()[2] else np.zeros(0, np.uint8)
    flat = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer((starts - starts[0]).astype(np.int32)), pa.py_buffer(data)])
    lists = pc.split_pattern(flat, " ")
    held = np.asarray(pc.not_equal(pc.binary_length(lists.values), 0))
    return lists.values.filter(pa.array(held)).cast(pa.binary()), np.r_[0, np.cumsum(held)][lists.offsets.to_numpy()]


def slices(texts: pa.Array):
    """(start, rows) of runs of texts of about SLICE bytes; a longer text is one by itself."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + SLICE, side="right")) - 1)
        yield a, texts.slice(a, b - a)
        a = b


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of rows (text as bytes)."""

    def run(batches):
        for batch in batches:
            for _, some in slices(batch.column(0)):
                counts = pc.value_counts(words_of(some)[0])
                yield pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], names=["word", "c"])

    return map_arrow(texts, run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place, so much at once as a core's cache holds."""
    flat = x.reshape(-1)
    with np.errstate(over="ignore"):
        for k in range(0, len(flat), 1 << 14):
            v = flat[k : k + (1 << 14)]
            np.negative(v, out=v)
            np.exp(v, out=v)
            v += 1
            np.reciprocal(v, out=v)
    return x


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def _run_sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The rows of each run added up: of short runs, which are most, all second rows at once, and so on."""
    if len(rows) > 8 * len(first):
        return np.add.reduceat(rows, first, axis=0)
    n, out = np.full(len(first), len(rows)), rows.take(first, axis=0)
    n[:-1] = first[1:]
    n -= first
    for k in range(1, 4):
        at = np.flatnonzero((n > k) & (n <= 4))
        out[at] += rows.take(first[at] + k, axis=0)
    long = np.flatnonzero(n > 4)
    if len(long):
        size = n[long]
        out[long] = np.add.reduceat(rows.take(np.flatnonzero(np.repeat(n > 4, n)), axis=0), np.cumsum(size) - size, axis=0)
    return out


def _sums(which: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, and the rows of each added up."""
    order = np.argsort(which)
    which = which.take(order)
    first = _runs(which)
    return which[first], _run_sums(rows.take(order, axis=0), first)


class LogBilinear:
    """Vectors R of context tokens, Q of outputs and K of classes, position matrices C1 and C2, biases b and a."""

    def __init__(self, shares: np.ndarray, seed: int = 11):
        r, n = np.random.default_rng(seed), len(shares)
        heads = min(n, HEADS)
        self.heads = heads
        self.starts = np.r_[np.arange(heads), np.arange(heads, n, max(1, math.ceil(math.sqrt(n - heads)))), n]
        self.kind = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        self.noise = shares / shares.sum()
        self.run = np.r_[0, np.cumsum(self.noise)]
        self.class_noise = np.diff(self.run[self.starts])
        self.class_run = np.cumsum(self.class_noise)
        inside = self.noise / self.class_noise[self.kind]
        self.p = {
            "R": r.normal(0, 0.1, (n, SIZE)), "Q": r.normal(0, 0.1, (n, SIZE)), "K": r.normal(0, 0.1, (len(self.class_noise), SIZE)),
            "C1": np.eye(SIZE) + r.normal(0, 0.02, (SIZE, SIZE)), "C2": np.eye(SIZE) * 0.5 + r.normal(0, 0.02, (SIZE, SIZE)),
            "b": np.log(inside), "a": np.log(self.class_noise),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.bar = np.log(NOISE * inside).astype(np.float32)
        self.class_bar = np.log(SHARED * self.class_noise).astype(np.float32)
        self.seen = {k: np.full(len(v) if k in "RQKba" else v.shape, 1e-6, np.float32) for k, v in self.p.items()}

    def _move(self, name: str, which: np.ndarray, g: np.ndarray) -> None:
        """Adagrad on some rows, each named once."""
        seen = self.seen[name].take(which) + (np.einsum("ij,ij->i", g, g) / SIZE if g.ndim > 1 else g * g)
        self.seen[name][which] = seen
        by = RATE / np.sqrt(seen)
        self.p[name][which] = self.p[name].take(which, axis=0) - (by[:, None] * g if g.ndim > 1 else by * g)

    def step(self, second: np.ndarray, first: np.ndarray, w: np.ndarray, r: np.random.Generator) -> None:
        """One move on the noise-contrastive losses of classes and of outputs within them."""
        order = np.argsort(w)
        second, first, w = second.take(order), first.take(order), w.take(order)
        p, c = self.p, self.kind.take(w)
        r1, r2 = p["R"].take(first, axis=0), p["R"].take(second, axis=0)
        hidden = r1 @ p["C1"] + r2 @ p["C2"]
        # Classes, against shared noise.
        drawn = np.minimum(np.searchsorted(self.class_run, r.random(SHARED) * self.class_run[-1]), len(self.class_noise) - 1)
        own, over = p["K"].take(c, axis=0), p["a"] - self.class_bar
        good = _sigmoid(np.einsum("ij,ij->i", hidden, own) + over.take(c)) - 1
        bad = hidden @ p["K"][drawn].T
        bad += over[drawn]
        bad = _sigmoid(bad)
        dh = good[:, None] * own
        dh += bad @ p["K"][drawn]
        runs = _runs(c)
        pairs = (c[runs], drawn), (_run_sums(good[:, None] * hidden, runs), bad.T @ hidden), (np.add.reduceat(good, runs), bad.sum(axis=0))
        at, g, gb = (np.concatenate(x) for x in pairs)
        # Outputs within classes of several, against noise of their class.
        m = int(np.searchsorted(w, self.heads))
        if m < len(w):
            h, ws, cs = hidden[m:], w[m:], c[m:]
            runs = _runs(cs)
            kinds, which = cs[runs], np.repeat(np.arange(len(runs)), np.diff(np.r_[runs, len(cs)]))
            u = self.run[self.starts[kinds]][:, None] + self.class_noise[kinds][:, None] * r.random((len(kinds), NOISE))
            others = np.clip(np.searchsorted(self.run, u, side="right") - 1, self.starts[kinds][:, None], self.starts[kinds + 1][:, None] - 1)
            q, qn = p["Q"].take(ws, axis=0), p["Q"][others]
            yes = _sigmoid(np.einsum("ij,ij->i", h, q) + p["b"].take(ws) - self.bar.take(ws)) - 1
            gn, gnb = np.empty((len(kinds), NOISE, SIZE), np.float32), np.empty((len(kinds), NOISE), np.float32)
            back = dh[m:]
            back += yes[:, None] * q
            bias = p["b"][others] - self.bar[others]
            for k in range(NOISE):
                qk = qn[:, k].take(which, axis=0)
                no = _sigmoid(np.einsum("ij,ij->i", h, qk) + bias[:, k].take(which))
                qk *= no[:, None]
                back += qk
                gn[:, k], gnb[:, k] = _run_sums(no[:, None] * h, runs), np.add.reduceat(no, runs)
            runs = _runs(ws)
            self._move("Q", ws[runs], _run_sums(yes[:, None] * h, runs))
            self._move("b", ws[runs], np.add.reduceat(yes, runs))
            self._move("Q", *_sums(others.ravel(), gn.reshape(-1, SIZE)))
            self._move("b", *_sums(others.ravel(), gnb.ravel()))
        self._move("K", *_sums(at, g))
        self._move("a", *_sums(at, gb))
        both = np.concatenate([dh @ p["C1"].T, dh @ p["C2"].T])
        for name, x in (("C1", r1), ("C2", r2)):
            g = x.T @ dh
            self.seen[name] += g * g
            p[name] -= 0.2 * RATE * g / np.sqrt(self.seen[name])
        self._move("R", *_sums(np.concatenate([first, second]), both))

    def _class_log_sums(self, second: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The logarithm of each context's sum of exponentials of class scores. A score is a part of the one token and a part of
        the other, so exponentials are taken once a distinct token and place, and the sum is a product of two rows of them."""
        p, n = self.p, len(self.kind)
        pairs, context = np.unique(first * n + second, return_inverse=True)
        f, s = np.divmod(pairs, n)
        ones, f = f[_runs(f)], np.cumsum(np.r_[False, f[1:] != f[:-1]])
        twos, s = np.unique(s, return_inverse=True)
        left, right = p["R"].take(ones, axis=0) @ p["C1"], p["R"].take(twos, axis=0) @ p["C2"]
        sums, far = np.zeros(len(pairs), np.float32), (np.zeros(len(ones), bool), np.zeros(len(twos), bool))
        for k in range(0, len(p["K"]), PART):
            turned = np.ascontiguousarray(p["K"][k : k + PART].T)
            parts = [left @ turned + p["a"][k : k + PART], right @ turned]
            for x, out in zip(parts, far, strict=True):
                if not (x.max() < SAFE and x.min() > -SAFE):
                    out |= ~(np.abs(x).max(axis=1) < SAFE)
                with np.errstate(over="ignore"):
                    for a in range(0, len(x), ROWS):
                        np.exp(x[a : a + ROWS], out=x[a : a + ROWS])
            unit = np.ones(turned.shape[1], np.float32)
            for a in range(0, len(pairs), ROWS):
                x = parts[0].take(f[a : a + ROWS], axis=0)
                with np.errstate(over="ignore", invalid="ignore"):
                    x *= parts[1].take(s[a : a + ROWS], axis=0)
                    sums[a : a + ROWS] += x @ unit
        with np.errstate(divide="ignore", invalid="ignore"):
            out = np.log(sums)
        # Beyond what products of two hold the whole scores are taken.
        direct = np.flatnonzero(far[0].take(f) | far[1].take(s))
        if len(direct):
            hidden = np.ones((len(direct), SIZE + 1), np.float32)
            hidden[:, :SIZE] = left[f[direct]] + right[s[direct]]
            out[direct] = _log_sums(hidden, np.c_[p["K"], p["a"]].T)
        return out.take(context)

    def log10(self, second: np.ndarray, first: np.ndarray, w: np.ndarray) -> np.ndarray:
        """log10 P(output | two tokens before); each context's probabilities add up to one."""
        p, out = self.p, np.empty(len(w))
        classes, outputs = np.c_[p["K"], p["a"]], np.c_[p["Q"], p["b"]]
        for k in range(0, len(w), AT_ONCE):
            one, two = first[k : k + AT_ONCE], second[k : k + AT_ONCE]
            order = np.argsort(w[k : k + AT_ONCE])
            v = w[k : k + AT_ONCE].take(order)
            # A last element of one, against which the biases stand.
            hidden, c = np.ones((len(v), SIZE + 1), np.float32), self.kind.take(v)
            hidden[:, :SIZE] = p["R"].take(one.take(order), axis=0) @ p["C1"]
            hidden[:, :SIZE] += p["R"].take(two.take(order), axis=0) @ p["C2"]
            part = np.einsum("ij,ij->i", hidden, classes.take(c, axis=0)) - self._class_log_sums(two, one).take(order)
            m = int(np.searchsorted(v, self.heads))
            if m < len(v):
                part[m:] += np.einsum("ij,ij->i", hidden[m:], outputs.take(v[m:], axis=0))
                runs = m + _runs(c[m:])
                for a, b in zip(runs.tolist(), [*runs[1:].tolist(), len(v)], strict=True):
                    part[a:b] -= _log_sums(hidden[a:b], outputs[self.starts[c[a]] : self.starts[c[a] + 1]].T)
            out[k + order] = part
        return out / math.log(10)


def _log_sums(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The logarithm of each row's sum of exponentials of ``left @ right``, some rows at a time."""
    out, ones = np.empty(len(left), np.float32), np.ones(right.shape[1], np.float32)
    for s in range(0, len(left), ROWS):
        scores = left[s : s + ROWS] @ right
        with np.errstate(over="ignore", divide="ignore"):
            sums = np.log(np.exp(scores, out=scores) @ ones)
        if not np.isfinite(sums).all():
            # Beyond what the numbers hold each row's largest is taken off first.
            scores = left[s : s + ROWS] @ right
            top = scores.max(axis=1)
            sums = top + np.log(np.exp(scores - top[:, None]) @ ones)
        out[s : s + ROWS] = sums
    return out


def triples(flat: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(second, first, output) of texts that lie end to end: two ends before each and one after."""
    n = np.diff(starts)
    padded = np.full(len(flat) + 3 * len(n), end, dtype=np.int64)
    padded[np.arange(len(flat)) + np.repeat(3 * np.arange(len(n)) + 2, n)] = flat
    at = np.arange(len(flat) + len(n)) + np.repeat(2 * np.arange(len(n)) + 2, n + 1)
    return padded[at - 2], padded[at - 1], padded[at]


class Scorer:
    """What the workers get: the frequent words with their counts, the groups' counts, totals, and the model."""

    def __init__(self, frequent: list[tuple[bytes, int]], groups: list[tuple[int, int]], ends: int, total: int, distinct: int):
        self.model: LogBilinear | None = None
        self.total, self.ends, self.groups = total, ends, len(groups)
        self.base_norm = total + 0.5 * (distinct + 1)
        self.words = pa.array([w for w, _ in frequent], pa.binary())
        counts = np.array([c for _, c in frequent], dtype=np.float64)
        self.base = np.log10((counts + 0.5) / self.base_norm)
        self.base_end = math.log10((ends + 0.5) / self.base_norm)
        sums = np.array([c for c, _ in groups], dtype=np.float64)
        self.group_norm = np.log10(sums + 0.5 * (np.array([n for _, n in groups]) + 1))
        # Outputs by falling count: of words, of groups, of the end.
        held = np.r_[counts, sums, ends] + 0.5
        order = np.argsort(-held, kind="stable")
        self.output = np.empty(len(held), dtype=np.int64)
        self.output[order] = np.arange(len(held))
        self.shares = held[order]

    @property
    def end(self) -> int:
        return int(self.output[-1])

    def encode(self, rows: np.ndarray, texts: pa.Array) -> tuple[dict, dict]:
        """Of each text its tokens, those of them known as frequent, base log10 of these, what groups take off, and
        the outputs as 32-bit numbers; of each other word, whose count is still to be met, the rows of its places."""
        words, starts = words_of(texts)
        found = pc.index_in(words, value_set=self.words)
        rare = np.asarray(found.is_null())
        place = np.asarray(found.fill_null(0))
        names = words.filter(pa.array(rare)).dictionary_encode()
        which = names.indices.to_numpy()
        group = np.array([zlib.crc32(w) % self.groups for w in names.dictionary.to_pylist()], dtype=np.int64)
        outputs = np.where(rare, 0, self.output[place]).astype(np.int32)
        outputs[rare] = self.output[len(self.words) + group][which]
        add = lambda x: np.diff(np.r_[0.0, np.cumsum(x)][starts])
        base = np.where(rare, 0.0, self.base[place] if len(self.base) else 0.0)
        off = np.zeros(len(rare))
        off[rare] = -self.group_norm[group][which]
        docs = {
            "row": rows,
            "n_tokens": np.diff(starts) + 1,
            "known": add(~rare).astype(np.int64) + (self.ends > 0),
            "base": add(base) + self.base_end,
            "off": add(off),
            "outputs": pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((starts * 4).astype(np.int32)), pa.py_buffer(outputs)]),
        }
        at = rows[np.repeat(np.arange(len(rows)), np.diff(starts))[rare]][np.argsort(which, kind="stable")]
        ends = np.r_[0, np.cumsum(np.bincount(which, minlength=len(group)))]
        return docs, {"word": names.dictionary, "rows": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int64()))}


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers in a column of bytes end to end, and where each row's begin."""
    starts = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1].astype(np.int64)
    data = lists.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[starts[0] : starts[-1]].view(np.int32) if data else np.zeros(0, np.int32)
    return flat, (starts - starts[0]) // 4


def _texts(lists: pa.Array):
    """(numbers end to end, where each text begins) of runs of texts of about 2 * AT_ONCE numbers."""
    flat, starts = _flat(lists)
    a = 0
    while a < len(lists):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + 2 * AT_ONCE, side="right")) - 1)
        yield flat[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
        a = b


def _trained(encoded: DataFrame, scorer: Scorer) -> LogBilinear:
    """The model, trained over all rows (outputs) in tasks whose weights are averaged by tokens."""
    sent = encoded.sparkSession.sparkContext.broadcast((scorer.shares, scorer.end, max(1, -(-DRAWS // scorer.total))))

    def run(batches):
        shares, end, turns = sent.value
        model, r, n, held, left = LogBilinear(shares), np.random.default_rng(13), 0, 0, []

        def steps(parts):
            if parts:
                second, first, w = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = r.permutation(len(w))
                for k in range(0, len(w), STEP):
                    o = order[k : k + STEP]
                    model.step(second[o], first[o], w[o], r)

        for batch in batches:
            for flat, starts in _texts(batch.column(0)):
                x = triples(flat, starts, end)
                n += len(x[0])
                for k in range(0, len(x[0]), MIXED * STEP):
                    left.append([v[k : k + MIXED * STEP] for v in x])
                    held += len(left[-1][0])
                    if held >= MIXED * STEP and turns == 1:
                        steps(left)
                        held, left = 0, []
        for _ in range(turns):
            steps(left)
        for name, v in model.p.items():
            for k in range(0, len(v), 4096):
                row = (name, k, n, v[k : k + 4096].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["name", "part", "n", "rows"])

    def mean(batches):
        sums: dict = {}
        for batch in batches:
            for name, part, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                v = np.frombuffer(data, np.float32).astype(np.float64)
                old = sums.get((name, part), (0, 0))
                sums[name, part] = (old[0] + n, old[1] + n * v)
        for (name, part), (n, v) in sums.items():
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int64()), pa.array([(v / n).astype(np.float32).tobytes()], pa.binary())], names=["name", "part", "rows"])

    tasks = int(min(TASKS, max(1, scorer.total // TASK_TOKENS)))
    # Written, as its parts are fetched one by one.
    own = map_arrow(encoded.select("outputs").coalesce(tasks), run, "name string, part long, n long, rows binary")
    model = LogBilinear(scorer.shares)
    for name, part, data in materialize(map_arrow(own.repartition("name", "part"), mean, "name string, part long, rows binary")).toLocalIterator():
        v = model.p[name]
        v[part : part + 4096] = np.frombuffer(data, np.float32).reshape(v[part : part + 4096].shape)
    model.seen = {}
    return model


def vocabulary(texts: DataFrame) -> tuple[Scorer, DataFrame]:
    """A scorer without a model, and (word, c) of every word of ``texts`` (text as bytes)."""
    counts = materialize(word_counts(texts))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = texts.count()
    total, distinct = total + ends, distinct + (ends > 0)
    often = (F.col("c") * FREQUENT >= total) & (F.length("word") <= LONGEST)
    frequent = sorted(((bytes(r[0]), r[1]) for r in counts.filter(often).collect()), key=lambda x: (-x[1], x[0]))
    groups = [(0, 0)] * int(min(GROUPS, max(1, (distinct - len(frequent)) // GROUP)))
    for g, c, n in counts.filter(~often).groupBy(F.pmod(F.crc32("word"), F.lit(len(groups))).alias("g")).agg(F.sum("c"), F.count(F.lit(1))).collect():
        groups[g] = (c, n)
    return Scorer(frequent, groups, ends, total, distinct), counts


def encoded(df: DataFrame, scorer: Scorer) -> DataFrame:
    """What ``Scorer.encode`` says of the rows of ``df`` (text as bytes), beside their other columns, and then of
    words: one table, written once. A word's row has no number."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(scorer)
    df = df.withColumn("row", F.monotonically_increasing_id())
    kept = [f for f in df.schema.fields if f.name not in ("text", "row")]
    made = T.StructType.fromDDL("row long, n_tokens long, known long, base double, off double, outputs binary, word binary, rows array<long>").fields
    schema = T.StructType([*kept, *made])
    text, row, places = df.columns.index("text"), df.columns.index("row"), [df.columns.index(f.name) for f in kept]
    kinds = {"row": pa.int64(), "n_tokens": pa.int64(), "known": pa.int64(), "base": pa.float64(), "off": pa.float64(), "outputs": pa.binary(), "word": pa.binary(), "rows": pa.list_(pa.int64())}

    def run(batches):
        for batch in batches:
            for a, some in slices(batch.column(text)):
                docs, words = sent.value.encode(batch.column(row).slice(a, len(some)).to_numpy(), some)
                for n, got, own in ((len(some), docs, True), (len(words["word"]), words, False)):
                    first = [batch.column(k).slice(a, n) if own else pa.nulls(n, batch.column(k).type) for k in places]
                    yield pa.RecordBatch.from_arrays([*first, *(pa.nulls(n, t) if k not in got else got[k] if isinstance(got[k], pa.Array) else pa.array(got[k], t) for k, t in kinds.items())], names=schema.names)

    return materialize(map_arrow(df, run, schema))


def _scored(rows: DataFrame, scorer: Scorer, counts: DataFrame, id_col: str) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of encoded rows."""
    sent = rows.sparkSession.sparkContext.broadcast((scorer.model, scorer.end))

    def run(batches):
        model, end = sent.value
        for batch in batches:
            base, off, outputs = batch.column(2), batch.column(3).to_numpy(), batch.column(4)
            score = base
            if model is not None and len(batch):
                sums = [np.add.reduceat(model.log10(*triples(flat, starts, end)), starts[:-1] + np.arange(len(starts) - 1)) for flat, starts in _texts(outputs)]
                score = pa.array(off + np.concatenate(sums))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), base, score], names=["row", "known", "base", "model"])

    docs = rows.filter("row is not null")
    scored = map_arrow(docs.select("row", "known", "base", "off", "outputs"), run, "row long, known long, base double, model double")
    # Few distinct words a slice meet their counts, and then their rows.
    met = rows.filter("word is not null").select("word", "rows").join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    alone = F.log10((F.col("c") + 0.5) / F.lit(float(scorer.base_norm)))
    rare = met.select(F.explode("rows").alias("row"), (F.col("c") > 0).cast("long").alias("known"), alone.alias("base"), (F.log10(F.col("c") + 0.5) if scorer.model is not None else alone).alias("model"))
    sums = scored.unionByName(rare).groupBy("row").agg(F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("model").alias("score"))
    return docs.select("row", "doc", "n_tokens").join(sums, "row").select(F.col("doc").alias(id_col), "n_tokens", "n_known", "base_score", "score")


def fit(texts: DataFrame) -> tuple[Scorer, DataFrame]:
    """The scorer, and (word, c) of every word of ``texts`` (text as bytes)."""
    scorer, counts = vocabulary(texts)
    if scorer.ends:
        scorer.model = _trained(encoded(texts.select("text"), scorer).filter("row is not null"), scorer)
    return scorer, counts


def score(df: DataFrame, scorer: Scorer, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score)."""
    rows = encoded(df.select(F.col(id_col).alias("doc"), text_bytes(text_col).alias("text")), scorer)
    return _scored(rows, scorer, counts, id_col)


def score_corpus(df: DataFrame, held_out_fold: int = 1) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of (doc_id, text)."""
    scorer, counts = vocabulary(df.filter(fold() != held_out_fold).select(text_bytes().alias("text")))
    rows = encoded(df.select(F.col("doc_id").alias("doc"), (fold() != held_out_fold).alias("learn"), text_bytes().alias("text")), scorer)
    if scorer.ends:
        scorer.model = _trained(rows.filter("learn"), scorer)
    return _scored(rows, scorer, counts, "doc_id").select("doc_id", (fold() == held_out_fold).alias("held_out"), "n_tokens", "n_known", F.lit(scorer.total).cast("long").alias("train_tokens"), "base_score", "score")

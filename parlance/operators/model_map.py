"""A remote model as a map over rows: bounded rate, retries, rounds, resumption.

A client answers prompts; it is made in the worker, once a partition. The rows of a partition are
asked in threads; the rate and the number of requests in flight hold over all partitions together.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.tokens import FAILED
from parlance.scratch import discard, materialize, shared_dir
from parlance.workers import ship


class Client(Protocol):
    def ask(self, prompt: str) -> str: ...


@dataclass
class EchoJudge:
    """Answers offline, always alike: judges' text out of the prompt's hash. ``fail_first`` calls of
    each prompt fail, and every prompt that holds ``broken`` fails always."""

    fail_first: int = 0
    broken: str = "\x00"
    seen: dict = field(default_factory=dict)

    def ask(self, prompt: str) -> str:
        n = self.seen[prompt] = self.seen.get(prompt, 0) + 1
        if n <= self.fail_first or self.broken in prompt:
            raise ConnectionError("no answer")
        score = int(hashlib.md5(prompt.encode()).hexdigest()[:8], 16) % 2
        return f"准确性：【{score}】兜底 是否为兜底回复：【0】{{{{{score}}}}}"


@dataclass(frozen=True)
class Limits:
    """Requests a second and in flight over all partitions, tries of one request, and pause between."""

    per_second: float = 5.0
    in_flight: int = 10
    tries: int = 5
    pause: float = 1.0
    partitions: int = 4


class _Window:
    """At most so many calls in each second."""

    def __init__(self, rate: float):
        self.gap, self.next, self.lock = 1 / rate if rate else 0.0, 0.0, Lock()

    def wait(self) -> None:
        with self.lock:
            at = max(self.next, time.monotonic())
            self.next = at + self.gap
        time.sleep(max(0.0, at - time.monotonic()))


def ask_all(df: DataFrame, make: Callable[[], Client], prompt: str = "prompt", key: str = "row_id", limits: Limits = Limits()) -> DataFrame:
    """(key, prompt, response); a request that fails at every try has the sentinel."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, window = make(), _Window(limits.per_second / limits.partitions)

        def one(text: str) -> str:
            for k in range(limits.tries):
                window.wait()
                try:
                    return client.ask(text)
                except Exception:  # noqa: BLE001  a client may fail in any way; the row says that it did
                    if k + 1 < limits.tries:
                        time.sleep(limits.pause)
            return FAILED

        with ThreadPoolExecutor(max(1, limits.in_flight // limits.partitions)) as pool:
            for frame in frames:
                yield frame.assign(response=list(pool.map(one, frame[prompt])))

    ship(df.sparkSession)
    rows = df.select(key, prompt).filter(F.col(prompt).isNotNull())
    return rows.repartition(limits.partitions, key).mapInPandas(run, rows.schema.add("response", "string"))


def ask_rounds(df: DataFrame, make: Callable[[], Client], prompt: str = "prompt", key: str = "row_id", limits: Limits = Limits(), rounds: int = 3, once_each: bool = True) -> DataFrame:
    """As ``ask_all``, with further rounds over the rows that failed; what fails to the end keeps the
    sentinel. Equal prompts are asked once."""
    asked = df.select(F.sha2(prompt, 256).alias("_h"), prompt).dropDuplicates(["_h"]) if once_each else df.select(F.col(key).cast("string").alias("_h"), prompt)
    done, left = None, asked
    for k in range(rounds):
        got = materialize(ask_all(left, make, prompt, "_h", limits).drop(prompt))
        good = got.filter(F.col("response") != FAILED)
        last = k + 1 == rounds
        done = (got if last else good) if done is None else done.unionByName(got if last else good)
        if last or got.filter(F.col("response") == FAILED).isEmpty():
            break
        left = left.join(got.filter(F.col("response") == FAILED).select("_h"), "_h", "left_semi")
    return df.withColumn("_h", F.sha2(prompt, 256) if once_each else F.col(key).cast("string")).join(done, "_h", "left").drop("_h")


def resume(df: DataFrame, saved: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows that have no saved answer yet, in whatever order the saved ones came."""
    return df.join(saved.select(key), key, "left_anti")


class Answers:
    """A store of answers by model and prompt, in a folder that all machines see.

    A prompt is asked when no answer of that model is stored, once however many rows have it, and its
    answer is written before anything reads it: later actions, later jobs and retries read. Prompts are
    asked ``chunk`` at a time, a write each, so what a lost machine had asked is asked again for one chunk
    at most. Failures are not stored. Of answers that two jobs stored at once the least is the answer."""

    SCHEMA = "hash string, response string, model string"

    def __init__(self, spark: SparkSession, path: str | None = None, chunk: int = 10_000):
        self.spark, self.chunk = spark, chunk
        self.path = path or f"{shared_dir(spark)}/parlance/answers/{uuid.uuid4().hex}"
        self.spark.createDataFrame([], self.SCHEMA).write.mode("append").parquet(self.path)

    def of(self, model: str) -> DataFrame:
        """(hash, response) stored for a model."""
        stored = self.spark.read.schema(self.SCHEMA).parquet(self.path).filter(F.col("model") == model)
        return stored.groupBy("hash").agg(F.min("response").alias("response"))

    def ask(self, df: DataFrame, make: Callable[[], Client], model: str, prompt: str = "prompt", key: str = "row_id", limits: Limits = Limits(), rounds: int = 3) -> DataFrame:
        """(key, prompt, response, model) of the rows that have a prompt; what failed in every round has the sentinel."""
        rows = df.select(key, prompt).filter(F.col(prompt).isNotNull()).withColumn("hash", F.sha2(prompt, 256))
        asked = materialize(rows.groupBy("hash").agg(F.first(prompt).alias("prompt")))
        for _ in range(rounds):
            left = asked.join(self.of(model), "hash", "left_anti")
            n = left.count()
            if not n:
                break
            parts = -(-n // self.chunk)
            for part in range(parts):
                some = left.filter(F.pmod(F.xxhash64("hash"), F.lit(parts)) == part)
                got = ask_all(some, make, "prompt", "hash", limits).filter(F.col("response") != FAILED)
                got.select("hash", "response", F.lit(model).alias("model")).write.mode("append").parquet(self.path)
        discard(asked)
        return rows.join(self.of(model), "hash", "left").select(key, prompt, F.coalesce("response", F.lit(FAILED)).alias("response"), F.lit(model).alias("model"))


def by_models(df: DataFrame, clients: dict[str, Callable[[], Client]], prompt: str = "prompt", key: str = "row_id", limits: Limits = Limits(), store: Answers | None = None) -> DataFrame:
    """(key, prompt, response, model), a row a model. Answers are in ``store``, or else in a new one, before
    they are read: no action asks a model again."""
    store = store or Answers(df.sparkSession)
    out = None
    for name, make in clients.items():
        got = store.ask(df, make, name, prompt, key, limits)
        out = got if out is None else out.unionByName(got)
    return out


def two_step(df: DataFrame, make: Callable[[], Client], question: str, key: str = "row_id", limits: Limits = Limits(), store: Answers | None = None) -> DataFrame:
    """The rows with a strategy and the answer that follows it: a first map asks how to answer, a second
    one answers by it. Where the first step failed the second is not asked, and has the sentinel too."""
    from parlance.functions import prompts

    store = store or Answers(df.sparkSession)
    first = df.select(key, prompts.strategy_prompt(F.col(question)).alias("prompt"))
    planned = df.join(store.ask(first, make, "strategy", "prompt", key, limits).select(key, F.col("response").alias("strategy")), key, "left")
    second = planned.filter(F.col("strategy") != FAILED).select(key, prompts.answer_prompt(F.col(question), F.col("strategy")).alias("prompt"))
    answered = store.ask(second, make, "answer", "prompt", key, limits).select(key, F.col("response").alias("answer"))
    return planned.join(answered, key, "left").withColumn("answer", F.coalesce("answer", F.when(F.col("strategy").isNotNull(), FAILED)))


#: Provider: where its JSON reply holds the text.
REPLIES = {"chat": "$.choices[0].message.content", "completion": "$.choices[0].text", "gateway": "$.data.choices[0].content"}


def reply_text(reply: Column, provider: str) -> Column:
    return F.coalesce(F.get_json_object(reply, REPLIES[provider]), F.lit(FAILED))


def service_body(query: Column, observation: Column, reply: Column, kind: str | None = None) -> Column:
    """A judge service's request as JSON."""
    fields = [query.alias("query"), observation.alias("observation"), reply.alias("response")]
    if kind:
        fields.append(F.lit(kind).alias("input_text_type"))
    return F.to_json(F.struct(*fields))


#: Bytes of texts that an encoder gets at once, beside its number of rows; a longer text is alone.
AT_ONCE = 1 << 20


def embed(df: DataFrame, make: Callable[[], Callable[[list[str]], list[list[float]]]], text: str, key: str, batch: int = 64) -> DataFrame:
    """(key, vector) by an encoder that is loaded once a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        for rows in batches:
            # Texts become strings a few at a time: of the others a task holds what Arrow brought.
            size, start = np.asarray(pc.binary_length(rows.column(1)), np.int64), 0
            while start < len(size):
                n = max(1, int(np.searchsorted(np.cumsum(size[start : start + batch]), AT_ONCE, side="right")))
                vectors = pa.array([list(v) for v in encode(rows.column(1).slice(start, n).to_pylist())], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([rows.column(0).slice(start, n), vectors], names=[key, "vector"])
                start += n

    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(text).cast("string").alias(text)).filter(F.col(text).isNotNull()).mapInArrow(run, f"`{key}` {kind}, vector array<float>")

"""Periodic jobs over day partitions, each period once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from inspect import signature
from threading import Event, Thread

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Days after which a kind of job takes a day up.
LAG = {"raw": 2, "extension": 2, "filter": 3, "report": 3}


def new_days(spark: SparkSession, path: str, schema, checkpoint: str, job: Callable[[DataFrame, int], None], files: int = 100) -> None:
    """Every file that arrived since the last run, in micro-batches: the checkpoint remembers what is
    done, and ``job`` must write a batch so that writing it again changes nothing."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class _Files:
    """Small marks in a folder of whatever store Spark reads."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.folder = spark._jvm, folder.rstrip("/")
        self.store = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def has(self, name: str) -> bool:
        return self.store.exists(self.at(name))

    def make(self, name: str) -> bool:
        """True for the one that makes it."""
        try:
            return self.store.createNewFile(self.at(name))
        except Py4JJavaError:  # some stores refuse instead of answering
            return False

    def write(self, name: str, text: str) -> None:
        out = self.store.create(self.at(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, name: str) -> str:
        given = self.store.open(self.at(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(given)).decode()
        finally:
            given.close()

    def written_at(self, name: str) -> float:
        return self.store.getFileStatus(self.at(name)).getModificationTime() / 1000

    def names(self, start: str) -> list[str]:
        return sorted(n for n in (f.getPath().getName() for f in self.store.listStatus(self.at(""))) if n.startswith(start))


class Lease:
    """The right to run, held by one at a time for as long as it is renewed.

    Each taking makes a file with the next number, which only one can; the latest number holds, until it
    says that it was given back or has not been renewed for ``seconds``. Ages are told by the store's own
    clock. A holder that was taken for dead finds a later number, and knows that it lost."""

    def __init__(self, files: _Files, name: str, seconds: float):
        self.files, self.name, self.seconds, self.owner = files, f"{name}.lock.", seconds, uuid.uuid4().hex
        self.mine: str | None = None
        self._stop = Event()

    def take(self) -> bool:
        held = self.files.names(self.name)
        if held:
            last = held[-1]
            clock = f".clock-{uuid.uuid4().hex}"
            self.files.write(clock, "")
            age = self.files.written_at(clock) - self.files.written_at(last)
            self.files.store.delete(self.files.at(clock), False)
            if self.files.read(last) != "given back" and age <= self.seconds:
                return False
        mine = f"{self.name}{int(held[-1].rsplit('.', 1)[1]) + 1 if held else 1:09d}"
        if not self.files.make(mine):
            return False
        self.mine = mine
        self.files.write(mine, self.owner)
        Thread(target=self._renew, daemon=True).start()
        return True

    def held(self) -> bool:
        return self.mine is not None and self.files.names(self.name)[-1:] == [self.mine]

    def _renew(self) -> None:
        while not self._stop.wait(self.seconds / 4):
            try:
                if not self.held():
                    return
                self.files.write(self.mine, self.owner)
            except Exception:  # noqa: BLE001  a store that fails now may answer in time for the next renewal
                continue

    def give_back(self) -> None:
        self._stop.set()
        if self.held():
            self.files.write(self.mine, "given back")


def run_once(spark: SparkSession, folder: str, job: str, period: str, work: Callable[..., None], needs: tuple[str, ...] = (), lease: float = 600.0) -> str:
    """``work`` once a period: "done" if it ran, "earlier" if it had, "running" while another holds the lease,
    "waits" until the jobs in ``needs`` are done for that period, "lost" if another took over meanwhile.

    Marks are files in ``folder``, which all machines see. A job that fails gives its lease back and leaves
    the period open; one whose driver was killed stops renewing, and after ``lease`` seconds the next takes
    over. A ``work`` that takes an argument gets a function that says whether the lease is still held, to ask
    before it publishes anything."""
    files = _Files(spark, f"{folder.rstrip('/')}/{period}")
    if files.has(f"{job}.done"):
        return "earlier"
    if not all(files.has(f"{n}.done") for n in needs):
        return "waits"
    files.store.mkdirs(files.at(""))
    right = Lease(files, job, lease)
    if not right.take():
        return "running"
    try:
        if files.has(f"{job}.done"):  # the last holder ended just now
            return "earlier"
        work(*[right.held][: len(signature(work).parameters)])
        if not right.held():
            return "lost"
        files.make(f"{job}.done")
    finally:
        right.give_back()
    return "done"


def append_once(spark: SparkSession, path: str, stream: str, form: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A job for micro-batches that leaves each row once: a batch is a folder of its own, named by the stream and
    its number. One that was written before is passed over when it comes again; one that was broken off
    is replaced. ``stream`` names a checkpoint: with a new one, numbers begin again."""

    def write(batch: DataFrame, number: int) -> None:
        place = f"{path.rstrip('/')}/stream={stream}/batch={number}"
        if not _Files(spark, place).has("_SUCCESS"):
            batch.write.mode("overwrite").format(form).save(place)

    return write


def appended(spark: SparkSession, path: str, schema: str, form: str = "parquet") -> DataFrame:
    """All rows of whole batches, with stream and batch. Batches that were broken off are passed over."""
    files = _Files(spark, path)
    whole = []
    for stream in files.names("stream=") if files.has("") else []:
        inside = _Files(spark, f"{files.folder}/{stream}")
        whole += [f"{inside.folder}/{b}" for b in inside.names("batch=") if inside.has(f"{b}/_SUCCESS")]
    full = f"{schema}, stream string, batch long"
    if not whole:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", files.folder).format(form).load(whole)


def write_day(df: DataFrame, path: str) -> None:
    """A day's rows in the place of what the day had."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def due(days: DataFrame, done: DataFrame, today: str, kind: str) -> DataFrame:
    """Days (date) that are old enough and not done."""
    return days.select("date").distinct().filter(F.datediff(F.lit(today), F.col("date")) >= LAG[kind]).join(done.select("date"), "date", "left_anti")


def week_of(day: Column) -> Column:
    """The days of a date's week, Monday to Sunday."""
    monday = F.date_trunc("week", day).cast("date")
    return F.sequence(monday, F.date_add(monday, 6), F.expr("interval 1 day"))


def regenerate(wanted: DataFrame, make: Callable[[DataFrame], DataFrame], read: Callable[[], DataFrame | None], write: Callable[[DataFrame], None], key: str, bad: Column, most: float = 0.5, rounds: int = 6) -> int:
    """Chunks that are missing or have too many bad rows are made again, up to ``rounds`` times.
    Returns the rounds that it took."""
    for k in range(rounds):
        have = read()
        if have is None:
            left = wanted
        else:
            good = have.groupBy(key).agg(F.avg(F.coalesce(bad, F.lit(True)).cast("int")).alias("_bad")).filter(F.col("_bad") <= most)
            left = wanted.join(good.select(key), key, "left_anti")
        if left.isEmpty():
            return k
        write(make(left))
    return rounds


def event_windows(events: DataFrame, ts: str = "ts", kind: str = "event_type", value: str = "value", width: str = "1 hour", late: str | None = "2 hours") -> DataFrame:
    """Extension: tumbling windows; late rows are waited for as long as ``late``. For streams and tables."""
    rows = events.withWatermark(ts, late) if late and events.isStreaming else events
    return rows.groupBy(F.window(ts, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), kind, "n", "total")


def sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str | None = "2 hours") -> DataFrame:
    """Extension: sessions that a pause ends."""
    rows = events.withWatermark(ts, late) if late and events.isStreaming else events
    return rows.groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count(F.lit(1)).alias("n")).select(user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")

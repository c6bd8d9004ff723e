"""Files out of tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.operators.order import chunks, row_ids


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",", mark: bool = False) -> None:
    """``mark`` opens each file with a byte order mark, as spreadsheets want it."""
    if mark:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df.write.mode(mode).csv(path, header=True, encoding="UTF-8", quote='"', escape='"', sep=sep)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_chunks(df: DataFrame, path: str, k: int, order: list[str]) -> None:
    """``k`` chunks, a folder each."""
    chunks(df, k, order).repartitionByRange(k, "chunk").write.mode("overwrite").partitionBy("chunk").json(path)


def write_arrays(df: DataFrame, path: str, k: int, order: list[str], name: str = "part") -> None:
    """``k`` files of one JSON array each, ``<path>/<name><chunk>.json``, in any store that Spark writes to.

    Tasks write an attempt in a hidden folder beside them, by Spark's own commit protocol, a record a
    line; when all have, the driver moves the files, ``k`` of them. A job that fails leaves nothing, and
    what was there before; a file of the same name is replaced. Readers pass hidden folders over. A
    table without rows gives no file."""
    n = df.count()
    size = max(1, -(-n // k))
    r = F.col("_r")
    first, last = (r - 1) % size == 0, (r % size == 0) | (r == n)
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    line = F.concat(F.when(first, "[\n    ").otherwise("    "), body, F.when(last, "\n]").otherwise(","))
    rows = row_ids(df, order, "_r").select(F.floor((r - 1) / size).cast("int").alias("chunk"), "_r", line.alias("value"))
    spark = df.sparkSession
    place = lambda *x: spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *x]))
    files = place().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    attempt = f"_attempt-{uuid.uuid4().hex}"
    try:
        rows.repartition("chunk").sortWithinPartitions("chunk", "_r").select("chunk", "value").write.partitionBy("chunk").option("maxRecordsPerFile", 0).text(place(attempt).toString())
        for part in files.listStatus(place(attempt)):
            at = part.getPath()
            if part.isDirectory() and at.getName().startswith("chunk="):
                (held,) = [f.getPath() for f in files.listStatus(at) if f.getPath().getName().startswith("part-")]
                target = place(f"{name}{at.getName().removeprefix('chunk=')}.json")
                files.delete(target, False)
                if not files.rename(held, target):
                    raise OSError(f"cannot move {held} to {target}")
                files.delete(place(f".{target.getName()}.crc"), False)  # a local store's checksum, which it would show beside the file
    finally:
        files.delete(place(attempt), True)


def write_by_producer(df: DataFrame, path: str) -> None:
    """Both sides of the gates, a folder a producer."""
    df.withColumn("legal", F.col("verdict") == "legal").write.mode("overwrite").partitionBy("legal", "producer").json(path)


def write_small(df: DataFrame, path: str, rows: int = 500) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).csv(path, header=True)


def write_routes(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("route").csv(path, header=True)


def write_stats(df: DataFrame, path: str) -> None:
    """A day's statistics in the day's partition: written again, not twice."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A header line and a line of values, tab-separated."""
    write_csv(df.coalesce(1), path, sep="\t")


def write_sheet(df: DataFrame, path: str) -> None:
    """For labellers: a sheet where openpyxl is there, else CSV. For tables that people read."""
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        write_csv(df, path)
    else:
        df.toPandas().to_excel(path, index=False)


def train_wrapper(df: DataFrame) -> DataFrame:
    """All records in one ``{"train": [...]}`` document. For small sets: it is one row."""
    return df.agg(F.to_json(F.struct(F.collect_list(F.struct(*[F.col(c) for c in df.columns])).alias("train"))).alias("value"))

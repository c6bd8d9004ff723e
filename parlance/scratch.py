"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Where that is unset a local master gets a temporary
    one; a cluster has to name a folder that all its machines see."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="parlance-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends here, losing an
    executor costs no recomputation, and what reads it later sees one and the same result."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/parlance/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialize`` wrote for these; nothing may read them any more."""
    for df in frames:
        path = getattr(df, "_scratch", None)
        if path:
            jvm, context = df.sparkSession._jvm, df.sparkSession.sparkContext
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)

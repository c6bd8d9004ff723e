"""Tables out of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.operators.align import together

#: What editors, file managers and checkpoints leave in a corpus.
SKIP = r"(checkpoint|\.DS_Store|\.swp)"


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV, JSON (an array a file), JSONL or Parquet, by suffix."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind == "csv":
        return read_csv(spark, path, schema)
    if kind == "json":
        return reader.json(path, multiLine=True)
    if kind == "jsonl":
        return reader.json(path)
    if kind == "parquet":
        return reader.parquet(path)
    if kind in ("xls", "xlsx"):
        return read_sheet(spark, path)
    raise ValueError(f"no reader for .{kind}")


def read_arrays(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON arrays of a record a line, as ``writers.write_arrays`` leaves them. A file is read in as many pieces as
    the store gives, where ``read_table`` has one task parse it whole; for arrays laid out in any other way that is the
    reader. A line that is no record is an error."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"^\[$|^\]$|^ +|,$", "").alias("value")).filter("value <> ''")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_csv(spark: SparkSession, path: str | list[str], schema=None, blanks: bool = False) -> DataFrame:
    """Quoted fields may hold newlines; nameless index columns go; ``blanks`` keeps empty strings."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.csv(path, header=True, multiLine=True, quote='"', escape='"', ignoreLeadingWhiteSpace=True, encoding="UTF-8", **({"nullValue": "\x00", "emptyValue": ""} if blanks else {}))
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    df = df.drop(*[c for c in df.columns if c.startswith("Unnamed:") or c.startswith("_c") and c[2:].isdigit()])
    return df.na.fill("") if blanks else df


def read_sheet(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A workbook's sheet, by number or name, as strings; blanks stay empty, the first row names the columns.
    Files are read by the tasks, row by row; one that is no workbook is read as CSV."""
    from parlance.sources.sheets import sheet_rows

    rows = sheet_rows(spark, path, sheet)
    head = rows.filter("at = 0").orderBy("file").first()
    if head is None:
        return spark.createDataFrame([], "value string").drop("value")
    names = [n or f"Unnamed: {k}" for k, n in enumerate(head["cells"])]
    return rows.filter("at > 0").select(*[F.coalesce(F.get("cells", F.lit(k)), F.lit("")).alias(n) for k, n in enumerate(names)])


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_prompt(spark: SparkSession, path: str) -> str:
    """A prompt, through Spark so that any store will do."""
    row = spark.read.text(path, wholetext=True).first()
    return row[0] if row else ""


def read_corpus(spark: SparkSession, path: str, schema=None, places: bool = True, skip: str = SKIP, without: tuple[str, ...] = (), pattern: str = "*.jsonl") -> DataFrame:
    """All JSONL files below a folder, with owner, folder, dataset and producer out of their paths:
    ``<path>/<owner>/<folder>/.../<dataset>.jsonl``; the producer is the owner up to an underscore.
    ``without`` names files that are passed over, ``pattern`` those that are read. Spaces, percent signs
    and other characters in names are as in the store; a file that lies outside the folder is an error."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.json(path, recursiveFileLookup=True, pathGlobFilter=pattern)
    # The path comes as a URI: a plus sign is itself there, but not to the decoder.
    df = df.withColumn("_path", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))
    # What follows the first place that holds the folder's whole path; folders below may bear its name again.
    root = "/" + path.split("://", 1)[-1].strip("/") + "/"
    begin = F.locate(root, F.col("_path"))
    outside = F.raise_error(F.concat(F.lit(f"not below {root}: "), F.col("_path"))).cast("string")
    df = df.withColumn("_below", F.when(begin > 0, F.substring(F.col("_path"), begin + len(root), F.length("_path"))).otherwise(outside))
    df = df.filter(~F.col("_below").rlike(skip) & ~F.substring_index("_below", "/", -1).isin(*without))
    if not places:
        return df.drop("_path", "_below")
    below = F.split("_below", "/")
    part = lambda k: F.coalesce(F.get(below, F.lit(k)), F.lit(""))
    return df.withColumns(
        {"owner": part(0), "folder": part(1), "dataset": F.regexp_replace(F.element_at(below, -1), r"\.jsonl$", ""), "producer": F.substring_index(part(0), "_", 1)}
    ).drop("_path", "_below")


def read_named(spark: SparkSession, folder: str, contains: str) -> DataFrame:
    """The union of the folder's CSV files whose names hold ``contains``, by name of column."""
    return read_csv(spark, f"{folder.rstrip('/')}/*{contains}*")


def union_named(*frames: DataFrame) -> DataFrame:
    return together(*frames)


def user_texts(spark: SparkSession, path: str, places: str = "") -> DataFrame:
    """Every user message's first text, beside columns out of the path that ``places`` declares; lines that
    are no JSON are passed over."""
    kept = [p.split()[0] for p in places.split(",") if p.strip()]
    schema = "messages array<struct<role:string,content:array<string>>>" + (f", {places}" if places else "")
    return users_of(spark.read.schema(schema).json(path, mode="DROPMALFORMED"), *kept)


def users_of(df: DataFrame, *kept: str) -> DataFrame:
    """The first text of every user message of ``messages``."""
    return df.select(*kept, F.explode(F.filter("messages", lambda m: m["role"] == "user")).alias("m")).select(*kept, F.get(F.col("m.content"), F.lit(0)).alias("user-query")).filter("`user-query` is not null")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")

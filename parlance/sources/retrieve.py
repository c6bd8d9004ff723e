"""Retrieval as a source: a pluggable connector, offline by default."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.functions.codec import passage_list
from parlance.schema import DOC
from parlance.workers import ship


class Retriever(Protocol):
    """One search: a tool, a query and its tags; documents as dictionaries of the fields of ``DOC``."""

    def search(self, tool: str, query: str, tags: list[str]) -> list[dict]: ...


def retrieve(requests: DataFrame, make: Callable[[], Retriever], tries: int = 5) -> DataFrame:
    """``docs`` for rows (row_id, call, tool, query, tags). Each call asks its own tool; a search that
    finds nothing or fails to the end has no documents, and keeps its place."""
    names = [f.name for f in DOC.fields]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source = make()

        def one(tool, query, tags) -> list[dict]:
            for _ in range(tries):
                try:
                    return [{n: d.get(n) for n in names} for d in source.search(tool, query, list(tags))]
                except Exception:  # noqa: BLE001  a connector may fail in any way
                    continue
            return []

        for frame in frames:
            docs = [one(*x) for x in zip(frame["tool"], frame["query"], frame["tags"], strict=True)]
            yield frame[["row_id", "call"]].assign(docs=docs)

    ship(requests.sparkSession)
    schema = T.StructType([requests.schema["row_id"], requests.schema["call"], T.StructField("docs", T.ArrayType(DOC))])
    return requests.select("row_id", "call", "tool", "query", "tags").mapInPandas(run, schema)


def from_table(requests: DataFrame, corpus: DataFrame) -> DataFrame:
    """The offline retriever: documents of a table (tool, query, docs) by equality."""
    found = requests.join(corpus.select("tool", "query", "docs"), ["tool", "query"], "left")
    return found.withColumn("docs", F.coalesce("docs", F.array().cast(corpus.schema["docs"].dataType)))


def gather(found: DataFrame, k: int, prefix: str = "") -> DataFrame:
    """(row_id, observation): passages of each row's calls, in the calls' order."""
    lists = F.sort_array(F.collect_list(F.struct("call", passage_list(F.col("docs"), k, prefix).alias("p"))))
    return found.groupBy("row_id").agg(F.transform(lists, lambda x: x["p"]).alias("observation"))


def web_pages(text: Column, with_title: bool = False) -> Column:
    """Documents out of a reply with ``data.webPages.value``: names, snippets and dates, without double quotes.
    ``with_title`` puts the title before the content."""
    found = F.from_json(text, "struct<data:struct<webPages:struct<value:array<struct<name:string,snippet:string,url:string,datePublished:string>>>>>")["data"]["webPages"]["value"]
    clean = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit(""))

    def page(d: Column) -> Column:
        title, content = clean(d["name"]), clean(d["snippet"])
        return F.struct(title.alias("title"), (F.concat(title, F.lit(" "), content) if with_title else content).alias("content"), clean(d["url"]).alias("url"), F.coalesce(d["datePublished"], F.lit("none")).alias("published"))

    return F.coalesce(F.transform(found, page), F.array().cast("array<struct<title:string,content:string,url:string,published:string>>"))


def linked_people(text: Column, linked: str = "人物", unlinked: str = "PER") -> Column:
    """(linked, unlinked): mentions of people in an entity linker's reply."""
    reply = F.from_json(text, "struct<data:array<struct<general:struct<category:string,mention:string>>>,unlink_entity:array<struct<category:string,mention:string>>>")
    none = F.array().cast("array<string>")
    known = F.transform(F.filter(reply["data"], lambda d: d["general"]["category"].contains(linked)), lambda d: d["general"]["mention"])
    other = F.transform(F.filter(reply["unlink_entity"], lambda d: d["category"].contains(unlinked)), lambda d: d["mention"])
    return F.struct(F.coalesce(known, none).alias("linked"), F.coalesce(other, none).alias("unlinked"))


def spoken_answer(text: Column) -> Column:
    """(domain, answer) of a voice service's reply; other and unknown where it says nothing."""
    said = F.get_json_object(text, "$.data.speak")
    return F.struct(F.when(said.isNotNull(), "encyclopedia").otherwise("other").alias("domain"), F.coalesce(said, F.lit("unknown")).alias("answer"))


def signed(query: Column, client: str, key: str, at: Column) -> Column:
    """The signature of a search request: half of an md5 over client, query, key and time in seconds."""
    return F.substring(F.md5(F.concat(F.lit(client), query, F.lit(key), at.cast("string"))), 1, 16)


def search_reply(text: Column, shape: str = "knowledge") -> Column:
    """Documents out of a search reply's JSON; content falls back on the snippet."""
    path = {"knowledge": "data", "media": "items", "web": "results"}[shape]
    item = "struct<id:string,title:string,content:string,snippet:string,url:string,source:string,score:string,source_domain:string,extend_data:map<string,string>>"
    parsed = F.from_json(text, f"struct<{path}:array<{item}>>")[path]
    return F.transform(
        F.coalesce(parsed, F.array().cast(f"array<{item}>")),
        lambda d: F.struct(d["id"].alias("id"), d["title"].alias("title"), F.coalesce(F.nullif(d["content"], F.lit("")), d["snippet"]).alias("content"), *[d[n].alias(n) for n in ("url", "source", "score", "source_domain", "extend_data")]),
    )

"""Rows of spreadsheets, read by the tasks that hold the files."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from parlance.workers import ship

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
#: Rows passed on at once.
_ROWS = 2000


def _column(name: str) -> int:
    """0 for A, 26 for AA."""
    n = 0
    for c in name:
        if c.isalpha():
            n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _texts(node) -> str:
    """All text of a string item, its runs one after the other, without readings above the line."""
    if node.tag == f"{_MAIN}rPh":
        return ""
    if node.tag == f"{_MAIN}t":
        return node.text or ""
    return "".join(_texts(child) for child in node)


def workbook_rows(content: bytes, sheet: str | int):
    """Lists of cells, a row each, from the first row on; rows that the file leaves out are empty."""
    import io
    import posixpath
    import zipfile
    from xml.etree import ElementTree

    book = zipfile.ZipFile(io.BytesIO(content))
    sheets = [(s.get("name"), s.get(_LINK)) for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]
    wanted = sheets[sheet][1] if isinstance(sheet, int) else dict(sheets)[sheet]
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    target = links[wanted]
    part = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        with book.open("xl/sharedStrings.xml") as given:
            for _, node in ElementTree.iterparse(given):
                if node.tag == f"{_MAIN}si":
                    shared.append(_texts(node))
                    node.clear()
    at = 0
    with book.open(part) as given:
        for _, node in ElementTree.iterparse(given):
            if node.tag != f"{_MAIN}row":
                continue
            number = int(node.get("r") or at + 1)
            for _ in range(at + 1, number):
                yield []
            at, cells = number, []
            for cell in node.iter(f"{_MAIN}c"):
                place = _column(cell.get("r")) if cell.get("r") else len(cells)
                cells += [""] * (place - len(cells))
                kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
                text = value.text or "" if value is not None else ""
                if kind == "s":
                    text = shared[int(text)]
                elif kind == "inlineStr":
                    text = _texts(cell.find(f"{_MAIN}is"))
                elif kind == "b":
                    text = "True" if text == "1" else "False"
                elif kind is None or kind == "n":
                    text = text.removesuffix(".0")
                cells.append(text)
            yield cells
            node.clear()


def delimited_rows(content: bytes):
    import csv
    import io

    yield from csv.reader(io.StringIO(content.decode("utf-8-sig"), newline=""))


def sheet_rows(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """(file, at, cells): a row a sheet row, from 0, by file. A file is one task's, as a packed workbook cannot
    be read from its middle; the format ends at about a million rows. Dates are the numbers that stand there."""

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = content.as_py()
                rows = workbook_rows(data, sheet) if data[:2] == b"PK" else delimited_rows(data)
                held: list[tuple[int, list[str]]] = []
                for at, cells in enumerate(rows):
                    held.append((at, cells))
                    if len(held) == _ROWS:
                        yield _batch(file, held)
                        held = []
                yield _batch(file, held)

    def _batch(file, held):
        return pa.RecordBatch.from_arrays([pa.array([file] * len(held), pa.string()), pa.array([x[0] for x in held], pa.int32()), pa.array([x[1] for x in held], pa.list_(pa.string()))], names=["file", "at", "cells"])

    ship(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, at int, cells array<string>")

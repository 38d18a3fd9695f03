"""First sheet of a workbook as rows of text cells.

Spark has no spreadsheet source and a workbook cannot be split, so this is the
one place where Python reads data: a small parser over the zipped XML, run by
``mapInPandas`` on the executors, one workbook per task where possible.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
# Built-in number formats that show dates or times.
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}
_ROWS_PER_FRAME = 10_000
SCHEMA = "path string, header string, line bigint, cells array<string>, error_message string"


def _text(node) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_MAIN}t"))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(n.get("numFmtId"))
        for n in root.iter(f"{_MAIN}numFmt")
        if re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", n.get("formatCode", "").lower()))
    }
    formats = root.find(f"{_MAIN}cellXfs")
    cells = [] if formats is None else list(formats)
    return {i for i, x in enumerate(cells) if int(x.get("numFmtId", 0)) in _DATE_FORMATS | custom}


def _first_sheet(book: zipfile.ZipFile) -> str:
    sheet = ElementTree.fromstring(book.read("xl/workbook.xml")).find(f"{_MAIN}sheets/{_MAIN}sheet")
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in links.iter(f"{_PACKAGE}Relationship") if r.get("Id") == sheet.get(f"{_REL}id"))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _column(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _value(cell, shared: list[str], dates: set[int]) -> str | None:
    kind, v = cell.get("t"), cell.find(f"{_MAIN}v")
    if kind == "inlineStr":
        return _text(cell)
    if v is None or v.text is None:
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "true" if v.text == "1" else "false"
    if kind is None and int(cell.get("s", 0)) in dates:
        return (datetime(1899, 12, 30) + timedelta(seconds=round(float(v.text) * 86400))).isoformat(sep=" ")
    return v.text


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet, streamed from the XML."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(si) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        dates = _date_styles(book)
        with book.open(_first_sheet(book)) as xml:
            for _, node in ElementTree.iterparse(xml):
                if node.tag != f"{_MAIN}row":
                    continue
                row: list[str | None] = []
                for i, cell in enumerate(node.iter(f"{_MAIN}c")):
                    at = _column(cell.get("r")) if cell.get("r") else i
                    row += [None] * (at + 1 - len(row))
                    row[at] = _value(cell, shared, dates)
                node.clear()
                yield row


def _frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["path", "header", "line", "cells", "error_message"]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            out: list[tuple] = []
            try:
                rows = (r for r in sheet_rows(content) if any(c not in (None, "") for c in r))
                head = [c if c not in (None, "") else f"Unnamed: {i}" for i, c in enumerate(next(rows, []))]
                header = json.dumps(head)
                for line, row in enumerate(rows):
                    out.append((path, header, line, (row + [None] * len(head))[: len(head)], None))
                    if len(out) == _ROWS_PER_FRAME:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
            except Exception as e:  # a broken workbook must not fail its neighbours
                out.append((path, None, None, None, f"{type(e).__name__}: {e}"))
            if out:
                yield pd.DataFrame(out, columns=columns)


def read_sheets(files: DataFrame, tasks: int) -> DataFrame:
    """``path, header, line, cells, error_message`` from ``path, content`` rows."""
    spread = files.select("path", "content").repartition(max(1, tasks), F.col("path"))
    return spread.mapInPandas(_frames, SCHEMA)

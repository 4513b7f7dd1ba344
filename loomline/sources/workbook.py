"""Worksheets of .xlsx files as long cells.

A workbook cannot be split, so the task that holds its bytes lists its sheets and reads their cells: the string table and the styles are parsed once a book and
file contents never leave the task. Sheets are parsed as streams and leave as Arrow-sized batches, so a task holds the zipped book, its string table and
one batch of cells, never a whole sheet. Spark spreads the books.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from array import array
from collections.abc import Iterator
from xml.etree.ElementTree import iterparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELL_SCHEMA = "source_file string, sheet_name string, row_idx int, col_idx int, value string, value_type string"
BATCH = 20_000

# Fixed values of the file format: built-in date formats and the tokens that make
# a custom format a date.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
DATE_TOKENS = re.compile(r"[ymdhs]", re.IGNORECASE)
QUOTED = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, archive part) in workbook order."""
    targets = {}
    for _, e in iterparse(book.open("xl/_rels/workbook.xml.rels")):
        if _tag(e) == "Relationship":
            target = e.get("Target").lstrip("/")
            targets[e.get("Id")] = target if target.startswith("xl/") else f"xl/{target}"
    found = []
    for _, e in iterparse(book.open("xl/workbook.xml")):
        if _tag(e) == "sheet":
            link = next(v for k, v in e.attrib.items() if k.endswith("}id"))
            found.append((e.get("name"), targets[link]))
    return found


class Strings:
    """The shared strings of a book: one buffer of UTF-8 bytes and where each string starts in it."""

    def __init__(self, book: zipfile.ZipFile):
        self.buffer, self.starts = bytearray(), array("q", [0])
        if "xl/sharedStrings.xml" not in book.namelist():
            return
        table = None
        for event, e in iterparse(book.open("xl/sharedStrings.xml"), events=("start", "end")):
            if table is None:
                table = e
            elif event == "end" and _tag(e) == "si":
                # Phonetic runs (rPh) are reading aids, not text.
                runs = [c for c in e if _tag(c) in ("t", "r")]
                self.buffer += "".join(t.text or "" for r in runs for t in r.iter() if _tag(t) == "t").encode()
                self.starts.append(len(self.buffer))
                table.clear()

    def __getitem__(self, k: int) -> str:
        if not 0 <= k < len(self.starts) - 1:
            raise ValueError(f"Shared string {k} of {len(self.starts) - 1}")
        return self.buffer[self.starts[k]:self.starts[k + 1]].decode()


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers that show a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    custom, styles, inside = set(), [], False
    for event, e in iterparse(book.open("xl/styles.xml"), events=("start", "end")):
        name = _tag(e)
        if name == "cellXfs":
            inside = event == "start"
        elif event == "start" and name == "xf" and inside:
            styles.append(int(e.get("numFmtId") or 0))
        elif event == "end" and name == "numFmt" and DATE_TOKENS.search(QUOTED.sub("", e.get("formatCode") or "")):
            custom.add(int(e.get("numFmtId")))
    return {i for i, fmt in enumerate(styles) if fmt in DATE_FORMATS or fmt in custom}


def _base_date(book: zipfile.ZipFile) -> dt.datetime:
    for _, e in iterparse(book.open("xl/workbook.xml")):
        if _tag(e) == "workbookPr" and e.get("date1904") in ("1", "true"):
            return dt.datetime(1904, 1, 1)
    return dt.datetime(1899, 12, 30)


def _column(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


def _cells(book: zipfile.ZipFile, part: str, strings: Strings, dates: set[int], base: dt.datetime) -> Iterator[tuple[int, int, str, str]]:
    row, col, grid = -1, -1, None
    for event, e in iterparse(book.open(part), events=("start", "end")):
        name = _tag(e)
        if event == "start":
            if name == "row":
                row, col = (int(e.get("r")) - 1 if e.get("r") else row + 1), -1
            elif name == "sheetData":
                grid = e
            continue
        if name == "c":
            col = _column(e.get("r")) if e.get("r") else col + 1
            kind, raw = e.get("t", "n"), next((v.text for v in e if _tag(v) == "v"), None)
            if kind == "inlineStr":
                raw = "".join(t.text or "" for t in e.iter() if _tag(t) == "t")
            if raw is not None and raw != "":
                if kind == "s":
                    yield row, col, strings[int(raw)], "s"
                elif kind in ("str", "inlineStr"):
                    yield row, col, raw, "s"
                elif kind == "d":
                    yield row, col, raw.replace("T", " "), "d"
                elif kind == "b":
                    yield row, col, "True" if raw == "1" else "False", "b"
                elif kind == "n" and int(e.get("s") or 0) in dates:
                    yield row, col, str(base + dt.timedelta(seconds=round(float(raw) * 86_400))), "d"
                elif kind == "n":
                    yield row, col, raw, "n"
        elif name == "row" and grid is not None:
            grid.clear()  # with the row itself


def _book_cells(path: str, content: bytes) -> Iterator[tuple[str, int, int, str, str]]:
    """(sheet name, row, column, value, type) of all sheets in workbook order."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings, dates, base = Strings(book), _date_styles(book), _base_date(book)
        for sheet, part in _sheets(book):
            for cell in _cells(book, part, strings, dates, base):
                yield sheet, *cell


def _read_books(batches: Iterator[pd.DataFrame], empty_fails: bool) -> Iterator[pd.DataFrame]:
    columns = ["source_file", "sheet_name", "row_idx", "col_idx", "value", "value_type"]
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            if not path.lower().endswith(".xlsx"):
                raise ValueError(f"Only .xlsx workbooks can be read: {path}")
            rows, found = [], False
            for cell in _book_cells(path, content):
                rows.append((path, *cell))
                found = True
                if len(rows) == BATCH:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)
            if empty_fails and not found:
                raise ValueError(f"Workbook without a cell: {path}")


def read_cells(spark: SparkSession, paths: list[str] | str, pattern: str = "*.[xX][lL][sS][xX]") -> DataFrame:
    """All cells of the workbooks of a folder that match ``pattern``, or of the files of a list; editor lock files are skipped.

    A workbook that cannot be read fails the load, and so does a listed one without any cell.
    """
    listed = not isinstance(paths, str)
    reader = spark.read.format("binaryFile")
    books = (reader if listed else reader.option("pathGlobFilter", pattern)).load(paths)
    named = books.where(~F.element_at(F.split("path", "/"), -1).startswith("~$")).select("path", "content")
    return named.mapInPandas(lambda batches: _read_books(batches, listed), CELL_SCHEMA)

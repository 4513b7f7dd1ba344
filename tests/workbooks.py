"""Tiny .xlsx files from rows of Python values."""

from __future__ import annotations

import datetime as dt
import zipfile
from xml.sax.saxutils import escape

NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _letters(col: int) -> str:
    text = ""
    col += 1
    while col:
        col, rest = divmod(col - 1, 26)
        text = chr(65 + rest) + text
    return text


def _cell(row: int, col: int, value, shared: list[str]) -> str:
    ref = f"{_letters(col)}{row + 1}"
    if isinstance(value, dt.datetime):
        serial = (value - dt.datetime(1899, 12, 30)).total_seconds() / 86_400
        return f'<c r="{ref}" s="1"><v>{serial}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    shared.append(value)
    return f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'


def write_xlsx(path, sheets: dict[str, dict[tuple[int, int], object]]) -> str:
    """``sheets`` maps a sheet name to {(row, col): value}."""
    shared: list[str] = []
    parts = {}
    for number, cells in enumerate(sheets.values(), start=1):
        rows: dict[int, list[str]] = {}
        for (row, col), value in sorted(cells.items()):
            rows.setdefault(row, []).append(_cell(row, col, value, shared))
        body = "".join(f'<row r="{r + 1}">{"".join(c)}</row>' for r, c in rows.items())
        parts[f"xl/worksheets/sheet{number}.xml"] = f"<worksheet {NS}><sheetData>{body}</sheetData></worksheet>"
    names = "".join(
        f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, start=1)
    )
    parts["xl/workbook.xml"] = f'<workbook {NS} xmlns:r="{REL}"><sheets>{names}</sheets></workbook>'
    links = "".join(
        f'<Relationship Id="rId{i}" Type="x" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)
    )
    parts["xl/_rels/workbook.xml.rels"] = f"<Relationships>{links}</Relationships>"
    parts["xl/styles.xml"] = f'<styleSheet {NS}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    texts = "".join(f"<si><t>{escape(t)}</t></si>" for t in shared)
    parts["xl/sharedStrings.xml"] = f"<sst {NS}>{texts}</sst>"
    with zipfile.ZipFile(path, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return str(path)

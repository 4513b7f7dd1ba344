"""Worksheet grids, from cells and from real .xlsx files."""

from __future__ import annotations

import datetime as dt
import re
import zipfile

import pytest
from pyspark.errors import PySparkException

from loomline.operators import sheets
from loomline.sources.workbook import read_cells

from workbooks import write_xlsx

CELLS = "source_file string, sheet_name string, row_idx int, col_idx int, value string, value_type string"


def grid(spark, sheet_cells: dict[str, list[tuple]]):
    rows = [("f.xlsx", sheet, *cell) for sheet, cells in sheet_cells.items() for cell in cells]
    return spark.createDataFrame(rows, CELLS)


def textile_sheet(machine="7.0", lot_date="2024-12-05", header="12월 5일", out_col=10):
    return [
        (3, 5, lot_date, "d"), (2, out_col - 2, header, "s"), (2, out_col, "생산 량(m)".replace(" ", ""), "s"),
        (4, 0, machine, "s"), (4, 5, " LOT-1 ", "s"), (4, out_col - 2, "11.5", "n"), (4, out_col - 1, "x", "s"), (4, out_col, "99", "n"),
    ]


def rows(df):
    return sorted(tuple(r)[1:] for r in df.collect())


def test_textile_sheet(spark):
    got = rows(sheets.textile_day_rows(grid(spark, {"WS": textile_sheet()})))
    assert got == [("WS", "7", dt.date(2024, 12, 5), "LOT-1", 11.5, None, 99.0)]


def test_summary_and_short_sheets_are_skipped(spark):
    cells = textile_sheet()
    assert rows(sheets.textile_day_rows(grid(spark, {" Total 1": cells, "KANGATANG ": cells}))) == []
    short = [(3, 5, "2024-12-05", "d"), (3, 0, "7", "s")]
    assert sheets.keep_sheets(grid(spark, {"WS": short})).count() == 0


def test_other_months_are_left_out_and_an_empty_part_drops_the_sheet(spark):
    # January production on a December sheet lies in the next year: no production part remains.
    assert rows(sheets.textile_day_rows(grid(spark, {"WS": textile_sheet(header="1월 5일")}))) == []
    assert rows(sheets.textile_day_rows(grid(spark, {"WS": textile_sheet(header="2월30일")}))) == []


def test_full_outer_rows(spark):
    cells = textile_sheet() + [(5, 0, "M-2", "s"), (5, 10, "5", "n"), (6, 0, "9", "n"), (6, 5, "LOT-9", "s"), (7, 0, "sum", "s"), (7, 10, "104", "n")]
    got = {r[1]: r[3:] for r in rows(sheets.textile_day_rows(grid(spark, {"WS": cells})))}
    assert got == {"7": ("LOT-1", 11.5, None, 99.0), "M-2": (None, None, None, 5.0), "9": ("LOT-9", None, None, None)}


def test_repeated_machine_is_an_error(spark):
    cells = textile_sheet() + [(5, 0, " 7 ", "s"), (5, 5, "LOT-2", "s")]
    with pytest.raises(PySparkException, match="repeat in sheet"):
        sheets.textile_day_rows(grid(spark, {"WS": cells})).collect()
    lots = sheets.lot_unpivot(grid(spark, {"WS": cells}), sheets.sheet_month(grid(spark, {"WS": cells})))
    made = sheets.production_unpivot(grid(spark, {"WS": cells}), sheets.sheet_month(grid(spark, {"WS": cells})))
    with pytest.raises(PySparkException, match="repeat in sheet"):
        sheets.lot_production_join(lots, made).collect()


def test_output_header_too_far_left(spark):
    cells = [c for c in textile_sheet() if c[1] < 8] + [(2, 1, "생산량", "s"), (4, 1, "3", "n")]
    assert rows(sheets.textile_day_rows(grid(spark, {"WS": cells}))) == []


def test_report_date_is_the_last_of_the_first_dated_row(spark):
    cells = [(0, 0, "Schedule", "s"), (1, 1, "2024-05-01", "d"), (1, 4, "2024-05-03", "d"), (2, 0, "2024-06-01", "d"), (1, 9, "45000", "n")]
    assert [r["report_date"] for r in sheets.sheet_report_date(grid(spark, {"S": cells})).collect()] == [dt.date(2024, 5, 3)]


def test_start_beam_workbook(spark, tmp_path):
    names = ["호기 Số máy", "Lot No", "상대일 Ngày lên beam", "B/M No.", "Length", "Unnamed: 9"]
    values = {(0, 3): dt.datetime(2026, 7, 6), **{(2, i): n for i, n in enumerate(names)}}
    values.update({(3, 0): 12, (3, 1): "sc-1", (3, 2): dt.datetime(2026, 7, 1), (3, 3): "B1", (3, 4): 100.5})
    values.update({(5, 0): "M-1", (5, 1): "sc-2", (5, 2): "soon", (5, 4): "long"})
    write_xlsx(tmp_path / "2026-07-06_start_beam.xlsx", {"Plan": values, "Empty": {}})
    got = sheets.start_beam_rows(read_cells(spark, str(tmp_path))).orderBy("row_idx").collect()
    assert [r["machine_no"] for r in got] == [12.0, None]
    assert [r["beam_start_date"] for r in got] == [dt.datetime(2026, 7, 1), None]
    assert [r["length"] for r in got] == [100.5, None]
    assert [r["_excel_row_number"] for r in got] == [4, 6]
    assert {r["_updated_at"] for r in got} == {dt.date(2026, 7, 6)}
    assert "beam_no" in got[0].asDict() and not any(c.startswith("unnamed") for c in got[0].asDict())


def test_complete_beam_workbook(spark, tmp_path):
    values = {(0, 0): "Date", (0, 1): "Machine", (0, 2): "Production (QTY)", (1, 2): "Kgs", (1, 3): "Mts"}
    values.update({(2, 0): dt.datetime(2026, 7, 1, 6, 30), (2, 1): 5, (2, 2): 1.5, (2, 3): 2.5})
    write_xlsx(tmp_path / "a_complete_beam.xlsx", {"S": values})
    (row,) = sheets.complete_beam_rows(read_cells(spark, str(tmp_path))).collect()
    assert row["date"] == "2026-07-01 06:30:00" and row["production_qty_kgs"] == "1.5" and row["production_qty_mts"] == "2.5"


def test_unreadable_workbook_fails_the_load(spark, tmp_path):
    (tmp_path / "bad.xlsx").write_bytes(b"not a zip")
    with pytest.raises(PySparkException):
        read_cells(spark, str(tmp_path)).collect()
    (tmp_path / "old.xls").write_bytes(b"x")
    with pytest.raises(PySparkException, match="Only .xlsx"):
        read_cells(spark, str(tmp_path), "*.xls").collect()


def test_duplicate_names_get_numbers(spark):
    heads = spark.createDataFrame([("f", "s", i, n) for i, n in enumerate(["a", "b", "a", "a"])], "source_file string, sheet_name string, col_idx int, name string")
    assert [r["name"] for r in sheets.dedup_names(heads).orderBy("col_idx").collect()] == ["a", "b", "a_2", "a_3"]


def operators(df) -> list[str]:
    """Names of the operators of the initial plan."""
    return re.findall(r"^\(\d+\) (\w+)", df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")), re.M)


def test_the_sheet_pipeline_reads_the_body_once(spark, tmp_path, monkeypatch):
    cells = grid(spark, {"WS": textile_sheet() + [(5, 0, "M-2", "s"), (5, 10, "5", "n")]})
    cells.write.parquet(str(tmp_path / "cells"))
    stored = spark.read.parquet(str(tmp_path / "cells"))
    plans, store = [], sheets.store_stage
    monkeypatch.setattr(sheets, "store_stage", lambda df, label: plans.append(df) or store(df, label))
    out = sheets.textile_day_rows(stored)
    assert len(rows(out)) == 2
    # What was run: exchanges that are read again do not count, nor do the scans below them.
    final = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    run = [line for line in final.splitlines() if "ReusedExchange" not in line]
    exchanges = sum("Exchange hashpartitioning" in line for line in run) + operators(plans[0]).count("Exchange")
    scans = sum("FileScan" in line and "/cells]" in line for line in run) + operators(plans[0]).count("Scan")
    assert (scans, exchanges <= 6) == (2, True), final


def test_a_header_far_right_and_a_triple_beside_the_machine(spark):
    wide = [(3, 5, "2024-12-05", "d"), (2, 16_381, "12월 6일", "s"), (2, 16_383, "생산량", "s"), (4, 0, "3", "s"), (4, 5, "L", "s"), (4, 16_383, "4", "n")]
    # The first column is the machine and, two left of an output header in column 2, a meter reading as well.
    beside = [(3, 5, "2024-12-05", "d"), (2, 0, "12월 5일", "s"), (2, 2, "생산량", "s"), (4, 0, "3", "s"), (4, 5, "L", "s"), (4, 2, "4", "n")]
    got = {r[0]: r[1:] for r in rows(sheets.textile_day_rows(grid(spark, {"A": wide, "B": beside}))) if r[2] != dt.date(2024, 12, 6)}
    assert got == {"A": ("3", dt.date(2024, 12, 5), "L", None, None, None), "B": ("3", dt.date(2024, 12, 5), "L", 3.0, None, 4.0)}


def test_a_workbook_is_read_in_one_pass(spark, tmp_path):
    values = {(0, 0): "same", (0, 1): "same", (1, 0): "ü 생산량", (1, 1): 7}
    write_xlsx(tmp_path / "A.XLSX", {"One": values, "Two": {(3, 2): "same"}, "Blank": {}})
    write_xlsx(tmp_path / "~$A.XLSX", {"One": values})
    cells = read_cells(spark, str(tmp_path))
    assert {(r["sheet_name"], r["row_idx"], r["col_idx"], r["value"]) for r in cells.collect()} == {
        ("One", 0, 0, "same"), ("One", 0, 1, "same"), ("One", 1, 0, "ü 생산량"), ("One", 1, 1, "7"), ("Two", 3, 2, "same")}
    assert "Exchange" not in operators(cells) and operators(cells).count("MapInPandas") == 1


def test_the_string_table_is_parsed_once_a_book(tmp_path, monkeypatch):
    from loomline.sources import workbook

    path = write_xlsx(tmp_path / "a.xlsx", {f"S{k}": {(0, 0): f"text {k}"} for k in range(5)})
    made, strings = [], workbook.Strings
    monkeypatch.setattr(workbook, "Strings", lambda book: made.append(1) or strings(book))
    cells = list(workbook._book_cells(path, open(path, "rb").read()))
    assert [c[0] for c in cells] == [f"S{k}" for k in range(5)] and len(made) == 1
    table = strings(zipfile.ZipFile(path))
    assert bytes(table.buffer) == b"text 0text 1text 2text 3text 4" and table[4] == "text 4"
    with pytest.raises(ValueError, match="Shared string 5"):
        table[5]

"""A whole run: workbooks and events to gold, twice, then a backfill."""

from __future__ import annotations

import datetime as dt

import pytest

from loomline.plans import daily
from loomline.sources import tables

from workbooks import write_xlsx

SCHEMA = "id bigint, machine_id string, status string, timestamp timestamp_ntz"


def textile(lots: dict[int, str]):
    cells = {(3, 5 + n): dt.datetime(2026, 7, 1 + n) for n in range(3)}
    for n in range(3):
        cells.update({(2, 40 + 3 * n): f"7월 {n + 1}일", (2, 42 + 3 * n): "생산량"})
    for row, (machine, lot) in enumerate(lots.items(), start=4):
        cells[(row, 0)] = machine
        for n in range(3):
            cells.update({(row, 5 + n): lot, (row, 40 + 3 * n): 10.0 + n, (row, 41 + 3 * n): 1.0, (row, 42 + 3 * n): 50.0 + n})
    return {"July": cells}


def start_beam(snapshot: dt.datetime, plans: list[tuple]):
    heads = ["호기 Số máy", "Lot No", "상대일 Ngày lên beam", "B/M No.", "1일생산량(Mts) Số Mts dệt mỗi ngày",
             "Total Yarn", "Length", "PRO", "하대예정일 Ngày dự kiến hết beam"]
    cells = {(0, 2): snapshot, **{(2, i): h for i, h in enumerate(heads)}}
    for row, plan in enumerate(plans, start=3):
        cells.update({(row, i): v for i, v in enumerate((*plan, 900, 800, 700, july(30)))})
    return {"Plan": cells}


def july(n, hour=0):
    return dt.datetime(2026, 7, n, hour)


def folder(tmp_path):
    write_xlsx(tmp_path / "textile_days.xlsx", textile({7: "sc-1", 8: "sc-2"}))
    plans = [(7, "SC-1", july(1), "B1", 100), (8, "SC-2", july(5), "B2", 60)]
    write_xlsx(tmp_path / "2026-07-03_start_beam.xlsx", start_beam(july(3), plans))
    write_xlsx(tmp_path / "2026-07-04_start_beam.xlsx", start_beam(july(4), [*plans, (7, "SC-1", july(4), "B3", 120)]))
    write_xlsx(tmp_path / "x_complete_beam.xlsx", {"S": {
        (0, 0): "Date", (0, 1): "Machine", (0, 2): "Shift", (0, 3): "Lot", (0, 4): "Production Qty", (1, 4): "Kgs", (1, 5): "Mts",
        (0, 6): "Worker", (0, 7): "Qty Unit", (2, 0): july(2), (2, 1): 7, (2, 2): "a", (2, 3): "sc-1", (2, 4): 5, (2, 5): 9, (2, 7): "mts"}})
    return str(tmp_path)


def test_daily_run_and_backfill(catalog, tmp_path):
    spark = catalog
    path = folder(tmp_path)
    events = spark.createDataFrame([(1, "7", "running", july(1, 6)), (2, "7", "stopped", july(2, 6))], SCHEMA)
    first = daily.run_day(spark, path, dt.date(2026, 7, 3), events)
    assert first["start_beam_mode"] == "baseline" and first["complete_beam"]

    made = {(r["date"].day, r["lot"]): r for r in spark.table("gld_production_daily_fact").collect()}
    assert set(made) == {(1, "SC-1"), (2, "SC-1"), (3, "SC-1")}  # machine 8 reports no status
    assert made[(2, "SC-1")]["beam_plan_key"] == "WEV007|SC-1|2026-07-01|B1" and made[(1, "SC-1")]["is_start_beam"]
    hours = {r["date"].day: (r["running_hours"], r["stopped_hours"]) for r in spark.table("gld_machine_status_daily_fact").collect()}
    assert hours == {1: (18.0, 0.0), 2: (6.0, 18.0)}
    assert spark.table("slv_complete_beam").collect()[0]["production_qty_mts"] == 9.0

    # The next day brings one new event; stored rows are neither doubled nor changed.
    more = spark.createDataFrame([(2, "7", "late", july(2, 7)), (3, "8", "running", july(4, 12))], SCHEMA)
    assert daily.run_day(spark, path, dt.date(2026, 7, 4), more)["start_beam_mode"] == "incremental"
    assert spark.table("raw_machine_status").count() == 3
    assert spark.table("slv_textile_days").count() == 6
    assert spark.table("slv_complete_beam").count() == 1
    # Only the plan that starts on the snapshot's date came with it.
    plans = {(r["machine"], r["beam_start_date"].day) for r in spark.table("gld_beam_plan_dim").collect()}
    assert plans == {("WEV007", 1), ("WEV008", 5), ("WEV007", 4)}
    assert spark.table("gld_production_daily_fact").where("machine = 'WEV008'").count() == 3

    modes = daily.backfill_snapshots(spark, path, [dt.date(2026, 7, 4), dt.date(2026, 7, 3)])
    assert modes == {dt.date(2026, 7, 3): "baseline", dt.date(2026, 7, 4): "incremental"}
    assert {(r["machine"], r["beam_start_date"].day) for r in spark.table("gld_beam_plan_dim").collect()} == plans

    exported = tables.export_parquet(spark, daily.GOLD_TABLES, str(tmp_path / "out"))
    assert {n: c for n, c, _ in exported}["gld_production_daily_fact"] == 6
    assert spark.read.parquet(exported[0][2]).count() == exported[0][1]

    spark.sql("insert into slv_textile_days select * from slv_textile_days")
    with pytest.raises(daily.ChecksFailed, match="unique_key"):
        daily.check(spark, "silver")

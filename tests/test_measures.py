"""Measures: blanks by hand, and three selections against SQL on the smallest tables."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from loomline.plans import measures as ms
from loomline.plans import quality, report
from loomline.plans.gold import Gold
from loomline.registry import load_entries
from loomline.registry.inputs import Mill
from loomline.registry.measure_queries import _CARD_KINDS, _CARDS, base
from loomline.registry.shape import shaped, sql_shaped
from loomline.registry.sql_inputs import with_tables
from tools.compare import duck, rows_of

FOLDER = "/root/testdata/sf0.001"
STATUS = "date date, machine string, running_hours double, stopped_hours double, changeover_hours double, disconnected_hours double, planned_shutdown_hours double"
MADE = "date date, machine string, lot string, production_qty_mts double, beam_plan_key string"
PLANS = "beam_plan_key string, planned_daily_output_mts double"


def day(n):
    return dt.date(2024, 1, n)


def facts(spark, status, made, plans=()):
    return Gold(spark.createDataFrame(list(status), STATUS), spark.createDataFrame(list(made), MADE), spark.createDataFrame(list(plans), PLANS))


def one(df):
    (row,) = df.collect()
    return row.asDict()


def test_no_common_data(spark):
    gold = facts(spark, [], [(day(1), "A", "L", 5.0, "k")], [("k", 10.0)])
    card = one(report.overview_cards(gold))
    assert card["reporting_date"] is None and card["reporting_date_label"] == ms.NO_COMMON_DATA
    assert card["factory_health_status"] == "DATA GAP" and card["factory_health_insight"] == ms.NO_OVERLAP
    assert card["plan_coverage_label"] == ms.NO_COVERAGE and card["production_color"] == ms.GREY
    assert card["critical_machines_at_rd"] is None


def test_blank_sides_of_the_plan_gap(spark):
    status = [(day(2), "A", 5.0, 0.0, 0.0, 0.0, 0.0)]
    only_made = facts(spark, status, [(day(2), "A", "L", 7.0, "k")], [("k", None)])
    assert one(ms.production_totals(only_made))["plan_gap_mts"] == -7.0
    unplanned = one(ms.production_totals(facts(spark, status, [(day(2), "A", "L", 7.0, None)])))
    assert unplanned["plan_gap_mts"] is None and unplanned["performance"] is None


def test_machine_counts_and_filters(spark):
    status = [
        (day(2), "A", 0.0, 10.0, 0.0, 0.0, 0.0), (day(2), "B", 9.0, 1.0, 0.0, 0.0, 0.0), (day(2), "D", 0.0, 0.0, 0.0, 0.0, 8.0),
        (day(3), "B", 9.0, 1.0, 0.0, 0.0, 0.0),
    ]
    made = [(day(2), m, "L", 5.0, "k") for m in "ACD"] + [(day(1), "B", "L", 4.0, None)]
    gold = facts(spark, status, made, [("k", 10.0)])
    assert one(ms.reporting_date(gold))["reporting_date"] == day(2)
    counts = one(ms.machine_counts_at_reporting_date(gold))
    assert counts == {"critical_machines_at_rd": 1, "telemetry_conflicts_at_rd": 1, "missing_status_at_rd": 2}
    only_b = ms.Selection(machines=["B"])
    assert one(ms.reporting_date(gold, only_b))["reporting_date"] == day(2)  # machines do not move it
    assert one(ms.at_reporting_date(gold, only_b))["production_at_rd"] is None
    assert one(ms.at_reporting_date(gold, only_b))["production_change"] == -1.0
    assert one(ms.machine_counts_at_reporting_date(gold, only_b))["critical_machines_at_rd"] is None
    assert "machines below" in one(report.overview_cards(gold, only_b))["factory_health_insight"]


def test_seven_day_frames_look_before_the_range_and_skip_gaps(spark):
    status = [(day(20), "A", 5.0, 5.0, 0.0, 0.0, 0.0), (day(14), "A", 10.0, 0.0, 0.0, 0.0, 0.0)]
    made = [(day(10), "A", "L", 10.0, "k"), (day(12), "A", "L", 30.0, "k"), (day(20), "A", "L", 2.0, "k")]
    gold = facts(spark, status, made, [("k", 10.0)])
    sel = ms.Selection(day(16), day(20))
    got = {r["date"]: r["production_7d_average"] for r in ms.production_7d_average(gold, sel).collect()}
    assert got == {day(16): 20.0, day(17): 30.0, day(18): 30.0, day(20): 2.0}
    share = {r["date"]: r["availability_7d_average"] for r in ms.availability_7d_average(gold, sel).collect()}
    assert share == {day(16): 1.0, day(17): 1.0, day(18): 1.0, day(19): 1.0, day(20): 0.75}


@pytest.mark.parametrize("sel, in_range, mine", [
    (ms.Selection(), "true", "true"),
    (ms.Selection(day(8), day(20)), "date between date '2024-01-08' and date '2024-01-20'", "true"),
    (ms.Selection(day(8), day(20), ["WEV002", "WEV004", "WEV010"]), "date between date '2024-01-08' and date '2024-01-20'",
     "machine in ('WEV002', 'WEV004', 'WEV010')"),
    (ms.Selection(dt.date(2023, 1, 1), dt.date(2023, 1, 31)), "date < date '2023-02-01'", "true"),
])
def test_cards_under_selections(spark, sel, in_range, mine):
    mill = Mill(spark, FOLDER)
    got = shaped(report.overview_cards(mill.stored_gold, sel))
    cursor = duck(FOLDER).execute(with_tables(sql_shaped(base(_CARDS, in_range, mine), **_CARD_KINDS)))
    assert rows_of(got.columns, got.collect()) == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def operators(df) -> list[str]:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return re.findall(r"^\(\d+\) (\S+)", df._jdf.queryExecution().explainString(mode), re.M)


def test_a_summary_reads_each_fact_once_and_a_report_one_date(spark, tmp_path):
    status = [(day(n), m, 5.0, 5.0, 0.0, 0.0, 0.0) for n in range(1, 11) for m in ("A", "B", None)]
    made = [(day(n), m, lot, 5.0, "k") for n in range(1, 9) for m in "AB" for lot in ("L", "M")]
    plain = facts(spark, status, made, [("k", 10.0)])
    for name in ("status", "production", "plans"):
        getattr(plain, name).write.parquet(str(tmp_path / name))
    stored = Gold(*[spark.read.parquet(str(tmp_path / n)) for n in ("status", "production", "plans")])
    assert operators(ms.summary(stored).rows).count("Scan") == 3  # one each of the facts and the plans
    kept = ms.stored_summary(stored)
    for measure in (ms.production_totals, ms.status_totals, ms.critical_machines, ms.reporting_date, ms.at_reporting_date, ms.machine_counts_at_reporting_date,
                    report.overview_cards, report.production_pulse, report.availability_pulse, report.loss_hotspots, report.plan_risk):
        for sel in (ms.EVERYTHING, ms.Selection(day(2), day(5)), ms.Selection(machines=["B", "X"])):
            assert measure(kept, sel).collect() == measure(plain, sel).collect(), measure
    counts = ms.machines_at_reporting_date(kept)
    assert "PartitionFilters: [isnotnull(date" in counts._jdf.queryExecution().executedPlan().toString()
    assert "subquery" in counts._jdf.queryExecution().executedPlan().toString()
    assert len(ms.machines_at_reporting_date(kept).collect()) == 2


def test_row_checks_are_counted_while_a_table_is_written(spark):
    status = spark.createDataFrame([(day(2), "A", 20.0, 5.0, 0.0, 0.0, 0.0), (day(2), None, -1.0, 0.0, 0.0, 0.0, 1.0)], STATUS)
    name = "gld_machine_status_daily_fact"
    checked = quality.store_checked(status, name)
    assert checked.rows.count() == 2
    assert {k: v for k, v in checked.broken.items() if v} == {"not_null:machine": 1, "hours_within_day": 2, "shutdown_within_window": 1}
    lazy, known = (quality.summary({name: t}) for t in (status, checked))
    assert sorted(map(tuple, known.collect())) == sorted(map(tuple, lazy.collect()))
    assert "parquet" not in known._jdf.queryExecution().executedPlan().toString().lower()  # nothing to read again


def test_raw_checks(spark):
    rows = spark.createDataFrame([("1", "m", "s", "2024-01-01"), ("1", "m", "s", "soon"), ("x", "m", "s", None)], "id string, machine_id string, status string, timestamp string")
    found = {r["check_name"]: r["violations"] for r in quality.summary({"raw_machine_status": rows, "slv_complete_beam": None} | {}, "raw").collect()}
    assert found == {"unreadable:id": 1, "unreadable:timestamp": 1, "unique_key": 1}


def test_an_empty_table_passes_its_key_checks(spark):
    none = spark.createDataFrame([], "machine string, is_in_status_fact boolean")
    assert [(r["check_name"], r["violations"]) for r in quality.summary({"gld_machine_dim": none}).orderBy("check_name").collect()] == [
        ("not_null:machine", 0), ("unique:machine", 0)]


def test_checks_find_seeded_faults(spark):
    status = spark.createDataFrame(
        [(day(2), "A", 20.0, 5.0, 0.0, 0.0, 0.0), (day(2), "B", -1.0, 0.0, 0.0, 0.0, 1.0), (day(7), "C", 0.0, 0.0, 0.0, 0.0, 18.5)], STATUS)
    made = spark.createDataFrame([(day(2), "Z", "L", 1.0, None), (day(2), None, "L", 1.0, None)], MADE)
    machines = spark.createDataFrame([("A", True), ("A", True)], "machine string, is_in_status_fact boolean")
    report_rows = quality.summary({"gld_machine_status_daily_fact": status, "gld_production_daily_fact": made, "gld_machine_dim": machines})
    bad = {(r["table_name"][4:], r["check_name"]): r["violations"] for r in report_rows.where("violations > 0").collect()}
    assert bad == {
        ("machine_status_daily_fact", "hours_within_day"): 2, ("machine_status_daily_fact", "shutdown_within_window"): 1,
        ("production_daily_fact", "machines_report_status"): 2, ("production_daily_fact", "not_null:machine"): 1,
        ("machine_dim", "unique:machine"): 1,
    }
    assert len(quality.failed(report_rows)) == 5


def test_silver_checks_find_seeded_faults(spark):
    rows = spark.createDataFrame([(day(1), "A", "L", None, None), (day(1), "A", "L", None, None)], "date date, machine string, lot string, shift string, worker string")
    bad = quality.summary({"slv_complete_beam": rows}, "silver").where("violations > 0").collect()
    assert [(r["check_name"], r["violations"]) for r in bad] == [("unique_key", 1)]


def test_keys_are_counted_as_they_are_typed(spark):
    """No text of names or keys is moved for a check; nulls are values of a composite key and exempt in a unique column."""
    rows = spark.createDataFrame(
        [(day(1), "A", "L"), (day(1), "A", "L"), (None, "A", "L"), (None, "A", "L"), (day(2), None, "L"), (day(1), "A,L", "")], "date date, machine string, lot string")
    dates = spark.createDataFrame([(day(1), 1), (day(1), 2), (None, 3), (None, 3)], "date date, date_key int")
    report = quality.summary({"slv_textile_days": rows, "gld_date_dim": dates})
    found = {(r["table_name"], r["check_name"]): r["violations"] for r in report.collect()}
    assert {k: v for k, v in found.items() if "unique" in k[1]} == {
        ("slv_textile_days", "unique_key"): 2, ("gld_date_dim", "unique:date"): 1, ("gld_date_dim", "unique:date_key"): 1}
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(date" in plan and "Generate explode" not in plan and "cast(date" not in plan


def test_color_and_label(spark):
    df = spark.createDataFrame([(0.1, 0.5), (-0.1, None), (0.0, 0.98765), (None, 1.0)], "c double, p double")
    got = [tuple(r) for r in df.select(ms.change_color(F.col("c")), ms.coverage_label(F.col("p"))).collect()]
    assert got == [(ms.GREEN, "50.0% of output covered"), (ms.RED, ms.NO_COVERAGE), (ms.GREY, "98.8% of output covered"),
                   (ms.GREY, "100.0% of output covered")]


def test_every_query_has_sql():
    entries = load_entries()
    assert len(entries) > 100 and all(e.sql for e in entries.values())

"""Versions, as-of matching and dimensions on hand-made rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from loomline.operators import asof, versions
from loomline.plans import gold, silver
from loomline.registry.inputs import Mill


def day(n: int) -> dt.date:
    return dt.date(2024, 1, n)


PLAN = "beam_plan_key string, machine string, lot string, beam_no string, beam_start_date date"
PLANS = [
    ("k1", "M", "L", "B1", day(5)), ("k2", "M", "L", "B2", day(5)), ("k3", "M", "L", None, day(10)),
    ("k4", "M", "L", "B9", day(10)), ("k5", "M", "X", "B1", day(3)),
]


def test_plan_ranges(spark):
    got = {r["beam_plan_key"]: r["next_beam_start_date"] for r in asof.plan_validity_ranges(spark.createDataFrame(PLANS, PLAN)).collect()}
    assert got == {"k1": day(5), "k2": day(10), "k3": None, "k4": day(10), "k5": None}


def test_asof_join(spark):
    made = [(day(4), "M", "L"), (day(5), "M", "L"), (day(9), "M", "L"), (day(10), "M", "L"), (day(20), "M", "L"), (day(20), "M", "Y")]
    production = spark.createDataFrame(made, "date date, machine string, lot string")
    got = [tuple(r) for r in asof.asof_plan_join(production, spark.createDataFrame(PLANS, PLAN)).orderBy("lot", "date").collect()]
    assert [g[3] for g in got] == [None, "k2", "k2", "k3", "k3", None]


def test_keep_best(spark):
    rows = [
        (day(1), "M", "L", 5.0, None, 1.0), (day(1), "M", "L", 5.0, 2.0, None), (day(1), "M", "L", None, 9.0, 9.0), (day(2), "M", "L", None, None, None),
    ]
    df = spark.createDataFrame(rows, "date date, machine string, lot string, production_qty_mts double, meter_reading_m double, cut_length_m double")
    got = {r["date"]: tuple(r[3:]) for r in versions.keep_best(df).collect()}
    assert got == {day(1): (5.0, 2.0, None), day(2): (None, None, None)}


def test_first_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = versions.first_per_key(df, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_number_rows_over_stretches(spark):
    df = spark.range(0, 50).select((F.col("id") % 2).alias("k"), (F.col("id") * 7).alias("pos"))
    got = versions.number_rows(df, ["k"], ["pos"], "n", width=40).collect()
    for k in (0, 1):
        rows = sorted((r["pos"], r["n"]) for r in got if r["k"] == k)
        assert [n for _, n in rows] == list(range(1, 26))


def test_machine_dim_lists_status_machines_only(spark):
    machines = lambda *names: spark.createDataFrame([(n,) for n in names], "machine string")
    got = {tuple(r) for r in gold.machine_dim(machines("A", "B", "A"), machines("A"), machines("B", "Z")).collect()}
    assert got == {("A", True, True, False), ("B", False, True, True)}


def test_date_dim_of_nothing_is_empty(spark):
    none = spark.createDataFrame([], "date date, beam_start_date date")
    assert gold.date_dim(none, none, none).count() == 0


def test_date_dim_iso_week(spark):
    some = spark.createDataFrame([(dt.date(2020, 12, 31), None), (dt.date(2021, 1, 3), None)], "date date, beam_start_date date")
    rows = gold.date_dim(some, some, some).orderBy("date").collect()
    assert [(r["date_key"], r["week_of_year"], r["iso_day_of_week"], r["is_weekend"]) for r in rows] == [
        (20201231, 53, 4, False), (20210101, 53, 5, False), (20210102, 53, 6, True), (20210103, 53, 7, True)]


def test_the_production_fact_shuffles_four_times(spark, tmp_path):
    day = dt.date(2024, 1, 2)
    made = [(day, "A", "L", 1.0, 1.0, 1.0), (day, "B", "L", 2.0, 1.0, 1.0), (day, None, "L", 3.0, 1.0, 1.0), (dt.date(2024, 1, 1), "A", "M", 4.0, 1.0, 1.0)]
    textile = spark.createDataFrame(made, "date date, machine string, lot string, production_qty_mts double, meter_reading_m double, cut_length_m double")
    plans = spark.createDataFrame([("k", "A", "L", "B1", day), ("j", "A", "N", None, None)], "beam_plan_key string, machine string, lot string, beam_no string, beam_start_date date")
    status = spark.createDataFrame([("A",), ("A",), (None,), ("C",)], "machine string")
    for name, df in (("t", textile), ("p", plans), ("s", status)):
        df.write.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.production_daily_fact(*[spark.read.parquet(str(tmp_path / n)) for n in "tsp"])
        assert fact._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 4
        got = sorted((r["date"].day, r["machine"], r["lot"], r["is_start_beam"], r["beam_plan_key"]) for r in fact.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(1, "A", "M", False, None), (2, "A", "L", True, "k")]
    one_by_one = asof.with_start_beam_flag(asof.keep_status_machines(textile, status), plans)
    assert sorted(map(str, one_by_one.select("date", "machine", "lot", "is_start_beam").collect())) == sorted(
        map(str, asof.keep_and_flag(textile, status, plans).select("date", "machine", "lot", "is_start_beam").collect()))


def test_values_are_parsed_behind_the_exchange(spark, tmp_path):
    """A file of one row group is read by one task; parsing is not its work."""
    names = {
        silver.machine_status: "id machine_id status timestamp", silver.complete_beam: "date machine shift lot production_qty_kgs production_qty_mts worker qty_unit",
        silver.textile_days_typed: "prod_date machine_no lot_no prod_output_m meter_reading_m cut_length_m",
        silver.start_beam_typed: "machine_no lot_no beam_no beam_start_date total_yarn length planned_output expected_beam_end_at daily_output_mts _updated_at",
    }
    for typed, columns in names.items():
        path = str(tmp_path / typed.__name__)
        spark.createDataFrame([tuple("2024-01-02" for _ in columns.split())], ", ".join(f"{c} string" for c in columns.split())).write.parquet(path)
        rows = typed(spark.read.parquet(path)).where("machine is not null")
        plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
        at = next(k for k, line in enumerate(plan) if "Exchange hashpartitioning" in line)
        assert not any("try_cast" in line for line in plan[at + 1:]), typed
        assert any("try_cast" in line for line in plan[:at]) and "SinglePartition" not in plan[at]
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            assert typed(spark.read.parquet(path)).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_values_are_parsed_once_and_versions_meet_before_the_shuffle(spark, tmp_path):
    names = "machine_no lot_no beam_no beam_start_date _updated_at".split()
    rows = [("7.0", "l", "B", "2024-01-05", "2024-01-05"), ("7.0", "l", "B", "2024-01-05", "2024-01-06"), (" ", "l", "B", "2024-01-05", "2024-01-06"),
            ("7.0", None, "B", "2024-01-05", "2024-01-06"), ("7.0", "l", "B", "1970-01-01", "2024-01-06"), ("7.0", "l", "B", "2024-01-05", "x"), (None, "l", None, None, None)]
    spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).write.parquet(str(tmp_path / "raw"))
    typed = silver.start_beam_typed(spark.read.parquet(str(tmp_path / "raw")), values=())
    assert [tuple(r) for r in typed.distinct().drop("source_updated_at").distinct().collect()] == [(day(5), "WEV007", "L", "B")]
    plan = typed._jdf.queryExecution().executedPlan().toString().splitlines()
    parsing = [line for line in plan if "try_cast(replace(_updated_at" in line]
    assert len(parsing) == 1 and "Project" in parsing[0]
    dealt = next(line for line in plan if "Exchange hashpartitioning" in line)
    assert "beam_start_date" in dealt and "_updated_at" not in dealt
    assert not any("trim" in line for line in plan[plan.index(dealt):])


def test_plans_and_output_without_unused_columns(spark):
    names = "machine_no lot_no beam_no beam_start_date total_yarn length planned_output expected_beam_end_at daily_output_mts _updated_at".split()
    rows = [
        ("7.0", "l", "B", "2024-01-05", "1", "2", "3", None, "4", "2024-01-05"), ("7", " L ", "B", "2024/01/05", "1", "2", "3", None, "9", "2024-01-06"),
        ("007", "L", "B", "2024-01-05 06:00", "1", "5", "3", "2024-02-01", "9", "2024-01-06"), ("7", "L", "B", "2024-01-05", "1", "9", "3", None, None, "2024-01-06"),
        ("7", "L", None, "2024-01-05", "1", "2", "3", None, "1d", "2024-01-05"), ("7", "L", "B", "1970-01-01", "1", "2", "3", None, "1", "2024-01-05"),
        ("8", "L", "B", "2024-01-05", "1", "2", "3", None, "1", None), ("000", "L", "B", "+2024-01-05", "1", "2", "3", None, "1", "2024-01-05"),
        ("000", "L", "B", "2024-1-5", "1", "2", "3", None, "Infinity", "2024-01-05"),
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    whole = gold.beam_plan_dim(silver.start_beam(raw))
    assert sorted(map(str, gold.beam_plan_dim(silver.start_beam_typed(raw)).collect())) == sorted(map(str, whole.collect()))
    keys = ["beam_plan_key", "machine", "lot", "beam_no", "beam_start_date"]
    got = gold.daily_plans(silver.start_beam_typed(raw, values=("daily_output_mts",)))
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.select(*keys, "planned_daily_output_mts").collect()))
    assert sorted((r["beam_plan_key"], r["planned_daily_output_mts"]) for r in got.collect()) == [
        ("WEV000|L|2024-01-05|B", float("inf")), ("WEV007|L|2024-01-05", None), ("WEV007|L|2024-01-05|B", 9.0)]
    got = gold.beam_plan_keys(silver.start_beam_typed(raw, values=()))
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.select(*keys).collect()))

    days = [("2024-01-02", "1", "L", a, m, "1") for a, m in ((None, "9"), ("5", "1"), ("5", "2"), ("x", "3"))] + [("2024-01-03", "1", "L", None, "1", "1")]
    raw = spark.createDataFrame(days, "prod_date string, machine_no string, lot_no string, prod_output_m string, meter_reading_m string, cut_length_m string")
    columns = ["date", "machine", "lot", "production_qty_mts"]
    assert sorted(map(str, silver.textile_output(raw).collect())) == sorted(map(str, silver.textile_days(raw).select(*columns).collect()))


def test_plans_in_force_are_the_last_beams_of_their_days(spark):
    """Spellings of a plan meet after their snapshots do; a beam without a number is the last."""
    names = "machine_no lot_no beam_no beam_start_date total_yarn length planned_output expected_beam_end_at daily_output_mts _updated_at".split()
    rows = [("7.0", "l", beam, day, "1", "2", str(k), None, daily, at) for k, (beam, day, daily, at) in enumerate([
        ("B1", "2024-01-05", "4", "2024-01-05"), ("B2", "2024-01-05", "4", "2024-01-06"), ("B2", "2024-01-05", "6", "2024-01-06"),
        ("B2", "2024-01-05", None, "2024-01-06"), ("B2", "2024-01-05", "9", "2024-01-05"), ("B2", "2024/01/05", "5", "2024-01-07"), ("B2", "2024-01-05", "99", "never"),
        ("B9", "2024-01-05", "99", None), ("B2", "1970-01-01", "4", "2024-01-05"), ("B3", "2024-01-09", "4", "2024-01-05"), (" ", "2024-01-09", "3", "2024-01-05"),
        (None, "2024-01-09", "8", "2024-01-05"), (None, None, "8", "2024-01-05")])]
    rows += [("007", "L", "B2", "2024-01-05 06:00", "1", "2", "3", None, "7", "2024-01-07"), (None, "L", "B2", "2024-01-05", "1", "2", "3", None, "7", "2024-01-07")]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    whole = gold.beam_plan_dim(silver.start_beam(raw))
    assert silver.start_beam_newest(raw).count() == 7
    expected = sorted(map(str, asof.plan_days(whole).join(whole.select("beam_plan_key", "planned_daily_output_mts"), "beam_plan_key").collect()))
    columns = ["beam_plan_key", "machine", "lot", "beam_start_date", "beam_no", "planned_daily_output_mts"]
    got = gold.plan_starts(silver.start_beam_newest(raw, "daily_output_mts"))
    assert sorted(map(str, got.select(*columns).collect())) == expected
    assert sorted((r["beam_plan_key"], r["planned_daily_output_mts"]) for r in got.collect()) == [("WEV007|L|2024-01-05|B2", 7.0), ("WEV007|L|2024-01-09", 8.0)]
    for starts in (gold.plan_starts(silver.start_beam_newest(raw)), gold.plan_starts(whole)):
        assert sorted(map(str, starts.select(*columns[:-1]).collect())) == sorted(map(str, asof.plan_days(whole).select(*columns[:-1]).collect()))


def test_measures_move_no_text_they_do_not_read(spark):
    mill = Mill(spark, "/root/testdata/sf0.001")
    plan = mill.gold.measured.production._jdf.queryExecution().optimizedPlan().toString()
    assert "l_quantity" in plan and "l_extendedprice" not in plan.split("Relation")[0]


def test_plans_are_cut_to_their_last_beams_before_they_move(spark, tmp_path):
    names = "machine_no lot_no beam_no beam_start_date daily_output_mts _updated_at".split()
    rows = [("7.0", "l", f"B{k}", "2024-01-05", str(k), at) for k in range(10) for at in ("2024-01-05", "2024-01-06", "never")]
    rows += [("7.0", "l", "B9", "2024-01-05", d, "2024-01-06") for d in (None, "12", "x")] + [(" 007", "L", "B99", "2024/01/05", "3", "2024-01-01")]
    rows += [("8", "l", " ", "2024-01-05", "1", "2024-01-05"), ("8", "l", "B1", "2024-01-05", "2", "2024-01-09"), ("8", "l", "B1", "1970-01-01", "2", "2024-01-09"),
             ("8", None, "B1", "2024-01-05", "2", "2024-01-09"), (None, "l", "B1", "2024-01-05", "2", "2024-01-09"), ("8", "l", "B1", "2024-02-05", "2", None)]
    spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    last = silver.start_beam_last(raw, "daily_output_mts")
    assert last.count() == 3  # two spellings of one start day, and another
    for value in (None, "daily_output_mts"):
        got, whole = gold.plan_starts(silver.start_beam_last(raw, value)), gold.plan_starts(silver.start_beam_newest(raw, value))
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    assert sorted((r["beam_plan_key"], r["planned_daily_output_mts"]) for r in gold.plan_starts(last).collect()) == [
        ("WEV007|L|2024-01-05|B99", 3.0), ("WEV008|L|2024-01-05", 1.0)]
    plan = last._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [k for k, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "partial_max" in "".join(plan[exchanges[0]:]) and "beam_no" not in plan[exchanges[0]].split("ENSURE")[0].split("hashpartitioning(")[1]


def test_output_meets_as_text_and_carries_its_planned_output(spark, tmp_path):
    days = [("2024-01-02", "7", "L", a) for a in ("1", "9", None, "x")] + [("2024/01/02", "007.0", " l", "10"), ("2024-01-01", "7", "L", None), ("never", "7", "L", "1")]
    spark.createDataFrame(days, "prod_date string, machine_no string, lot_no string, prod_output_m string").write.parquet(str(tmp_path / "raw"))
    output = silver.textile_output(spark.read.parquet(str(tmp_path / "raw")))
    assert sorted(map(tuple, output.collect())) == [(day(1), "WEV007", "L", None), (day(2), "WEV007", "L", 10.0)]
    plan = output._jdf.queryExecution().executedPlan().toString().splitlines()
    first = max(k for k, line in enumerate(plan) if "Exchange hashpartitioning" in line)
    assert "partial_max" in "".join(plan[first:]) and "prod_date" in plan[first]
    plans = spark.createDataFrame([("k", "WEV007", "L", "B1", day(2), 5.0), ("j", "WEV007", "M", None, day(1), None)], f"{PLAN}, planned_daily_output_mts double")
    status = spark.createDataFrame([("WEV007",)], "machine string")
    fact = gold.production_daily_fact(output, status, plans, in_force=True)
    assert sorted((r["date"].day, r["is_start_beam"], r["beam_plan_key"], r["planned_daily_output_mts"]) for r in fact.collect()) == [(1, True, None, None), (2, True, "k", 5.0)]
    plain = gold.production_daily_fact(output, status, plans)
    assert sorted(map(str, gold.with_plan_columns(plain, plans, "planned_daily_output_mts").select(*fact.columns).collect())) == sorted(map(str, fact.collect()))


def test_machines_meet_before_they_move(spark, tmp_path):
    days = [("2024-01-02", "7", "L"), ("never", "7", "L"), ("2024-01-02", "007.0", "M"), ("2024-01-02", "8", " "), ("never", "8", "L"), ("2024-01-02", None, "L"),
            ("2024-01-02", " ", "L"), ("2024/01/02", "wev9", "L")]
    spark.createDataFrame(days, "prod_date string, machine_no string, lot_no string").write.parquet(str(tmp_path / "days"))
    plans = [("7.0", "l", "B", "2024-01-05", "2024-01-05"), ("8", "l", "B", "1970-01-01", "2024-01-05"), ("8", None, "B", "2024-01-05", "2024-01-05"),
             ("8", "l", "B", "2024-01-05", "x"), ("wev9", "l", "B", "2024-01-05", "2024-01-05"), (None, "l", "B", "2024-01-05", "2024-01-05")]
    spark.createDataFrame(plans, "machine_no string, lot_no string, beam_no string, beam_start_date string, _updated_at string").write.parquet(str(tmp_path / "plans"))
    days, plans = spark.read.parquet(str(tmp_path / "days")), spark.read.parquet(str(tmp_path / "plans"))
    for got, whole, names in ((silver.textile_machines(days), silver.textile_days_typed(days, ()), ["WEV007", "WEV9"]),
                              (silver.start_beam_machines(plans), silver.start_beam_typed(plans, values=()), ["WEV007", "WEV9"])):
        found = sorted({r["machine"] for r in got.collect()})
        assert found == sorted({r["machine"] for r in whole.collect()}) and len(found) == len(names)
        plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
        at = next(k for k, line in enumerate(plan) if "Exchange hashpartitioning(machine_no" in line)
        assert "partial_bool_or" in "".join(plan[at:]) or "partial_max" in "".join(plan[at:])


def test_production_rows_meet_as_text_before_they_move(spark, tmp_path):
    days = [("2024-01-02", "1", "L", a, m, c) for a, m, c in ((None, "9", "9"), ("5", "1", "9"), ("5", "2", None), ("5", "2", "3"), ("x", "3", "4"))]
    days += [("2024/01/02", " 001", "l", "5", "2", "4"), ("2024-01-03", "1.0", "L", None, None, "x"), ("never", "1", "L", "1", "1", "1"), (None, None, None, "1", "1", "1")]
    spark.createDataFrame(days, "prod_date string, machine_no string, lot_no string, prod_output_m string, meter_reading_m string, cut_length_m string").write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    best = silver.textile_days(raw)
    assert sorted(map(str, best.collect())) == sorted(map(str, versions.keep_best(silver.textile_days_typed(raw)).collect()))
    assert sorted(tuple(r)[3:] for r in best.where("date = '2024-01-02'").collect()) == [(5.0, 2.0, 4.0)] and best.count() == 2
    plan = best._jdf.queryExecution().executedPlan().toString().splitlines()
    first = max(k for k, line in enumerate(plan) if "Exchange hashpartitioning" in line)
    assert "partial_max" in "".join(plan[first:]) and "prod_date" in plan[first]

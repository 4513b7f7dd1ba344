"""Incremental loads, replay, file lookup and database scan."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loomline.operators import incremental as inc
from loomline.plans import daily
from loomline.sources import database, files, tables

from workbooks import write_xlsx


def test_append_keeps_only_rows_above_the_mark(catalog):
    spark = catalog
    first = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, status string")
    tables.append_table(first, "raw_t", "id", "bigint")
    second = spark.createDataFrame([("2", "late", "x"), ("abc", "bad", "x"), ("3", "new", "x")], "ID string, Status string, extra string")
    tables.append_table(second, "raw_t", "id", "bigint")
    got = {tuple(r) for r in spark.table("raw_t").collect()}
    assert got == {("1", "a", None), ("2", "b", None), ("3", "new", "x")}
    assert spark.table("raw_t").columns == ["id", "status", "extra"]


def test_append_without_a_readable_mark_keeps_everything(spark):
    target = spark.createDataFrame([("x",)], "id string")
    source = spark.createDataFrame([("1",), ("y",)], "id string")
    assert inc.incremental_rows(source, target, "id", "bigint").count() == 2


def test_missing_incremental_column(spark):
    with pytest.raises(ValueError, match="Missing column"):
        inc.column_named(spark.range(1), "nope")


def test_replace_reads_its_own_table(catalog):
    spark = catalog
    tables.replace_table([spark.createDataFrame([(1, "a")], "n int, s string"), spark.createDataFrame([(2.5,)], "n double")], "raw_r")
    assert {tuple(r) for r in spark.table("raw_r").collect()} == {("1", "a"), ("2.5", None)}
    tables.swap_in(spark.table("raw_r").where("n = '1'"), "raw_r")
    assert [tuple(r) for r in spark.table("raw_r").collect()] == [("1", "a")]


def test_a_swap_that_was_cut_off_is_finished(catalog):
    spark = catalog
    spark.range(3).write.saveAsTable("slv_start_beam__staged")  # the old table was dropped, the new one not renamed yet
    tables.swap_in(spark.table("slv_start_beam__staged").where("id > 0"), "other")
    tables.recover(spark, "slv_start_beam")
    assert spark.table("slv_start_beam").count() == 3 and not spark.catalog.tableExists("slv_start_beam__staged")
    spark.range(9).write.saveAsTable("slv_start_beam__staged")  # cut off before the drop: the current table counts
    tables.swap_in(spark.table("slv_start_beam").where("id = 2"), "slv_start_beam")
    assert [r["id"] for r in spark.table("slv_start_beam").collect()] == [2]


def test_the_stored_id_reaches_the_scan(catalog, tmp_path, capsys):
    spark = catalog
    spark.range(10).selectExpr("id", "'m' as machine_id").write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    tables.append_table(source.where("id < 7"), "raw_machine_status", "id", "bigint")
    tables.above_mark(source, spark.table("raw_machine_status"), "id", "bigint").explain("formatted")
    assert "GreaterThan(id,6)" in capsys.readouterr().out
    daily.ingest_status(source)
    assert sorted(int(r["id"]) for r in spark.table("raw_machine_status").collect()) == list(range(10))


def test_the_mark_is_known_without_reading_the_table(catalog, tmp_path, monkeypatch):
    spark = catalog
    schema = "id string, timestamp string"
    tables.append_table(spark.createDataFrame([("1", "a"), ("30", "b"), ("x", "c")], schema), "raw_m", "id", "bigint")
    assert tables.properties(spark, "raw_m")[tables.MARK] == "30"
    scans = []
    monkeypatch.setattr(tables, "highwater_mark", lambda df, *a: scans.append(1) or inc.highwater_mark(df, *a))
    # Files of the stored table out of reach: the next load must not open them.
    monkeypatch.setattr(tables, "incremental_rows", lambda *a: pytest.fail("the stored rows were read"))
    tables.append_table(spark.createDataFrame([("30", "late"), ("31", "new"), ("y", "bad")], schema), "raw_m", "ID", "bigint")
    assert not scans and tables.properties(spark, "raw_m")[tables.MARK] == "31"
    tables.append_table(spark.createDataFrame([("5", "late")], schema), "raw_m", "id", "bigint")
    assert tables.properties(spark, "raw_m")[tables.MARK] == "31"
    assert sorted(r["id"] for r in spark.table("raw_m").collect()) == ["1", "30", "31", "x"]
    plan = tables.above_known(spark.createDataFrame([("9", "a")], schema), tables.known_mark(spark, "raw_m", "id", "bigint"), "id", "bigint")
    assert "raw_m" not in plan._jdf.queryExecution().toString()


def test_a_mark_that_is_missing_or_cut_off_is_taken_from_the_rows(catalog):
    spark = catalog
    spark.createDataFrame([("7", "2024-01-02")], "id string, timestamp string").write.saveAsTable("raw_m")
    assert tables.known_mark(spark, "raw_m", "id", "bigint") == "7"
    # A load wrote its rows and stopped before the mark.
    tables.set_properties(spark, "raw_m", loomline__mark__state="loading")
    spark.createDataFrame([("9", "2024-01-03")], "id string, timestamp string").write.insertInto("raw_m")
    tables.append_table(spark.createDataFrame([("8", "x"), ("10", "y")], "id string, timestamp string"), "raw_m", "id", "bigint")
    assert sorted(int(r["id"]) for r in spark.table("raw_m").collect()) == [7, 9, 10]
    # Another column has a mark of its own.
    assert tables.known_mark(spark, "raw_m", "timestamp", "timestamp") == "2024-01-03 00:00:00"
    spark.createDataFrame([("x",)], "id string").write.saveAsTable("raw_n")
    assert tables.known_mark(spark, "raw_n", "id", "bigint") is None
    tables.append_table(spark.createDataFrame([("y",)], "id string"), "raw_n", "id", "bigint")
    assert spark.table("raw_n").count() == 2


def test_readers_find_the_table_at_every_step_of_a_swap(catalog, monkeypatch):
    spark = catalog
    tables.swap_in(spark.range(3), "slv_s")
    seen, run, write = [], spark.sql, tables.uuid.uuid4

    def look(statement, *args, **kwargs):
        seen.append(spark.table("slv_s").count())
        out = run(statement, *args, **kwargs)
        seen.append(spark.table("slv_s").count())
        return out

    monkeypatch.setattr(spark, "sql", look)
    monkeypatch.setattr(tables.uuid, "uuid4", lambda: seen.append(spark.table("slv_s").count()) or write())
    tables.swap_in(spark.table("slv_s").union(spark.range(10, 12)), "slv_s")
    assert set(seen) == {3, 5} and seen == sorted(seen) and len(seen) > 4
    planned = spark.table("slv_s").where("id > 1")  # a reader that has its files listed already
    planned.explain()
    seen.clear()
    tables.swap_in(spark.table("slv_s").where("id > 1"), "slv_s")
    assert set(seen) == {5, 3} and planned.count() == 3
    for _ in range(3):
        tables.swap_in(spark.table("slv_s").where("id > 2"), "slv_s")
    assert sorted(r["id"] for r in spark.table("slv_s").collect()) == [10, 11]
    monkeypatch.undo()
    spark.sql("DROP TABLE slv_s")
    spark.range(1).write.saveAsTable("slv_s")  # no version is left in the way
    tables.swap_in(spark.createDataFrame([("a",)], "name string"), "slv_s")  # other columns: by name
    assert [r["name"] for r in spark.table("slv_s").collect()] == ["a"]


def files_read(df) -> int:
    """Files that the scan of a stored table opened when the frame was run."""
    df.collect()
    found = []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
            return
        if node.getClass().getSimpleName() == "FileSourceScanExec" and node.relation().partitionSchema().length() > 0:
            found.append(node.metrics().apply("numFiles").value())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            walk(node.plan())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_a_merge_opens_the_days_of_its_load_only(catalog):
    spark = catalog

    def days(*numbers):
        rows = [(dt.date(2024, 1, n), "M", f"L{k}", float(k)) for n in numbers for k in range(2)]
        return spark.createDataFrame(rows, "date date, machine string, lot string, production_qty_mts double").coalesce(1)

    daily.insert_only(days(*range(1, 11)), "slv_textile_days", inc.TEXTILE_KEY)
    daily.insert_only(days(3, 11).union(days(3)), "slv_textile_days", inc.TEXTILE_KEY)
    assert spark.table("slv_textile_days").groupBy("date").count().where("count <> 2 and day(date) <> 11").count() == 0
    load = tables.store_stage(days(4, 7), "load")
    merged = inc.new_keys(load, inc.stored_days(spark.table("slv_textile_days"), load, "date"), inc.TEXTILE_KEY)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x and "slv_textile_days" in x)
    assert "array_contains" in line.split("PartitionFilters:")[1] and "subquery" in line.split("PartitionFilters:")[1]
    assert files_read(merged) == 2 and merged.count() == 0


def test_a_replay_drops_whole_snapshots(catalog, monkeypatch):
    spark = catalog
    rows = [("M", "L", "B", dt.date(2026, 7, n), dt.datetime(2026, 7, n), dt.date(2026, 7, n)) for n in (9, 10, 11)]
    frame = spark.createDataFrame(rows, "machine string, lot string, beam_no string, beam_start_date date, source_updated_at timestamp_ntz, snapshot_date date")
    daily.insert_only(frame, "slv_start_beam", inc.START_BEAM_KEY)
    monkeypatch.setattr(inc, "replay_mode", lambda *a: pytest.fail("the rows were read"))
    assert daily.prepare_start_beam(spark, dt.date(2026, 7, 10)) == "incremental"
    assert [r["snapshot_date"] for r in spark.table("slv_start_beam").collect()] == [dt.date(2026, 7, 9)]
    assert daily.prepare_start_beam(spark, dt.date(2026, 7, 9)) == "baseline" and not spark.catalog.tableExists("slv_start_beam")


def test_exported_files_must_agree_with_what_was_written(catalog, tmp_path):
    spark = catalog
    tables.swap_in(spark.range(5), "gld_a")
    exported = tables.export_parquet(spark, ["default.gld_a"], str(tmp_path))
    assert [tuple(r) for r in tables.exported_counts(spark, exported).collect()] == [("gld_a", 5)]
    spark.range(1).write.mode("append").parquet(exported[0][2])
    with pytest.raises(PySparkException, match="differ"):
        tables.exported_counts(spark, exported).collect()


def test_a_new_table_of_a_folder_is_listed(spark, tmp_path):
    folder = f"{tmp_path}/given"
    spark.range(2).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([("a", 1.5)], "name string, size double").coalesce(1).write.parquet(f"{folder}/fresh.parquet")
    database = "listing"
    assert tables.register_folder(spark, folder, database) == ["fresh", "orders"]
    assert {tuple(r) for r in tables.catalog_columns(spark, database).collect()} == {
        ("fresh", 1, "name", "string"), ("fresh", 2, "size", "double"), ("orders", 1, "id", "bigint")}
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_binary_workbooks_are_refused_by_name(spark, tmp_path):
    (tmp_path / "2026_complete_beam.xls").write_bytes(b"x")
    with pytest.raises(ValueError, match="complete_beam.xls"):
        daily.ingest_folder(spark, str(tmp_path), daily.COMPLETE_BEAM)


def beams(day: dt.datetime, machine: int):
    return {"Plan": {(0, 2): day, (2, 0): "호기 Số máy", (2, 1): "Lot No", (3, 0): machine, (3, 1): "L"}}


def test_suffixes_in_capitals_are_read(catalog, tmp_path):
    spark = catalog
    write_xlsx(tmp_path / "2026-07-03_start_beam.xlsx", beams(dt.datetime(2026, 7, 3), 7))
    write_xlsx(tmp_path / "2026-07-04_start_beam.XLSX", beams(dt.datetime(2026, 7, 4), 8))
    write_xlsx(tmp_path / "2026-07-05_start_beam.Xlsx", beams(dt.datetime(2026, 7, 5), 9))
    write_xlsx(tmp_path / "2026_complete_beam.XLSX", {"S": {(0, 0): "Date", (2, 0): "2026-07-01"}})
    write_xlsx(tmp_path / "textile_days.XLSX", {"S": {(0, 0): "x"}})
    found = files.list_files(spark, str(tmp_path), "*")
    for day, machine in ((3, "7.0"), (4, "8.0"), (5, "9.0")):
        daily.ingest_workbooks(spark, [files.find_snapshot(found, dt.date(2026, 7, day))], daily.START_BEAM)
        assert [r["machine_no"] for r in spark.table("raw_start_beam").collect()] == [machine]
    assert daily.ingest_folder(spark, str(tmp_path), daily.COMPLETE_BEAM)
    assert spark.table("raw_complete_beam").count() == 1
    manifest = files.check_raw_inputs(found, spark, dt.date(2026, 7, 4))
    assert manifest["start_beam_path"].endswith("2026-07-04_start_beam.XLSX") and manifest["complete_beam"]


def test_a_listed_workbook_without_cells_keeps_the_stored_table(catalog, tmp_path):
    spark = catalog
    paths = [write_xlsx(tmp_path / "2026-07-03_start_beam.xlsx", beams(dt.datetime(2026, 7, 3), 7)), write_xlsx(tmp_path / "2026-07-04_start_beam.xlsx", {"Plan": {}})]
    daily.ingest_workbooks(spark, paths[:1], daily.START_BEAM)
    with pytest.raises(PySparkException, match="without a cell"):
        daily.ingest_workbooks(spark, paths[1:], daily.START_BEAM)
    assert spark.table("raw_start_beam").count() == 1


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from loomline.session import ensure_checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_null_keys_in_merges(spark):
    schema = "date date, machine string, lot string, shift string, worker string"
    d = dt.date(2024, 1, 1)
    stored = spark.createDataFrame([(d, "M", "L", None, "w")], schema)
    fresh = spark.createDataFrame([(d, "M", "L", None, "w"), (d, "M", "L", "A", "w")], schema)
    assert [r["shift"] for r in inc.new_keys(fresh, stored, inc.COMPLETE_BEAM_KEY, inc.COMPLETE_BEAM_NULL_SAFE).collect()] == ["A"]
    plain = "machine string, lot string, beam_no string, beam_start_date date, source_updated_at date"
    row = spark.createDataFrame([("M", "L", None, d, d)], plain)
    assert inc.new_keys(row, row, inc.START_BEAM_KEY).count() == 1  # a NULL beam number is added again


def test_replay_keeps_older_snapshots(catalog):
    spark = catalog
    days = [dt.date(2026, 7, n) for n in (9, 10, 11)]
    spark.createDataFrame([(d,) for d in days], "source_updated_at date").write.saveAsTable("slv_start_beam")
    assert daily.prepare_start_beam(spark, dt.date(2026, 7, 10)) == "incremental"
    assert [r[0] for r in spark.table("slv_start_beam").collect()] == [dt.date(2026, 7, 9)]


def test_replay_without_older_snapshots_drops_the_table(catalog):
    spark = catalog
    spark.createDataFrame([(dt.date(2026, 7, 17),)], "source_updated_at date").write.saveAsTable("slv_start_beam")
    assert daily.prepare_start_beam(spark, dt.date(2026, 7, 6)) == "baseline"
    assert not spark.catalog.tableExists("slv_start_beam")
    assert daily.prepare_start_beam(spark, dt.date(2026, 7, 6)) == "baseline"


def test_snapshot_lookup_on_a_folder(spark, tmp_path):
    for name in ("2026-07-06_start_beam.xlsx", "2026-07-07_start_beam.xlsx", "2026-07-07_start_beam.xls", "~$2026-07-06_start_beam.xlsx"):
        (tmp_path / name).write_bytes(b"x")
    found = files.list_files(spark, str(tmp_path), "*")
    assert files.find_snapshot(found, dt.date(2026, 7, 6)).endswith("/2026-07-06_start_beam.xlsx")
    with pytest.raises(ValueError):
        files.find_snapshot(found, dt.date(2026, 7, 7))
    with pytest.raises(FileNotFoundError):
        files.find_snapshot(found, dt.date(2026, 7, 8))
    with pytest.raises(FileNotFoundError, match="textile_days"):
        files.check_raw_inputs(found, spark, dt.date(2026, 7, 6))


def test_run_date_key():
    assert daily.parse_run_date("2026-07-06") == dt.date(2026, 7, 6)
    for key in (None, "", "6 July"):
        with pytest.raises(ValueError):
            daily.parse_run_date(key)


def test_status_scan_filters_reach_the_scan(spark, tmp_path, capsys):
    spark.sql("select 1L id, 'm' machine_id, 's' status, timestamp_ntz'2026-07-02 00:00:00' timestamp").write.parquet(str(tmp_path / "t"))
    scan = database.status_scan(spark.read.parquet(str(tmp_path / "t")), dt.date(2026, 7, 1), dt.date(2026, 8, 1), min_id=0)
    scan.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(id,0)" in plan and "GreaterThanOrEqual(timestamp" in plan
    assert scan.count() == 1


def test_status_files_stream(catalog, tmp_path):
    from loomline.streaming.status_files import load_available

    spark = catalog
    rows = spark.sql("select 5L id, 'm' machine_id, 's' status, timestamp_ntz'2026-07-02 00:00:00' timestamp")
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        load_available(spark, str(tmp_path / "in"), str(tmp_path / "ckpt")).awaitTermination()
    assert [r["id"] for r in spark.table("raw_machine_status").collect()] == ["5"]
    rows.withColumn("id", F.lit(4).cast("bigint")).write.mode("append").parquet(str(tmp_path / "in"))
    load_available(spark, str(tmp_path / "in"), str(tmp_path / "ckpt")).awaitTermination()
    assert spark.table("raw_machine_status").count() == 1  # late id


def test_a_stored_stage_leaves_no_shuffle_files(spark):
    from loomline.sources.tables import store_stage

    def shuffled():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name for name in (blocks.apply(k).name() for k in range(blocks.size())) if name.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = spark.conf.get(setting, None), shuffled()
    stored = store_stage(spark.range(5000).repartition(7, "id").groupBy("id").count(), "shuffled")
    until = time.time() + 20
    while shuffled() - held and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - held and spark.conf.get(setting, None) == before
    assert stored.count() == 5000

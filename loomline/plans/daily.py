"""The daily run and the snapshot backfill: raw tables, silver, checks, gold, checks.

Tables live in the session catalog. Silver is the incremental state; gold is
rebuilt and swapped in.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import APPEND, COMPLETE_BEAM, MACHINE_STATUS, START_BEAM, TEXTILE_DAYS, RawSource
from ..operators import incremental as inc
from ..operators.sheets import row_metadata
from ..sources import files, tables
from ..sources.workbook import read_cells
from . import gold, quality, silver

GOLD_TABLES = (
    "gld_date_dim", "gld_machine_dim", "gld_beam_plan_dim", "gld_production_daily_fact", "gld_machine_status_daily_fact",
)


class ChecksFailed(RuntimeError):
    """A layer has rows that break its rules."""


def parse_run_date(key: str | None) -> dt.date:
    """Partition key of a run, an ISO date; a backfill run must have one."""
    if not key:
        raise ValueError("This run has no partition date; start it as a backfill over a date range.")
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", key):
        raise ValueError(f"Not an ISO date: {key}")
    return dt.date.fromisoformat(key)


# -- raw -------------------------------------------------------------------


def ingest_workbooks(spark: SparkSession, paths: Sequence[str], source: RawSource) -> None:
    """Cells of the given workbooks -> the source's raw table. Old binary workbooks cannot be read: they are an error, never left out."""
    files.refuse_binary(paths)
    cells = tables.store_stage(read_cells(spark, list(paths)), "cells")
    rows = row_metadata(source.extract(cells)).drop("row_idx")
    if source.strategy == APPEND:
        tables.append_table(rows, source.table, source.incremental_column, source.incremental_kind, source.sort)
    else:
        tables.replace_table([rows], source.table)


def ingest_folder(spark: SparkSession, folder: str, source: RawSource) -> bool:
    """All workbooks of a folder that match the source's pattern; False when there are none."""
    names = files.list_files(spark, folder, f"{source.pattern}.[xX][lL][sS]*").select("path").collect()
    if names:
        ingest_workbooks(spark, [r["path"] for r in names], source)
    return bool(names)


def ingest_status(events: DataFrame) -> None:
    """Status events (see ``sources.database``) above the stored id; the source filters by it."""
    tables.append_table(
        events, MACHINE_STATUS.table, MACHINE_STATUS.incremental_column, MACHINE_STATUS.incremental_kind, MACHINE_STATUS.sort
    )


# -- silver ----------------------------------------------------------------


#: Partition columns of the silver tables; a merge reads the stored days of its own rows only.
PARTITIONS = {"slv_textile_days": "date", "slv_complete_beam": "date", "slv_start_beam": "snapshot_date"}


def insert_only(rows: DataFrame, name: str, keys: Sequence[str], null_safe: Sequence[str] = ()) -> None:
    """Add the rows whose key is not stored. First write wins.

    The stored side is filtered by the days of the load, which Spark knows only when it runs: other partitions are not opened. Days of a load are bounded by
    the calendar.
    """
    spark = rows.sparkSession
    day = PARTITIONS[name]
    if spark.catalog.tableExists(name):
        rows = tables.store_stage(rows, name)
        rows = inc.new_keys(rows, inc.stored_days(spark.table(name), rows, day), keys, null_safe)
    tables.append_rows(rows, name, day)


def load_silver(spark: SparkSession, start_beam_mode: str = "baseline") -> None:
    """Merge every raw table that exists into its silver table. First write wins."""
    exists = spark.catalog.tableExists
    if exists("raw_machine_status"):
        raw = spark.table("raw_machine_status")
        if exists("slv_machine_status"):
            raw = inc.above_stored_id(raw, spark.table("slv_machine_status"))
        tables.append_rows(silver.machine_status(raw), "slv_machine_status")
    if exists("raw_textile_days"):
        insert_only(silver.textile_days(spark.table("raw_textile_days")), "slv_textile_days", inc.TEXTILE_KEY)
    if exists("raw_complete_beam"):
        rows = silver.complete_beam(spark.table("raw_complete_beam"))
        insert_only(rows, "slv_complete_beam", inc.COMPLETE_BEAM_KEY, inc.COMPLETE_BEAM_NULL_SAFE)
    if exists("raw_start_beam"):
        load_start_beam(spark, start_beam_mode)


def load_start_beam(spark: SparkSession, mode: str) -> None:
    rows = silver.start_beam(spark.table("raw_start_beam"), incremental=mode == "incremental")
    insert_only(rows.withColumn("snapshot_date", F.col("source_updated_at").cast("date")), "slv_start_beam", inc.START_BEAM_KEY)


def prepare_start_beam(spark: SparkSession, day: dt.date, name: str = "slv_start_beam") -> str:
    """Undo snapshots of ``day`` and later, so the day can be loaded again.

    Returns 'incremental' when older snapshots remain. Without any the table is
    dropped and the day becomes the full baseline. Of a table by snapshot only
    whole partitions are dropped, and none is read.
    """
    tables.recover(spark, name)
    if not spark.catalog.tableExists(name):
        return "baseline"
    if tables.partition_columns(spark, name) == ["snapshot_date"]:
        found = [r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
        mode = "incremental" if any(d < day.isoformat() for d in found) else "baseline"
        for late in sorted((d for d in found if d >= day.isoformat()), reverse=True) if mode == "incremental" else ():
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (snapshot_date = date'{late}')")
    else:
        stored = spark.table(name)
        mode = inc.replay_mode(stored, day).collect()[0]["mode"]
        if mode == "incremental":
            tables.swap_in(inc.rows_before(stored, day), name)
    if mode == "baseline":
        spark.sql(f"DROP TABLE {name}")
    return mode


# -- gold ------------------------------------------------------------------


def build_gold(spark: SparkSession) -> None:
    """Rebuild all gold tables from silver."""
    tables.swap_in(gold.machine_status_daily_fact(spark.table("slv_machine_status")), "gld_machine_status_daily_fact")
    tables.swap_in(gold.beam_plan_dim(spark.table("slv_start_beam")), "gld_beam_plan_dim")
    status, plans = spark.table("gld_machine_status_daily_fact"), spark.table("gld_beam_plan_dim")
    tables.swap_in(gold.production_daily_fact(spark.table("slv_textile_days"), status, plans), "gld_production_daily_fact")
    production = spark.table("gld_production_daily_fact")
    tables.swap_in(gold.machine_dim(status, production, plans), "gld_machine_dim")
    tables.swap_in(gold.date_dim(production, status, plans), "gld_date_dim")


def check(spark: SparkSession, layer: str) -> None:
    """Run the layer's checks on its stored tables; any violation stops the run."""
    names = [t for t in quality.NOT_NULL if quality.layer_of(t) == layer and spark.catalog.tableExists(t)]
    broken = quality.failed(quality.summary({t: spark.table(t) for t in names}, layer))
    if broken:
        raise ChecksFailed("; ".join(broken))


# -- runs ------------------------------------------------------------------


def run_day(spark: SparkSession, folder: str, run_date: dt.date, events: DataFrame) -> dict[str, object]:
    """One daily run over a raw folder and the status events of the database."""
    manifest = files.check_raw_inputs(files.list_files(spark, folder, "*"), spark, run_date)
    for source in (COMPLETE_BEAM, TEXTILE_DAYS):
        ingest_folder(spark, folder, source)
    ingest_status(events)
    ingest_workbooks(spark, [manifest["start_beam_path"]], START_BEAM)
    mode = prepare_start_beam(spark, run_date)
    load_silver(spark, mode)
    check(spark, "silver")
    build_gold(spark)
    check(spark, "gold")
    return {**manifest, "start_beam_mode": mode}


def backfill_snapshots(spark: SparkSession, folder: str, days: Sequence[dt.date]) -> dict[dt.date, str]:
    """Load start-beam snapshots oldest first, then rebuild gold. Returns each day's mode."""
    found = files.list_files(spark, folder, "*_start_beam.*")
    modes = {}
    for day in sorted(days):
        ingest_workbooks(spark, [files.find_snapshot(found, day)], START_BEAM)
        modes[day] = prepare_start_beam(spark, day)
        load_start_beam(spark, modes[day])
        check(spark, "silver")
    build_gold(spark)
    return modes

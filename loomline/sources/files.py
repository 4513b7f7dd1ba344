"""Raw file discovery over a manifest (filename, path)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WORKBOOK = r"(?i)\.(xlsx|xls)\z"
_SNAPSHOT = r"^(\d{4}-\d{2}-\d{2})_start_beam\.(?i:xlsx|xls)\z"


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Workbooks of a folder (not below it) that match a glob; editor lock files are left out.

    Only names are read: the content column is never touched.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    return workbooks(found.withColumn("filename", F.element_at(F.split("path", "/"), -1)))


def workbooks(files: DataFrame) -> DataFrame:
    return files.where(F.col("filename").rlike(_WORKBOOK) & ~F.col("filename").startswith("~$"))


def table_names(spark: SparkSession, folder: str) -> list[str]:
    """Tables of a folder: files or folders named ``<table>.parquet``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder).select("path")
    last = folder.rstrip("/").rsplit("/", 1)[-1]
    own = F.regexp_extract("path", rf".*?/\Q{last}\E/([^/]+)\.parquet", 1)
    return sorted(r["name"] for r in found.select(own.alias("name")).distinct().where("name <> ''").collect())


def plain_suffix(filename: Column) -> Column:
    """The name with a workbook suffix in small letters: writers of ``.XLSX`` mean the same file."""
    at = F.length(filename) - 4
    return F.when(F.lower(filename).endswith(".xlsx"), F.concat(F.substring(filename, F.lit(1), at), F.lit("xlsx"))).otherwise(filename)


def refuse_binary(paths: Iterable[str]) -> None:
    """Only the zipped workbook format is read; a file in the old one stops the load by name."""
    old = sorted(p for p in paths if p.lower().endswith(".xls"))
    if old:
        raise ValueError(f"Cannot read binary workbooks, save them as .xlsx: {', '.join(old)}")


def snapshots(files: DataFrame) -> DataFrame:
    """Dated start-beam snapshots: snapshot_date, filename, path."""
    date = F.nullif(F.regexp_extract("filename", _SNAPSHOT, 1), F.lit("")).try_cast("date")
    return workbooks(files).withColumn("snapshot_date", date).where("snapshot_date is not null")


def snapshot_lookup(files: DataFrame, dates: DataFrame) -> DataFrame:
    """For each asked date how many snapshots exist, and the path when it is exactly one."""
    found = snapshots(files).groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("file_count"), F.min("path").alias("path")
    )
    count = F.coalesce("file_count", F.lit(0))
    outcome = F.when(count == 0, "missing").when(count == 1, "found").otherwise("several")
    return dates.join(found, "snapshot_date", "left").select(
        "snapshot_date",
        count.alias("file_count"),
        outcome.alias("outcome"),
        F.when(count == 1, F.col("path")).alias("path"),
    )


def find_snapshot(files: DataFrame, day: dt.date) -> str:
    """Path of the one snapshot of a day."""
    paths = [r["path"] for r in snapshots(files).where(F.col("snapshot_date") == F.lit(day)).select("path").take(2)]
    if not paths:
        raise FileNotFoundError(f"Snapshot not found: {day}_start_beam.xlsx")
    if len(paths) > 1:
        raise ValueError(f"More than one start-beam snapshot found for {day}: {', '.join(sorted(paths))}")
    return paths[0]


def required_inputs(run_dates: DataFrame) -> DataFrame:
    """Names a run needs: the textile workbook and the run date's snapshot."""
    snapshot = F.concat(F.col("run_date").cast("string"), F.lit("_start_beam.xlsx"))
    return run_dates.select("run_date", F.explode(F.array(F.lit("textile_days.xlsx"), snapshot)).alias("filename"))


def missing_inputs(files: DataFrame, run_dates: DataFrame) -> DataFrame:
    """Required (run_date, filename) pairs that are not in the manifest."""
    present = files.select(plain_suffix(F.col("filename")).alias("filename"))
    return required_inputs(run_dates).join(present, "filename", "left_anti").select("run_date", "filename")


def check_raw_inputs(files: DataFrame, spark: SparkSession, run_date: dt.date) -> dict[str, object]:
    """Manifest of one run; a missing required file is an error, finished beams are optional."""
    wanted = spark.range(1).select(F.lit(run_date).alias("run_date"))
    missing = missing_inputs(files, wanted).orderBy("filename").take(1)
    if missing:
        raise FileNotFoundError(f"Required raw file not found: {missing[0]['filename']}")
    beams = workbooks(files).where(F.contains("filename", F.lit("complete_beam"))).take(1)
    return {
        "date": run_date.isoformat(),
        "start_beam_path": find_snapshot(files.where(F.lower("filename").endswith(".xlsx")), run_date),
        "textile_days": True,
        "complete_beam": bool(beams),
    }

"""Reading and writing tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import match_columns
from ..operators.incremental import all_string, column_named, highwater_mark, incremental_rows, source_sort, typed_key, union_frames, with_stored_names
from ..session import ensure_checkpoint_dir
from .files import table_names


def store_stage(df: DataFrame, label: str, *partitions: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back.

    What reads it starts from files: lost executors cost no recomputation, and
    filters and column selections reach the scan. With ``partitions`` a filter on
    these columns leaves out whole folders. Nothing asks for the shuffles that
    led to it any more: they leave the executors' disks when it is written.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stage/{label}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.partitionBy(*partitions).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files behind; otherwise they stay until the driver happens to collect its garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def replace_table(frames: Sequence[DataFrame], name: str) -> None:
    """Replace a raw table by the union of frames, all text; the old one stays until the new is written."""
    swap_in(union_frames(frames), name)


def above_mark(source: DataFrame, stored: DataFrame, column: str, kind: str) -> DataFrame:
    """Source rows above the largest stored key.

    A source column of whole numbers is compared as it is with the known mark, a filter that JDBC and Parquet sources take over; text is parsed row by row.
    """
    column_named(source, column)  # an error if it is missing
    name = next(c for c in source.columns if c.lower() == column.lower())
    if not isinstance(source.schema[name].dataType, T.IntegralType):
        return incremental_rows(source, stored, column, kind)
    mark = highwater_mark(stored, column, kind).first()["latest"]
    return source if mark is None else source.where(F.col(f"`{name}`") > F.lit(mark))


# -- the mark of an append-only table --------------------------------------

MARK, MARK_OF, MARK_STATE, PREVIOUS = "loomline.mark", "loomline.mark.of", "loomline.mark.state", "loomline.previous"


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def set_properties(spark: SparkSession, name: str, **values: str) -> None:
    pairs = ", ".join(f"'{key.replace('__', '.')}' = '{value}'" for key, value in values.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def known_mark(spark: SparkSession, name: str, column: str, kind: str) -> str | None:
    """The largest stored key as text, from the table's properties: no stored row is read.

    Where the property is missing, stands for another column, or a load was cut off after it began to write, the rows are read once and it is written anew.
    """
    found = properties(spark, name)
    if found.get(MARK_STATE) == "stored" and found.get(MARK_OF) == f"{column.lower()}:{kind}":
        return found.get(MARK) or None
    latest = highwater_mark(spark.table(name), column, kind).select(F.col("latest").cast("string")).first()[0]
    _keep_mark(spark, name, column, kind, latest)
    return latest


def _keep_mark(spark: SparkSession, name: str, column: str, kind: str, latest: str | None) -> None:
    set_properties(spark, name, loomline__mark=latest or "", loomline__mark__of=f"{column.lower()}:{kind}", loomline__mark__state="stored")


def above_known(source: DataFrame, mark: str | None, column: str, kind: str) -> DataFrame:
    """Source rows above a known mark; whole numbers are compared as they are, a filter that JDBC and Parquet sources take over."""
    name = column_named(source, column)
    if mark is None:
        return source
    if isinstance(source.schema[name].dataType, T.IntegralType):
        return source.where(F.col(f"`{name}`") > F.lit(int(mark)))
    return source.where(typed_key(f"`{name}`", kind) > F.lit(mark).cast("bigint" if kind == "bigint" else "timestamp_ntz"))


def append_table(source: DataFrame, name: str, column: str, kind: str, sort: Sequence[str] = ()) -> None:
    """Append source rows above the stored mark; the first load stores everything.

    New columns are added to the table as text, names matched without case. The mark is taken from the rows while they are written and kept as a property of
    the table, so rows must only be added by this function; a load that stops halfway leaves the table marked as loading, and the next one reads its rows.
    """
    spark = source.sparkSession
    rows = all_string(source)
    seen = Observation(f"mark_{name}")

    def marked(df: DataFrame) -> DataFrame:
        key = typed_key(f"`{column_named(df, column)}`", kind)
        return source_sort(df, sort or (column,)).observe(seen, F.max(key).cast("string").alias("latest"))

    if not spark.catalog.tableExists(name):
        marked(rows).write.saveAsTable(name)
        _keep_mark(spark, name, column, kind, seen.get["latest"])
        return
    mark = known_mark(spark, name, column, kind)
    stored = spark.table(name)
    widened, _ = match_columns(stored.columns, rows.columns)
    added = widened[len(stored.columns):]
    if added:
        spec = ", ".join(f"`{c}` STRING" for c in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({spec})")
        stored = spark.table(name)
    fresh = with_stored_names(all_string(above_known(source, mark, column, kind)), stored.columns)
    aligned = fresh.select(
        *[F.col(f"`{c}`") if c in fresh.columns else F.lit(None).cast("string").alias(c) for c in widened]
    )
    set_properties(spark, name, loomline__mark__state="loading")
    marked(aligned).write.insertInto(name)
    latest = seen.get["latest"]
    _keep_mark(spark, name, column, kind, mark if latest is None else latest)


def append_rows(rows: DataFrame, name: str, *partitions: str) -> None:
    """Append typed rows, creating the table, partitioned by ``partitions``, on the first load."""
    if rows.sparkSession.catalog.tableExists(name):
        rows.select(*rows.sparkSession.table(name).columns).write.insertInto(name)
    else:
        rows.write.partitionBy(*partitions).saveAsTable(name)


# -- replacing a table -------------------------------------------------------


def location(spark: SparkSession, name: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return found["data_type"]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def recover(spark: SparkSession, name: str) -> None:
    """Finish a swap that was cut off between dropping a table and renaming the one that was to take its place."""
    staged = f"{name}__staged"
    if spark.catalog.tableExists(staged) and not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")


def swap_in(rows: DataFrame, name: str) -> None:
    """Write a table's next version beside the current one and point the table at it.

    The switch is one statement, so a reader finds the old rows or the new ones and never no table; one that has planned its scan finishes it on the version it
    has, which is kept until the next switch. The rows may come from the table being replaced: nothing is read from a path that is being written. A table of
    other columns, or a partitioned one, takes the name instead (see ``_rename_in``).
    """
    spark = rows.sparkSession
    recover(spark, name)
    if not spark.catalog.tableExists(name):
        rows.write.saveAsTable(name)
        return
    stored = spark.table(name)

    def kinds(df: DataFrame) -> set[tuple[str, str]]:
        return {(f.name, f.dataType.simpleString()) for f in df.schema.fields}

    if kinds(rows) != kinds(stored) or partition_columns(spark, name):
        _rename_in(rows, name)
        return
    current, before = location(spark, name), properties(spark, name).get(PREVIOUS)
    base, _, version = current.rstrip("/").partition("__v")
    fresh = f"{base}__v{uuid.uuid4().hex}"
    rows.select(*stored.columns).write.parquet(fresh)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
    # The folder that carries the table's own name is in the way of a later table of that name.
    gone, kept = [p for p in (before, None if version else current) if p], current if version else ""
    set_properties(spark, name, loomline__previous=kept)
    for path in gone:
        _remove(spark, path)


def _rename_in(rows: DataFrame, name: str) -> None:
    """Write a table beside the current one, then take its name. A staged table is only ever dropped while the current one is there (see ``recover``)."""
    spark = rows.sparkSession
    staged = f"{name}__staged"
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    rows.write.partitionBy(*partition_columns(spark, name)).saveAsTable(staged)
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")


def register_folder(spark: SparkSession, folder: str, database: str) -> list[str]:
    """Make every Parquet table of a folder known to the session catalog; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = table_names(spark, folder)
    for name in names:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.`{name}` USING parquet LOCATION '{folder}/{name}.parquet'")
    return names


def catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """(table_name, position, column_name, data_type) of all tables of a database, as the session catalog has them. Only metadata is read."""
    rows = [
        (table.name, k, column.name, column.dataType)
        for table in spark.catalog.listTables(database)
        for k, column in enumerate(spark.catalog.listColumns(f"{database}.`{table.name}`"), start=1)
    ]
    return spark.createDataFrame(rows, "table_name string, position long, column_name string, data_type string")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of several tables."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    merged = counts[0]
    for part in counts[1:]:
        merged = merged.unionByName(part)
    return merged


def export_parquet(spark: SparkSession, names: Sequence[str], folder: str) -> list[tuple[str, int, str]]:
    """Write stored tables as Parquet; returns (table, rows, path), rows counted while writing."""
    exported = []
    for name in names:
        short = name.rsplit(".", 1)[-1]
        seen = Observation(f"export_{short}")
        path = f"{folder}/{short}.parquet"
        spark.table(name).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        exported.append((name, seen.get["rows"], path))
    return exported


def exported_counts(spark: SparkSession, exported: Sequence[tuple[str, int, str]]) -> DataFrame:
    """(table_name, row_count) of exported files as they are read back; a file that holds other than what was written to it is an error."""
    counts = row_counts({name.rsplit(".", 1)[-1]: spark.read.parquet(path) for name, _, path in exported})
    written = spark.createDataFrame([(name.rsplit(".", 1)[-1], rows) for name, rows, _ in exported], "table_name string, _written long")
    other = F.raise_error(F.concat(F.lit("rows written and read differ: "), "table_name")).cast("bigint")
    both = counts.join(written, "table_name")
    return both.select("table_name", F.when(F.col("row_count") == F.col("_written"), F.col("row_count")).otherwise(other).alias("row_count"))

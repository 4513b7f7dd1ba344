"""Helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import store_stage

#: White space of the word rule: space and the five ASCII controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
NO_ID = -(2**63)
#: Bytes of rows that go to a Python worker at once, where the session sets no limit of its own: texts may be of any length.
BATCH_BYTES = 8_000_000
_BATCH_SETTING, _NO_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", str(2**31 - 1)
#: Mean rows of a bucket in which rows are ordered.
BUCKET_ROWS = 256


def importable(spark: SparkSession) -> None:
    """Let Python workers that start from now on import this library where the driver found it.

    Where it is installed, or on the workers' path already, that changes nothing. Batches of rows for these workers are bounded by bytes from now on.
    """
    if spark.conf.get(_BATCH_SETTING, _NO_LIMIT) in (_NO_LIMIT, f"{_NO_LIMIT}b"):
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo; a null id has remainder 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(0))


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name, n = wanted, 1
    while name.lower() in taken:
        name, n = f"{wanted}_{n}", n + 1
    return name


def unclash(df: DataFrame, made: Iterable[str]) -> DataFrame:
    """Drop the columns that an operator is about to make: its own values win."""
    wanted = {c.lower() for c in made}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in wanted])


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def squash(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def running_start(df: DataFrame, group: str, size: str, order: tuple[str, ...]) -> DataFrame:
    """``df`` with ``_start``: the sum of ``size`` over the rows before it in its group.

    The order within a group is (bucket, order columns), buckets being hash buckets of a fixed mean size. A place is the sum of the buckets before and of
    the rows before in the bucket, so a group may hold any share of all rows. Buckets themselves are summed in two steps.
    """
    buckets = max(1, df.count() // BUCKET_ROWS)
    stretch = max(1, int(buckets**0.5))
    placed = df.withColumn("_bucket", F.pmod(F.xxhash64(group, *order), F.lit(buckets)))
    sums = placed.groupBy(group, "_bucket").agg(F.sum(size).alias("_sum")).withColumn("_stretch", F.floor(F.col("_bucket") / stretch))
    sums = store_stage(sums, "buckets")

    def before(frame: DataFrame, keys: tuple[str, ...], by: tuple[str, ...], column: str, name: str) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumn(name, F.coalesce(F.sum(column).over(window), F.lit(0)))

    wide = before(sums.groupBy(group, "_stretch").agg(F.sum("_sum").alias("_sum")), (group,), ("_stretch",), "_sum", "_base").drop("_sum")
    bases = before(sums, (group, "_stretch"), ("_bucket",), "_sum", "_before").join(wide, [group, "_stretch"]).select(
        group, "_bucket", (F.col("_base") + F.col("_before")).alias("_base")
    )
    inner = before(placed, (group, "_bucket"), order, size, "_before")
    return inner.join(bases, [group, "_bucket"]).withColumn("_start", F.col("_base") + F.col("_before")).drop("_base", "_before", "_bucket")


def to_pandas(df: DataFrame):
    """A bounded result on the driver, by way of Arrow whatever the session's settings are: rows as Python objects would take many times the memory."""
    return df.toArrow().to_pandas()

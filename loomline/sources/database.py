"""Status events from a relational database."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("id", "machine_id", "status", "timestamp")


def status_scan(table: DataFrame, first: dt.date, end: dt.date, min_id: int | None = None) -> DataFrame:
    """Four columns of [first, end), optionally above an id, stamped with the load time.

    Plain comparisons on columns, so that the source (JDBC or Parquet) filters.
    """
    at = F.col("timestamp")
    kept = (at >= F.lit(first).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz"))
    if min_id is not None:
        kept = kept & (F.col("id") > F.lit(min_id))
    return table.where(kept).select(*COLUMNS).withColumn("_ingested_at", F.current_timestamp())


def read_status(
    spark: SparkSession, url: str, table: str, bounds: tuple[int, int], partitions: int, **options: str
) -> DataFrame:
    """The status table over JDBC, read in id ranges by many tasks.

    ``bounds`` are the ids the ranges are cut from; rows outside still arrive.
    Times are read without a zone.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="id", lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                 numPartitions=str(partitions), preferTimestampNTZ="true", **options)
        .load()
        .select(*COLUMNS)
    )

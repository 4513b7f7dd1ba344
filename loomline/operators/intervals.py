"""Status events -> intervals -> hours per day.

Events of one machine may be a large share of all rows, so nothing here sorts a
whole machine in one task. Events are keyed by (machine, bucket), a bucket being
one hour, and ordered inside it. Per bucket one summary row remains; ordering
those per machine costs at most 24 rows a day however many events there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import (
    DAY_SECONDS,
    day_start_seconds,
    epoch_seconds,
    midnight,
    seconds_to_timestamp,
    shutdown_bounds,
    shutdown_overlap,
)

BUCKET_SECONDS = 3_600

# Statuses that get an hours column. Others only add shutdown hours.
STATUSES = ("running", "stopped", "changeover", "disconnected")


def _bucketed(events: DataFrame, bucket_seconds: int) -> DataFrame:
    if DAY_SECONDS % bucket_seconds:
        raise ValueError("bucket_seconds must divide a day")
    sec = epoch_seconds(F.col("timestamp"))
    return (
        events.where("machine is not null and status is not null and timestamp is not null")
        .select("id", "machine", "status", "timestamp", sec.alias("sec"))
        .withColumn("bucket", F.col("sec") - F.pmod(F.col("sec"), F.lit(bucket_seconds)))
    )


def status_intervals(events: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Each event runs to the machine's next event; the last one to its midnight.

    Columns: id, machine, status, status_started_at, status_ended_at. Events
    that share an instant with a later id leave no interval.
    """
    keyed = _bucketed(events, bucket_seconds)
    in_bucket = Window.partitionBy("machine", "bucket").orderBy("timestamp", "id")
    over_buckets = Window.partitionBy("machine").orderBy("bucket")
    following = (
        keyed.groupBy("machine", "bucket")
        .agg(F.min("timestamp").alias("first_at"))
        .withColumn("following_at", F.lead("first_at").over(over_buckets))
        .drop("first_at")
    )
    end_of_day = midnight(F.date_add(F.col("timestamp").cast("date"), 1))
    return (
        keyed.withColumn("next_at", F.lead("timestamp").over(in_bucket))
        .join(following, ["machine", "bucket"])
        .select(
            "id",
            "machine",
            "status",
            F.col("timestamp").alias("status_started_at"),
            F.coalesce("next_at", "following_at", end_of_day).alias("status_ended_at"),
        )
        .where("status_ended_at > status_started_at")
    )


def split_by_day(intervals: DataFrame) -> DataFrame:
    """Cut intervals at midnights: one row per (interval, date) with segment bounds."""
    first = F.col("status_started_at").cast("date")
    # An end at exactly midnight belongs to the day before.
    last = F.timestamp_add("MICROSECOND", F.lit(-1), F.col("status_ended_at")).cast("date")
    days = F.sequence(first, last, F.expr("interval 1 day"))
    day = F.col("date")
    return intervals.withColumn("date", F.explode(days)).select(
        "id",
        "date",
        "machine",
        "status",
        F.greatest("status_started_at", midnight(day)).alias("segment_started_at"),
        F.least("status_ended_at", midnight(F.date_add(day, 1))).alias("segment_ended_at"),
    )


def with_planned_shutdown(dates: DataFrame) -> DataFrame:
    """Add planned_shutdown_started_at / _ended_at to rows that have a date."""
    start, end = shutdown_bounds(F.col("date"))
    return dates.withColumns(
        {
            "planned_shutdown_started_at": seconds_to_timestamp(start),
            "planned_shutdown_ended_at": seconds_to_timestamp(end),
        }
    )


def status_hours(segments: DataFrame) -> DataFrame:
    """Hours per (date, machine, status), planned shutdown taken out and summed apart."""
    start = epoch_seconds(F.col("segment_started_at"))
    end = epoch_seconds(F.col("segment_ended_at"))
    planned = shutdown_overlap(start, end)
    return (
        segments.select("date", "machine", "status", (end - start).alias("secs"), planned.alias("planned"))
        .groupBy("date", "machine", "status")
        .agg(
            _hours(F.sum(F.col("secs") - F.col("planned"))).alias("status_duration_hours"),
            _hours(F.sum("planned")).alias("planned_shutdown_hours"),
        )
    )


def _hours(seconds: Column) -> Column:
    return seconds / F.lit(3600.0)


def machine_status_daily_fact(events: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Running, stopped, changeover, disconnected and planned-shutdown hours per (date, machine).

    Same result as ``status_intervals`` -> ``split_by_day`` -> ``status_hours``
    pivoted by status, in one pass over the events: the wide shuffle is by
    (machine, bucket); its aggregate needs no further exchange, and what follows
    works on bucket summaries. Only the last event of a bucket can cross into
    later days, so only that one is spread over dates.
    """
    keyed = _bucketed(events, bucket_seconds)
    in_bucket = Window.partitionBy("machine", "bucket").orderBy("timestamp", "id")
    sec, next_sec, status = F.col("sec"), F.col("next_sec"), F.col("status")
    bucket_day = F.date_from_unix_date(F.floor(F.col("bucket") / DAY_SECONDS).cast("int"))

    inner = keyed.withColumn("next_sec", F.lead("sec").over(in_bucket)).withColumn(
        "planned", F.when(next_sec.isNotNull(), shutdown_overlap(sec, next_sec)).otherwise(0)
    )
    net = F.coalesce(next_sec - sec, F.lit(0)) - F.col("planned")
    summary = inner.groupBy("machine", "bucket").agg(
        *[F.sum(F.when(status == s, net).otherwise(0)).alias(f"{s}_secs") for s in STATUSES],
        F.sum("planned").alias("planned_secs"),
        F.min("sec").alias("first_sec"),
        F.max("sec").alias("last_sec"),
        F.max(F.when(next_sec.isNull(), status)).alias("last_status"),
    )

    over_buckets = Window.partitionBy("machine").orderBy("bucket")
    end_of_day = day_start_seconds(bucket_day) + DAY_SECONDS
    carried = summary.select(
        "*",
        bucket_day.alias("first_day"),
        F.coalesce(F.lead("first_sec").over(over_buckets), end_of_day).alias("end_sec"),
    )
    last_day = F.date_from_unix_date(F.floor((F.col("end_sec") - 1) / DAY_SECONDS).cast("int"))
    spread = carried.select(
        "*", F.posexplode(F.sequence("first_day", last_day, F.expr("interval 1 day"))).alias("pos", "date")
    )
    start = F.greatest("last_sec", day_start_seconds(F.col("date")))
    end = F.least("end_sec", day_start_seconds(F.col("date")) + DAY_SECONDS)
    parts = spread.select(
        "*", (end - start).alias("tail"), shutdown_overlap(start, end).alias("tail_planned")
    )

    def first_day_only(name: str) -> Column:
        return F.when(F.col("pos") == 0, F.col(name)).otherwise(0)

    def total(s: str) -> Column:
        tail = F.when(F.col("last_status") == s, F.col("tail") - F.col("tail_planned")).otherwise(0)
        return _hours(F.sum(first_day_only(f"{s}_secs") + tail)).alias(f"{s}_hours")

    return parts.groupBy("date", "machine").agg(
        *[total(s) for s in STATUSES],
        _hours(F.sum(first_day_only("planned_secs") + F.col("tail_planned"))).alias("planned_shutdown_hours"),
    )


def pivot_status_hours(hours: DataFrame) -> DataFrame:
    """(date, machine, status) hours -> one row per (date, machine)."""
    status, amount = F.col("status"), F.col("status_duration_hours")
    return hours.groupBy("date", "machine").agg(
        *[F.sum(F.when(status == s, amount).otherwise(0.0)).alias(f"{s}_hours") for s in STATUSES],
        F.sum("planned_shutdown_hours").alias("planned_shutdown_hours"),
    )

"""Keep one row per key, and row numbers that do not sort a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


PLAN_KEY = ["machine", "lot", "beam_no", "beam_start_date"]
# What tells rows of one plan and snapshot apart, the most of the first first.
VERSION_VALUES = ("daily_output_mts", "planned_output", "length_m", "total_yarn", "expected_beam_end_at")


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row per key under ``order``.

    The rank-one filter lets Spark keep one row per key on the map side
    (WindowGroupLimit), so a key with very many rows is cut before the shuffle.
    The hash in front settles nearly all comparisons of the sorts by one number.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def keep_best(textile: DataFrame) -> DataFrame:
    """One row per (date, machine, lot): most production, then meter reading, then cut length."""
    best = ("production_qty_mts", "meter_reading_m", "cut_length_m")
    return first_per_key(textile, ["date", "machine", "lot"], [F.desc_nulls_last(c) for c in best])


def keep_one_per_snapshot(plans: DataFrame) -> DataFrame:
    """One row per plan and snapshot. Equal keys are told apart by the remaining columns."""
    keys = [*PLAN_KEY, "source_updated_at"]
    return first_per_key(plans, keys, [F.desc_nulls_last(c) for c in VERSION_VALUES])


def latest_version(plans: DataFrame) -> DataFrame:
    """Newest snapshot of each plan (machine, lot, beam_no, beam_start_date).

    Rows of one snapshot are ordered as in ``keep_one_per_snapshot``, so the typed
    rows of all snapshots give the same as the rows kept per snapshot. Columns
    that the plans come without are left out of the order.
    """
    order = ("source_updated_at", *VERSION_VALUES)
    return first_per_key(plans, PLAN_KEY, [F.desc_nulls_last(c) for c in order if c in plans.columns])


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, stretch: Column | None = None, width: int = 10_000
) -> DataFrame:
    """1-based number of each row within ``keys`` under a unique ``order``.

    Same as row_number over the keys, but a group is cut into stretches: rows are
    numbered inside a stretch and the counts of earlier stretches are added, so
    one huge sheet is spread over many tasks. By default a stretch is ``width``
    positions of a single integer order column; any expression that grows with
    the order will do.
    """
    if stretch is None:
        stretch = F.floor(F.col(order[0]) / width).cast("bigint")
    cut = df.withColumn("_stretch", stretch)
    before = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_stretch")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_stretch", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys, "_stretch").orderBy(*order)
    return (
        cut.withColumn("_nth", F.row_number().over(inside))
        .join(offsets, [*keys, "_stretch"])
        .withColumn(name, F.col("_offset") + F.col("_nth"))
        .drop("_stretch", "_nth", "_offset")
    )

"""Match production days to the beam plan in force."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def plan_days(plans: DataFrame) -> DataFrame:
    """The plan in force from each (machine, lot, beam_start_date).

    Of several beams that start on one day the last by beam number counts
    (no number sorts last); the others have an empty range. A plain aggregate,
    so a (machine, lot) keeps at most one row per calendar day.
    """
    beam = F.struct(F.col("beam_no").isNull().alias("unnumbered"), "beam_no", "beam_plan_key")
    return (
        plans.groupBy("machine", "lot", "beam_start_date")
        .agg(F.max(beam).alias("last"))
        .select("machine", "lot", "beam_start_date", "last.beam_no", "last.beam_plan_key")
    )


def plan_validity_ranges(plans: DataFrame) -> DataFrame:
    """Half-open range [beam_start_date, next_beam_start_date) of every plan.

    The last range of a (machine, lot) is open. Only day-level rows are ordered
    per (machine, lot); plans find their day by an equi join, which adaptive
    execution may split when one day holds very many plans.
    """
    by_start = Window.partitionBy("machine", "lot").orderBy("beam_start_date")
    days = plan_days(plans).select(
        "machine",
        "lot",
        "beam_start_date",
        F.col("beam_no").alias("_last_beam"),
        F.lead("beam_start_date").over(by_start).alias("_next_start"),
    )
    is_last = F.col("beam_no").eqNullSafe(F.col("_last_beam"))
    return plans.join(days, ["machine", "lot", "beam_start_date"]).select(
        "beam_plan_key",
        "machine",
        "lot",
        "beam_no",
        "beam_start_date",
        F.when(is_last, F.col("_next_start")).otherwise(F.col("beam_start_date")).alias("next_beam_start_date"),
    )


def asof_plan_join(production: DataFrame, plans: DataFrame, in_force: bool = False, *carried: str) -> DataFrame:
    """Add the beam_plan_key in force on each production date, and the ``carried`` columns of that plan, NULL before the first plan.

    Left outer. Production holds one row per (date, machine, lot) and plans one
    per day after ``plan_days``, so both sides of a (machine, lot) are bounded by
    the calendar. They are merged and the last plan is carried forward: one
    shuffle and one sort, no pairs of rows and ranges. ``in_force`` says that
    the plans are one per (machine, lot, beam_start_date) already.
    """
    columns = production.columns
    plan = F.struct("beam_plan_key", *carried)
    days = plans if in_force else plan_days(plans)
    starts = days.select("machine", "lot", F.col("beam_start_date").alias("date"), plan.alias("_plan"), F.lit(0).alias("_side"))
    rows = production.withColumn("_side", F.lit(1))
    in_order = (
        Window.partitionBy("machine", "lot")
        .orderBy("date", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = rows.unionByName(starts, allowMissingColumns=True)
    last = F.last("_plan", ignorenulls=True).over(in_order)
    return merged.withColumn("_plan", last).where("_side = 1").select(*columns, "_plan.*")


def keep_status_machines(production: DataFrame, status: DataFrame) -> DataFrame:
    """Production of machines that report status."""
    return production.join(status.select("machine").distinct(), "machine", "left_semi")


def with_start_beam_flag(production: DataFrame, plans: DataFrame) -> DataFrame:
    """is_start_beam: any plan of the machine starts on that date."""
    starts = (
        plans.select(F.col("beam_start_date").alias("date"), "machine")
        .distinct()
        .withColumn("_starts", F.lit(True))
    )
    return (
        production.join(starts, ["date", "machine"], "left")
        .withColumn("is_start_beam", F.col("_starts").isNotNull())
        .drop("_starts")
    )


def keep_and_flag(production: DataFrame, status: DataFrame, plans: DataFrame) -> DataFrame:
    """``keep_status_machines`` and ``with_start_beam_flag`` by one join on the machine.

    Status and plans are reduced to a row per machine with its start days, which are bounded by the calendar, so production is shuffled once for both, and
    adaptive execution may split a machine that holds very many rows.
    """
    told = status.select("machine", F.lit(None).cast("date").alias("_start"), F.lit(True).alias("_told"))
    starts = plans.select("machine", F.col("beam_start_date").alias("_start"), F.lit(False).alias("_told"))
    known = told.unionByName(starts).groupBy("machine").agg(F.bool_or("_told").alias("_told"), F.collect_set("_start").alias("_starts"))
    joined = production.join(known.where("_told"), "machine")
    return joined.withColumn("is_start_beam", F.array_contains("_starts", F.col("date"))).select(*production.columns, "is_start_beam")

"""Silver tables -> dimensions and daily facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.asof import asof_plan_join, keep_and_flag
from ..operators.intervals import machine_status_daily_fact
from ..operators.versions import PLAN_KEY, latest_version


@dataclass(frozen=True)
class Gold:
    """The gold tables, lazy or read back from storage."""

    status: DataFrame
    production: DataFrame
    plans: DataFrame


def _plan_key() -> Column:
    return F.concat_ws("|", "machine", "lot", F.col("beam_start_date").cast("string"), "beam_no").alias("beam_plan_key")


def beam_plan_keys(start_beam: DataFrame) -> DataFrame:
    """Key columns of ``beam_plan_dim``. All versions of a plan share them, so none has to be chosen."""
    return start_beam.select(*PLAN_KEY).distinct().select(_plan_key(), *PLAN_KEY)


def daily_plans(start_beam: DataFrame) -> DataFrame:
    """Key columns and planned daily output of ``beam_plan_dim``: the most of the latest snapshot."""
    rows = start_beam.select(*PLAN_KEY, "source_updated_at", "daily_output_mts")
    return latest_version(rows).select(_plan_key(), *PLAN_KEY, F.col("daily_output_mts").alias("planned_daily_output_mts"))


def plan_starts(start_beam: DataFrame) -> DataFrame:
    """Key columns, and planned daily output if there is one, of the plans of ``beam_plan_dim`` that can be in force: ``plan_days`` of its rows.

    The production fact matches these and no others, so it and what joins plans by its key read a row per (machine, lot, start day) instead of every plan.
    One aggregate over typed rows of all snapshots: the last beam of a day, then its latest snapshot, then the most.
    """
    daily = [c for c in ("daily_output_mts",) if c in start_beam.columns]
    last = F.struct(F.col("beam_no").isNull().alias("unnumbered"), "beam_no", "source_updated_at", *daily)
    key = ("machine", "lot", "beam_start_date")
    # The hash in front settles nearly all comparisons of the sort by one number.
    days = start_beam.groupBy(F.xxhash64(*key).alias("_hash"), *key).agg(F.max(last).alias("last"))
    rows = days.select("machine", "lot", "last.beam_no", "beam_start_date", *[F.col(f"last.{c}").alias(f"planned_{c}") for c in daily])
    return rows.select(_plan_key(), "*")


def beam_plan_dim(start_beam: DataFrame) -> DataFrame:
    """Latest version of each plan under the key machine|lot|date|beam."""
    return latest_version(start_beam).select(
        _plan_key(),
        "machine",
        "lot",
        "beam_no",
        "beam_start_date",
        "total_yarn",
        "length_m",
        "planned_output",
        "expected_beam_end_at",
        F.col("daily_output_mts").alias("planned_daily_output_mts"),
        "source_updated_at",
    )


def status_machines(events: DataFrame) -> DataFrame:
    """Machines of the status fact, straight from silver.

    Every machine with a usable event has at least one interval (the last event
    runs to midnight), so the hours need not be computed to know the machines.
    """
    return events.where("status is not null").select("machine")


PLANNED = "planned_daily_output_mts"


def production_daily_fact(textile: DataFrame, status: DataFrame, plans: DataFrame, in_force: bool = False) -> DataFrame:
    """Production per (date, machine, lot) with the start-beam flag and plan key.

    ``status`` is anything with one or more rows per status machine: the status
    fact, or ``status_machines`` of the silver events. Amounts that ``textile``
    comes without are left out. Of the plans only the key columns are read.

    ``in_force`` says that the plans are those of ``plan_starts``: they are not
    reduced to start days again, and their planned daily output, where they have
    it, comes with the key.
    """
    planned = [c for c in (PLANNED,) if in_force and c in plans.columns]
    matched = asof_plan_join(keep_and_flag(textile, status, plans), plans, in_force, *planned)
    amounts = [c for c in ("production_qty_mts", "meter_reading_m", "cut_length_m") if c in textile.columns]
    return matched.select("date", "machine", "lot", *amounts, "is_start_beam", "beam_plan_key", *planned)


def machine_dim(status: DataFrame, production: DataFrame, plans: DataFrame) -> DataFrame:
    """Machines that report status, and which other tables know them.

    One tagged union and one aggregate: repeats collapse on the map side, and no
    table is broadcast or joined.
    """

    def tagged(df: DataFrame, tag: str) -> DataFrame:
        tags = {t: F.lit(t == tag) for t in ("production", "status", "plan")}
        return df.select("machine").withColumns(tags)

    seen = tagged(production, "production").unionByName(tagged(status, "status")).unionByName(tagged(plans, "plan"))
    return (
        seen.where("machine is not null")
        .groupBy("machine")
        .agg(
            F.bool_or("production").alias("is_in_production_fact"),
            F.bool_or("status").alias("is_in_status_fact"),
            F.bool_or("plan").alias("is_in_beam_plan_dim"),
        )
        .where("is_in_status_fact")
    )


def date_dim(production: DataFrame, status: DataFrame, plans: DataFrame) -> DataFrame:
    """One row per day from the first to the last date of the three tables."""
    dates = (
        production.select("date")
        .unionByName(status.select("date"))
        .unionByName(plans.select(F.col("beam_start_date").alias("date")))
    )
    day = F.col("date")
    bounds = dates.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).where("lo is not null")
    calendar = bounds.select(F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("date"))
    iso_day = (F.weekday(day) + 1).cast("bigint")
    return calendar.select(
        "date",
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(day).cast("bigint").alias("year_number"),
        F.quarter(day).cast("bigint").alias("quarter_number"),
        F.month(day).cast("bigint").alias("month_number"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.weekofyear(day).cast("bigint").alias("week_of_year"),
        iso_day.alias("iso_day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (iso_day >= 6).alias("is_weekend"),
    )


def build(events: DataFrame, textile: DataFrame, start_beam: DataFrame) -> Gold:
    """All facts from silver, lazily."""
    plans = beam_plan_dim(start_beam)
    return Gold(
        status=machine_status_daily_fact(events),
        production=production_daily_fact(textile, status_machines(events), plans),
        plans=plans,
    )


def with_plan_columns(production: DataFrame, plans: DataFrame, *columns: str) -> DataFrame:
    """Add columns of each row's plan, NULL for rows without one.

    Rows without a plan would all hash to one partition; each gets a key of its
    own that no plan has, so they stay spread out.
    """
    no_plan = F.concat_ws("|", F.lit("\x00"), "machine", "lot", F.col("date").cast("string"))
    keyed = production.withColumn("_plan", F.coalesce("beam_plan_key", no_plan))
    wanted = plans.select(F.col("beam_plan_key").alias("_plan"), *columns)
    return keyed.join(wanted, "_plan", "left").drop("_plan")


def star_join(gold: Gold, dates: DataFrame, machines: DataFrame) -> DataFrame:
    """Production with its calendar, machine and plan attributes."""
    calendar = dates.select("date", "year_month", "iso_day_of_week", "is_weekend")
    flags = machines.select("machine", "is_in_beam_plan_dim")
    planned = with_plan_columns(gold.production.drop(PLANNED), gold.plans, PLANNED, "beam_start_date")
    return planned.join(calendar, "date").join(flags, "machine")

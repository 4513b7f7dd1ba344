"""What each visual of the overview page asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import measures as ms
from .gold import Gold
from .measures import EVERYTHING, Selection, Summary


def overview_cards(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """All cards in one row."""
    counts = ms.machine_counts_at_reporting_date(gold, sel)
    # Two one-row results side by side: tag both and merge.
    row = ms.factory_health(ms.at_reporting_date(gold, sel))
    merged = row.unionByName(counts, allowMissingColumns=True)
    one = merged.agg(*[F.max(c).alias(c) for c in merged.columns])
    return one.select(
        "reporting_date",
        ms.date_label().alias("reporting_date_label"),
        "factory_health",
        "factory_health_status",
        ms.health_insight(F.col("critical_machines_at_rd")).alias("factory_health_insight"),
        "production_at_rd",
        "production_change",
        "availability_at_rd",
        "availability_change",
        "plan_attainment_at_rd",
        "plan_change",
        ms.coverage_label(F.col("plan_coverage_at_rd")).alias("plan_coverage_label"),
        "critical_machines_at_rd",
        "telemetry_conflicts_at_rd",
        "missing_status_at_rd",
        "plan_coverage_at_rd",
        ms.change_color(F.col("production_change")).alias("production_color"),
        ms.change_color(F.col("availability_change")).alias("availability_color"),
        ms.change_color(F.col("plan_change")).alias("plan_color"),
    )


def production_pulse(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """Date x (production, seven-day average) up to the reporting date, ascending."""
    day = F.col("date")
    spread = ms._trailing_week(ms.daily(gold, sel)).where("axis <= reporting_date")
    series = spread.groupBy("axis").agg(
        F.max(F.when(F.col("axis") == day, F.col("production_mts"))).alias("production_mts"),
        F.avg("production_mts").alias("production_7d_average"),
    )
    return ms._range_on("axis", sel, series).where("production_7d_average is not null").orderBy("date")


def availability_pulse(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """Date x (availability, seven-day average), ascending."""
    on_day = F.col("axis") == F.col("date")
    spread = ms._trailing_week(ms.daily(gold, sel)).where("axis <= last_status_date")
    sums = spread.groupBy("axis").agg(
        *[F.sum(c).alias(c) for c in ms._STATUS_SUMS],
        *[F.sum(F.when(on_day, F.col(c))).alias(f"day_{c}") for c in ms._STATUS_SUMS],
    )
    day_total = sum((F.col(f"day_{c}") for c in ms._STATUS_SUMS[1:]), F.col("day_running_hours"))
    series = sums.select(
        "axis",
        F.try_divide(F.col("day_running_hours"), day_total).alias("availability"),
        ms.availability().alias("availability_7d_average"),
    )
    return ms._range_on("axis", sel, series).where("availability_7d_average is not null").orderBy("date")


def loss_hotspots(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """Machine x lost hours on the reporting date, most first."""
    kept = (F.col("date") == ms.reporting_date(gold, sel).scalar()) & sel.on_machine()
    lost = ms.status_sums(gold, "machine", kept=kept).select("machine", ms.lost_hours().alias("lost_hours"))
    return lost.orderBy(F.desc("lost_hours"), "machine")


def plan_risk(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """Machine x plan gap on the reporting date, largest first."""
    kept = (F.col("date") == ms.reporting_date(gold, sel).scalar()) & sel.on_machine()
    gaps = ms.production_sums(gold, "machine", kept=kept).select("machine", ms.plan_gap().alias("plan_gap_mts"))
    return gaps.where("plan_gap_mts is not null").orderBy(F.desc("plan_gap_mts"), "machine")

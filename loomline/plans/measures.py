"""Measures over the gold tables under a date and machine selection.

Blank is NULL. Sums of nothing, ratios over nothing or zero, and counts of no
rows are blank. Facts are first reduced to one row per date and machine (see
``Summary``), so what is ordered or compared afterwards is bounded by the
calendar and the mill, not by the data. Every measure takes the facts or a
summary that is stored already.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import store_stage
from .gold import PLANNED, Gold, with_plan_columns

# Thresholds, weights, labels and colours shown on the report.
CRITICAL_BELOW = 0.75
AVAILABILITY_WEIGHT, PLAN_WEIGHT = 0.6, 0.4
HEALTH_BANDS = ((0.95, "STRONG"), (0.85, "STABLE"), (0.75, "WATCH"))
HEALTH_LOWEST, HEALTH_BLANK = "CRITICAL", "DATA GAP"
GREY, GREEN, RED = "#667085", "#2FA66A", "#E63946"
NO_COMMON_DATA = "NO COMMON DATA IN SELECTED RANGE"
NO_COVERAGE = "NO MATCHED PLAN COVERAGE"
NO_OVERLAP = "Insufficient overlapping production, status, and matched plan data."


@dataclass(frozen=True)
class Selection:
    """Slicer state: an inclusive date range and a list of machines, each optional."""

    date_from: dt.date | None = None
    date_to: dt.date | None = None
    machines: Sequence[str] | None = None

    def in_range(self) -> Column:
        """Half-open on the day after date_to, so a time of day would still match."""
        kept = F.lit(True)
        if self.date_from is not None:
            kept = kept & (F.col("date") >= F.lit(self.date_from))
        if self.date_to is not None:
            kept = kept & (F.col("date") < F.lit(self.date_to + dt.timedelta(days=1)))
        return kept

    def on_machine(self) -> Column:
        if self.machines is None:
            return F.col("machine").isNotNull()
        return F.col("machine").isin(list(self.machines))


EVERYTHING = Selection()


# -- base sums -------------------------------------------------------------


def has_plan() -> Column:
    return F.col("beam_plan_key").isNotNull() & (F.col("beam_plan_key") != "")


_PRODUCTION_SUMS = {
    "production_mts": lambda: F.col("production_qty_mts"),
    "with_plan_mts": lambda: F.when(has_plan(), F.col("production_qty_mts")),
    "planned_mts": lambda: F.col("planned_daily_output_mts"),
}
_STATUS_SUMS = ("running_hours", "stopped_hours", "changeover_hours", "disconnected_hours")
_FLAGS = ("any_production", "any_plan", "any_status")


@dataclass(frozen=True)
class Summary:
    """Both facts reduced to (date, machine) and to dates, in one table partitioned by date.

    ``by_machine`` rows hold the base sums, ``by_date`` rows what any machine has on a date. Reports of one date read its partition only.
    """

    rows: DataFrame

    @property
    def by_machine(self) -> DataFrame:
        return self.rows.where("level = 'machine'").drop("level")

    @property
    def by_date(self) -> DataFrame:
        return self.rows.where("level = 'date'").select("date", *_FLAGS)


def _production_rows(gold: Gold) -> DataFrame:
    # A fact that was matched with the planned output of its plans has it already.
    rows = gold.production if PLANNED in gold.production.columns else with_plan_columns(gold.production, gold.plans, PLANNED)
    sums = [value().alias(name) for name, value in _PRODUCTION_SUMS.items()]
    return rows.select("date", "machine", *sums, F.lit(True).alias("any_production"), has_plan().alias("any_plan"))


def _status_rows(gold: Gold) -> DataFrame:
    return gold.status.select("date", "machine", *_STATUS_SUMS, F.lit(True).alias("any_status"))


def summary(gold: Gold) -> Summary:
    """Each fact is read once: one tagged union, one aggregate over two grouping sets.

    Planned output counts once per production row: two lots on a day count twice.
    """
    both = _production_rows(gold).unionByName(_status_rows(gold), allowMissingColumns=True)
    sums = [F.sum(name).alias(name) for name in (*_PRODUCTION_SUMS, *_STATUS_SUMS)]
    flags = [F.coalesce(F.bool_or(name), F.lit(False)).alias(name) for name in _FLAGS]
    level = F.when(F.grouping("machine") == 1, "date").otherwise("machine").alias("level")
    return Summary(both.groupingSets([["date", "machine"], ["date"]], "date", "machine").agg(*sums, *flags, level))


def stored_summary(gold: Gold) -> Summary:
    """The summary written once, a folder per date, for reports that ask it many things. A date has at most a row per machine and one more."""
    return Summary(store_stage(summary(gold).rows.repartition("date"), "summary", "date"))


def production_sums(facts: Gold | Summary, *keys: str, kept: Column | None = None) -> DataFrame:
    """Produced, produced-with-plan and planned metres per ``keys`` of date and machine."""
    return _sums(facts, "any_production", _PRODUCTION_SUMS, keys, kept)


def status_sums(facts: Gold | Summary, *keys: str, kept: Column | None = None) -> DataFrame:
    return _sums(facts, "any_status", _STATUS_SUMS, keys, kept)


def _sums(facts: Gold | Summary, flag: str, names: Iterable[str], keys: Sequence[str], kept: Column | None) -> DataFrame:
    if isinstance(facts, Summary):
        rows = facts.by_machine.where(flag)
    else:  # the one fact that is asked for
        rows = _production_rows(facts) if flag == "any_production" else _status_rows(facts)
    if kept is not None:
        rows = rows.where(kept)
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names])


def as_summary(facts: Gold | Summary) -> Summary:
    return facts if isinstance(facts, Summary) else summary(facts)


def lost_hours() -> Column:
    return F.col("stopped_hours") + F.col("changeover_hours") + F.col("disconnected_hours")


def total_hours() -> Column:
    return F.col("running_hours") + lost_hours()


def availability() -> Column:
    return F.try_divide("running_hours", total_hours())


def plan_attainment() -> Column:
    return F.try_divide("with_plan_mts", "planned_mts")


def plan_coverage() -> Column:
    return F.try_divide("with_plan_mts", "production_mts")


def blank_minus(a: Column, b: Column) -> Column:
    """a - b where one blank side counts as zero and two give blank."""
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0)))


def plan_gap() -> Column:
    return blank_minus(F.col("planned_mts"), F.col("with_plan_mts"))


def blank_if_none(count: Column) -> Column:
    return F.nullif(count, F.lit(0).cast("bigint"))


# -- totals under a selection ----------------------------------------------


def production_totals(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """One row: total production, production with plan, planned output, performance, gap, coverage."""
    return production_sums(gold, kept=sel.in_range() & sel.on_machine()).select(
        "production_mts",
        "with_plan_mts",
        "planned_mts",
        plan_attainment().alias("performance"),
        plan_gap().alias("plan_gap_mts"),
        plan_coverage().alias("plan_coverage"),
    )


def status_totals(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """One row: the four status hours, their total, lost hours and availability."""
    return status_sums(gold, kept=sel.in_range() & sel.on_machine()).select(
        *_STATUS_SUMS,
        total_hours().alias("total_status_hours"),
        lost_hours().alias("lost_hours"),
        availability().alias("availability"),
    )


def is_critical() -> Column:
    return (total_hours() > 0) & (availability() < CRITICAL_BELOW)


def critical_machines(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """One row: machines with status hours and availability below the threshold."""
    by_machine = status_sums(gold, "machine", kept=sel.in_range() & sel.on_machine())
    return by_machine.agg(blank_if_none(F.count_if(is_critical())).alias("critical_machines"))


# -- reporting date --------------------------------------------------------


def reporting_date(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """One row: the last date with both planned production and status, in the date range.

    The machine selection does not move it. Blank when either side has no date.
    """
    days = as_summary(gold).by_date.where(sel.in_range())
    last = days.agg(F.max(F.when(F.col("any_plan"), F.col("date"))).alias("produced"), F.max(F.when(F.col("any_status"), F.col("date"))).alias("reported"))
    return last.select(_common_date().alias("reporting_date"))


def _common_date() -> Column:
    both = F.col("produced").isNotNull() & F.col("reported").isNotNull()
    return F.when(both, F.least("produced", "reported"))


def reporting_label(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    return reporting_date(gold, sel).select("reporting_date", date_label().alias("reporting_date_label"))


def date_label() -> Column:
    text = F.concat(F.lit("REPORTING DATE  |  "), F.upper(F.date_format("reporting_date", "dd MMM yyyy")))
    return F.coalesce(text, F.lit(NO_COMMON_DATA))


# -- daily series and the reporting day ------------------------------------


def daily(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """One row per date: all base sums of the selected machines, plus the reporting date.

    Every date is kept, since seven-day frames look back before the range. One
    pass over the summary; the window at the end spans days, not facts.
    """
    mine = sel.on_machine()
    days = as_summary(gold).by_machine.groupBy("date").agg(
        *[F.sum(F.when(mine, F.col(name))).alias(name) for name in (*_PRODUCTION_SUMS, *_STATUS_SUMS)],
        F.bool_or("any_plan").alias("any_plan"),
        F.bool_or("any_status").alias("any_status"),
        F.bool_or(mine & F.col("any_status")).alias("my_status"),
    )
    all_days = Window.partitionBy()

    def last_in_range(flag: str) -> Column:
        return F.max(F.when(sel.in_range() & F.col(flag), F.col("date"))).over(all_days)

    return (
        days.withColumns({"produced": last_in_range("any_plan"), "reported": last_in_range("any_status"),
                          "last_status_date": last_in_range("my_status")})
        .withColumn("reporting_date", _common_date())
        .drop("produced", "reported", "any_plan", "any_status", "my_status")
    )


def at_reporting_date(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """One row: the measures on the reporting date, the week before it, and their change.

    The date range is replaced by the reporting date (or the seven days before
    it); the machine selection stays.
    """
    rd, day = F.col("reporting_date"), F.col("date")
    on_day, week_before = day == rd, day.between(F.date_sub(rd, 7), F.date_sub(rd, 1))
    sums = [*_PRODUCTION_SUMS, *_STATUS_SUMS]
    row = daily(gold, sel).agg(
        F.max(rd).alias("reporting_date"),
        *[F.sum(F.when(on_day, F.col(c))).alias(c) for c in sums],
        *[F.sum(F.when(week_before, F.col(c))).alias(f"week_{c}") for c in sums],
        F.avg(F.when(week_before, F.col("production_mts"))).alias("week_average"),
    )
    week_total = sum((F.col(f"week_{c}") for c in _STATUS_SUMS[1:]), F.col("week_running_hours"))
    measured = row.select(
        "reporting_date",
        F.col("production_mts").alias("production_at_rd"),
        plan_attainment().alias("plan_attainment_at_rd"),
        plan_gap().alias("plan_gap_at_rd"),
        plan_coverage().alias("plan_coverage_at_rd"),
        availability().alias("availability_at_rd"),
        lost_hours().alias("lost_hours_at_rd"),
        F.col("week_average").alias("production_previous_7d"),
        F.try_divide("week_with_plan_mts", "week_planned_mts").alias("plan_attainment_previous_7d"),
        F.try_divide(F.col("week_running_hours"), week_total).alias("availability_previous_7d"),
    )
    return measured.withColumns(
        {
            "production_change": F.try_divide(
                blank_minus(F.col("production_at_rd"), F.col("production_previous_7d")), F.col("production_previous_7d")
            ),
            "plan_change": blank_minus(F.col("plan_attainment_at_rd"), F.col("plan_attainment_previous_7d")),
            "availability_change": blank_minus(F.col("availability_at_rd"), F.col("availability_previous_7d")),
        }
    )


def change_color(change: Column) -> Column:
    return F.when(change > 0, GREEN).when(change < 0, RED).otherwise(GREY)


def coverage_label(coverage: Column) -> Column:
    text = F.concat(F.format_string("%.1f%%", F.round(coverage * 100, 1)), F.lit(" of output covered"))
    return F.when(coverage.isNull(), NO_COVERAGE).otherwise(text)


def factory_health(at_rd: DataFrame) -> DataFrame:
    """Add the health score and its band to a row of ``at_reporting_date``."""

    def share(name: str) -> Column:
        return F.least(F.greatest(F.col(name), F.lit(0.0)), F.lit(1.0))

    both = F.col("availability_at_rd").isNotNull() & F.col("plan_attainment_at_rd").isNotNull()
    score = share("availability_at_rd") * AVAILABILITY_WEIGHT + share("plan_attainment_at_rd") * PLAN_WEIGHT
    scored = at_rd.withColumn("factory_health", F.when(both, score))
    band = F.when(F.col("factory_health").isNull(), HEALTH_BLANK)
    for least, name in HEALTH_BANDS:
        band = band.when(F.col("factory_health") >= least, name)
    return scored.withColumn("factory_health_status", band.otherwise(HEALTH_LOWEST))


def health_insight(critical: Column) -> Column:
    """Sentence under the score; no critical machines is an empty number, as on the report."""
    counted = F.concat(F.coalesce(F.format_number(critical, 0), F.lit("")), F.lit(" machines below 75% availability."))
    return F.when(F.col("reporting_date").isNull(), NO_OVERLAP).otherwise(counted)


# -- machines on the reporting date ----------------------------------------


def machines_at_reporting_date(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """One row per selected machine with any fact on the reporting date: base sums of both facts. A stored summary is read for that date only."""
    facts = as_summary(gold)
    return facts.by_machine.where((F.col("date") == reporting_date(facts, sel).scalar()) & sel.on_machine()).drop("date", *_FLAGS)


def machine_counts_at_reporting_date(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """One row: critical, conflicting and silent machines on the reporting date."""
    produced, hours = F.col("production_mts") > 0, total_hours()
    conflict = produced & (hours > 0) & (F.col("running_hours") == 0)
    silent = produced & (hours.isNull() | (hours == 0))
    return machines_at_reporting_date(gold, sel).agg(
        blank_if_none(F.count_if(is_critical())).alias("critical_machines_at_rd"),
        blank_if_none(F.count_if(conflict)).alias("telemetry_conflicts_at_rd"),
        blank_if_none(F.count_if(silent)).alias("missing_status_at_rd"),
    )


# -- series ----------------------------------------------------------------


def _trailing_week(days: DataFrame) -> DataFrame:
    """Each day's row repeated under the seven dates whose trailing week holds it, as ``axis``."""
    return days.withColumn(
        "axis", F.explode(F.sequence(F.col("date"), F.date_add("date", 6), F.expr("interval 1 day")))
    )


def _range_on(name: str, sel: Selection, series: DataFrame) -> DataFrame:
    return series.withColumnRenamed(name, "date").where(sel.in_range())


def production_through_reporting_date(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """Production per date up to the reporting date."""
    return (
        daily(gold, sel)
        .where(sel.in_range() & (F.col("date") <= F.col("reporting_date")) & F.col("production_mts").isNotNull())
        .select("date", "production_mts")
    )


def production_7d_average(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """Per date up to the reporting date: mean daily production of the seven days ending there.

    Days without production are left out of the mean.
    """
    spread = _trailing_week(daily(gold, sel)).where("axis <= reporting_date")
    means = spread.groupBy("axis").agg(F.avg("production_mts").alias("production_7d_average"))
    return _range_on("axis", sel, means).where("production_7d_average is not null")


def availability_7d_average(gold: Gold | Summary, sel: Selection = EVERYTHING) -> DataFrame:
    """Per date up to the machines' last status date: running over total hours of seven days."""
    spread = _trailing_week(daily(gold, sel)).where("axis <= last_status_date")
    sums = spread.groupBy("axis").agg(*[F.sum(c).alias(c) for c in _STATUS_SUMS])
    ratio = sums.select("axis", availability().alias("availability_7d_average"))
    return _range_on("axis", sel, ratio).where("availability_7d_average is not null")

"""Measures and report queries over the whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import measures as ms
from ..plans import report
from ..plans.gold import Gold
from .book import query
from .inputs import Mill

# The day-level and machine-level tables below take a selection: a condition on
# dates (in_range) and one on machines (mine). They are formatted per query.
_BASE = """with lines as (
  select f.*, q.planned_daily_output_mts as planned from production_fact f left join plans q using (beam_plan_key)),
rd as (
  select case when p is not null and s is not null then least(p, s) end as rd
  from (select (select max(date) from lines where beam_plan_key <> '' and {in_range}) as p,
               (select max(date) from status_fact where {in_range}) as s)),
made as (
  select date, machine, sum(production_qty_mts) as production, sum(planned) as planned,
         sum(production_qty_mts) filter (where beam_plan_key <> '') as with_plan
  from lines where {mine} group by all),
told as (
  select date, machine, sum(running_hours) as running, sum(stopped_hours + changeover_hours + disconnected_hours) as lost,
         sum(running_hours + stopped_hours + changeover_hours + disconnected_hours) as total
  from status_fact where {mine} group by all),
at_made as (
  select sum(production) as production, sum(planned) as planned, sum(with_plan) as with_plan
  from made, rd where date = rd),
at_told as (select sum(running) as running, sum(lost) as lost, sum(total) as total from told, rd where date = rd),
week_made as (
  select avg(production) as average, sum(with_plan) as with_plan, sum(planned) as planned
  from (select date, sum(production) as production, sum(with_plan) as with_plan, sum(planned) as planned
        from made, rd where date between rd - 7 and rd - 1 group by date)),
week_told as (
  select sum(running) as running, sum(total) as total from told, rd where date between rd - 7 and rd - 1),
card as (
  select rd as reporting_date, m.production as production_at_rd, m.with_plan / nullif(m.planned, 0) as plan_attainment_at_rd,
         case when m.planned is not null or m.with_plan is not null
              then coalesce(m.planned, 0) - coalesce(m.with_plan, 0) end as plan_gap_at_rd,
         m.with_plan / nullif(m.production, 0) as plan_coverage_at_rd, t.running / nullif(t.total, 0) as availability_at_rd,
         t.lost as lost_hours_at_rd, wm.average as production_previous_7d,
         wm.with_plan / nullif(wm.planned, 0) as plan_attainment_previous_7d,
         wt.running / nullif(wt.total, 0) as availability_previous_7d,
         (m.production - wm.average) / nullif(wm.average, 0) as production_change,
         m.with_plan / nullif(m.planned, 0) - wm.with_plan / nullif(wm.planned, 0) as plan_change,
         t.running / nullif(t.total, 0) - wt.running / nullif(wt.total, 0) as availability_change
  from rd, at_made m, at_told t, week_made wm, week_told wt),
per_machine as (
  select machine, sum(p) as production, sum(r) as running, sum(t) as total
  from (select machine, production as p, null as r, null as t from made, rd where date = rd
        union all select machine, null, running, total from told, rd where date = rd) group by machine),
counts as (
  select nullif(count(*) filter (where total > 0 and running / nullif(total, 0) < 0.75), 0) as critical_machines_at_rd,
         nullif(count(*) filter (where production > 0 and total > 0 and running = 0), 0) as telemetry_conflicts_at_rd,
         nullif(count(*) filter (where production > 0 and coalesce(total, 0) = 0), 0) as missing_status_at_rd
  from per_machine)
"""


def base(sql: str, in_range: str = "true", mine: str = "true") -> str:
    return _BASE.format(in_range=in_range, mine=mine) + sql


def planned(m: Mill) -> Gold:
    """Lazy facts over stored plans."""
    return m.gold.measured


# -- totals ----------------------------------------------------------------


@query("m_total_production", "select sum(production_qty_mts) as production_mts from production_fact", doubles="production_mts")
def _(m: Mill) -> DataFrame:
    return ms.production_totals(planned(m)).select("production_mts")


@query("m_status_hours", """
       select sum(running_hours) as running_hours, sum(stopped_hours) as stopped_hours, sum(changeover_hours) as changeover_hours,
              sum(disconnected_hours) as disconnected_hours,
              sum(running_hours + stopped_hours + changeover_hours + disconnected_hours) as total_status_hours
       from status_fact""", doubles="running_hours stopped_hours changeover_hours disconnected_hours total_status_hours")
def _(m: Mill) -> DataFrame:
    return ms.status_totals(m.gold).drop("lost_hours", "availability")


@query("m_availability", """
       select sum(running_hours) / sum(running_hours + stopped_hours + changeover_hours + disconnected_hours) as availability
       from status_fact""", doubles="availability")
def _(m: Mill) -> DataFrame:
    return ms.status_totals(m.gold).select("availability")


@query("m_lost_hours", "select sum(stopped_hours + changeover_hours + disconnected_hours) as lost_hours from status_fact",
       doubles="lost_hours")
def _(m: Mill) -> DataFrame:
    return ms.status_totals(m.gold).select("lost_hours")


@query("m_production_with_plan", """
       select sum(production_qty_mts) as with_plan_mts from production_fact where beam_plan_key is not null""",
       doubles="with_plan_mts")
def _(m: Mill) -> DataFrame:
    return ms.production_totals(planned(m)).select("with_plan_mts")


@query("m_planned_output", """
       select sum(planned_daily_output_mts) as planned_mts from production_fact join plans using (beam_plan_key)""",
       doubles="planned_mts")
def _(m: Mill) -> DataFrame:
    return ms.production_totals(planned(m)).select("planned_mts")


@query("m_plan_performance", base("""
       select sum(with_plan) / sum(planned) as performance, sum(planned) - sum(with_plan) as plan_gap_mts,
              sum(with_plan) / sum(production) as plan_coverage from made"""),
       doubles="performance plan_gap_mts plan_coverage")
def _(m: Mill) -> DataFrame:
    return ms.production_totals(planned(m)).select("performance", "plan_gap_mts", "plan_coverage")


@query("m_critical_machines", base("""
       select nullif(count(*), 0) as critical_machines
       from (select machine from told group by machine having sum(total) > 0 and sum(running) / sum(total) < 0.75)"""))
def _(m: Mill) -> DataFrame:
    return ms.critical_machines(m.gold)


# -- reporting date --------------------------------------------------------


@query("m_reporting_date", base("select rd as reporting_date from rd"), dates="reporting_date")
def _(m: Mill) -> DataFrame:
    return ms.reporting_date(planned(m))


@query("m_reporting_label", base("""
       select rd as reporting_date, coalesce('REPORTING DATE  |  ' || upper(strftime(rd, '%d %b %Y')),
                                             'NO COMMON DATA IN SELECTED RANGE') as reporting_date_label from rd"""),
       dates="reporting_date")
def _(m: Mill) -> DataFrame:
    return ms.reporting_label(planned(m))


_AT = "production_at_rd plan_attainment_at_rd plan_gap_at_rd plan_coverage_at_rd availability_at_rd lost_hours_at_rd"


@query("m_at_reporting_date", base(f"""
       select reporting_date, {', '.join(_AT.split())}, critical_machines_at_rd from card, counts"""),
       dates="reporting_date", doubles=_AT)
def _(m: Mill) -> DataFrame:
    row = ms.at_reporting_date(m.summary).select("reporting_date", *_AT.split())
    counts = ms.machine_counts_at_reporting_date(m.summary).select("critical_machines_at_rd")
    merged = row.unionByName(counts, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


_WEEK = "production_previous_7d plan_attainment_previous_7d availability_previous_7d"


@query("m_previous_7d", base(f"select reporting_date, {', '.join(_WEEK.split())} from card"), dates="reporting_date", doubles=_WEEK)
def _(m: Mill) -> DataFrame:
    return ms.at_reporting_date(m.summary).select("reporting_date", *_WEEK.split())


_CHANGE = "production_change plan_change availability_change"


@query("m_change_vs_7d", base(f"select reporting_date, {', '.join(_CHANGE.split())} from card"), dates="reporting_date",
       doubles=_CHANGE)
def _(m: Mill) -> DataFrame:
    return ms.at_reporting_date(m.summary).select("reporting_date", *_CHANGE.split())


_HEALTH = """
  select reporting_date, h as factory_health,
         case when h is null then 'DATA GAP' when h >= 0.95 then 'STRONG' when h >= 0.85 then 'STABLE'
              when h >= 0.75 then 'WATCH' else 'CRITICAL' end as factory_health_status,
         case when reporting_date is null then 'Insufficient overlapping production, status, and matched plan data.'
              else coalesce(format('{:,}', critical_machines_at_rd), '') || ' machines below 75% availability.' end
           as factory_health_insight
  from (select reporting_date, critical_machines_at_rd,
               case when availability_at_rd is not null and plan_attainment_at_rd is not null
                    then 0.6 * least(greatest(availability_at_rd, 0), 1) + 0.4 * least(greatest(plan_attainment_at_rd, 0), 1) end as h
        from card, counts)"""


@query("m_factory_health", base(_HEALTH), dates="reporting_date", doubles="factory_health")
def _(m: Mill) -> DataFrame:
    return report.overview_cards(m.summary).select(
        "reporting_date", "factory_health", "factory_health_status", "factory_health_insight"
    )


@query("m_change_color", base("""
       select case when production_change > 0 then '#2FA66A' when production_change < 0 then '#E63946' else '#667085' end as production_color,
              case when availability_change > 0 then '#2FA66A' when availability_change < 0 then '#E63946' else '#667085' end as availability_color,
              case when plan_change > 0 then '#2FA66A' when plan_change < 0 then '#E63946' else '#667085' end as plan_color
       from card"""))
def _(m: Mill) -> DataFrame:
    row = ms.at_reporting_date(m.summary)
    return row.select(*[ms.change_color(F.col(f"{c}_change")).alias(f"{c}_color") for c in ("production", "availability", "plan")])


@query("m_coverage_label", base("""
       select coalesce(printf('%.1f%%', round(plan_coverage_at_rd * 100, 1)) || ' of output covered', 'NO MATCHED PLAN COVERAGE')
                as plan_coverage_label from card"""))
def _(m: Mill) -> DataFrame:
    return ms.at_reporting_date(m.summary).select(ms.coverage_label(F.col("plan_coverage_at_rd")).alias("plan_coverage_label"))


@query("m_telemetry_conflicts", base("select telemetry_conflicts_at_rd from counts"))
def _(m: Mill) -> DataFrame:
    return ms.machine_counts_at_reporting_date(m.summary).select("telemetry_conflicts_at_rd")


@query("m_missing_status", base("select missing_status_at_rd from counts"))
def _(m: Mill) -> DataFrame:
    return ms.machine_counts_at_reporting_date(m.summary).select("missing_status_at_rd")


# -- series ----------------------------------------------------------------


@query("m_production_through_rd", base("""
       select date, sum(production) as production_mts from made, rd where date <= rd group by date"""),
       dates="date", doubles="production_mts")
def _(m: Mill) -> DataFrame:
    return ms.production_through_reporting_date(m.summary)


def _pulse_sql(in_range: str = "true", mine: str = "true") -> str:
    return base(f"""
       select c.date, max(x.production) filter (where x.date = c.date) as production_mts, avg(x.production) as production_7d_average
       from date_dim c join (select date, sum(production) as production from made group by date) x
         on x.date between c.date - 6 and c.date
       where c.date <= (select rd from rd) and {in_range.replace('date', 'c.date', 1) if in_range != 'true' else 'true'}
       group by c.date""", in_range, mine)


def _availability_sql() -> str:
    return base("""
       select c.date, sum(x.running) filter (where x.date = c.date) / sum(x.total) filter (where x.date = c.date) as availability,
              sum(x.running) / sum(x.total) as availability_7d_average
       from date_dim c join (select date, sum(running) as running, sum(total) as total from told group by date) x
         on x.date between c.date - 6 and c.date
       where c.date <= (select max(date) from told)
       group by c.date having sum(x.total) > 0""")


@query("m_production_7d_avg", f"select date, production_7d_average from ({_pulse_sql()})", dates="date", doubles="production_7d_average")
def _(m: Mill) -> DataFrame:
    return ms.production_7d_average(m.summary)


@query("m_availability_7d_avg", f"select date, availability_7d_average from ({_availability_sql()})", dates="date",
       doubles="availability_7d_average")
def _(m: Mill) -> DataFrame:
    return ms.availability_7d_average(m.summary)


@query("production_pulse", _pulse_sql(), dates="date", doubles="production_mts production_7d_average")
def _(m: Mill) -> DataFrame:
    return report.production_pulse(m.summary)


@query("availability_pulse", _availability_sql(), dates="date", doubles="availability availability_7d_average")
def _(m: Mill) -> DataFrame:
    return report.availability_pulse(m.summary)


# -- visuals ---------------------------------------------------------------

_CARDS = f"""
  select c.reporting_date, coalesce('REPORTING DATE  |  ' || upper(strftime(c.reporting_date, '%d %b %Y')),
                                    'NO COMMON DATA IN SELECTED RANGE') as reporting_date_label,
         h.factory_health, h.factory_health_status, h.factory_health_insight, c.production_at_rd, c.production_change,
         c.availability_at_rd, c.availability_change, c.plan_attainment_at_rd, c.plan_change,
         coalesce(printf('%.1f%%', round(c.plan_coverage_at_rd * 100, 1)) || ' of output covered', 'NO MATCHED PLAN COVERAGE')
           as plan_coverage_label,
         n.critical_machines_at_rd, n.telemetry_conflicts_at_rd, n.missing_status_at_rd, c.plan_coverage_at_rd,
         case sign(c.production_change) when 1 then '#2FA66A' when -1 then '#E63946' else '#667085' end as production_color,
         case sign(c.availability_change) when 1 then '#2FA66A' when -1 then '#E63946' else '#667085' end as availability_color,
         case sign(c.plan_change) when 1 then '#2FA66A' when -1 then '#E63946' else '#667085' end as plan_color
  from card c, counts n, ({_HEALTH}) h"""
_CARD_KINDS = dict(dates="reporting_date", doubles="factory_health production_at_rd production_change availability_at_rd "
                   "availability_change plan_attainment_at_rd plan_change plan_coverage_at_rd")


@query("overview_cards", base(_CARDS), **_CARD_KINDS)
def _(m: Mill) -> DataFrame:
    return report.overview_cards(m.summary)


@query("filter_date_range", base(_CARDS, in_range="date >= date '2024-01-05' and date < date '2024-01-18'"), **_CARD_KINDS)
def _(m: Mill) -> DataFrame:
    """All cards under the date slicer: 5 to 17 January, both included."""
    return report.overview_cards(m.summary, ms.Selection(dt.date(2024, 1, 5), dt.date(2024, 1, 17)))


_TICKED = ("WEV002", "WEV004", "WEV010", "WEV016", "WEV048", "WEV1000", "not there")


@query("filter_machines", base(_CARDS, in_range="date >= date '2024-01-05' and date < date '2024-01-18'", mine=f"machine in {_TICKED}"), **_CARD_KINDS)
def _(m: Mill) -> DataFrame:
    """All cards under a list of machines and a date range."""
    return report.overview_cards(m.summary, ms.Selection(dt.date(2024, 1, 5), dt.date(2024, 1, 17), _TICKED))


@query("loss_hotspots", base("select machine, sum(lost) as lost_hours from told, rd where date = rd group by machine"),
       doubles="lost_hours")
def _(m: Mill) -> DataFrame:
    return report.loss_hotspots(m.summary)


@query("plan_risk", base("""
       select machine, coalesce(sum(planned), 0) - coalesce(sum(with_plan), 0) as plan_gap_mts
       from made, rd where date = rd group by machine having sum(planned) is not null or sum(with_plan) is not null"""),
       doubles="plan_gap_mts")
def _(m: Mill) -> DataFrame:
    return report.plan_risk(m.summary)

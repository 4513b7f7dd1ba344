"""Cleaning, silver tables, intervals, versions, joins, facts and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casting, cleaning
from ..operators import asof, intervals, versions
from ..plans import gold, silver
from .book import query
from .inputs import Mill

# -- scalar functions ------------------------------------------------------


@query("clean_text", "select id, nullif(trim(status), '') as status, nullif(trim(machine_id), '') as machine_id "
       "from raw_machine_status")
def _(m: Mill) -> DataFrame:
    return m.raw_machine_status.select(
        "id",
        cleaning.clean_text(F.col("status")).alias("status"),
        cleaning.clean_text(F.col("machine_id")).alias("machine_id"),
    )


@query("clean_code", "select upper(nullif(trim(lot_no), '')) as lot, count(*) as row_count from raw_start_beam group by 1")
def _(m: Mill) -> DataFrame:
    lot = cleaning.clean_code(F.col("lot_no")).alias("lot")
    return m.raw_start_beam.groupBy(lot).agg(F.count(F.lit(1)).alias("row_count"))


@query("clean_machine_no", """
       select machine_no as raw_machine_no, nullif(trim(regexp_replace(machine_no, '\\.0$', '')), '') as machine_no,
              count(*) as row_count
       from raw_start_beam group by all""")
def _(m: Mill) -> DataFrame:
    number = cleaning.clean_machine_no(F.col("machine_no")).alias("machine_no")
    return m.raw_start_beam.groupBy(F.col("machine_no").alias("raw_machine_no"), number).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query("standardize_machine", """
       select id, machine_id,
              'WEV' || lpad(regexp_extract(machine_id, '[0-9]+'), cast(greatest(3, length(regexp_extract(machine_id, '[0-9]+'))) as integer), '0') as machine
       from raw_machine_status""")
def _(m: Mill) -> DataFrame:
    return m.raw_machine_status.select(
        "id", "machine_id", cleaning.standardize_machine(F.col("machine_id")).alias("machine")
    )


@query("standardize_machine_decimal", """
       select machine_no, 'WEV' || lpad(split_part(machine_no, '.', 1), cast(greatest(3, length(split_part(machine_no, '.', 1))) as integer), '0') as machine, count(*) as row_count
       from raw_start_beam group by all""")
def _(m: Mill) -> DataFrame:
    machine = cleaning.standardize_machine(F.col("machine_no"), prefixed=False).alias("machine")
    return m.raw_start_beam.groupBy("machine_no", machine).agg(F.count(F.lit(1)).alias("row_count"))


@query("safe_casts", """
       select id as source_id, try_cast(id || case when user_id % 2 = 0 then '.5' else '' end as bigint) as as_bigint,
              try_cast(case when user_id % 5 = 0 then machine_id else cast(value as varchar) end as double) as as_double,
              try_cast(case when user_id % 4 = 0 then cast(user_id + 1900 as varchar)
                            when user_id % 4 = 1 then replace("timestamp", '-', '/') else "timestamp" end as timestamp) as as_timestamp
       from raw_machine_status join events on event_id = cast(id as bigint)""",
       stamps="as_timestamp", doubles="as_double")
def _(m: Mill) -> DataFrame:
    user, ts = F.col("user_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    slashed = F.date_format("ts", "yyyy/MM/dd HH:mm:ss.SSSSSS")
    name = (F.when(user % 3 == 0, F.concat(F.lit("wev"), user.cast("string")))
            .when(user % 3 == 1, user.cast("string")).otherwise(F.concat(F.lit("  "), user.cast("string"), F.lit(" "))))
    number = F.concat(F.col("event_id").cast("string"), F.when(user % 2 == 0, ".5").otherwise(""))
    mixed = F.when(user % 5 == 0, name).otherwise(F.col("value").cast("string"))
    when = F.when(user % 4 == 0, (user + 1900).cast("string")).when(user % 4 == 1, slashed).otherwise(ts)
    return m.table("events").select(
        F.col("event_id").cast("string").alias("source_id"),
        casting.to_bigint(number).alias("as_bigint"),
        casting.to_double(mixed).alias("as_double"),
        casting.to_timestamp(when).alias("as_timestamp"),
    )


@query("epoch_guard", """
       select beam_start_date as raw_value, nullif(cast(beam_start_date as timestamp), timestamp '1970-01-01') as beam_start_date,
              count(*) as row_count
       from raw_start_beam group by all""", stamps="beam_start_date")
def _(m: Mill) -> DataFrame:
    start = casting.drop_epoch(casting.to_timestamp(F.col("beam_start_date"))).alias("beam_start_date")
    return m.raw_start_beam.groupBy(F.col("beam_start_date").alias("raw_value"), start).agg(
        F.count(F.lit(1)).alias("row_count")
    )


# -- silver ----------------------------------------------------------------


@query("slv_machine_status", 'select id, machine, status, ts as "timestamp", cast(ts as date) as date from slv_machine_status',
       dates="date", stamps='"timestamp"')
def _(m: Mill) -> DataFrame:
    return m.slv_machine_status


@query("slv_complete_beam", "from slv_complete_beam", dates="date", doubles="production_qty_kgs production_qty_mts", digits=3)
def _(m: Mill) -> DataFrame:
    return m.slv_complete_beam


@query("slv_textile_days", "from slv_textile_days", dates="date",
       doubles="production_qty_mts meter_reading_m cut_length_m")
def _(m: Mill) -> DataFrame:
    return m.slv_textile_days


@query("dedup_keep_best", """
       from textile_typed
       qualify row_number() over (partition by date, machine, lot order by production_qty_mts desc nulls last,
                                  meter_reading_m desc nulls last, cut_length_m desc nulls last) = 1""",
       dates="date", doubles="production_qty_mts meter_reading_m cut_length_m")
def _(m: Mill) -> DataFrame:
    return versions.keep_best(silver.textile_days_typed(m.raw_textile_days))


_START = dict(dates="beam_start_date", stamps="expected_beam_end_at source_updated_at",
              doubles="total_yarn length_m planned_output daily_output_mts")


@query("slv_start_beam", "from slv_start_beam", **_START)
def _(m: Mill) -> DataFrame:
    return m.slv_start_beam


@query("slv_start_beam_incremental", "from slv_start_beam where beam_start_date = cast(source_updated_at as date)", **_START)
def _(m: Mill) -> DataFrame:
    return silver.start_beam(m.raw_start_beam, incremental=True)


@query("dedup_snapshot", """
       select machine, lot, beam_no, beam_start_date, source_updated_at, best.d as daily_output_mts,
              best.p as planned_output, best.l as length_m, best.y as total_yarn, best.e as expected_beam_end_at
       from (select machine, lot, beam_no, beam_start_date, source_updated_at,
                    max({'d': daily_output_mts, 'p': planned_output, 'l': length_m, 'y': total_yarn,
                         'e': expected_beam_end_at}) as best
             from start_typed group by all)""", **_START)
def _(m: Mill) -> DataFrame:
    return versions.keep_one_per_snapshot(silver.start_beam_typed(m.raw_start_beam))


# -- intervals -------------------------------------------------------------


@query("status_intervals", """
       select id, machine, status, started as status_started_at, ended as status_ended_at from intervals""",
       stamps="status_started_at status_ended_at")
def _(m: Mill) -> DataFrame:
    return intervals.status_intervals(m.slv_machine_status)


@query("status_day_segments", """
       select id, date, machine, status, seg_start as segment_started_at, seg_end as segment_ended_at from segments""",
       dates="date", stamps="segment_started_at segment_ended_at")
def _(m: Mill) -> DataFrame:
    return intervals.split_by_day(intervals.status_intervals(m.slv_machine_status))


@query("planned_shutdown_window", """
       select distinct date, off_start as planned_shutdown_started_at, off_end as planned_shutdown_ended_at from rest_days""",
       dates="date", stamps="planned_shutdown_started_at planned_shutdown_ended_at")
def _(m: Mill) -> DataFrame:
    segments = intervals.split_by_day(intervals.status_intervals(m.slv_machine_status))
    return intervals.with_planned_shutdown(segments.select("date").distinct())


_HOURS = "running_hours stopped_hours changeover_hours disconnected_hours planned_shutdown_hours"


@query("status_hours_by_status", "from status_hours", dates="date", doubles="status_duration_hours planned_shutdown_hours")
def _(m: Mill) -> DataFrame:
    return intervals.status_hours(intervals.split_by_day(intervals.status_intervals(m.slv_machine_status)))


@query("machine_status_daily_fact", "from status_fact", dates="date", doubles=_HOURS)
def _(m: Mill) -> DataFrame:
    return m.gold.status


# -- plans and production --------------------------------------------------


_PLAN = dict(dates="beam_start_date", stamps="expected_beam_end_at source_updated_at",
             doubles="total_yarn length_m planned_output planned_daily_output_mts")


@query("latest_version", """
       select machine, lot, beam_no, beam_start_date, total_yarn, length_m, planned_output, expected_beam_end_at,
              planned_daily_output_mts as daily_output_mts, source_updated_at from plans""", **_START)
def _(m: Mill) -> DataFrame:
    return versions.latest_version(m.slv_start_beam)


@query("beam_plan_dim", "from plans", **_PLAN)
def _(m: Mill) -> DataFrame:
    return m.gold.plans


@query("plan_validity_ranges", "from ranges", dates="beam_start_date next_beam_start_date")
def _(m: Mill) -> DataFrame:
    return asof.plan_validity_ranges(m.gold.plan_keys)


@query("asof_plan_join", """
       select t.date, t.machine, t.lot, t.production_qty_mts, r.beam_plan_key
       from slv_textile_days t left join ranges r
         on r.machine = t.machine and r.lot = t.lot and t.date >= r.beam_start_date
        and (r.next_beam_start_date is null or t.date < r.next_beam_start_date)""",
       dates="date", doubles="production_qty_mts")
def _(m: Mill) -> DataFrame:
    production = silver.textile_output(m.raw_textile_days)
    return asof.asof_plan_join(production, gold.beam_plan_keys(m.start_beam_keys))


@query("status_machine_semi_join", """
       select date, machine, lot, production_qty_mts from slv_textile_days
       where machine in (select machine from status_fact)""", dates="date", doubles="production_qty_mts")
def _(m: Mill) -> DataFrame:
    production = silver.textile_output(m.raw_textile_days)
    return asof.keep_status_machines(production, gold.status_machines(m.slv_machine_status))


@query("start_beam_flag", """
       select t.date, t.machine, t.lot, s.machine is not null as is_start_beam
       from slv_textile_days t
       left join (select distinct machine, beam_start_date from plans) s
         on s.machine = t.machine and s.beam_start_date = t.date""", dates="date")
def _(m: Mill) -> DataFrame:
    return asof.with_start_beam_flag(m.textile_keys.distinct(), m.start_beam_keys)


@query("production_daily_fact", "from production_fact", dates="date",
       doubles="production_qty_mts meter_reading_m cut_length_m")
def _(m: Mill) -> DataFrame:
    return m.gold.production


@query("machine_dim", "from machine_dim")
def _(m: Mill) -> DataFrame:
    return m.machine_dim


@query("date_dim", "from date_dim", dates="date")
def _(m: Mill) -> DataFrame:
    return m.date_dim


@query("star_join", """
       select year_month, iso_day_of_week, is_weekend, is_in_beam_plan_dim, count(*) as row_count,
              count(q.beam_start_date) as planned_rows, sum(f.production_qty_mts) as production_mts,
              sum(q.planned_daily_output_mts) as planned_mts
       from production_fact f join date_dim using (date) join machine_dim using (machine)
       left join plans q using (beam_plan_key)
       group by all""", doubles="production_mts planned_mts")
def _(m: Mill) -> DataFrame:
    facts = m.stored_gold
    dates = gold.date_dim(facts.production, facts.status, facts.plans)
    joined = gold.star_join(facts, dates, gold.machine_dim(facts.status, facts.production, facts.plans))
    return joined.groupBy("year_month", "iso_day_of_week", "is_weekend", "is_in_beam_plan_dim").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("beam_start_date").alias("planned_rows"),
        F.sum("production_qty_mts").alias("production_mts"),
        F.sum("planned_daily_output_mts").alias("planned_mts"),
    )

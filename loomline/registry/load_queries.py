"""Loads, file discovery, mail selection and worksheets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as dates_fn
from ..functions import naming
from ..operators import incremental as inc
from ..operators import mail, sheets
from ..sources import database, files
from ..sources.tables import store_stage
from .book import query
from .inputs import Mill

HALF_WAY = "2024-01-16"

# -- database scan and raw loads -------------------------------------------


@query("status_scan_range", """
       select cast(event_id as varchar) as id, cast(user_id as varchar) as machine_id, event_type as status,
              strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as "timestamp"
       from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-25' and event_id > 100""")
def _(m: Mill) -> DataFrame:
    events = m.table("events").selectExpr("event_id as id", "user_id as machine_id", "event_type as status", "ts as timestamp")
    scanned = database.status_scan(events, dt.date(2024, 1, 10), dt.date(2024, 1, 25), min_id=100)
    return scanned.select(
        F.col("id").cast("string"), F.col("machine_id").cast("string"), "status",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
    )


@query("raw_replace_load", """
       select prod_date, machine_no, lot_no, prod_output_m, cast(null as varchar) as meter_reading_m, 'a' as block from raw_textile_days
       union all
       select prod_date, machine_no, null, null, meter_reading_m, 'b' from raw_textile_days""")
def _(m: Mill) -> DataFrame:
    raw = m.raw_textile_days
    first = raw.select("prod_date", "machine_no", "lot_no", "prod_output_m", F.lit("a").alias("block"))
    second = raw.select("prod_date", "machine_no", "meter_reading_m", F.lit("b").alias("block"))
    return inc.union_frames([first, second])


def _earlier(m: Mill) -> DataFrame:
    """What an earlier load stored: events before the middle of the month."""
    return m.raw_machine_status.where(F.col("timestamp") < HALF_WAY)


def _incoming(m: Mill) -> DataFrame:
    """The whole source again, in another column spelling and with a new column."""
    return m.raw_machine_status.withColumnsRenamed({"machine_id": "Machine_ID", "status": "STATUS"}).withColumn(
        "source", F.lit("sensor")
    )


@query("raw_append_load", f"""
       with stored as (select * from raw_machine_status where "timestamp" < '{HALF_WAY}')
       select *, cast(null as varchar) as source from stored
       union all
       select *, 'sensor' from raw_machine_status
       where cast(id as bigint) > (select max(cast(id as bigint)) from stored)""")
def _(m: Mill) -> DataFrame:
    return inc.append_load(_earlier(m), _incoming(m), "id", "bigint")


@query("highwater_mark", f"""
       select max(cast(id as bigint)) as max_id, max(cast("timestamp" as timestamp)) as max_timestamp
       from raw_machine_status where "timestamp" < '{HALF_WAY}'""", stamps="max_timestamp")
def _(m: Mill) -> DataFrame:
    stored = _earlier(m)
    ids = inc.highwater_mark(stored, "ID", "bigint").select(F.col("latest").alias("max_id"))
    times = inc.highwater_mark(stored, "timestamp", "timestamp").select(F.col("latest").alias("max_timestamp"))
    both = ids.unionByName(times, allowMissingColumns=True)
    return both.agg(F.max("max_id").alias("max_id"), F.max("max_timestamp").alias("max_timestamp"))


@query("incremental_rows", f"""
       select id, machine_id, status, "timestamp" from raw_machine_status
       where cast("timestamp" as timestamp) > (select max(cast("timestamp" as timestamp)) from raw_machine_status
                                               where "timestamp" < '{HALF_WAY}')""")
def _(m: Mill) -> DataFrame:
    return inc.incremental_rows(m.raw_machine_status, _earlier(m), "timestamp", "timestamp")


@query("schema_evolution_union", f"""
       select *, null as source from raw_machine_status where "timestamp" < '{HALF_WAY}'
       union all select *, 'sensor' from raw_machine_status""")
def _(m: Mill) -> DataFrame:
    return inc.evolve_union(_earlier(m), _incoming(m))


@query("align_all_string", """
       select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
              cast(cast(o_orderdate as date) as varchar) as o_orderdate from orders""")
def _(m: Mill) -> DataFrame:
    orders = m.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date"))
    return inc.all_string(orders)


@query("source_sort", "select prod_date, machine_no, lot_no, prod_output_m from raw_textile_days")
def _(m: Mill) -> DataFrame:
    raw = m.raw_textile_days.select("prod_date", "machine_no", "lot_no", "prod_output_m")
    return inc.source_sort(raw, ("prod_date", "machine_no", "not_there"))


@query("highwater_filter", f"""
       select id, machine_id, status from raw_machine_status
       where cast(id as bigint) > (select coalesce(max(id), 0) from slv_machine_status where ts < timestamp '{HALF_WAY}')""")
def _(m: Mill) -> DataFrame:
    stored = m.slv_machine_status.where(F.col("timestamp") < F.lit(HALF_WAY).cast("timestamp_ntz"))
    return inc.above_stored_id(m.raw_machine_status, stored).select("id", "machine_id", "status")


# -- insert-only merges ----------------------------------------------------


@query("incremental_anti_join", f"""
       select date, machine, lot, production_qty_mts from slv_textile_days t
       where not exists (from slv_textile_days s where s.date < date '{HALF_WAY}' and s.date = t.date
                         and s.machine = t.machine and s.lot = t.lot)""", dates="date", doubles="production_qty_mts")
def _(m: Mill) -> DataFrame:
    fresh = m.slv_textile_days.select("date", "machine", "lot", "production_qty_mts")
    stored = m.slv_textile_days.where(F.col("date") < F.lit(HALF_WAY).cast("date"))
    return inc.new_keys(fresh, stored, inc.TEXTILE_KEY)


@query("incremental_null_safe_anti_join", """
       select date, machine, lot, shift, worker, production_qty_kgs from slv_complete_beam n
       where not exists (
         from slv_complete_beam s where s.date < date '1998-01-01' and s.date = n.date and s.machine = n.machine and s.lot = n.lot
           and s.shift is not distinct from n.shift and s.worker is not distinct from n.worker)""",
       dates="date", doubles="production_qty_kgs", digits=3)
def _(m: Mill) -> DataFrame:
    fresh = m.slv_complete_beam.select("date", "machine", "lot", "shift", "worker", "production_qty_kgs")
    stored = m.slv_complete_beam.where(F.col("date") < F.lit("1998-01-01").cast("date"))
    return inc.new_keys(fresh, stored, inc.COMPLETE_BEAM_KEY, inc.COMPLETE_BEAM_NULL_SAFE)


@query("start_beam_anti_join", f"""
       with fresh as materialized (
         select machine, lot, beam_no, beam_start_date, source_updated_at, daily_output_mts from slv_start_beam),
       stored as (
         select distinct machine, lot, beam_no, beam_start_date, source_updated_at from fresh
         where source_updated_at < timestamp '{HALF_WAY}' and beam_no is not null)
       select * from fresh anti join stored using (machine, lot, beam_no, beam_start_date, source_updated_at)""",
       dates="beam_start_date", stamps="source_updated_at", doubles="daily_output_mts")
def _(m: Mill) -> DataFrame:
    fresh = store_stage(m.slv_start_beam.select(*inc.START_BEAM_KEY, "daily_output_mts"), "start_beam")
    stored = fresh.where(F.col("source_updated_at") < F.lit(HALF_WAY).cast("timestamp_ntz"))
    return inc.new_keys(fresh, stored, inc.START_BEAM_KEY)


@query("replay_from_date", """
       select cast(source_updated_at as date) as snapshot_date, count(*) as kept_rows, 'incremental' as mode
       from slv_start_beam where source_updated_at < timestamp '2024-01-20' group by all""", dates="snapshot_date")
def _(m: Mill) -> DataFrame:
    day = dt.date(2024, 1, 20)
    kept = inc.rows_before(m.slv_start_beam, day)
    mode = inc.replay_mode(m.slv_start_beam, day).scalar()
    by_day = kept.groupBy(F.col("source_updated_at").cast("date").alias("snapshot_date"))
    return by_day.agg(F.count(F.lit(1)).alias("kept_rows")).withColumn("mode", mode)


@query("local_run_date", """
       select cast(ts + interval 7 hour as date) as run_date, count(*) as event_count from events group by all""", dates="run_date")
def _(m: Mill) -> DataFrame:
    run_date = dates_fn.local_date(F.col("ts")).alias("run_date")
    return m.table("events").groupBy(run_date).agg(F.count(F.lit(1)).alias("event_count"))


# -- files -----------------------------------------------------------------


def _order_dates(m: Mill, name: str) -> DataFrame:
    """All days from the first to the last order, with or without a file."""
    bounds = m.table("orders").agg(F.min(F.col("o_orderdate").cast("date")).alias("lo"), F.max(F.col("o_orderdate").cast("date")).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(name))


_DAYS = """(select cast(unnest(generate_series(min(cast(o_orderdate as date))::timestamp, max(o_orderdate), interval 1 day)) as date) as d
            from orders)"""


@query("snapshot_lookup", f"""
       select d as snapshot_date, count(filename) as file_count,
              case count(filename) when 0 then 'missing' when 1 then 'found' else 'several' end as outcome,
              case when count(filename) = 1 then '/data/raw/' || max(filename) end as path
       from {_DAYS} left join files on starts_with(filename, cast(d as varchar)) and contains(filename, '_start_beam.')
       group by d""", dates="snapshot_date")
def _(m: Mill) -> DataFrame:
    return files.snapshot_lookup(m.files, _order_dates(m, "snapshot_date"))


@query("required_inputs_missing", f"""
       select d as run_date, 'textile_days.xlsx' as filename from {_DAYS}
       union all
       select d, d || '_start_beam.xlsx' from {_DAYS} where d || '_start_beam.xlsx' not in (select filename from files)""",
       dates="run_date")
def _(m: Mill) -> DataFrame:
    return files.missing_inputs(m.files, _order_dates(m, "run_date"))


# -- mail ------------------------------------------------------------------

# The two data sets of the daily mail; sender and subject texts fit the manifest.
RULES = (
    mail.MailRule(
        name="weaving",
        sender="Urgent",
        subject="hall 2 LOOM report",
        output_folder="",
        attachments=(
            mail.AttachmentRule(("Überblick Stühle",), ("Draft",), (".xlsx", ".xls", ".xlsm"), "textile_days",
                                save_mode=mail.REPLACE_LATEST),
            mail.AttachmentRule(("Kettplan Woche",), ("Draft",), (".xlsx", ".xls", ".xlsm"), "start_beam"),
        ),
    ),
    mail.MailRule(name="reports", output_folder=None, save_mode=mail.DATED_ARCHIVE,
                  attachments=(mail.AttachmentRule(), )),
    mail.MailRule(name="spinning", enabled=False, attachments=(mail.AttachmentRule(), )),
)

_MATCHED = """with matched as (
  select *, 'weaving' as rule from mail_manifest where contains(lower(sender), 'urgent') and lower(subject) = 'hall 2 loom report'
  union all select *, 'reports' from mail_manifest),
chosen as (
  select entry_id, attachment_index, filename, received_at, rule,
         case when rule = 'weaving' and filename like 'Kettplan%' then 2 else 1 end as attachment_rule,
         case when rule = 'reports' then '' when filename like 'Kettplan%' then 'start_beam' else 'textile_days' end as dataset_name,
         case when rule = 'reports' then 'reports' else '' end as output_folder,
         case when rule = 'weaving' and filename not like 'Kettplan%' then 'replace_latest' else 'dated_archive' end as save_mode
  from matched
  where (rule = 'weaving' and filename in ('Überblick Stühle.xlsx', 'Kettplan Woche.XLS'))
     or (rule = 'reports' and filename <> 'notes.pdf')),
named as (
  select *, case when dataset_name = 'textile_days' then 'textile_days.xlsx'
                 when dataset_name = 'start_beam' then strftime(received_at, '%Y-%m-%d') || '_start_beam.xls'
                 else strftime(received_at, '%Y-%m-%d') || '_' || filename end as output_name,
         case when save_mode = 'replace_latest' then 'weaving||textile_days'
              else rule || '|' || entry_id || '|1|' || filename end as state_key
  from chosen),
newest as (
  select * from named where save_mode <> 'replace_latest'
  union all
  (select * from named where save_mode = 'replace_latest' order by received_at desc, entry_id limit 1)),
unseen as (
  select * from newest n where not exists (
    from named s where s.received_at < timestamp '1999-01-01' and s.state_key = n.state_key
      and (n.save_mode <> 'replace_latest' or s.received_at >= n.received_at)))
"""


def _matched(m: Mill) -> DataFrame:
    return mail.match_mail(m.mail_manifest, mail.active_rules(RULES))


def _chosen(m: Mill) -> DataFrame:
    return mail.first_rule(_matched(m), RULES).drop("subject", "sender_values")


def _unseen(m: Mill) -> DataFrame:
    """State: everything an earlier run saved, up to the end of 1998."""
    earlier = _chosen(m).where(F.col("received_at") < F.lit("1999-01-01").cast("timestamp_ntz"))
    state = earlier.select(mail.state_key().alias("state_key"), "received_at", F.lit(True).alias("output_exists"))
    return mail.not_seen(mail.newest_per_dataset(_chosen(m)), state)


@query("mail_range_filter", """
       select entry_id, received_at from mail_manifest
       where received_at >= timestamp '1997-03-01' and received_at < timestamp '1998-04-01'""", stamps="received_at")
def _(m: Mill) -> DataFrame:
    kept = mail.received_between(m.mail_manifest, dt.date(1997, 3, 1), dt.date(1998, 3, 31))
    return kept.select("entry_id", "received_at")


@query("mail_rule_filter", _MATCHED + "select entry_id, subject, rule from matched")
def _(m: Mill) -> DataFrame:
    return _matched(m).select("entry_id", "subject", "rule")


@query("attachment_match", """
       select filename, filename like 'Überblick Stühle%' as takes_textile, filename like 'Kettplan%' as takes_start_beam,
              filename <> 'notes.pdf' as takes_any, count(*) as mail_count
       from mail_manifest group by all""")
def _(m: Mill) -> DataFrame:
    textile, beam = RULES[0].attachments
    return (
        m.mail_manifest.groupBy(
            "filename",
            mail.attachment_matches(textile).alias("takes_textile"),
            mail.attachment_matches(beam).alias("takes_start_beam"),
            mail.attachment_matches(RULES[1].attachments[0]).alias("takes_any"),
        ).agg(F.count(F.lit(1)).alias("mail_count"))
    )


@query("attachment_first_rule", _MATCHED + "select * from chosen", stamps="received_at")
def _(m: Mill) -> DataFrame:
    return _chosen(m)


@query("attachment_output_name", _MATCHED + "select entry_id, rule, filename, output_name from named")
def _(m: Mill) -> DataFrame:
    return mail.with_output_name(_chosen(m)).select("entry_id", "rule", "filename", "output_name")


@query("attachment_latest", _MATCHED + "select entry_id, rule, filename, state_key, received_at from newest", stamps="received_at")
def _(m: Mill) -> DataFrame:
    return mail.newest_per_dataset(_chosen(m)).select("entry_id", "rule", "filename", "state_key", "received_at")


@query("attachment_not_seen", _MATCHED + "select entry_id, rule, filename, state_key from unseen")
def _(m: Mill) -> DataFrame:
    return _unseen(m).select("entry_id", "rule", "filename", "state_key")


@query("attachment_counts", _MATCHED + """
       select rule, count(distinct entry_id) as matched_emails, (select count(*) from unseen u where u.rule = matched.rule) as saved_files
       from matched group by rule""")
def _(m: Mill) -> DataFrame:
    return mail.counts_per_rule(_matched(m), _unseen(m))


# -- worksheet names -------------------------------------------------------


def _headers(m: Mill) -> DataFrame:
    """Header texts from the part table: brand, type and size as stacked header cells."""
    return m.table("part").select(
        F.lit("parts.xlsx").alias("source_file"),
        F.col("p_brand").alias("sheet_name"),
        F.col("p_partkey").alias("col_idx"),
        F.array(
            F.when(F.col("p_size") % 3 == 0, F.lit("Unnamed: 0_level_0")).otherwise(F.concat(F.lit(" #"), "p_type", F.lit(" (kg) "))),
            F.when(F.col("p_size") % 2 == 0, F.lit("B")).otherwise(F.concat(F.lit("Size-"), F.col("p_size").cast("string"), F.lit("."))),
        ).alias("parts"),
    )


_NAMES = """with heads as (
  select p_partkey as col_idx, p_brand as sheet_name,
         case when p_size % 3 = 0 then null else trim(' #' || p_type || ' (kg) ') end as upper_part,
         case when p_size % 2 = 0 then 'B' else 'Size-' || p_size || '.' end as lower_part
  from part),
named as (
  select col_idx, sheet_name,
         lower(trim(regexp_replace(regexp_replace(
           case when upper_part is null then lower_part when lower_part = 'B' then upper_part else upper_part || '_' || lower_part end,
           '[()#]', '', 'g'), '[\\s/\\\\.\\-_]+', '_', 'g'), '_')) as name
  from heads)
"""


@query("normalize_names", _NAMES + "select col_idx, sheet_name, name from named")
def _(m: Mill) -> DataFrame:
    return _headers(m).select("col_idx", "sheet_name", naming.header_name(F.col("parts")).alias("name"))


@query("dedup_names", _NAMES + """
       select col_idx, sheet_name, case when n > 1 then name || '_' || n else name end as name
       from (select *, row_number() over (partition by sheet_name, name order by col_idx) as n from named)""")
def _(m: Mill) -> DataFrame:
    named = _headers(m).withColumn("name", naming.header_name(F.col("parts"))).drop("parts")
    return sheets.dedup_names(named).select("col_idx", "sheet_name", "name")


_RENAMED = """
       select cast(l_suppkey as varchar) as machine_no, l_returnflag as model, l_linestatus as item_type, 'm' as unit,
              cast(cast(l_shipdate as date) as varchar) as beam_start_date, l_orderkey as po, l_linenumber as order_no,
              cast(l_partkey as varchar) as lot_no, cast(l_quantity as varchar) as total_yarn, cast(l_orderkey as varchar) as beam_no,
              cast(l_extendedprice as varchar) as length, cast(l_quantity as varchar) as planned_output, '-' as output_gap,
              cast(l_discount as varchar) as output_rate, 'soon' as expected_beam_end_at, l_returnflag as weaving_days,
              cast(l_tax as varchar) as daily_output_mts
       from lineitem"""


def _localized(m: Mill) -> DataFrame:
    """Lineitem under the localized sheet headers."""
    values = (
        F.col("l_suppkey").cast("string"), F.col("l_returnflag"), F.col("l_linestatus"), F.lit("m"),
        F.col("l_shipdate").cast("date").cast("string"), F.col("l_orderkey"), F.col("l_linenumber"),
        F.col("l_partkey").cast("string"), F.col("l_quantity").cast("string"), F.col("l_orderkey").cast("string"),
        F.col("l_extendedprice").cast("string"), F.col("l_quantity").cast("string"), F.lit("-"),
        F.col("l_discount").cast("string"), F.lit("soon"), F.col("l_returnflag"), F.col("l_tax").cast("string"),
    )
    return m.table("lineitem").select(*[v.alias(n) for v, n in zip(values, sheets.START_BEAM_NAMES, strict=True)])


@query("rename_map", _RENAMED)
def _(m: Mill) -> DataFrame:
    return sheets.rename_columns(_localized(m), sheets.START_BEAM_NAMES)


@query("coerce_types", f"""
       select * replace (cast(machine_no as double) as machine_no, cast(beam_start_date as timestamp) as beam_start_date,
                         null::double as output_gap, null::double as weaving_days, null::timestamp as expected_beam_end_at,
                         cast(total_yarn as double) as total_yarn, cast(length as double) as length,
                         cast(planned_output as double) as planned_output, cast(output_rate as double) as output_rate,
                         cast(daily_output_mts as double) as daily_output_mts)
       from ({_RENAMED})""", stamps="beam_start_date expected_beam_end_at")
def _(m: Mill) -> DataFrame:
    return sheets.coerce_types(sheets.rename_columns(_localized(m), sheets.START_BEAM_NAMES))


# -- worksheet grids -------------------------------------------------------


@query("row_metadata", """
       select 'orders.xlsx' as _source_file, o_orderpriority as _sheet_name, o_orderkey as row_idx,
              row_number() over (partition by o_orderpriority order by o_orderkey) as _row_number, true as _ingested
       from orders""")
def _(m: Mill) -> DataFrame:
    rows = m.table("orders").select(
        F.lit("orders.xlsx").alias("source_file"), F.col("o_orderpriority").alias("sheet_name"), F.col("o_orderkey").alias("row_idx")
    )
    return sheets.row_metadata(rows).withColumn("_ingested", F.col("_ingested_at").isNotNull()).drop("_ingested_at")


@query("sheet_report_date", """
       select distinct case when l_suppkey % 5 = 4 then ' Total all' else 'WS-' || (l_suppkey % 5) end as sheet_name,
              date '2024-01-31' as report_date
       from sheet_days""", dates="report_date")
def _(m: Mill) -> DataFrame:
    return sheets.sheet_report_date(m.cells).select("sheet_name", "report_date")


@query("sheet_filter", """
       select sheet_name, count(*) * 4 + count(distinct row_idx) + count(distinct prod_date) * 3 + 1 as cell_count
       from sheet_rows group by sheet_name""")
def _(m: Mill) -> DataFrame:
    return sheets.keep_sheets(m.cells).groupBy("sheet_name").agg(F.count(F.lit(1)).alias("cell_count"))


@query("sheet_month", "select distinct sheet_name, 2024 as sheet_year, 1 as sheet_month from sheet_rows")
def _(m: Mill) -> DataFrame:
    return sheets.sheet_month(sheets.keep_sheets(m.cells)).select("sheet_name", "sheet_year", "sheet_month")


@query("valid_machine_rows", "select distinct sheet_name, row_idx, machine_no from sheet_rows")
def _(m: Mill) -> DataFrame:
    kept = sheets.machine_rows(sheets.named_sheets(m.cells))
    return kept.select("sheet_name", F.col("row_idx").cast("bigint").alias("row_idx"), "machine_no")


@query("lot_unpivot", "select sheet_name, machine_no, prod_date, lot as lot_no from sheet_rows", dates="prod_date")
def _(m: Mill) -> DataFrame:
    cells = sheets.named_sheets(m.cells)
    return sheets.lot_unpivot(cells, sheets.sheet_month(cells)).drop("source_file")


@query("production_unpivot", """
       select sheet_name, machine_no, prod_date, cast(meter as varchar) as meter_reading_m, cast(cut as varchar) as cut_length_m,
              cast(output as varchar) as prod_output_m from sheet_rows""", dates="prod_date")
def _(m: Mill) -> DataFrame:
    cells = sheets.named_sheets(m.cells)
    return sheets.production_unpivot(cells, sheets.sheet_month(cells)).drop("source_file")


@query("lot_production_full_join", """
       select sheet_name, machine_no, prod_date, lot as lot_no, meter as meter_reading_m, cut as cut_length_m, output as prod_output_m
       from sheet_rows""", dates="prod_date", doubles="meter_reading_m cut_length_m prod_output_m")
def _(m: Mill) -> DataFrame:
    return sheets.textile_day_rows(m.cells).drop("source_file")


@query("current_month_filter", """
       select o_orderkey, cast(o_orderdate as date) as prod_date from orders
       join (select o_orderpriority, min(o_orderdate) as f from orders group by 1) s using (o_orderpriority)
       where date_trunc('month', o_orderdate) = date_trunc('month', f)""", dates="prod_date")
def _(m: Mill) -> DataFrame:
    """Orders of the first month of their priority, priorities standing in for sheets."""
    rows = m.table("orders").select(
        F.lit("orders.xlsx").alias("source_file"), F.col("o_orderpriority").alias("sheet_name"), "o_orderkey",
        F.col("o_orderdate").cast("date").alias("prod_date"),
    )
    first = rows.groupBy("source_file", "sheet_name").agg(F.min("prod_date").alias("d"))
    months = first.select("source_file", "sheet_name", F.year("d").alias("sheet_year"), F.month("d").alias("sheet_month"))
    return sheets.in_sheet_month(rows, months).select("o_orderkey", "prod_date")


def _year_end_headers(m: Mill) -> DataFrame:
    """Order dates as headers of a December sheet; every 13th order has a day 31."""
    day = F.when(F.col("o_orderkey") % 13 == 0, 31).otherwise(F.dayofmonth("o_orderdate"))
    korean = F.format_string(" %d 월%d일 생산", F.month("o_orderdate"), day)
    is_date = F.col("o_custkey") % 2 == 0
    return m.table("orders").select(
        "o_orderkey",
        F.when(is_date, F.col("o_orderdate").cast("date").cast("string")).otherwise(korean).alias("header"),
        F.when(is_date, "d").otherwise("s").alias("kind"),
        F.month("o_orderdate").alias("month_number"),
    )


_YEAR = "2024 + case when month_number >= 9 then -1 when month_number <= -3 then 1 else 0 end"
_YEAR_END = """with heads as (
  select o_orderkey, month(o_orderdate) as month_number,
         case when o_custkey % 2 <> 0 and o_orderkey % 13 = 0 then 31 else day(o_orderdate) end as day_number
  from orders)
"""


@query("parse_korean_date", _YEAR_END + f"""
       select o_orderkey, try_cast(({_YEAR}) || '-' || lpad('' || month_number, 2, '0') || '-' || lpad('' || day_number, 2, '0') as date)
              as prod_date from heads""", dates="prod_date")
def _(m: Mill) -> DataFrame:
    heads = _year_end_headers(m)
    date = dates_fn.production_date(F.col("header"), F.col("kind"), F.lit(2024), F.lit(3))
    return heads.select("o_orderkey", date.alias("prod_date"))


@query("resolve_year", """
       select month(o_orderdate) as month_number, m as sheet_month,
              case when month(o_orderdate) - m >= 6 then 2023 when month(o_orderdate) - m <= -6 then 2025 else 2024 end as year_number,
              count(*) as row_count
       from orders, (values (1), (6), (12)) as s(m) group by all""")
def _(m: Mill) -> DataFrame:
    heads = m.table("orders").select(
        F.month("o_orderdate").cast("bigint").alias("month_number"), F.explode(F.array(F.lit(1), F.lit(6), F.lit(12))).alias("sheet_month")
    )
    year = dates_fn.resolve_year(F.lit(2024), F.col("sheet_month"), F.col("month_number"))
    return heads.groupBy("month_number", "sheet_month", year.cast("int").alias("year_number")).agg(F.count(F.lit(1)).alias("row_count"))

"""Quality checks and exports over the whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casting import to_bigint, to_timestamp
from ..plans import gold, silver
from ..plans import quality as q
from ..plans.daily import GOLD_TABLES
from ..session import ensure_checkpoint_dir
from ..sources import tables
from .book import query
from .inputs import Mill


def _gold(m: Mill) -> dict[str, DataFrame]:
    """Without amounts."""
    facts = m.keys
    dates = gold.date_dim(facts.production, facts.status, facts.plans)
    return q.gold_tables(facts, dates, gold.machine_dim(facts.status, facts.production, facts.plans))


# SQL names of the same tables.
_SQL_TABLES = {
    "slv_machine_status": '(select id, machine, status, ts as "timestamp", cast(ts as date) as date from slv_machine_status)',
    "slv_complete_beam": "slv_complete_beam",
    "slv_textile_days": "slv_textile_days",
    "slv_start_beam": "slv_start_beam",
    "gld_date_dim": "date_dim",
    "gld_machine_dim": "machine_dim",
    "gld_beam_plan_dim": "plans",
    "gld_production_daily_fact": "production_fact",
    "gld_machine_status_daily_fact": "status_fact",
}


def _null_sql() -> str:
    parts = [
        f"select '{t}' as table_name, '{c}' as column_name, count(*) - count(\"{c}\") as violations from {_SQL_TABLES[t]}"
        for t, columns in q.NOT_NULL.items() for c in columns
    ]
    return "\nunion all ".join(parts)


@query("dq_not_null", _null_sql())
def _(m: Mill) -> DataFrame:
    return q._union([q.null_counts(df, t, q.NOT_NULL[t]) for t, df in {**m.keys.silver, **_gold(m)}.items()])


def _unique_sql() -> str:
    parts = [
        f"select '{t}' as table_name, '{','.join(k)}' as column_name, "
        f"(select count(*) from (select {k[0]} from {_SQL_TABLES[t]} where {k[0]} is not null group by 1 having count(*) > 1)) as violations"
        for t, keys in q.UNIQUE.items() for k in keys
    ]
    return "\nunion all ".join(parts)


@query("dq_unique", _unique_sql())
def _(m: Mill) -> DataFrame:
    tables_by_name = {**m.keys.silver, **_gold(m)}
    return q._union([q.unique_violations(tables_by_name[t], t, k) for t, keys in q.UNIQUE.items() for k in keys])


@query("dq_duplicate_keys", """
       select date, machine, lot, count(*) as duplicate_count from textile_typed group by all having count(*) > 1""", dates="date")
def _(m: Mill) -> DataFrame:
    """Duplicates of the key before the best row is kept; the silver table itself has none."""
    return q.duplicate_keys(silver.textile_days_typed(m.raw_textile_days), ("date", "machine", "lot"))


@query("dq_duplicates_top", """
       select machine_no, beam_no, count(*) as duplicate_count from raw_start_beam group by all having count(*) > 1
       order by duplicate_count desc, machine_no nulls first, beam_no nulls first limit 20""")
def _(m: Mill) -> DataFrame:
    return q.duplicates_top(m.raw_start_beam, ("machine_no", "beam_no"))


_HOURS = "running_hours stopped_hours changeover_hours disconnected_hours planned_shutdown_hours"


# The fact keeps its rules, so the checks are tried on a spoiled one: machines ending in 0 run a day more, those ending in 5 less than nothing, and rows of
# machines ending in 3 rest seven hours more.
_SPOILED = """(select * replace (running_hours + case right(machine, 1) when '0' then 24.5 when '5' then -30 else 0 end as running_hours,
                                 planned_shutdown_hours + if(right(machine, 1) = '3', 7, 0) as planned_shutdown_hours) from status_fact)"""


def _spoiled(m: Mill) -> DataFrame:
    last = F.right("machine", F.lit(1))
    return m.gold.status.withColumns({
        "running_hours": F.col("running_hours") + F.when(last == "0", 24.5).when(last == "5", -30.0).otherwise(0.0),
        "planned_shutdown_hours": F.col("planned_shutdown_hours") + F.when(last == "3", 7.0).otherwise(0.0),
    })


@query("dq_hours_bounds", f"""
       from {_SPOILED} where least(running_hours, stopped_hours, changeover_hours, disconnected_hours, planned_shutdown_hours) < 0
       or running_hours + stopped_hours + changeover_hours + disconnected_hours + planned_shutdown_hours > 24.0001""",
       dates="date", doubles=_HOURS)
def _(m: Mill) -> DataFrame:
    return q.hours_out_of_bounds(_spoiled(m))


@query("dq_shutdown_window", f"""
       select date, machine, planned_shutdown_hours from {_SPOILED}
       where planned_shutdown_hours > case isodow(date) when 7 then 18.5001 when 1 then 6.5001 else 0.0001 end""",
       dates="date", doubles="planned_shutdown_hours")
def _(m: Mill) -> DataFrame:
    return q.shutdown_out_of_window(_spoiled(m))


@query("dq_orphan_machines", "select machine from slv_textile_days except select machine from machine_dim")
def _(m: Mill) -> DataFrame:
    """Run on all textile machines, of which some never report status; the production fact has none."""
    return q.orphan_machines(m.textile_machines, m.machine_dim)


@query("profile_tables", """
       select 'raw_machine_status' as table_name, count(*) as total_rows, cast(min(cast(id as bigint)) as varchar) as min_value,
              cast(max(cast(id as bigint)) as varchar) as max_value from raw_machine_status
       union all select 'raw_textile_days', count(*), '' || min(cast(prod_date as date)), '' || max(cast(prod_date as date)) from raw_textile_days
       union all select 'raw_start_beam', count(*), '' || min(cast(beam_start_date as date)), '' || max(cast(beam_start_date as date)) from raw_start_beam
       union all select 'raw_complete_beam', count(*), '' || min(cast(date as date)), '' || max(cast(date as date)) from raw_complete_beam
       union all select 'slv_textile_days', count(*), '' || min(date), '' || max(date) from slv_textile_days
       union all select 'gld_beam_plan_dim', count(*), '' || min(beam_start_date), '' || max(beam_start_date) from plans
       union all select 'gld_production_daily_fact', count(*), '' || min(date), '' || max(date) from production_fact
       union all select 'gld_machine_status_daily_fact', count(*), '' || min(date), '' || max(date) from status_fact""")
def _(m: Mill) -> DataFrame:
    def day(name: str):
        return to_timestamp(F.col(name)).cast("date")

    return q._union([
        q.profile(m.raw_machine_status, "raw_machine_status", to_bigint(F.col("id"))),
        q.profile(m.raw_textile_days, "raw_textile_days", day("prod_date")),
        q.profile(m.raw_start_beam, "raw_start_beam", day("beam_start_date")),
        q.profile(m.raw_complete_beam, "raw_complete_beam", day("date")),
        q.profile(m.keys.textile, "slv_textile_days", F.col("date")),
        q.profile(m.keys.plans, "gld_beam_plan_dim", F.col("beam_start_date")),
        q.profile(m.keys.production, "gld_production_daily_fact", F.col("date")),
        q.profile(m.keys.status, "gld_machine_status_daily_fact", F.col("date")),
    ])


@query("top_k_preview", "from production_fact order by date desc, machine, lot limit 20", dates="date",
       doubles="production_qty_mts meter_reading_m cut_length_m")
def _(m: Mill) -> DataFrame:
    return q.preview(m.gold.production, [F.desc("date"), F.asc("machine"), F.asc("lot")], 20)


@query("point_lookup", """
       from raw_textile_days where prod_date = '2024-01-15' and machine_no = '100' and lot_no = 'lot-5'""")
def _(m: Mill) -> DataFrame:
    return m.raw_textile_days.where("prod_date = '2024-01-15' and machine_no = '100' and lot_no = 'lot-5'")


@query("missing_plan_rows", "select count(*) as missing_beam_plan_key_rows from production_fact where beam_plan_key is null")
def _(m: Mill) -> DataFrame:
    return q.missing_plan_rows(m.gold.production_keys)


@query("rows_by_flag", "select is_start_beam, count(*) as row_count from production_fact group by all")
def _(m: Mill) -> DataFrame:
    return q.rows_by_flag(m.gold.production_keys)


@query("fact_totals", """
       select count(*) as total_rows, min(date) as min_date, max(date) as max_date, sum(running_hours) as total_running_hours,
              sum(stopped_hours) as total_stopped_hours, sum(changeover_hours) as total_changeover_hours,
              sum(disconnected_hours) as total_disconnected_hours from status_fact""", dates="min_date max_date",
       doubles="total_running_hours total_stopped_hours total_changeover_hours total_disconnected_hours")
def _(m: Mill) -> DataFrame:
    return q.fact_totals(m.gold.status)


@query("machine_counts_by_table", "\nunion all ".join(
    f"select '{t}' as table_name, count(distinct machine) as machine_count from {t}"
    for t in ("slv_machine_status", "slv_complete_beam", "slv_textile_days", "slv_start_beam")))
def _(m: Mill) -> DataFrame:
    return q.machine_counts({
        "slv_machine_status": m.slv_machine_status, "slv_complete_beam": m.keys.complete_beam, "slv_textile_days": m.textile_keys, "slv_start_beam": m.start_beam_keys,
    })


# Columns of the given tables, in order.
_GIVEN = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
# Spark's type names for the types of the given tables.
_TYPES = """case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double' when 'FLOAT[]' then 'array<float>'
            when 'TIMESTAMP' then 'timestamp_ntz' else 'string' end"""


def _describe_sql() -> str:
    columns = _GIVEN
    parts = [
        f"select '{t}' as table_name, {i} as position, '{c}' as column_name, max(typeof({c})) as data_type, count({c}) as filled_rows from {t}"
        for t, names in columns.items() for i, c in enumerate(names.split(), start=1)
    ]
    return f"select table_name, position::bigint as position, column_name, {_TYPES} as data_type, filled_rows from ({' union all '.join(parts)})"


@contextmanager
def _catalog(m: Mill) -> Iterator[str]:
    """A database with the tables of the folder, whichever there are."""
    database = f"given_{uuid.uuid4().hex}"
    tables.register_folder(m.spark, m.folder, database)
    try:
        yield database
    finally:
        m.spark.sql(f"DROP DATABASE {database} CASCADE")


@query("describe_tables", _describe_sql())
def _(m: Mill) -> DataFrame:
    with _catalog(m) as database:
        names = sorted(t.name for t in m.spark.catalog.listTables(database))
        return q.describe({t: m.spark.table(f"{database}.`{t}`") for t in names})


@query("catalog_listing", f"""
       select table_name, ordinal_position::bigint as position, column_name, {_TYPES} as data_type
       from information_schema.columns where table_schema = 'main'""")
def _(m: Mill) -> DataFrame:
    with _catalog(m) as database:
        return tables.catalog_columns(m.spark, database)


def _summary_sql() -> str:
    nulls = f"select table_name, 'not_null:' || column_name as check_name, violations from ({_null_sql()})"
    unique = f"select table_name, 'unique:' || column_name, violations from ({_unique_sql()})"
    composite = [
        f"select '{t}', 'unique_key', (select count(*) from (select 1 from {t} group by {', '.join(keys)} having count(*) > 1))"
        for t, keys in q.COMPOSITE_KEYS.items()
    ]
    facts = [
        "select 'gld_machine_status_daily_fact', 'hours_within_day', (select count(*) from status_fact where "
        "running_hours + stopped_hours + changeover_hours + disconnected_hours + planned_shutdown_hours > 24.0001 or "
        "least(running_hours, stopped_hours, changeover_hours, disconnected_hours, planned_shutdown_hours) < 0)",
        "select 'gld_machine_status_daily_fact', 'shutdown_within_window', (select count(*) from status_fact where "
        "planned_shutdown_hours > case isodow(date) when 7 then 18.5001 when 1 then 6.5001 else 0.0001 end)",
        "select 'gld_production_daily_fact', 'machines_report_status', "
        "(select count(*) from (select machine from production_fact except select machine from machine_dim))",
    ]
    raw = [
        f"select '{t}', 'unique_key', (select count(*) from (select 1 from {t} group by {', '.join(keys)} having count(*) > 1))"
        for t, keys in q.RAW_KEYS.items()
    ]
    raw += [
        f"select '{t}', 'unreadable:{c}', (select count(*) from {t} where \"{c}\" is not null and try_cast(\"{c}\" as {kind}) is null)"
        for t, columns in q.RAW_TYPES.items() for c, kind in columns.items()
    ]
    body = " union all ".join([nulls, unique, *composite, *facts, *raw])
    layer = "case left(table_name, 3) when 'raw' then 'raw' when 'slv' then 'silver' else 'gold' end"
    return f"select {layer} as layer, * from ({body})"


def _checked_layers(m: Mill) -> dict[str, q.Checked]:
    """All three layers as a run writes them: each table once, read by the next layer from storage, its row checks counted on the way."""
    made: dict[str, q.Checked] = {}

    def keep(table: str, df: DataFrame) -> DataFrame:
        made[table] = q.store_checked(df, table)
        return made[table].rows

    events = silver.machine_status(keep("raw_machine_status", m.raw_machine_status))
    events = keep("slv_machine_status", events)
    textile = keep("slv_textile_days", silver.textile_days(keep("raw_textile_days", m.raw_textile_days)))
    starts = keep("slv_start_beam", silver.start_beam(keep("raw_start_beam", m.raw_start_beam)))
    keep("slv_complete_beam", silver.complete_beam(keep("raw_complete_beam", m.raw_complete_beam)))
    status = keep("gld_machine_status_daily_fact", gold.machine_status_daily_fact(events))
    plans = keep("gld_beam_plan_dim", gold.beam_plan_dim(starts))
    in_force = tables.store_stage(gold.plan_starts(plans), "plan_starts")
    production = keep("gld_production_daily_fact", gold.production_daily_fact(textile, status, in_force, in_force=True))
    keep("gld_machine_dim", gold.machine_dim(status, production, in_force))
    keep("gld_date_dim", gold.date_dim(production, status, in_force))
    return made


@query("dq_summary", _summary_sql())
def _(m: Mill) -> DataFrame:
    return q.summary(_checked_layers(m))


@query("gold_export_counts", "\nunion all ".join(
    f"select '{t}' as table_name, count(*) as row_count from {_SQL_TABLES[t]}" for t in _SQL_TABLES if t.startswith("gld_")))
def _(m: Mill) -> DataFrame:
    """The gold tables of a catalog are exported as Parquet, counted while they are written; what is read back must agree."""
    spark = m.spark
    database = f"export_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    try:
        # As a run writes them: each table once, read by the next from the catalog.
        def keep(name: str, table: DataFrame) -> DataFrame:
            tables.swap_in(table, f"{database}.{name}")
            return spark.table(f"{database}.{name}")

        events = m.keys.events
        status = keep("gld_machine_status_daily_fact", gold.machine_status_daily_fact(events))
        plans = keep("gld_beam_plan_dim", m.gold.plans)
        in_force = tables.store_stage(gold.plan_starts(plans), "plan_starts")
        production = keep("gld_production_daily_fact", gold.production_daily_fact(m.slv_textile_days, status, in_force, in_force=True))
        keep("gld_machine_dim", gold.machine_dim(status, production, in_force))
        keep("gld_date_dim", gold.date_dim(production, status, in_force))
        folder = f"{ensure_checkpoint_dir(spark)}/stage/{database}"
        exported = tables.export_parquet(spark, [f"{database}.{t}" for t in GOLD_TABLES], folder)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return tables.exported_counts(spark, exported)

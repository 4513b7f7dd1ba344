"""Data-quality checks: each is a query, and one summary counts all violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.casting import to_bigint, to_timestamp
from ..sources.tables import store_stage
from .gold import Gold

# Columns that must be filled, and keys that must be unique.
NOT_NULL = {
    "slv_machine_status": ("id", "machine", "timestamp", "date"),
    "slv_complete_beam": ("date", "machine", "lot"),
    "slv_textile_days": ("date", "machine", "lot"),
    "slv_start_beam": ("beam_start_date", "machine", "lot", "source_updated_at"),
    "gld_date_dim": ("date", "date_key"),
    "gld_beam_plan_dim": ("beam_plan_key", "machine", "lot", "beam_start_date"),
    "gld_machine_dim": ("machine",),
    "gld_machine_status_daily_fact": (
        "date", "machine", "running_hours", "stopped_hours", "changeover_hours", "disconnected_hours", "planned_shutdown_hours",
    ),
    "gld_production_daily_fact": ("date", "machine", "lot"),
}
UNIQUE = {
    "slv_machine_status": (("id",),),
    "gld_date_dim": (("date",), ("date_key",)),
    "gld_beam_plan_dim": (("beam_plan_key",),),
    "gld_machine_dim": (("machine",),),
}
COMPOSITE_KEYS = {
    "slv_complete_beam": ("date", "machine", "lot", "shift", "worker"),
    "slv_start_beam": ("machine", "lot", "beam_no", "beam_start_date", "source_updated_at"),
    "slv_textile_days": ("date", "machine", "lot"),
}
RAW_KEYS = {
    "raw_complete_beam": ("date", "machine", "lot", "shift", "worker"),
    "raw_start_beam": ("machine_no", "beam_no"),
    "raw_textile_days": ("prod_date", "machine_no", "lot_no"),
    "raw_machine_status": ("id",),
}
RAW_TYPES = {
    "raw_complete_beam": {"date": "timestamp"},
    "raw_start_beam": {"beam_start_date": "timestamp"},
    "raw_textile_days": {"prod_date": "timestamp"},
    "raw_machine_status": {"id": "bigint", "timestamp": "timestamp"},
}
HOURS = ("running_hours", "stopped_hours", "changeover_hours", "disconnected_hours", "planned_shutdown_hours")
MOST_HOURS, MOST_SUNDAY, MOST_MONDAY, MOST_OTHER = 24.0001, 18.5001, 6.5001, 0.0001


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, violations): NULLs of all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns])
    return counts.select(F.lit(table).alias("table_name"), F.inline(rows))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row. NULL counts as a value of a composite key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")


def duplicates_top(df: DataFrame, keys: Sequence[str], limit: int = 20) -> DataFrame:
    """Worst duplicates first, ties by key."""
    return duplicate_keys(df, keys).orderBy(F.desc("duplicate_count"), *keys).limit(limit)


def unique_violations(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """(table_name, column_name, violations): values of a unique column seen twice or more; NULL is exempt."""
    filled = df.dropna("any", subset=list(keys))
    return duplicate_keys(filled, keys).agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("column_name"), "violations"
    )


def _beyond_a_day() -> Column:
    total = F.col(HOURS[0])
    for name in HOURS[1:]:
        total = total + F.col(name)
    return (F.least(*HOURS) < 0) | (total > MOST_HOURS)


def hours_out_of_bounds(status: DataFrame) -> DataFrame:
    """Fact rows with negative hours or more than a day in total."""
    return status.where(_beyond_a_day())


def _outside_window() -> Column:
    weekday = F.weekday("date")
    most = F.when(weekday == 6, MOST_SUNDAY).when(weekday == 0, MOST_MONDAY).otherwise(MOST_OTHER)
    return F.col("planned_shutdown_hours") > most


def shutdown_out_of_window(status: DataFrame) -> DataFrame:
    """Fact rows with more planned shutdown than their weekday allows."""
    return status.where(_outside_window()).select("date", "machine", "planned_shutdown_hours")


def orphan_machines(production: DataFrame, machines: DataFrame) -> DataFrame:
    """Production machines that the machine dimension lacks or does not mark as reporting status."""
    known = machines.where("is_in_status_fact").select("machine")
    return production.select("machine").distinct().join(known, "machine", "left_anti")


def profile(df: DataFrame, table: str, column: Column) -> DataFrame:
    """(table_name, total_rows, min_value, max_value) with the bounds as text."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.min(column).alias("lo"), F.max(column).alias("hi")
    ).select(
        F.lit(table).alias("table_name"), "total_rows",
        F.col("lo").cast("string").alias("min_value"), F.col("hi").cast("string").alias("max_value"),
    )


def preview(df: DataFrame, order: Sequence[Column], limit: int) -> DataFrame:
    """First rows under an order; each task keeps only its own first ones."""
    return df.orderBy(*order).limit(limit)


def machine_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, machine_count): distinct machines per table."""
    return _union([
        df.agg(F.countDistinct("machine").alias("machine_count")).select(F.lit(t).alias("table_name"), "machine_count")
        for t, df in tables.items()
    ])


def fact_totals(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count(F.lit(1)).alias("total_rows"), F.min("date").alias("min_date"), F.max("date").alias("max_date"),
        *[F.sum(c).alias(f"total_{c}") for c in HOURS[:4]],
    )


def rows_by_flag(production: DataFrame) -> DataFrame:
    return production.groupBy("is_start_beam").agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("is_start_beam"))


def missing_plan_rows(production: DataFrame) -> DataFrame:
    return production.agg(F.count_if(F.col("beam_plan_key").isNull()).alias("missing_beam_plan_key_rows"))


def describe(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, data_type, filled_rows) for every column of the tables."""
    parts = []
    for table, df in tables.items():
        counts = df.agg(*[F.count(f"`{f.name}`").alias(f.name) for f in df.schema.fields])
        rows = F.array(*[
            F.struct(F.lit(i).cast("bigint").alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"`{f.name}`").alias("filled_rows"))
            for i, f in enumerate(df.schema.fields, start=1)
        ])
        parts.append(counts.select(F.lit(table).alias("table_name"), F.inline(rows)))
    return _union(parts)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def layer_of(table: str) -> str:
    return {"raw": "raw", "slv": "silver"}.get(table[:3], "gold")


# -- all checks of a table -----------------------------------------------------


def row_checks(table: str) -> dict[str, Column]:
    """Check name -> condition that a row breaks it."""
    checks = {f"not_null:{c}": F.col(c).isNull() for c in NOT_NULL.get(table, ())}
    for column, kind in RAW_TYPES.get(table, {}).items():
        read = to_bigint(F.col(column)) if kind == "bigint" else to_timestamp(F.col(column))
        checks[f"unreadable:{column}"] = F.col(column).isNotNull() & read.isNull()
    if table == "gld_machine_status_daily_fact":
        checks |= {"hours_within_day": _beyond_a_day(), "shutdown_within_window": _outside_window()}
    return checks


def key_checks(table: str) -> dict[str, tuple[Sequence[str], bool]]:
    """Check name -> (key columns, whether rows with a NULL are exempt)."""
    checks = {f"unique:{','.join(k)}": (k, True) for k in UNIQUE.get(table, ())}
    composite = COMPOSITE_KEYS.get(table) or RAW_KEYS.get(table)
    return checks | ({"unique_key": (composite, False)} if composite else {})


def key_violations(df: DataFrame, table: str) -> list[DataFrame]:
    """(table_name, check_name, violations) of each key check. Keys are grouped as they are typed: only their columns are moved, without names or text."""
    parts = []
    for check, (columns, exempt) in key_checks(table).items():
        rows = df.dropna("any", subset=list(columns)) if exempt else df
        parts.append(_counted(duplicate_keys(rows, columns), table, check))
    return parts


def unreported(production: DataFrame, machines: DataFrame) -> DataFrame:
    """The check that machines of the production fact report status; a row without a machine asks for a partner without one. One group-by of both sides."""
    asks = production.select("machine", F.lit(True).alias("asks"), F.lit(False).alias("known"))
    knows = machines.where("is_in_status_fact").select("machine", F.lit(False).alias("asks"), F.lit(True).alias("known"))
    held = asks.unionByName(knows).groupBy("machine").agg(F.bool_or("asks").alias("asks"), F.bool_or("known").alias("known"))
    return _counted(held.where("asks and not known"), "gld_production_daily_fact", "machines_report_status")


def _counted(broken: DataFrame, table: str, check: str) -> DataFrame:
    return broken.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "violations")


@dataclass(frozen=True)
class Checked:
    """A stored table and how many rows broke its row checks, counted while it was written."""

    rows: DataFrame
    broken: Mapping[str, int]


def store_checked(df: DataFrame, table: str) -> Checked:
    """Write a table; its row checks are counted by the tasks that write it."""
    checks = row_checks(table)
    if not checks:
        return Checked(store_stage(df, table), {})
    seen = Observation(f"checks_{table}")
    stored = store_stage(df.observe(seen, *[F.count_if(broken).alias(name) for name, broken in checks.items()]), table)
    return Checked(stored, dict(seen.get))


def _row_results(table: str, given: DataFrame | Checked) -> DataFrame:
    """(table_name, check_name, violations) of the row checks; a table that was not stored by ``store_checked`` is read once for all of them."""
    checks = row_checks(table)
    if isinstance(given, Checked):
        source = given.rows.sparkSession.range(1)
        counts = [F.lit(given.broken[name]).cast("bigint") for name in checks]
    else:
        source = given.agg(*[F.count_if(broken).alias(f"c{k}") for k, broken in enumerate(checks.values())])
        counts = [F.col(f"c{k}") for k in range(len(checks))]
    rows = [F.struct(F.lit(name).alias("check_name"), count.alias("violations")) for name, count in zip(checks, counts)]
    return source.select(F.inline(F.array(*rows))).select(F.lit(table).alias("table_name"), "check_name", "violations")


def summary(tables: Mapping[str, DataFrame | Checked], layer: str | None = None) -> DataFrame:
    """(layer, table_name, check_name, violations) of every check on the given tables.

    Each key is counted by a group-by of its own columns; row checks of ``Checked`` tables are known already. A passing pipeline has zero violations in silver and
    gold; raw tables repeat keys by nature, their counts inform. ``layer`` limits the run to 'raw', 'silver' or 'gold'.
    """
    chosen = {t: given for t, given in tables.items() if layer in (None, layer_of(t))}
    rows = {t: given.rows if isinstance(given, Checked) else given for t, given in chosen.items()}
    parts = [_row_results(t, given) for t, given in chosen.items() if row_checks(t)]
    for t, df in rows.items():
        parts += key_violations(df, t)
    if "gld_production_daily_fact" in rows and "gld_machine_dim" in rows:
        parts.append(unreported(rows["gld_production_daily_fact"], rows["gld_machine_dim"]))
    layers = F.when(F.col("table_name").startswith("raw"), "raw").when(F.col("table_name").startswith("slv"), "silver").otherwise("gold")
    return _union(parts).select(layers.alias("layer"), "table_name", "check_name", "violations")


def failed(report: DataFrame) -> list[str]:
    """Names of failed checks; the report holds one row per check, so this is a short list."""
    bad = report.where("violations > 0").collect()
    return [f"{r['table_name']} {r['check_name']}: {r['violations']}" for r in bad]


def gold_tables(gold: Gold, dates: DataFrame, machines: DataFrame) -> dict[str, DataFrame]:
    """The five gold tables under their names."""
    return {
        "gld_date_dim": dates,
        "gld_machine_dim": machines,
        "gld_beam_plan_dim": gold.plans,
        "gld_production_daily_fact": gold.production,
        "gld_machine_status_daily_fact": gold.status,
    }

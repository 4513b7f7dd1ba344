"""Raw inputs of the mill, derived from the given tables.

The mill's own files are not available, so every raw table is a projection of a
whole given table: status events from ``events``, production and beam plans from
``lineitem``, finished beams, mail and file lists from ``orders``. Names, codes
and dates are written untidily on purpose. ``registry.sql_inputs`` states the
same projections in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.asof import keep_status_machines
from ..operators.intervals import machine_status_daily_fact
from ..plans import gold, measures, silver
from ..sources.tables import store_stage

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def folded(ts: Column) -> Column:
    """Move any date into January 2024, the month of ``events``."""
    days = F.datediff(ts.cast("date"), F.lit("1995-01-01").cast("date"))
    return F.date_add(F.lit("2024-01-01").cast("date"), days % 30)


class Mill:
    """The raw, silver and gold tables of one data folder, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    # -- raw ---------------------------------------------------------------

    @cached_property
    def raw_machine_status(self) -> DataFrame:
        user = F.col("user_id").cast("string")
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").cast("string").alias("id"),
            F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("wev"), user))
            .when(F.col("user_id") % 3 == 1, user)
            .otherwise(F.concat(F.lit("  "), user, F.lit(" ")))
            .alias("machine_id"),
            F.when(kind == "click", "Running")
            .when(kind == "error", "stopped ")
            .when(kind == "signup", "CHANGEOVER")
            .when(kind == "view", "disconnected")
            .otherwise("idle")
            .alias("status"),
            F.date_format("ts", MICROS).alias("timestamp"),
        )

    @cached_property
    def raw_textile_days(self) -> DataFrame:
        return self.table("lineitem").select(
            folded(F.col("l_shipdate")).cast("string").alias("prod_date"),
            (F.col("l_suppkey") * 2).cast("string").alias("machine_no"),
            F.concat(F.lit("lot-"), (F.col("l_partkey") % 10).cast("string")).alias("lot_no"),
            F.col("l_quantity").cast("string").alias("prod_output_m"),
            F.col("l_extendedprice").cast("string").alias("meter_reading_m"),
            F.col("l_discount").cast("string").alias("cut_length_m"),
        )

    @cached_property
    def raw_start_beam(self) -> DataFrame:
        """Every line is a plan seen in two snapshots, on its start day and a day later."""
        lot = F.col("l_partkey") % 10
        # Six start days per machine, so that some production precedes every plan.
        offset = (F.col("l_suppkey") * 7 + lot % 2 * 5 + F.col("l_orderkey") % 3 * 11) % 30
        start = F.date_add(F.lit("2024-01-01").cast("date"), offset.cast("int"))
        return self.table("lineitem").select(
            F.concat((F.col("l_suppkey") * 2).cast("string"), F.lit(".0")).alias("machine_no"),
            F.concat(F.lit(" lot-"), lot.cast("string"), F.lit(" ")).alias("lot_no"),
            F.when(F.col("l_tax") == 0, F.lit("1970-01-01")).otherwise(start.cast("string")).alias("beam_start_date"),
            F.when(F.col("l_orderkey") % 11 != 0, F.concat(F.lit("B"), (F.col("l_orderkey") % 40).cast("string"))).alias(
                "beam_no"
            ),
            F.col("l_quantity").cast("string").alias("total_yarn"),
            F.col("l_extendedprice").cast("string").alias("length"),
            F.col("l_extendedprice").cast("string").alias("planned_output"),
            F.date_add(start, 5).cast("string").alias("expected_beam_end_at"),
            start.alias("_start"),
            F.col("l_quantity").alias("_quantity"),
            # A select of its own, so that both snapshots share the texts of their line.
        ).withColumn("_k", F.explode(F.array(F.lit(0), F.lit(1)))).select(
            "machine_no",
            "lot_no",
            "beam_start_date",
            "beam_no",
            "total_yarn",
            "length",
            "planned_output",
            "expected_beam_end_at",
            (F.col("_quantity") + F.col("_k") * 10).cast("string").alias("daily_output_mts"),
            F.date_add("_start", F.col("_k")).cast("string").alias("_updated_at"),
        )

    @cached_property
    def raw_complete_beam(self) -> DataFrame:
        worker = F.concat(F.lit("w"), (F.col("o_custkey") % 50).cast("string"))
        return self.table("orders").select(
            F.col("o_orderdate").cast("date").cast("string").alias("date"),
            (F.col("o_custkey") * 2).cast("string").alias("machine"),
            F.lower("o_orderstatus").alias("shift"),
            F.concat(F.lit("lot-"), (F.col("o_orderkey") % 10).cast("string")).alias("lot"),
            F.col("o_totalprice").cast("string").alias("production_qty_kgs"),
            (F.col("o_totalprice") / 2).cast("string").alias("production_qty_mts"),
            F.when(F.col("o_custkey") % 7 != 0, worker).alias("worker"),
            F.lit("mts").alias("qty_unit"),
        )

    @cached_property
    def mail_manifest(self) -> DataFrame:
        """One attachment per order."""
        kind = F.col("o_orderkey") % 5
        return self.table("orders").select(
            F.col("o_orderkey").cast("string").alias("entry_id"),
            F.lit(1).alias("attachment_index"),
            F.when(kind == 0, "Überblick Stühle.xlsx")
            .when(kind == 1, "Kettplan Woche.XLS")
            .when(kind == 2, "Draft Überblick Stühle.xlsx")
            .when(kind == 3, "notes.pdf")
            .otherwise("report.csv")
            .alias("filename"),
            F.when(F.col("o_custkey") % 3 == 0, "Hall 2 loom report").otherwise("Other").alias("subject"),
            F.array("o_orderpriority").alias("sender_values"),
            F.timestamp_add("MINUTE", (F.col("o_orderkey") % 1440).cast("int"), F.col("o_orderdate")).alias("received_at"),
        )

    @cached_property
    def files(self) -> DataFrame:
        """Snapshot files: one workbook per order date, and an .xls twin where an urgent order exists."""
        day = F.col("o_orderdate").cast("date").cast("string")
        suffixes = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("xlsx"), F.lit("xls"))).otherwise(
            F.array(F.lit("xlsx"))
        )
        named = self.table("orders").select(day.alias("day"), F.explode(suffixes).alias("suffix"))
        return named.distinct().select(
            F.concat("day", F.lit("_start_beam."), "suffix").alias("filename"),
            F.concat(F.lit("/data/raw/"), "day", F.lit("_start_beam."), "suffix").alias("path"),
        )

    @cached_property
    def sheet_days(self) -> DataFrame:
        """What the sheet grid holds: one row per (machine number, folded day)."""
        lot = F.concat(F.lit(" lot-"), (F.col("l_partkey") % 10).cast("string"), F.lit(" "))
        return (
            self.table("lineitem")
            .select("l_suppkey", "l_quantity", "l_extendedprice", "l_discount", lot.alias("lot"),
                    F.datediff(folded(F.col("l_shipdate")), F.lit("2024-01-01").cast("date")).alias("d"))
            .groupBy("l_suppkey", "d")
            .agg(
                F.max("l_quantity").alias("output"),
                F.max("l_extendedprice").alias("meter"),
                F.max("l_discount").alias("cut"),
                F.max("lot").alias("lot"),
            )
        )

    @cached_property
    def cells(self) -> DataFrame:
        """Worksheet cells. Five sheets by machine number; the fifth is a total sheet.

        Row 2 has production headers, row 3 lot dates, data starts in row 4.
        Lot of day d is in column 5 + d, its production triple ends in column
        42 + 3d. Even days have Korean headers, odd days date cells.
        """
        group = F.col("l_suppkey") % 5
        sheet = F.when(group == 4, F.lit(" Total all")).otherwise(F.concat(F.lit("WS-"), group.cast("string")))
        where = [F.lit("textile_days.xlsx").alias("source_file"), sheet.alias("sheet_name")]

        def cell(row: Column, col: Column, value: Column, kind: str | Column) -> Column:
            kind = F.lit(kind) if isinstance(kind, str) else kind
            return F.struct(
                row.cast("int").alias("row_idx"), col.cast("int").alias("col_idx"),
                value.alias("value"), kind.alias("value_type"),
            )

        days = store_stage(self.sheet_days, "days")
        row, d = F.col("l_suppkey") + 4, F.col("d")
        c = 42 + d * 3
        body = F.array(
            cell(row, d + 5, F.col("lot"), "s"),
            cell(row, c - 2, F.col("meter").cast("string"), "n"),
            cell(row, c - 1, F.col("cut").cast("string"), "n"),
            cell(row, c, F.col("output").cast("string"), "n"),
        )
        day = F.date_add(F.lit("2024-01-01").cast("date"), d)
        korean = F.format_string("%d월 %d일", F.month("_day"), F.dayofmonth("_day"))
        even = d % 2 == 0
        heads = F.array(
            cell(F.lit(3), d + 5, F.col("_day").cast("string"), "d"),
            cell(F.lit(2), c - 2, F.when(even, korean).otherwise(F.col("_day").cast("string")),
                 F.when(even, F.lit("s")).otherwise(F.lit("d"))),
            cell(F.lit(2), c, F.lit("생산량 (m)"), "s"),
        )
        machine = F.when(F.col("l_suppkey") % 7 == 6, F.concat(F.lit("M-"), F.col("l_suppkey").cast("string"))).otherwise(
            F.concat(F.lit(" "), F.col("l_suppkey").cast("string"), F.lit(".0"))
        )
        parts = [
            days.select(*where, F.explode(body).alias("cell")),
            days.withColumn("_day", day).select(*where, F.explode(heads).alias("cell")).distinct(),
            days.select(*where, cell(row, F.lit(0), machine, "s").alias("cell")).distinct(),
            days.select(*where, cell(F.lit(0), F.lit(1), F.lit("2024-01-31 00:00:00"), "d").alias("cell")).distinct(),
        ]
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        return store_stage(merged.select("source_file", "sheet_name", "cell.*"), "cells")

    # -- silver and gold ---------------------------------------------------

    @cached_property
    def slv_machine_status(self) -> DataFrame:
        return silver.machine_status(self.raw_machine_status)

    @cached_property
    def slv_textile_days(self) -> DataFrame:
        return silver.textile_days(self.raw_textile_days)

    @cached_property
    def slv_start_beam(self) -> DataFrame:
        return silver.start_beam(self.raw_start_beam)

    @cached_property
    def slv_complete_beam(self) -> DataFrame:
        return silver.complete_beam(self.raw_complete_beam)

    @cached_property
    def gold(self) -> LazyGold:
        return LazyGold(self)

    @cached_property
    def stored_gold(self) -> StoredGold:
        return StoredGold(self.gold)

    @cached_property
    def summary(self) -> measures.Summary:
        """Both facts by (date, machine), stored for reports that ask it many things."""
        return measures.stored_summary(self.gold.measured)

    # Rows of silver tables without amounts, repeats included: what dimensions and checks of keys read.

    @cached_property
    def textile_keys(self) -> DataFrame:
        return silver.textile_days_typed(self.raw_textile_days, ())

    @cached_property
    def textile_machines(self) -> DataFrame:
        return silver.textile_machines(self.raw_textile_days)

    @cached_property
    def start_beam_keys(self) -> DataFrame:
        return silver.start_beam_typed(self.raw_start_beam, values=())

    @cached_property
    def keys(self) -> StoredKeys:
        return StoredKeys(self)

    @property
    def produced(self) -> DataFrame:
        """Dates and machines of the production fact, which flag and plan match leave as they are."""
        return keep_status_machines(self.textile_keys, gold.status_machines(self.slv_machine_status)).select("date", "machine")

    @cached_property
    def machine_dim(self) -> DataFrame:
        """Of the machines with production it keeps those that report status, so ``produced`` need not."""
        status = gold.status_machines(self.slv_machine_status)
        return gold.machine_dim(status, self.textile_machines, silver.start_beam_machines(self.raw_start_beam))

    @cached_property
    def date_dim(self) -> DataFrame:
        return gold.date_dim(self.produced, self.gold.status, self.start_beam_keys)


class LazyGold:
    """The facts and plans of a mill, each built when first asked for.

    The plans are read twice by the production fact (start days and as-of
    match), so that fact reads them as the pipeline does: from storage. It needs
    their key columns only, and the measures the planned daily output besides.
    """

    def __init__(self, mill: Mill):
        self._mill = mill

    @cached_property
    def status(self) -> DataFrame:
        return machine_status_daily_fact(self._mill.slv_machine_status)

    @cached_property
    def plans(self) -> DataFrame:
        """The latest version of all versions is the latest of one row per snapshot."""
        return gold.beam_plan_dim(silver.start_beam_typed(self._mill.raw_start_beam))

    @cached_property
    def plan_keys(self) -> DataFrame:
        return store_stage(gold.beam_plan_keys(self._mill.start_beam_keys), "plan_keys")

    @cached_property
    def plan_starts(self) -> DataFrame:
        """The plans that production can meet: what the fact reads, twice."""
        return store_stage(gold.plan_starts(silver.start_beam_last(self._mill.raw_start_beam)), "plan_starts")

    @cached_property
    def daily_plans(self) -> DataFrame:
        """The same with their planned daily output."""
        return store_stage(gold.plan_starts(silver.start_beam_last(self._mill.raw_start_beam, "daily_output_mts")), "daily_plans")

    @cached_property
    def machines(self) -> DataFrame:
        return gold.status_machines(self._mill.slv_machine_status)

    @cached_property
    def production(self) -> DataFrame:
        return gold.production_daily_fact(self._mill.slv_textile_days, self.machines, self.plan_starts, in_force=True)

    @cached_property
    def production_keys(self) -> DataFrame:
        """The production fact without amounts."""
        return gold.production_daily_fact(self._mill.textile_keys.distinct(), self.machines, self.plan_starts, in_force=True)

    @cached_property
    def measured(self) -> gold.Gold:
        """What measures and reports read: facts and plans without amounts that none of them uses. The status fact is stored, since it tells the machines too."""
        output = silver.textile_output(self._mill.raw_textile_days)
        status = store_stage(self.status, "status")
        return gold.Gold(status, gold.production_daily_fact(output, status, self.daily_plans, in_force=True), self.daily_plans)


class StoredGold:
    """What measures and reports read, all from storage, for those that read a fact several times."""

    def __init__(self, lazy: LazyGold):
        self._lazy = lazy

    @property
    def plans(self) -> DataFrame:
        return self._lazy.daily_plans

    @cached_property
    def status(self) -> DataFrame:
        return self._lazy.measured.status

    @cached_property
    def production(self) -> DataFrame:
        return store_stage(self._lazy.measured.production, "production")


class StoredKeys:
    """Silver and gold tables without amounts, each written once and read by the next layer from storage, for checks of keys and of filled columns.

    A silver table that keeps one row per key has the rows of its distinct keys.
    """

    def __init__(self, mill: Mill):
        self._mill = mill

    @cached_property
    def events(self) -> DataFrame:
        return store_stage(self._mill.slv_machine_status, "events")

    @cached_property
    def complete_beam(self) -> DataFrame:
        return silver.complete_beam(self._mill.raw_complete_beam, ())

    @cached_property
    def textile(self) -> DataFrame:
        return store_stage(self._mill.textile_keys.distinct(), "textile_keys")

    @cached_property
    def start_beam(self) -> DataFrame:
        return store_stage(self._mill.start_beam_keys.distinct(), "start_beam_keys")

    @cached_property
    def plans(self) -> DataFrame:
        return store_stage(gold.beam_plan_keys(self.start_beam), "plan_keys")

    @cached_property
    def plan_starts(self) -> DataFrame:
        return store_stage(gold.plan_starts(self.start_beam), "plan_starts")

    @cached_property
    def status(self) -> DataFrame:
        return store_stage(machine_status_daily_fact(self.events), "status")

    @cached_property
    def production(self) -> DataFrame:
        return store_stage(gold.production_daily_fact(self.textile, self.status, self.plan_starts, in_force=True), "production_keys")

    @property
    def silver(self) -> dict[str, DataFrame]:
        return {
            "slv_machine_status": self.events, "slv_complete_beam": self.complete_beam, "slv_textile_days": self.textile, "slv_start_beam": self.start_beam,
        }

"""Raw string tables -> typed, cleaned, de-duplicated silver tables.

Each function gives the rows of one load. Insert-only merging with what a table
already holds is in ``operators.incremental``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import after_epoch, to_bigint, to_date, to_double, to_timestamp
from ..functions.cleaning import clean_code, clean_text, machine_of_code
from ..operators.versions import keep_best, keep_one_per_snapshot

# Codes are cleaned in a first select, so that the machine rules read the cleaned
# code once. A code is blank where the machine or lot made of it is NULL.


def dealt(raw: DataFrame, *columns: str, by: Sequence[str] = ()) -> DataFrame:
    """The columns to parse, dealt over the shuffle partitions by their text.

    Parsing is most of the work of this layer, and the splits of a file say nothing about its share: a large row group is one task. The text of all columns
    decides, so a machine, lot or day with very many rows is spread as well. With ``by`` some columns decide: what has them equal meets before the next shuffle.
    """
    return raw.select(*columns).repartition(*(by or columns))


def parsed(rows: DataFrame, condition: Column, *columns: Column | str) -> DataFrame:
    """Select parsed columns and keep the rows where ``condition`` holds for them.

    The select names its task and the condition reads that name, so the condition stays above the select, behind the exchange: moved below, every value that it
    reads would be parsed a second time.
    """
    return rows.select(*columns, F.spark_partition_id().alias("_task")).where((F.col("_task") >= 0) & condition).drop("_task")


def machine_status(raw: DataFrame) -> DataFrame:
    """Status events. An unreadable id, machine or time drops the row; status may be NULL."""
    rows = dealt(raw, "id", "machine_id", "status", "timestamp")
    coded = rows.select("id", clean_code(F.col("machine_id")).alias("code"), "status", "timestamp")
    return parsed(
        coded,
        F.col("machine").isNotNull() & F.col("id").isNotNull() & F.col("timestamp").isNotNull(),
        to_bigint(F.col("id")).alias("id"),
        machine_of_code(F.col("code")).alias("machine"),
        F.lower(clean_text(F.col("status"))).alias("status"),
        to_timestamp(F.col("timestamp")).alias("timestamp"),
    ).withColumn("date", F.col("timestamp").cast("date"))


# Columns of a finished beam beside its day, machine and lot, and how each is read.
BEAM_VALUES = {
    "shift": clean_code, "production_qty_kgs": to_double, "production_qty_mts": to_double, "worker": clean_text, "qty_unit": clean_code,
}


def complete_beam(raw: DataFrame, values: Sequence[str] = tuple(BEAM_VALUES)) -> DataFrame:
    """Finished beams; repeats inside one load are kept. No text is moved or parsed for a column that ``values`` leaves out."""
    rows = dealt(raw, "date", "machine", "lot", *values)
    own = {name: BEAM_VALUES[name](F.col(name)).alias(name) for name in values}
    coded = rows.withColumns({"code": clean_code(F.col("machine")), "lot_code": clean_code(F.col("lot"))})
    return parsed(
        coded,
        F.col("machine").isNotNull() & F.col("lot").isNotNull() & F.col("date").isNotNull(),
        to_date(F.col("date")).alias("date"),
        machine_of_code(F.col("code")).alias("machine"),
        *[own[name] for name in values if name == "shift"],
        F.col("lot_code").alias("lot"),
        *[own[name] for name in values if name != "shift"],
    )


# Amounts of a production row and the raw text of each.
TEXTILE_VALUES = {"production_qty_mts": "prod_output_m", "meter_reading_m": "meter_reading_m", "cut_length_m": "cut_length_m"}


def textile_days_typed(raw: DataFrame, values: Sequence[str] = tuple(TEXTILE_VALUES)) -> DataFrame:
    """Daily production, typed and filtered, before the best row per key is kept. No text is moved or parsed for amounts that ``values`` leaves out."""
    rows = dealt(raw, "prod_date", "machine_no", "lot_no", *[TEXTILE_VALUES[name] for name in values])
    return _textile_typed(rows, *[to_double(F.col(TEXTILE_VALUES[name])).alias(name) for name in values])


def _textile_typed(rows: DataFrame, *amounts: Column | str) -> DataFrame:
    coded = rows.withColumns({"code": clean_code(F.col("machine_no")), "lot_code": clean_code(F.col("lot_no"))})
    return parsed(
        coded,
        F.col("machine").isNotNull() & F.col("lot").isNotNull() & F.col("date").isNotNull(),
        to_date(F.col("prod_date")).alias("date"),
        machine_of_code(F.col("code")).alias("machine"),
        F.col("lot_code").alias("lot"),
        *amounts,
    )


def textile_machines(raw: DataFrame) -> DataFrame:
    """Machines of ``textile_days``. Rows meet by the text of their machine before anything is moved; spellings of a machine are left apart."""
    kept = clean_code(F.col("lot_no")).isNotNull() & to_date(F.col("prod_date")).isNotNull()
    return _machines(raw, kept)


def _machines(raw: DataFrame, kept: Column, prefixed: bool = True) -> DataFrame:
    """Machines with a row for which ``kept`` holds."""
    seen = raw.groupBy("machine_no").agg(F.bool_or(kept).alias("kept")).where("kept")
    coded = seen.select(clean_code(F.col("machine_no")).alias("code"))
    return parsed(coded, F.col("machine").isNotNull(), machine_of_code(F.col("code"), prefixed=prefixed).alias("machine"))


def textile_days(raw: DataFrame) -> DataFrame:
    """The best row of each (date, machine, lot), in the order of ``keep_best``.

    The rows of a key meet as text before they are moved, so a key is parsed once for all of them; then the best of each spelling meet.
    """
    key, best = ("prod_date", "machine_no", "lot_no"), F.max(F.struct(*TEXTILE_VALUES)).alias("best")
    read = raw.select(*key, *[to_double(F.col(text)).alias(name) for name, text in TEXTILE_VALUES.items()])
    # The hash in front settles nearly all comparisons of the sorts by one number.
    spelled = read.groupBy(F.xxhash64(*key).alias("_hash"), *key).agg(best)
    days = ("date", "machine", "lot")
    kept = _textile_typed(spelled, "best.*").groupBy(F.xxhash64(*days).alias("_hash"), *days).agg(best)
    return kept.select(*days, "best.*")


def textile_output(raw: DataFrame) -> DataFrame:
    """``textile_days`` without meter reading and cut length, which only choose among rows of equal production.

    Repeats of a key meet as text before they are moved, so a key is parsed once for all of them; spellings of one key meet afterwards.
    """
    most = raw.groupBy("prod_date", "machine_no", "lot_no").agg(F.max(to_double(F.col("prod_output_m"))).alias("production_qty_mts"))
    return _textile_typed(most, "production_qty_mts").groupBy("date", "machine", "lot").agg(F.max("production_qty_mts").alias("production_qty_mts"))


# Columns of a beam plan beside its key and snapshot time: the raw text and how it is read.
PLAN_VALUES = {
    "total_yarn": ("total_yarn", to_double),
    "length_m": ("length", to_double),
    "planned_output": ("planned_output", to_double),
    "expected_beam_end_at": ("expected_beam_end_at", to_timestamp),
    "daily_output_mts": ("daily_output_mts", to_double),
}


def start_beam_typed(raw: DataFrame, incremental: bool = False, values: Sequence[str] = tuple(PLAN_VALUES)) -> DataFrame:
    """Beam plans of one snapshot, typed and filtered.

    ``incremental`` keeps only plans that start on the snapshot's own date. No
    text is moved or parsed for a column that ``values`` leaves out.
    """
    texts = [PLAN_VALUES[name][0] for name in values]
    key = ("machine_no", "lot_no", "beam_no", "beam_start_date")
    # The snapshots of a plan are cut to one row where they meet.
    rows = dealt(raw, *key, *texts, "_updated_at", by=key)
    coded = rows.withColumns({"code": clean_code(F.col("machine_no")), "lot_code": clean_code(F.col("lot_no"))})
    typed = (
        parsed(
            coded,
            # A plan without a start date or snapshot time is not kept.
            F.col("machine").isNotNull() & F.col("lot").isNotNull() & after_epoch(F.col("started_at")) & F.col("source_updated_at").isNotNull(),
            to_timestamp(F.col("beam_start_date")).alias("started_at"),
            machine_of_code(F.col("code"), prefixed=False).alias("machine"),
            F.col("lot_code").alias("lot"),
            clean_text(F.col("beam_no")).alias("beam_no"),
            *[PLAN_VALUES[name][1](F.col(PLAN_VALUES[name][0])).alias(name) for name in values],
            to_timestamp(F.col("_updated_at")).alias("source_updated_at"),
        )
        .withColumn("started_at", F.col("started_at").cast("date"))
        .withColumnRenamed("started_at", "beam_start_date")
    )
    if incremental:
        typed = typed.where(F.col("beam_start_date") == F.col("source_updated_at").cast("date"))
    return typed


def start_beam_newest(raw: DataFrame, value: str | None = None) -> DataFrame:
    """The latest snapshot of each spelling of a plan's key, typed and filtered: key columns, snapshot time and the most of ``value`` in that snapshot.

    The snapshots of a plan meet as text, so its key is parsed once for all of them. Spellings that mean one plan are left to what reads this.
    """
    values = (value,) if value else ()
    key = ("machine_no", "lot_no", "beam_no", "beam_start_date")
    rows = dealt(raw, *key, *[PLAN_VALUES[name][0] for name in values], "_updated_at", by=key)
    seen = parsed(
        rows,
        F.col("source_updated_at").isNotNull(),
        *key,
        to_timestamp(F.col("_updated_at")).alias("source_updated_at"),
        *[PLAN_VALUES[name][1](F.col(PLAN_VALUES[name][0])).alias(f"_{name}") for name in values],
    )
    at = F.col("source_updated_at")
    if value:
        # Times and numbers are aggregated by hash, where a struct of them would be sorted: first the most of a snapshot, then the latest snapshot.
        snapshots = seen.groupBy(*key, "source_updated_at").agg(F.max(f"_{value}").alias(f"_{value}"))
        newest = snapshots.groupBy(*key).agg(F.max(at).alias("source_updated_at"), F.max_by(f"_{value}", at).alias(f"_{value}"))
    else:
        newest = seen.groupBy(*key).agg(F.max(at).alias("source_updated_at"))
    return _plans_typed(newest.withColumn("beam_no", clean_text(F.col("beam_no"))), values)


def _plans_typed(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """Rows of raw machine, lot and start day with all else parsed already, typed and filtered."""
    coded = rows.withColumns({"code": clean_code(F.col("machine_no")), "lot_code": clean_code(F.col("lot_no"))})
    return (
        parsed(
            coded,
            F.col("machine").isNotNull() & F.col("lot").isNotNull() & after_epoch(F.col("started_at")),
            to_timestamp(F.col("beam_start_date")).alias("started_at"),
            machine_of_code(F.col("code"), prefixed=False).alias("machine"),
            F.col("lot_code").alias("lot"),
            "beam_no",
            *[F.col(f"_{name}").alias(name) for name in values],
            "source_updated_at",
        )
        .withColumn("started_at", F.col("started_at").cast("date"))
        .withColumnRenamed("started_at", "beam_start_date")
    )


def start_beam_last(raw: DataFrame, value: str | None = None) -> DataFrame:
    """The last beam of each spelling of a (machine, lot, start day), in its latest snapshot: what ``gold.plan_starts`` keeps of each spelling, typed and filtered.

    Plans are cut to their last beam where they are read, before anything is moved: what is shuffled, and parsed for machine, lot and day, is bounded by start
    days and not by beams or snapshots. The order is the one of ``plan_starts``: last beam (none is the last), latest snapshot, most of ``value``.
    """
    values = (value,) if value else ()
    key = ("machine_no", "lot_no", "beam_start_date")
    seen = parsed(
        raw,
        F.col("source_updated_at").isNotNull(),
        *key,
        clean_text(F.col("beam_no")).alias("beam_no"),
        to_timestamp(F.col("_updated_at")).alias("source_updated_at"),
        *[PLAN_VALUES[name][1](F.col(PLAN_VALUES[name][0])).alias(f"_{name}") for name in values],
    )
    last = F.struct(F.col("beam_no").isNull().alias("unnumbered"), "beam_no", "source_updated_at", *[f"_{name}" for name in values])
    # The hash in front settles nearly all comparisons of the sort by one number.
    kept = seen.groupBy(F.xxhash64(*key).alias("_hash"), *key).agg(F.max(last).alias("last")).select(*key, "last.*")
    return _plans_typed(kept, values)


def start_beam_machines(raw: DataFrame) -> DataFrame:
    """Machines of ``start_beam``, as in ``textile_machines``."""
    started, updated = to_timestamp(F.col("beam_start_date")), to_timestamp(F.col("_updated_at"))
    kept = clean_code(F.col("lot_no")).isNotNull() & after_epoch(started) & updated.isNotNull()
    return _machines(raw, kept, prefixed=False)


def start_beam(raw: DataFrame, incremental: bool = False) -> DataFrame:
    return keep_one_per_snapshot(start_beam_typed(raw, incremental))

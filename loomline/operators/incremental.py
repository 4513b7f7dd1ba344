"""Incremental loads: high-water marks, schema alignment, insert-only merges, replay.

Late rows are lost by design: a row at or below the stored maximum is never
taken, and a key once written is never corrected.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import to_bigint, to_timestamp
from ..functions.naming import match_columns

_PARSERS = {"bigint": to_bigint, "timestamp": to_timestamp}


def typed_key(column: str, kind: str) -> Column:
    """The incremental column parsed as 'bigint' or 'timestamp'."""
    return _PARSERS[kind](F.col(column))


def column_named(df: DataFrame, name: str) -> str:
    """The column of that name, ignoring case."""
    for column in df.columns:
        if column.casefold() == name.casefold():
            return column
    raise ValueError(f"Missing column: {name}")


def highwater_mark(target: DataFrame, column: str, kind: str) -> DataFrame:
    """One row ``latest``: the largest readable key, NULL when there is none."""
    return target.agg(F.max(typed_key(column_named(target, column), kind)).alias("latest"))


def incremental_rows(source: DataFrame, target: DataFrame, column: str, kind: str) -> DataFrame:
    """Source rows strictly above the target's mark.

    Without a mark everything is kept; with one, unreadable keys fall out.
    """
    latest = highwater_mark(target, column, kind).scalar()
    return source.where(latest.isNull() | (typed_key(column_named(source, column), kind) > latest))


def above_stored_id(source: DataFrame, stored: DataFrame, column: str = "id") -> DataFrame:
    """Rows of a raw table whose id is above the largest id already in silver."""
    largest = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("largest")).scalar()
    return source.where(to_bigint(F.col(column)) > largest)


def all_string(df: DataFrame) -> DataFrame:
    """Every column as text, as raw tables store them."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Ordered union of columns; what a frame lacks is NULL; all text."""
    merged = all_string(frames[0])
    for frame in frames[1:]:
        merged = merged.unionByName(all_string(frame), allowMissingColumns=True)
    return merged


def with_stored_names(source: DataFrame, stored: Sequence[str]) -> DataFrame:
    """Rename source columns to the stored spelling; new ones keep their name."""
    _, mapping = match_columns(stored, source.columns)
    return source.withColumnsRenamed({old: new for old, new in mapping.items() if old != new})


def evolve_union(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target and source under one schema, columns matched without regard to case."""
    return union_frames([target, with_stored_names(source, target.columns)])


def append_load(target: DataFrame, source: DataFrame, column: str, kind: str) -> DataFrame:
    """The target after an append: its rows and the source rows above its mark."""
    return evolve_union(target, incremental_rows(source, target, column, kind))


def source_sort(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order rows by those of ``columns`` that exist; range-partitioned, so files stay sorted."""
    present = [c for c in columns if c in df.columns]
    return df.orderBy(*present) if present else df


def new_keys(source: DataFrame, stored: DataFrame, keys: Sequence[str], null_safe: Sequence[str] = ()) -> DataFrame:
    """Source rows whose key is not stored yet.

    Keys in ``null_safe`` treat NULL as equal to NULL; a NULL in any other key
    never matches, so such rows are added again.
    """
    old = stored.select(*[F.col(k).alias(f"_{k}") for k in (*keys, *null_safe)])
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    same += [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in null_safe]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return source.join(old, condition, "left_anti")


def stored_days(stored: DataFrame, load: DataFrame, day: str) -> DataFrame:
    """Stored rows of the days that ``load`` has rows of; of a table partitioned by ``day`` only these partitions are opened."""
    days = load.agg(F.collect_set(day)).scalar()
    return stored.where(F.array_contains(days, F.col(day)))


TEXTILE_KEY = ("date", "machine", "lot")
COMPLETE_BEAM_KEY, COMPLETE_BEAM_NULL_SAFE = ("date", "machine", "lot"), ("shift", "worker")
START_BEAM_KEY = ("machine", "lot", "beam_no", "beam_start_date", "source_updated_at")


def rows_before(stored: DataFrame, day: dt.date) -> DataFrame:
    """What a replay of ``day`` keeps: snapshots taken before it."""
    return stored.where(F.col("source_updated_at").cast("date") < F.lit(day))


def replay_mode(stored: DataFrame, day: dt.date) -> DataFrame:
    """One row ``mode``: 'incremental' when older snapshots exist, else 'baseline'."""
    older = F.coalesce(F.bool_or(F.col("source_updated_at").cast("date") < F.lit(day)), F.lit(False))
    return stored.agg(F.when(older, "incremental").otherwise("baseline").alias("mode"))

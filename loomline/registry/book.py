"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .inputs import Mill
from .shape import shaped, sql_shaped
from .sql_inputs import with_tables


@dataclass(frozen=True)
class Entry:
    build: Callable[[Mill], DataFrame]
    sql: str | None
    digits: int = 6

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return shaped(self.build(Mill(spark, folder)), self.digits)


ENTRIES: dict[str, Entry] = {}


def query(key: str, sql: str | None, dates: str = "", stamps: str = "", doubles: str = "", digits: int = 6):
    """Register a function of the mill under ``key`` with its SQL and that SQL's column kinds."""

    def add(build: Callable[[Mill], DataFrame]):
        if key in ENTRIES:
            raise ValueError(f"query {key} is registered twice")
        text = with_tables(sql_shaped(sql, dates, stamps, doubles, digits)) if sql else None
        ENTRIES[key] = Entry(build, text, digits)
        return build

    return add

"""Source registry: how each raw table is loaded."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .operators import sheets

APPEND, REPLACE = "append", "replace"


@dataclass(frozen=True)
class RawSource:
    """``extract`` turns worksheet cells into rows; status events have none."""

    table: str
    pattern: str = ""
    extract: Callable[[DataFrame], DataFrame] | None = None
    strategy: str = REPLACE
    incremental_column: str = ""
    incremental_kind: str = "timestamp"
    sort: tuple[str, ...] = ()


# Tables, file patterns and load rules.
COMPLETE_BEAM = RawSource(
    "raw_complete_beam", "*complete_beam*", sheets.complete_beam_rows, APPEND, "date", "timestamp",
    ("date", "machine", "lot", "shift", "worker"),
)
START_BEAM = RawSource("raw_start_beam", "*start_beam*", sheets.start_beam_rows, REPLACE)
TEXTILE_DAYS = RawSource(
    "raw_textile_days", "*textile_days*", sheets.textile_day_rows, APPEND, "prod_date", "timestamp", ("prod_date", "machine_no"),
)
MACHINE_STATUS = RawSource("raw_machine_status", strategy=APPEND, incremental_column="id", incremental_kind="bigint", sort=("id",))

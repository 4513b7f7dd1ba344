"""Calendar expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casting import to_date

DAY_SECONDS = 86_400

# The weekly planned shutdown, in seconds after midnight.
# Sunday 05:30 to midnight and Monday midnight to 06:30.
SUNDAY_SHUTDOWN = (19_800, 86_400)
MONDAY_SHUTDOWN = (0, 23_400)

# Fixed pattern: month and day in a Korean date header, e.g. "1월5일".
KOREAN_MONTH_DAY = r"(\d{1,2})월(\d{1,2})일"


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ.

    Differences of this count second boundaries, so they add up exactly
    wherever an interval is cut.
    """
    return F.unix_timestamp(ts)


def day_start_seconds(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") * DAY_SECONDS


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def seconds_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ without a zone."""
    day = F.date_from_unix_date(F.floor(seconds / DAY_SECONDS).cast("int"))
    return F.timestamp_add("SECOND", F.pmod(seconds, F.lit(DAY_SECONDS)).cast("int"), midnight(day))


def shutdown_bounds(day: Column) -> tuple[Column, Column]:
    """Planned-shutdown start and end of a date in epoch seconds; NULL on working days."""
    base, weekday = day_start_seconds(day), F.weekday(day)
    sunday, monday = weekday == 6, weekday == 0
    start = F.when(sunday, base + SUNDAY_SHUTDOWN[0]).when(monday, base + MONDAY_SHUTDOWN[0])
    end = F.when(sunday, base + SUNDAY_SHUTDOWN[1]).when(monday, base + MONDAY_SHUTDOWN[1])
    return start, end


def shutdown_overlap(start: Column, end: Column) -> Column:
    """Seconds of [start, end) (epoch seconds within one day) inside the planned shutdown.

    Counted from the week's Monday, where the shutdown is one stretch at the
    beginning and one at the end. 1970 began on a Thursday.
    """
    from_monday = F.pmod(start + 3 * DAY_SECONDS, F.lit(7 * DAY_SECONDS))
    until = from_monday + (end - start)
    early = F.least(until, F.lit(MONDAY_SHUTDOWN[1])) - from_monday
    late = until - F.greatest(from_monday, F.lit(6 * DAY_SECONDS + SUNDAY_SHUTDOWN[0]))
    return F.greatest(early, late, F.lit(0))


def resolve_year(sheet_year: Column, sheet_month: Column, month: Column) -> Column:
    """Year of a header month on a sheet that may reach over New Year."""
    gap = month - sheet_month
    return F.when(gap >= 6, sheet_year - 1).when(gap <= -6, sheet_year + 1).otherwise(sheet_year)


def header_month_day(header: Column, value_type: Column) -> tuple[Column, Column]:
    """Month and day of a production header: a date cell, else a Korean month-day text."""
    as_date = F.when(value_type == "d", to_date(header))
    text = F.replace(header, F.lit(" "), F.lit(""))
    month = F.nullif(F.regexp_extract(text, KOREAN_MONTH_DAY, 1), F.lit("")).cast("int")
    day = F.nullif(F.regexp_extract(text, KOREAN_MONTH_DAY, 2), F.lit("")).cast("int")
    return F.coalesce(F.month(as_date), month), F.coalesce(F.dayofmonth(as_date), day)


def production_date(
    header: Column, value_type: Column, sheet_year: Column, sheet_month: Column
) -> Column:
    """Header -> DATE in the resolved year; an impossible day is NULL."""
    month, day = header_month_day(header, value_type)
    year = resolve_year(sheet_year, sheet_month, month)
    return F.format_string("%04d-%02d-%02d", year, month, day).try_cast("date")


def local_date(ts: Column, zone: str = "Asia/Bangkok") -> Column:
    """Date of a UTC wall-clock TIMESTAMP_NTZ in the mill's zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts).cast("date")

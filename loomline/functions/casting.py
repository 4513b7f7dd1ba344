"""Safe casts from raw strings. A value that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: what a raw date or number may look like. They narrow Spark's
# own parsing, which also takes a bare year, an hour without minutes and Java
# numbers such as "1d" or "0x1p3". One match per value keeps the generated code
# small: a select over many columns must stay below the size the JVM compiles.
_DATE_OR_TIMESTAMP = r"^\d{4,6}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}.*)?\z"
_JAVA_NUMBER = r"[0-9.][dDfF]\s*\z|[xX]"


def to_timestamp(value: Column) -> Column:
    """String -> TIMESTAMP_NTZ; a zone suffix keeps the wall-clock time.

    Year first, parts joined by dashes or slashes.
    """
    text = F.replace(value.cast("string"), F.lit("/"), F.lit("-"))
    # Most values are plain days. One that prints as it was read needs no pattern.
    day = text.try_cast("date")
    return F.when((F.length(text) == 10) & (day.cast("string") == text), day.cast("timestamp_ntz")).when(text.rlike(_DATE_OR_TIMESTAMP), text.try_cast("timestamp_ntz"))


def to_date(value: Column) -> Column:
    """String -> DATE through the timestamp rules."""
    return to_timestamp(value).cast("date")


def to_double(value: Column) -> Column:
    """String -> DOUBLE."""
    text = value.cast("string")
    # The pattern is only tried on a text that holds one of its letters.
    lettered = text.contains("d") | text.contains("D") | text.contains("f") | text.contains("F") | text.contains("x") | text.contains("X")
    return F.when(~(lettered & text.rlike(_JAVA_NUMBER)), text.try_cast("double"))


def to_bigint(value: Column) -> Column:
    """String -> BIGINT, halves rounded away from zero ('100.5' -> 101)."""
    return F.round(value.cast("string").try_cast("decimal(38,6)")).try_cast("bigint")


def drop_epoch(value: Column) -> Column:
    """Timestamps up to 1970-01-02 are empty cells read as numbers: NULL them."""
    return F.when(after_epoch(value), value)


def after_epoch(value: Column) -> Column:
    return value > F.lit("1970-01-02").cast("timestamp_ntz")

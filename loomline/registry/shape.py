"""Shape of registered results: dates as text, doubles to six decimals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .inputs import MICROS


def shaped(df: DataFrame, digits: int = 6) -> DataFrame:
    """Both engines add doubles in their own order and print dates their own way."""

    def column(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, MICROS)
        elif isinstance(field.dataType, T.DoubleType):
            col = F.round(col, digits)
        return col.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def sql_shaped(sql: str, dates: str = "", stamps: str = "", doubles: str = "", digits: int = 6) -> str:
    """The same for a statement: name its date, timestamp and double columns."""
    changes = [f"cast({c} as varchar) as {c}" for c in dates.split()]
    changes += [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') as {c}" for c in stamps.split()]
    changes += [f"round({c}, {digits}) as {c}" for c in doubles.split()]
    if not changes:
        return sql
    return f"select * replace ({', '.join(changes)}) from ({sql})"

"""Text, code and machine-name cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(value: Column) -> Column:
    """Trim spaces; blank becomes NULL."""
    text = F.trim(value.cast("string"))
    return F.when(text != "", text)


def clean_code(value: Column) -> Column:
    """Upper-case ``clean_text``."""
    return F.upper(clean_text(value))


def clean_machine_no(value: Column) -> Column:
    """Machine number from a sheet cell: drop one trailing '.0', trim, blank -> NULL."""
    return clean_text(F.regexp_replace(value.cast("string"), r"\.0\z", ""))


def _loom_code(digits: Column) -> Column:
    """Padded to three digits; longer numbers stay whole."""
    return F.concat(F.lit("WEV"), F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0")))


def machine_of_code(code: Column, decimals: bool = True, prefixed: bool = True) -> Column:
    """``standardize_machine`` for a value that went through ``clean_code`` already."""
    plain = r"^[0-9]+(\.0)?\z" if decimals else r"^[0-9]+\z"
    # Digits of any length, without the decimals and the leading zeros of a number.
    whole = F.when(code.endswith(".0"), F.substr(code, F.lit(1), F.length(code) - 2)).otherwise(code) if decimals else code
    result = F.when(code.rlike(plain), _loom_code(F.ltrim(whole, F.lit("0"))))
    if prefixed:
        result = result.when(code.rlike(r"^WEV[0-9]+\z"), _loom_code(F.substr(code, F.lit(4))))
    return result.otherwise(code)


def standardize_machine(value: Column, decimals: bool = True, prefixed: bool = True) -> Column:
    """One spelling per machine: '7', '7.0', 'wev7' -> 'WEV007'; 'm-3' -> 'M-3'.

    ``decimals`` also reads '100.0' as machine 100 (numbers that passed through
    a float column); switch it off for sources whose ids never do. ``prefixed``
    pads the digits of an id that already starts with WEV.
    """
    return machine_of_code(clean_code(value), decimals, prefixed)

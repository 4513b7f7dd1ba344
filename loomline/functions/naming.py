"""Column-name rules for sheet headers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def header_name(parts: Column) -> Column:
    """Array of header cells (top to bottom) -> one normalized column name.

    Blank and placeholder parts are dropped, then a trailing single capital
    (a spreadsheet column letter) when something else remains. Brackets and
    hashes vanish, separators become single underscores, the rest is lower-cased.
    """
    trimmed = F.transform(F.coalesce(parts, F.array().cast("array<string>")), lambda p: F.trim(p))
    kept = F.filter(trimmed, lambda p: p.isNotNull() & (p != "") & ~p.startswith("Unnamed"))
    letter_last = (F.size(kept) > 1) & F.element_at(kept, -1).rlike(r"^[A-Z]\z")
    kept = F.when(letter_last, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
    return plain_name(F.concat_ws("_", kept))


def plain_name(text: Column) -> Column:
    """Single header text -> normalized name; an empty result is 'unnamed'."""
    text = F.regexp_replace(F.trim(text), r"[()#]+", "")
    text = F.regexp_replace(text, r"[\s/\\\-._]+", "_")
    text = F.lower(F.regexp_replace(text, r"^_+|_+\z", ""))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("unnamed"))


def suffixed(name: Column, nth: Column) -> Column:
    """Second and later columns of one name get _2, _3, ..."""
    return F.when(nth > 1, F.concat_ws("_", name, nth.cast("string"))).otherwise(name)


def match_columns(existing: Sequence[str], incoming: Sequence[str]) -> tuple[list[str], dict[str, str]]:
    """Case-insensitive schema match.

    Returns the widened column list and, per incoming column, the name to use.
    """
    by_key = {name.casefold(): name for name in existing}
    widened, mapping = list(existing), {}
    for name in incoming:
        if name.casefold() not in by_key:
            by_key[name.casefold()] = name
            widened.append(name)
        mapping[name] = by_key[name.casefold()]
    return widened, mapping

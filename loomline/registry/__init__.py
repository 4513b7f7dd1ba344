"""Queries over the given test tables, with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

MODULES = ("silver_gold", "measure_queries", "load_queries", "quality_queries")


def load_entries():
    """All registered queries by key."""
    from .book import ENTRIES

    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return ENTRIES

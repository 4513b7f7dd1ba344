"""Relational building blocks: intervals, as-of matching, versions, loads, sheets, mail rules."""

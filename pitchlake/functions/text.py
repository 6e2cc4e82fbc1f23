"""Value mapping helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fold(column: Column) -> Column:
    """Source text compares without regard to case; mappings are keyed in lower case."""
    return F.lower(column)


def decode(column: Column, mapping: dict[str, list]) -> Column:
    """Label of the value list that holds the value, NULL when none does.

    A lookup in a constant map reads the column once. A chain of conditions reads
    it once per label, and stacked chains, inlined by the optimizer into a pushed
    filter, multiply beyond what one generated method can hold.
    """
    entries = [f"{value!r}, {label!r}" for label, values in mapping.items() for value in values]
    return F.try_element_at(F.expr(f"map({', '.join(entries)})"), column)

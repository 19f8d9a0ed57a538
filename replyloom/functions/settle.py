"""Computing expensive columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def settle(df: DataFrame, columns: dict[str, Column], drop=()) -> DataFrame:
    """Add or replace columns so that later filters read them instead of repeating
    their expressions.

    Catalyst pushes a filter through a projection by substituting the projected
    expressions; through several layers of parsing that multiplies the work. It
    does not push through a generator, and ``inline`` of a one-element array is a
    generator that keeps the row count. ``drop`` names inputs no longer needed.
    """
    rest = [F.col(c) for c in df.columns if c not in columns and c not in drop]
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*rest, F.inline(F.array(row)))

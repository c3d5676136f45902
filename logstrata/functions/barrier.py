"""Columns that are computed once per row, whatever is filtered on them later."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add or replace columns.

    The optimizer copies an ordinary column's expression into every filter it
    pushes below it, so an expensive one would run several times per row. Filters
    on the output of a generator stay above it. (Spreading a computed list has the same
    flaw: a plain explode also filters on the list's size. The outer variants,
    used throughout this package, do not.)
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))

"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns like ``withColumns``, as the output of a one-row generator.

    The optimizer writes a filter on a computed column in terms of what it was
    computed from, once per use, and does the same with nested projections.  For
    expressions like a parser's that means evaluating them many times per row,
    and code too large to compile.  It does not look through generators.
    """
    fields = [c.alias(n) for n, c in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))

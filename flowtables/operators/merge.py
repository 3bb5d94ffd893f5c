"""Merging tagged inputs and telling cases of a sum type apart."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_tagged(branches: dict, tag: str = "branch") -> DataFrame:
    """Union of DataFrames with the same columns; ``tag`` says where a row is from."""
    if not branches:
        raise ValueError("nothing to merge")
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in branches.items()]
    return reduce(DataFrame.unionByName, tagged)


def concat_ordered(*parts: DataFrame, order: str, position: str = "part_no") -> DataFrame:
    """Union whose rows sort in the order of the arguments, then by ``order``:
    sort by ``(part_no, order)``."""
    numbered = {i: df for i, df in enumerate(parts)}
    merged = merge_tagged(numbered, position)
    return merged.select(position, order, *[c for c in merged.columns if c not in (position, order)])


def collect_kind(df: DataFrame, kind: str, value: str, **columns: Column) -> DataFrame:
    """Rows of one case of a sum type, projected to that case's columns."""
    rows = df.where(F.col(kind) == value)
    return rows.select(*[c.alias(n) for n, c in columns.items()]) if columns else rows

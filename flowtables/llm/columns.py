"""Columns of a caller's table, out of the way of an operator's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table under names that no operator uses, and the new name of each column."""
    names = [f"own{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))

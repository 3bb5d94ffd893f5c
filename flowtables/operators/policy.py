"""What to do with rows that carry an error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POLICIES = ("stop", "skip", "dead_letter")


def with_error_policy(df: DataFrame, error: str, policy: str):
    """Apply an error policy to rows whose ``error`` column is not null.

    ``stop`` fails the query at the first such row, ``skip`` drops them; both
    return the good rows without the error column.  ``dead_letter`` returns two
    DataFrames, the good rows and the bad rows with their error.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}, use one of {POLICIES}")
    bad = F.col(error).isNotNull()
    if policy == "stop":
        checked = F.when(bad, F.raise_error(F.col(error).cast("string")).cast("boolean"))
        return df.where(checked.isNull()).drop(error)
    good = df.where(~bad).drop(error)
    return good if policy == "skip" else (good, df.where(bad))

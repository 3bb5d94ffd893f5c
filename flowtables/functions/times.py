"""Time columns as numbers and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(col: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp, with or without time zone."""
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(col.cast("timestamp"))


def plus_seconds(col: str | Column, seconds: str | Column | int | float) -> Column:
    """Timestamp plus a number of seconds."""
    col = F.col(col) if isinstance(col, str) else col
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    seconds = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return col + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def hour_file_name(at: str | Column, prefix: str = "stream-", suffix: str = ".log") -> Column:
    """Name of the hourly file a row belongs to, ``stream-yyyy-MM-dd_HH.log``."""
    at = F.col(at) if isinstance(at, str) else at
    return F.concat(F.lit(prefix), F.date_format(at, "yyyy-MM-dd_HH"), F.lit(suffix))

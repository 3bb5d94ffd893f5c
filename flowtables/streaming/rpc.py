"""Requests and replies that arrive as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlate_rpc_stream(
    requests: DataFrame,
    replies: DataFrame,
    timeout: str,
    correlation: str = "correlation_id",
    requested_at: str = "requested_at",
    replied_at: str = "replied_at",
    delay: str = "0 seconds",
) -> DataFrame:
    """Each request with each of its replies that came within ``timeout`` (an
    interval such as ``10 minutes``); a request without any comes once, with nulls,
    when the watermark says that none can follow."""
    left = requests.withWatermark(requested_at, delay)
    right = replies.withColumnRenamed(correlation, "_id").withWatermark(replied_at, delay)
    on = (
        (F.col(correlation) == F.col("_id"))
        & (F.col(replied_at) >= F.col(requested_at))
        & (F.col(replied_at) <= F.col(requested_at) + F.expr(f"interval {timeout}"))
    )
    return left.join(right, on, "left_outer").drop("_id")

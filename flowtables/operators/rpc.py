"""Requests with their replies, and batch entries with their results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def header_int(headers: str | Column, name: str, default: int) -> Column:
    """Header ``name`` as an integer; ``default`` if missing or no integer."""
    headers = F.col(headers) if isinstance(headers, str) else headers
    value = F.try_element_at(headers, F.lit(name)).try_cast("int")
    return F.coalesce(value, F.lit(default))


def correlate_rpc(
    requests: DataFrame,
    replies: DataFrame,
    correlation: str = "correlation_id",
    headers: str | None = "headers",
    default_expected: int = 1,
) -> DataFrame:
    """Requests with ``expected``, ``received`` and ``outstanding`` reply counts.

    The expected number comes from the header ``expectedReplies``.  Replies are
    counted per correlation id before the join, so an id with very many replies
    reaches the join as one row.
    """
    counted = replies.groupBy(F.col(correlation).alias("_id")).agg(
        F.count(F.lit(1)).alias("received")
    )
    expected = (
        header_int(headers, "expectedReplies", default_expected)
        if headers
        else F.lit(default_expected)
    )
    joined = requests.join(counted, F.col(correlation) == F.col("_id"), "left").drop("_id")
    return (
        joined.withColumn("received", F.coalesce(F.col("received"), F.lit(0).cast("bigint")))
        .withColumn("expected", expected)
        .withColumn("outstanding", F.col("expected") - F.col("received"))
        .withColumn("complete", F.col("outstanding") <= 0)
    )


def correlate_batch(
    requests: DataFrame, responses: DataFrame, on: Sequence[str] = ("batch_no", "idx")
) -> DataFrame:
    """Each entry of a batch request with the result for its position or id.

    ``on`` must identify an entry.  Entries without a result keep null result
    columns; ``answered`` tells them apart.
    """
    marked = responses.withColumn("_answered", F.lit(True))
    joined = requests.join(marked, list(on), "left")
    return joined.withColumn("answered", F.col("_answered").isNotNull()).drop("_answered")

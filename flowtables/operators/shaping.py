"""Rate shaping, bounded buffers, in-flight gauges and early ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.times import micros
from flowtables.plans.ordered import arrange, key_total, run_count, run_max, run_sum

Names = str | Sequence[str]

STRATEGIES = ("drop_head", "drop_tail", "drop_new", "drop_buffer", "fail")


def throttle(
    df: DataFrame,
    rate: float,
    burst: float,
    key: Names,
    order: Names,
    at: str,
    cost: str | Column | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """When each row leaves a shaper that lets ``rate`` units of ``cost`` per
    second pass and at most ``burst`` at once; adds ``emit_us``, microseconds
    since 1970.  Rows leave in order.

    With S the running cost and t the arrival, a row leaves at the later of its
    arrival and ``max over j <= i of (t_j - S_(j-1) / rate) + (S_i - burst) / rate``
    (the greedy shaper of network calculus).  A row that costs more than the
    burst waits until the excess has been earned.
    """
    if rate <= 0 or burst <= 0:
        raise ValueError("rate and burst must be positive")
    cost = F.lit(1) if cost is None else F.col(cost) if isinstance(cost, str) else cost
    scale = 1_000_000.0 / rate
    rows = arrange(
        df.withColumns({"_t": micros(at), "_cost": cost.cast("bigint")}), key, order, rows_per_chunk
    )
    rows = rows.scan(_sum=run_sum("_cost"), _arrived=run_max("_t"))
    credit = F.col("_t") - (F.col("_sum") - F.col("_cost")) * F.lit(scale)
    rows = rows.with_columns(_credit=credit).scan(_credit=run_max("_credit"))
    paid = F.col("_credit") + (F.col("_sum") - F.lit(burst)) * F.lit(scale)
    emit = F.greatest(F.col("_arrived").cast("double"), paid)
    return rows.df.withColumn("emit_us", F.round(emit).cast("bigint")).drop(
        "_t", "_cost", "_sum", "_arrived", "_credit"
    )


def bounded_buffer(
    df: DataFrame,
    capacity: int,
    strategy: str,
    key: Names,
    order: Names,
    keep_dropped: bool = False,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """What is left in a buffer of ``capacity`` per key after all rows arrived and
    nothing was read meanwhile (``streaming.bounded_buffer_stream`` handles reads).

    ``drop_head`` drops the oldest row, ``drop_tail`` the newest buffered one,
    ``drop_new`` the arriving one, ``drop_buffer`` all buffered ones; ``fail``
    fails the query.  With ``keep_dropped`` all rows stay, flagged by ``kept``.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}, use one of {STRATEGIES}")
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    rows = arrange(df, key, order, rows_per_chunk)
    rows = rows.scan(_pos=run_count(), _n=key_total(F.lit(1).cast("bigint")))
    pos, n = F.col("_pos") - 1, F.col("_n")
    kept = {
        "drop_head": n - pos <= capacity,
        "drop_new": pos < capacity,
        "drop_tail": (n <= capacity) | (pos < capacity - 1) | (pos == n - 1),
        "drop_buffer": pos >= (n - 1) - (n - 1) % capacity,
        "fail": F.when(
            n > capacity, F.raise_error(F.lit(f"buffer of {capacity} has overflown")).cast("boolean")
        ).otherwise(F.lit(True)),
    }[strategy]
    flagged = rows.df.withColumn("kept", kept).drop("_pos", "_n")
    return flagged if keep_dropped else flagged.where("kept").drop("kept")


def in_flight(
    df: DataFrame,
    change: str | Column,
    prefetch: int,
    key: Names,
    order: Names,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Number of open deliveries after each event: ``change`` is +1 for a delivery
    and minus the number of deliveries a settlement closes.  Adds ``in_flight``
    and ``over_prefetch``."""
    change = F.col(change) if isinstance(change, str) else change
    rows = arrange(df.withColumn("_d", change.cast("bigint")), key, order, rows_per_chunk)
    return (
        rows.scan(in_flight=run_sum("_d"))
        .df.drop("_d")
        .withColumn("over_prefetch", F.col("in_flight") > prefetch)
    )


def take_while(
    df: DataFrame,
    predicate: Column,
    key: Names,
    order: Names,
    inclusive: bool = False,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Rows of each key before the first one that fails ``predicate``; with
    ``inclusive`` that one too.  A null predicate counts as failed."""
    failed = F.when(F.coalesce(predicate, F.lit(False)), 0).otherwise(1)
    rows = arrange(df.withColumn("_f", failed.cast("bigint")), key, order, rows_per_chunk)
    return rows.scan(_f=run_sum("_f", exclusive=inclusive)).df.where(F.col("_f") == 0).drop("_f")


def rate_use(df: DataFrame, limit: float, every: str, key: Names, at: str, cost: Column | None = None) -> DataFrame:
    """What each key uses of a rate: one row per key and window of ``every`` (such as ``1 hour``) with
    ``started_at``, ``rows``, ``used`` (the sum of ``cost``, or the rows), ``share`` of ``limit``, and
    ``over``, what a limit would hold back to later windows.  Summed before it is shuffled, so a
    hot key is one row a task."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    keys = [key] if isinstance(key, str) else list(key)
    amount = F.lit(1) if cost is None else cost
    used = df.groupBy(*keys, F.window(at, every)["start"].alias("started_at")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(amount), F.lit(0)).cast("bigint").alias("used")
    )
    return used.withColumns({
        "share": F.col("used") / F.lit(float(limit)), "over": F.greatest(F.col("used") - F.lit(limit), F.lit(0)).cast("bigint"),
    })


def retain(df: DataFrame, n: int, which: str, key: Names, order: Names, rows_per_chunk: int | None = None) -> DataFrame:
    """At most ``n`` rows of each key: its ``last`` or ``first`` ones, ``first_and_last`` (n - 1 first ones and the
    very last), or those of the ``last_batch`` of n."""
    strategies = {"last": "drop_head", "first": "drop_new", "first_and_last": "drop_tail", "last_batch": "drop_buffer"}
    if which not in strategies:
        raise ValueError(f"which must be one of {sorted(strategies)}")
    return bounded_buffer(df, n, strategies[which], key, order, rows_per_chunk=rows_per_chunk)

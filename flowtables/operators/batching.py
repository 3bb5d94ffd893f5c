"""Batches by count, by count or time, and by size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.times import micros
from flowtables.plans.cuts import ByCountOrSpan, BySize, cut
from flowtables.plans.ordered import (
    arrange,
    key_total,
    last_value,
    previous,
    run_count,
)

Names = str | Sequence[str]


def batch_by_count(
    df: DataFrame, n: int, key: Names, order: Names, rows_per_chunk: int | None = None
) -> DataFrame:
    """Number batches of ``n`` consecutive rows per key: ``batch_no`` from 0, and
    ``idx``, the position in the batch, from 0."""
    if n < 1:
        raise ValueError("n must be at least 1")
    rows = arrange(df, key, order, rows_per_chunk).scan(_n=run_count())
    return rows.df.withColumns(
        {
            "batch_no": F.expr(f"(_n - 1) div {n}"),
            "idx": ((F.col("_n") - 1) % n).cast("int"),
        }
    ).drop("_n")


def collect_batches(
    df: DataFrame, batch: Names, idx: str, columns: Sequence[str], name: str = "items"
) -> DataFrame:
    """One row per batch with its rows as an ordered array.  A batch has a size
    limit (see :func:`batch_by_count`), so no array grows with the data."""
    batch = [batch] if isinstance(batch, str) else list(batch)
    items = F.sort_array(F.collect_list(F.struct(idx, *columns)))
    fields = [F.col(f"_items.{c}") for c in columns]
    flat = fields[0] if len(columns) == 1 else F.arrays_zip(*fields)
    return df.groupBy(*batch).agg(items.alias("_items")).select(*batch, flat.alias(name))


def grouped_within(
    df: DataFrame,
    n: int,
    seconds: float,
    key: Names,
    order: Names,
    at: str,
    mode: str = "open",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Groups of at most ``n`` rows and at most ``seconds`` long; ``at`` is the
    time column and must not decrease along ``order``.

    ``mode="open"``: the clock of a group starts with its first row; adds
    ``group_no`` from 1.  ``mode="tick"``: the clock ticks every ``seconds`` from
    the key's first row, as a free-running timer does; adds ``tick`` and
    ``group_no``, the group's number inside the tick, from 1.
    """
    if n < 1 or seconds <= 0:
        raise ValueError("n and seconds must be positive")
    span = int(seconds * 1_000_000)
    timed = df.withColumn("_t", micros(at))
    rows = arrange(timed, key, order, rows_per_chunk)
    if mode == "open":
        return cut(rows, ByCountOrSpan(n, span), "_t", "group_no").drop("_t")
    if mode != "tick":
        raise ValueError(f"unknown mode {mode!r}")
    rows = rows.scan(_n=run_count(), _t0=key_total("_t", "min"))
    rows = rows.with_columns(tick=F.expr(f"(_t - _t0) div {span}"))
    rows = rows.scan(_tick0=previous("tick"))
    starts = F.when(F.col("_tick0").isNull() | (F.col("_tick0") != F.col("tick")), F.col("_n"))
    rows = rows.with_columns(_start=starts).scan(_start=last_value("_start"))
    in_tick = F.expr(f"(_n - _start) div {n} + 1")
    return rows.df.withColumn("group_no", in_tick).drop(
        "_t", "_t0", "_n", "_tick0", "_start"
    )


def pack_greedy(
    df: DataFrame,
    max_size: int,
    size: str | Column,
    key: Names,
    order: Names,
    name: str = "batch_no",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Consecutive batches per key that stay within ``max_size``, numbered from 1.
    A row larger than that has a batch of its own."""
    if max_size < 1:
        raise ValueError("max_size must be positive")
    size = F.col(size) if isinstance(size, str) else size
    rows = arrange(df.withColumn("_size", size.cast("bigint")), key, order, rows_per_chunk)
    return cut(rows, BySize(max_size), "_size", name).drop("_size")


class _Rooms:
    """Room left in batches, as a tree of maxima, so the first batch with enough room is found in
    steps that grow with the logarithm of their number.  Batches beyond the last one are empty."""

    def __init__(self, size: int):
        self.size, self.leaves = size, 1
        self.most = [size, size]  # of node i are 2i and 2i + 1; leaves come last

    def put(self, amount: int) -> int:
        most = self.most
        if most[1] < amount:  # twice as many batches, the first half as it was
            leaves = self.leaves
            grown = [self.size] * (4 * leaves)
            width = 1
            while width <= leaves:
                grown[2 * width : 3 * width] = most[width : 2 * width]
                width *= 2
            self.most, self.leaves = grown, 2 * leaves
            most = grown
        node = 1
        while node < self.leaves:
            node *= 2
            if most[node] < amount:
                node += 1
        at = node - self.leaves
        most[node] -= amount
        while node > 1:
            node //= 2
            left, right = most[2 * node], most[2 * node + 1]
            best = left if left > right else right
            if most[node] == best:
                break
            most[node] = best
        return at


def pack_first_fit(
    df: DataFrame,
    max_size: int,
    size: str | Column,
    key: Names,
    order: Names,
    list_size: int,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Fill size-capped batches from lists of ``list_size`` consecutive rows.

    Every row of a list that still fits goes into the current batch; the refused
    ones wait for the next batch, and later smaller rows may overtake them.  The
    next list starts with a new batch.  Adds ``list_no`` from 0 and ``batch_no``
    from 1 inside the list; a row larger than ``max_size`` fits nowhere and has
    no ``batch_no``.
    """
    if max_size < 1:
        raise ValueError("max_size must be positive")
    size = F.col(size) if isinstance(size, str) else size
    lists = batch_by_count(
        df.withColumn("_size", F.coalesce(size.cast("bigint"), F.lit(0))),
        list_size,
        key,
        order,
        rows_per_chunk,
    ).withColumnRenamed("batch_no", "list_no")
    key = [key] if isinstance(key, str) else list(key)
    group = [*key, "list_no"]
    columns = [*df.columns, "list_no"]
    in_list = Window.partitionBy(*group).orderBy("idx")
    ordered = (
        lists.withColumn("_new", F.row_number().over(in_list) == 1)
        .sortWithinPartitions(*group, "idx")
        .select(*columns, "_size", "_new")
    )
    schema = T.StructType(
        [*lists.select(*columns).schema.fields, T.StructField("batch_no", T.IntegerType())]
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = _Rooms(max_size)
        for batch in batches:
            numbers = []
            sizes = batch.column("_size").to_pylist()
            for new, amount in zip(batch.column("_new").to_pylist(), sizes):
                if new:
                    open_ = _Rooms(max_size)
                numbers.append(None if amount > max_size else open_.put(amount) + 1)
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(numbers, pa.int32())], names=[*columns, "batch_no"]
            )

    return ordered.mapInArrow(fit, schema)

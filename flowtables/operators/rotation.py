"""Which file each row of a rotating log goes to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions.times import hour_file_name
from flowtables.operators.batching import pack_greedy
from flowtables.plans.automata import Automaton, run_automaton
from flowtables.plans.ordered import Arranged, arrange, previous, run_count, run_max, run_sum

Names = str | Sequence[str]


def rotate(
    df: DataFrame, trigger: Column, key: Names, order: Names, rows_per_chunk: int | None = None
) -> DataFrame:
    """A new file starts at each row where ``trigger`` holds; that row belongs to
    the new file, and rows before the first trigger are dropped.  Adds ``file_no``
    from 1 and ``row_no``, the row's position in its file, from 1."""
    opens = F.coalesce(trigger, F.lit(False)).cast("bigint")
    rows = arrange(df.withColumn("_open", opens), key, order, rows_per_chunk)
    return _number_rows(rows, "_open")


def rotate_by_automaton(
    df: DataFrame,
    machine: Automaton,
    symbol: Column,
    key: Names,
    order: Names,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """:func:`rotate` with a trigger that remembers: a new file starts at each row at which the
    automaton fires.  It reads ``symbol``, and starts anew with each key."""
    marked = df.withColumn("_symbol_of", symbol.cast("string"))
    fired = run_automaton(arrange(marked, key, order, rows_per_chunk), machine, "_symbol_of", "_state", "_fires")
    return rotate(fired.drop("_symbol_of", "_state"), F.col("_fires"), key, order, rows_per_chunk).drop("_fires")


def _number_rows(rows: Arranged, opens: str) -> DataFrame:
    rows = rows.scan(file_no=run_sum(opens), _n=run_count())
    rows = rows.with_columns(_at=F.when(F.col(opens) == 1, F.col("_n")))
    rows = rows.scan(_at=run_max("_at"))
    return (
        rows.df.where(F.col("file_no") > 0)
        .withColumn("row_no", F.col("_n") - F.col("_at") + 1)
        .drop(opens, "_n", "_at")
    )


def rotate_by_size(
    df: DataFrame,
    max_size: int,
    size: str | Column,
    key: Names,
    order: Names,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """A new file starts when the current one would grow past ``max_size``."""
    return pack_greedy(df, max_size, size, key, order, "file_no", rows_per_chunk)


def rotate_by_time(
    df: DataFrame,
    key: Names,
    order: Names,
    at: str,
    name: Column | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """A new file starts when the formatted time of a row differs from that of
    the row before; hourly names unless ``name`` is given.  Adds ``file_name``,
    ``file_no`` and ``row_no``."""
    named = df.withColumn("file_name", hour_file_name(at) if name is None else name)
    # a name may be null; what holds it is null only before the first row
    named = named.withColumn("_held", F.struct("file_name"))
    rows = arrange(named, key, order, rows_per_chunk).scan(_before=previous("_held"))
    same = F.col("_before").isNotNull() & F.col("_before.file_name").eqNullSafe(F.col("file_name"))
    rows = rows.map(lambda d: d.withColumn("_open", (~same).cast("bigint")).drop("_before", "_held"))
    return _number_rows(rows, "_open")

"""Running computations over an ordered key, for keys of any size.

``Window.partitionBy(key).orderBy(order)`` sends a whole key to one task.  When
one key holds a third of a table, that task never ends.  :func:`arrange` finds
such keys and cuts each of them into chunks of consecutive rows.  A running
value is then computed in two steps:

1. inside each ``(key, chunk)`` with an ordinary window, all chunks in parallel;
2. one summary row per chunk gives what the chunks before it (or after it, for
   reverse scans) contribute, and that is added to every row of the chunk.

Keys that are not hot have no chunk number and pay nothing but the sampling
scan of their key and order columns.  The result equals the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.plans.sizes import broadcast_if_small, written

#: Rows of a key that one task handles at a time, about.
ROWS_PER_CHUNK = 2_000_000
#: Sampled rows per chunk; more gives more even chunks.
SAMPLES_PER_CHUNK = 32
#: Bounds that are looked through at once; a key with more has pages of them, in levels.
BOUNDS_PER_PAGE = 64

CHUNK = "_chunk"
_FIRST = Window.unboundedPreceding
_LAST = Window.unboundedFollowing


@dataclass(frozen=True)
class Scan:
    """How one running value is computed inside a chunk, summed up per chunk,
    carried over from other chunks, and put together."""

    local: Callable  # window over (key, chunk), ordered -> Column
    total: Callable  # struct of the order columns -> aggregate Column
    carry: Callable  # total column, window over key ordered by chunk -> Column
    merge: Callable  # local, carry, is-edge-row -> Column
    edge: str = ""  # "first" / "last": merge needs to know that row of the chunk


def _frames(reverse: bool, exclusive: bool):
    if reverse:
        return (1 if exclusive else 0, _LAST), (1, _LAST)
    return (_FIRST, -1 if exclusive else 0), (_FIRST, -1)


def run_sum(value, reverse: bool = False, exclusive: bool = False) -> Scan:
    """Running sum up to this row (from this row on with ``reverse``)."""
    value = _column(value)
    near, far = _frames(reverse, exclusive)
    return Scan(
        lambda w: F.coalesce(F.sum(value).over(w.rowsBetween(*near)), F.lit(0)),
        lambda o: F.sum(value),
        lambda t, w: F.sum(t).over(w.rowsBetween(*far)),
        lambda a, c, e: a + F.coalesce(c, F.lit(0)),
    )


def run_count() -> Scan:
    """Position of the row in its key, from 1."""
    return Scan(
        lambda w: F.row_number().over(w).cast("bigint"),
        lambda o: F.count(F.lit(1)),
        lambda t, w: F.sum(t).over(w.rowsBetween(_FIRST, -1)),
        lambda a, c, e: a + F.coalesce(c, F.lit(0)),
    )


def run_max(value, reverse: bool = False, exclusive: bool = False) -> Scan:
    value = _column(value)
    near, far = _frames(reverse, exclusive)
    return Scan(
        lambda w: F.max(value).over(w.rowsBetween(*near)),
        lambda o: F.max(value),
        lambda t, w: F.max(t).over(w.rowsBetween(*far)),
        lambda a, c, e: F.greatest(a, c),
    )


def run_min(value, reverse: bool = False, exclusive: bool = False) -> Scan:
    value = _column(value)
    near, far = _frames(reverse, exclusive)
    return Scan(
        lambda w: F.min(value).over(w.rowsBetween(*near)),
        lambda o: F.min(value),
        lambda t, w: F.min(t).over(w.rowsBetween(*far)),
        lambda a, c, e: F.least(a, c),
    )


def last_value(value, exclusive: bool = False) -> Scan:
    """Latest value so far that is not null."""
    value = _column(value)
    near, far = _frames(False, exclusive)
    return Scan(
        lambda w: F.last(value, ignorenulls=True).over(w.rowsBetween(*near)),
        lambda o: F.max_by(value, F.when(value.isNotNull(), o)),
        lambda t, w: F.last(t, ignorenulls=True).over(w.rowsBetween(*far)),
        lambda a, c, e: F.coalesce(a, c),
    )


def previous(value) -> Scan:
    """Value of the row before."""
    value = _column(value)
    return Scan(
        lambda w: F.lag(value).over(w),
        lambda o: F.max_by(value, o),
        lambda t, w: F.lag(t).over(w),
        lambda a, c, e: F.when(e, c).otherwise(a),
        edge="first",
    )


def following(value) -> Scan:
    """Value of the row after."""
    value = _column(value)
    return Scan(
        lambda w: F.lead(value).over(w),
        lambda o: F.min_by(value, o),
        lambda t, w: F.lead(t).over(w),
        lambda a, c, e: F.when(e, c).otherwise(a),
        edge="last",
    )


def key_total(value, how: str = "sum") -> Scan:
    """Sum, minimum or maximum over the whole key, on every row."""
    value = _column(value)
    agg = {"sum": F.sum, "min": F.min, "max": F.max}[how]
    whole = (_FIRST, _LAST)
    return Scan(
        lambda w: agg(value).over(w.rowsBetween(*whole)),
        lambda o: agg(value),
        lambda t, w: agg(t).over(w.rowsBetween(*whole)),
        lambda a, c, e: F.coalesce(c, a),
    )


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Arranged:
    """A DataFrame with a key, an order and, if some key is hot, a chunk number.

    ``measured`` says that the chunks came from :func:`arrange`, so there are
    few of them and their summaries may be broadcast.
    """

    table: DataFrame
    key: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    measured: bool = True

    @property
    def df(self) -> DataFrame:
        return self.table.drop(CHUNK)

    @property
    def group(self) -> list[str]:
        return [*self.key, CHUNK] if self.split else [*self.key]

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Arranged:
        """Row-wise changes (``select``, ``withColumn``, ``where``)."""
        return replace(self, table=change(self.table))

    def with_columns(self, **columns: Column) -> Arranged:
        return self.map(lambda df: df.withColumns(columns))

    def scan(self, **scans: Scan) -> Arranged:
        """Add running values.  Scans of one arrangement share one shuffle."""
        w = Window.partitionBy(*self.group).orderBy(*self.order)
        if not self.split:
            return self.with_columns(**{n: s.local(w) for n, s in scans.items()})

        at = F.struct(*self.order)
        totals = self.summary(**{n: s.total(at) for n, s in scans.items()})
        by_chunk = Window.partitionBy(*self.key).orderBy(CHUNK)
        carry = totals.select(
            *self.group, *[s.carry(F.col(n), by_chunk).alias(f"_c_{n}") for n, s in scans.items()]
        )
        local = {n: s.local(w) for n, s in scans.items()}
        edges = {s.edge for s in scans.values() if s.edge}
        if "first" in edges:
            local["_edge_first"] = F.row_number().over(w) == 1
        if "last" in edges:
            local["_edge_last"] = F.lead(F.lit(True)).over(w).isNull()
        rows = self.table.withColumns(local)
        joined = replace(self, table=rows).with_carry(carry)
        merged = {
            n: s.merge(F.col(n), F.col(f"_c_{n}"), F.col(f"_edge_{s.edge}") if s.edge else None)
            for n, s in scans.items()
        }
        columns = [
            merged[c].alias(c) if c in merged else F.col(c)
            for c in rows.columns
            if not c.startswith("_edge_")
        ]
        return replace(self, table=joined.select(*columns))

    def summary(self, **totals: Column) -> DataFrame:
        """One row per chunk of the keys that are cut."""
        hot = self.table.where(F.col(CHUNK).isNotNull())
        return hot.groupBy(*self.group).agg(*[t.alias(n) for n, t in totals.items()])

    def with_carry(self, carry: DataFrame) -> DataFrame:
        """The rows with the columns of ``carry``, which has one row per chunk.

        ``carry`` is written to the shared folder first.  So it is computed once,
        and a second scan does not have the first one's summary in its plan twice.
        """
        names = [f"_k{i}" for i in range(len(self.group))]
        # One row per chunk: at most rows / rows_per_chunk, plus one per hot key.
        carry = broadcast_if_small(carry) if self.measured else written(carry, "carry")
        carry = carry.withColumnsRenamed(dict(zip(self.group, names)))
        matched = F.lit(True)
        for k, n in zip(self.group, names):
            mine, theirs = self.table[k], carry[n]
            matched &= mine.eqNullSafe(theirs) if self.measured else mine == theirs
        return self.table.join(carry, matched, "left").drop(*names)


def arrange(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    rows_per_chunk: int | None = None,
) -> Arranged:
    """Prepare ``df`` for running computations per ``key`` along ``order``.

    ``order`` must be unique inside a key, else results are not repeatable.
    Runs one job over the key and order columns that keeps a hashed sample and
    reports chunk bounds for hot keys only.  ``rows_per_chunk=0`` skips that,
    for keys whose size has a proven bound.
    """
    key, order = _names(key), _names(order)
    if rows_per_chunk == 0:
        return Arranged(df, key, order, split=False)
    bounds = written(_chunk_bounds(df, key, order, rows_per_chunk or ROWS_PER_CHUNK), "bounds")
    if bounds.isEmpty():
        return Arranged(df, key, order, split=False)
    names = [f"_b{i}" for i in range(len(key))]
    chunked = count_at_most(df, bounds, dict(zip(key, names)), F.struct(*order), CHUNK)
    return Arranged(chunked, key, order, split=True)


def arrange_by(df: DataFrame, key, order, chunk: Column) -> Arranged:
    """Like :func:`arrange` with chunks that the data brings along, such as the
    file block of a line.  ``chunk`` must not decrease along ``order``."""
    return Arranged(
        df.withColumn(CHUNK, chunk), _names(key), _names(order), split=True, measured=False
    )


def _names(names: str | Sequence[str]) -> tuple[str, ...]:
    names = (names,) if isinstance(names, str) else tuple(names)
    if not names:
        raise ValueError("key and order must name at least one column")
    return names


def _chunk_bounds(df: DataFrame, key, order, rows_per_chunk: int) -> DataFrame:
    """``_bound``: first order value of every chunk but the first, of hot keys.

    The sample is chosen by a hash of the row's key and order, so it does not
    depend on how the input is partitioned.
    """
    every = min(SAMPLES_PER_CHUNK, rows_per_chunk)
    sampled = F.pmod(F.xxhash64(*key, *order), F.lit(rows_per_chunk)) < every
    position = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return (
        df.where(sampled)
        .select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(key)], F.struct(*order).alias("_bound"), position.alias("_n"))
        .where(F.col("_n") % every == 0)
        .drop("_n")
        .distinct()
    )


def count_at_most(rows: DataFrame, bounds: DataFrame, key: dict[str, str], value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: how many bounds of the row's key are <= ``value``, null for a key without any.

    ``bounds`` has a row for each, in ``_bound``; ``key`` names its key columns for those of the
    rows.  Rows never hold all bounds of a key: they look through a page, whose number leads to
    a page of the next level, and so on, as in a B-tree.
    """
    names = list(key.values())
    at = Window.partitionBy(*names).orderBy("_bound")
    numbered = bounds.select(*names, "_bound", F.row_number().over(at).cast("bigint").alias("_i"))
    first = bounds.select(*names).distinct().select("*", F.lit(None).cast(bounds.schema["_bound"].dataType).alias("_bound"), F.lit(0).cast("bigint").alias("_i"))
    numbered = written(numbered.unionByName(first), "bounds")
    most = numbered.agg(F.max("_i")).first()[0] or 0
    stride = 1
    while stride * BOUNDS_PER_PAGE <= most:
        stride *= BOUNDS_PER_PAGE
    columns, count = rows.columns, F.lit(0).cast("bigint")
    rows = rows.withColumns({"_looked": value, "_found": count})
    while stride:
        own = F.when(F.col("_i") % (stride * BOUNDS_PER_PAGE) != 0, F.col("_bound"))
        page = F.floor(F.col("_i") / (stride * BOUNDS_PER_PAGE)).cast("bigint")
        pages = (
            numbered.where(F.col("_i") % stride == 0)
            .groupBy(*[F.col(n).alias(f"_page{i}") for i, n in enumerate(names)], page.alias("_page"))
            .agg(F.sort_array(F.collect_list(own)).alias("_bounds"))
        )
        matched = F.col("_found") == F.col("_page")
        for i, k in enumerate(key):
            matched &= F.col(k).eqNullSafe(F.col(f"_page{i}"))
        found = F.col("_found") * BOUNDS_PER_PAGE + _count_at_most(F.col("_bounds"), F.col("_looked"), BOUNDS_PER_PAGE)
        rows = rows.join(broadcast_if_small(pages), matched, "left").select(*columns, "_looked", F.when(F.col("_bounds").isNotNull(), found).alias("_found"))
        stride //= BOUNDS_PER_PAGE
    return rows.select(*columns, F.col("_found").cast("int").alias(name))


def _count_at_most(bounds: Column, value: Column, most: int) -> Column:
    """Number of sorted ``bounds`` that are <= ``value``, by bisection."""
    steps = [1 << b for b in reversed(range(most.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda found, step: F.when(
            F.get(bounds, found + step - 1) <= value, found + step
        ).otherwise(found),
    )

"""Cutting an ordered key into groups where each cut depends on the last one.

"Start a new file when the current one would grow past the limit" has no closed
form: where a group starts depends on where the group before it started.  Within
one chunk of rows the next start is a function of the current start, found by
binary search.  A key that is cut into chunks is solved in three steps:

1. In each chunk, in parallel, every row that can be the first start of the chunk
   becomes an *entry*: the groups from there to the chunk's end and the last start.
2. That last start leads to one entry of a later chunk, found by a window over the
   entries and the places that are looked for.  So entries are a forest of pointers,
   and the way from the key's first row is marked by doubling: each round joins the
   marked entries with the pointers, and the pointers with themselves.
3. Each chunk takes the group open before it from the last marked entry before it,
   and all chunks label their rows in parallel.

Entries are rows, not arrays, so no table of a chunk is ever in one cell, and a
group may be longer than any number of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.plans.ordered import CHUNK, Arranged, count_at_most
from flowtables.plans.sizes import broadcast_if_small, written

# The open group at some point: (size, 0) or (rows, time of its first row).
Open = tuple[int, int]


@dataclass(frozen=True)
class BySize:
    """A group ends before the row that would take its total past ``limit``."""

    limit: int

    def next_starts(self, v: np.ndarray) -> np.ndarray:
        ends = np.cumsum(v)
        found = np.searchsorted(ends, ends - v + self.limit, side="right")
        return np.maximum(found, np.arange(1, len(v) + 1))

    def first_start(self, state: Open, v: np.ndarray) -> int:
        return int(np.searchsorted(np.cumsum(v), self.limit - state[0], side="right"))

    def opened(self, v: np.ndarray, start: int) -> Open:
        return int(v[start:].sum()), 0

    def extended(self, state: Open, rows: int, total: int) -> Open:
        return state[0] + total, 0

    def places(self, v: np.ndarray, before: int) -> np.ndarray:
        """What grows along the key, and says at which row a group is over."""
        return before + np.cumsum(v)

    def begins(self, v: np.ndarray, before: int) -> np.ndarray:
        """A group that starts at a row is over where places reach this plus ``reach``."""
        return before + np.cumsum(v) - v

    @property
    def reach(self) -> int:
        return self.limit + 1

    def head(self, v: np.ndarray) -> np.ndarray:
        """The rows among which the first start of a chunk must lie."""
        return v[: int(np.searchsorted(np.cumsum(v), self.limit, side="right")) + 1]


@dataclass(frozen=True)
class ByCountOrSpan:
    """A group ends after ``rows`` rows, or before the row that comes ``span``
    or more after the group's first row."""

    rows: int
    span: int

    def next_starts(self, v: np.ndarray) -> np.ndarray:
        here = np.arange(len(v))
        late = np.searchsorted(v, v + self.span, side="left")
        return np.maximum(np.minimum(here + self.rows, late), here + 1)

    def first_start(self, state: Open, v: np.ndarray) -> int:
        late = int(np.searchsorted(v, state[1] + self.span, side="left"))
        return min(self.rows - state[0], late, len(v))

    def opened(self, v: np.ndarray, start: int) -> Open:
        return len(v) - start, int(v[start])

    def extended(self, state: Open, rows: int, total: int) -> Open:
        return state[0] + rows, state[1]

    def places(self, v: np.ndarray, before: int) -> np.ndarray:
        return v

    def begins(self, v: np.ndarray, before: int) -> np.ndarray:
        return v

    @property
    def reach(self) -> int:
        return self.span

    def head(self, v: np.ndarray) -> np.ndarray:
        return v[: self.rows]


Rule = BySize | ByCountOrSpan


def cut(rows: Arranged, rule: Rule, value: str, name: str) -> DataFrame:
    """Number the groups of each key from 1 in column ``name``.

    ``value`` is the BIGINT column the rule looks at: the size of the row, or
    its time, which must not decrease along the order.
    """
    columns = rows.df.columns
    table = rows.table
    if rows.split:
        # One row per chunk of a hot key.
        carry = broadcast_if_small(_carry(rows, rule, value))
        matched = F.lit(True)
        for i, k in enumerate(rows.group):
            matched &= table[k].eqNullSafe(carry[f"_k{i}"])
        table = table.join(carry, matched, "left").select(
            *[table[c] for c in table.columns], "_a", "_b", "_groups"
        )
    else:
        none = F.lit(None).cast("bigint")
        table = table.withColumns({"_a": none, "_b": none, "_groups": none})

    # The window brings each (key, chunk) into one task in order and marks its
    # first row; the sort adds nothing to that plan, it states what is needed.
    w = Window.partitionBy(*rows.group).orderBy(*rows.order)
    table = (
        table.withColumn("_new", F.row_number().over(w) == 1)
        .withColumn("_value", F.coalesce(F.col(value), F.lit(0)).cast("bigint"))
        .sortWithinPartitions(*rows.group, *rows.order)
        .select(*columns, "_value", "_new", "_a", "_b", "_groups")
    )
    schema = T.StructType([*rows.df.schema.fields, T.StructField(name, T.LongType())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: Open | None = None
        groups = 0
        for batch in batches:
            values = batch.column("_value").to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(batch.column("_new").to_numpy(zero_copy_only=False))
            labels = np.empty(batch.num_rows, dtype=np.int64)
            edges = sorted({0, *begins.tolist(), batch.num_rows})
            fresh = set(begins.tolist())
            for low, high in zip(edges, edges[1:]):
                if low in fresh:
                    a = batch.column("_a")[low].as_py()
                    state = None if a is None else (a, batch.column("_b")[low].as_py())
                    groups = batch.column("_groups")[low].as_py() or 0
                starts, state = _walk(rule, values[low:high], state)
                labels[low:high] = groups + np.searchsorted(starts, np.arange(high - low), side="right")
                groups += len(starts)
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(labels)], names=[*columns, name])

    return table.mapInArrow(label, schema)


def _walk(rule: Rule, v: np.ndarray, state: Open | None) -> tuple[list[int], Open]:
    """Group starts among the rows ``v``, and the group open after them."""
    at = 0 if state is None else rule.first_start(state, v)
    if at >= len(v):
        return [], rule.extended(state, len(v), int(v.sum()))
    following = rule.next_starts(v).tolist()
    starts = []
    while at < len(v):
        starts.append(at)
        at = following[at]
    return starts, rule.opened(v, starts[-1])


def _carry(rows: Arranged, rule: Rule, value: str) -> DataFrame:
    """The group open before each chunk of a hot key, and the groups so far."""
    by_size = isinstance(rule, BySize)
    keys = [f"_k{i}" for i in range(len(rows.group))]
    order = [f"_o{i}" for i in range(len(rows.order))]
    hot = rows.table.where(F.col(CHUNK).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(rows.group, keys)],
        *[F.col(o).alias(n) for o, n in zip(rows.order, order)],
        F.coalesce(F.col(value), F.lit(0)).cast("bigint").alias("_v"),
    )
    chunks = written(_chunks(hot, keys, by_size), "chunks")
    entries = written(_entries(hot, chunks, keys, order, rule), "entries")
    roots = entries.where("n = 1").select("_id", "n", F.lit(0).cast("bigint").alias("before"))
    marked = _marked(roots, written(_pointers(entries, chunks, rule), "pointers"))
    marked = marked.join(entries, ["_id", "n"]).select("_id", "_c", "exit_n", "exit_at", (F.col("before") + F.col("groups")).alias("_groups"))
    # One row per chunk, with the last marked entry before it.
    earlier = Window.partitionBy("_id").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("_groups").isNotNull(), F.struct("exit_n", "exit_at", "_groups")), ignorenulls=True).over(earlier)
    open_rows = F.col("rows_before") - F.col("_last.exit_n") + 1
    state = (F.col("before") - F.col("_last.exit_at"), F.lit(0).cast("bigint")) if by_size else (open_rows, F.col("_last.exit_at"))
    none = F.col("_last").isNull()
    return chunks.join(marked, ["_id", "_c"], "left").withColumn("_last", last).select(
        *keys[:-1],
        F.col("_c").alias(keys[-1]),
        *[F.when(~none, c).alias(n) for c, n in zip(state, ("_a", "_b"))],
        F.coalesce("_last._groups", F.lit(0)).cast("bigint").alias("_groups"),
    )


def _chunks(hot: DataFrame, keys: list[str], by_size: bool) -> DataFrame:
    """One row per chunk: a number for the key, the chunk's place ``_p`` in it from 1, the rows
    and values before the chunk, and the row and the place it ends with."""
    chunks = hot.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("_v").alias("total"), F.max("_v").alias("last"))
    in_key = Window.partitionBy(*keys[:-1]).orderBy(keys[-1])
    so_far = in_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.first(F.monotonically_increasing_id()).over(so_far)
    rows, total = F.sum("rows").over(so_far), F.sum("total").over(so_far)
    return chunks.withColumn("_id", number).select(
        *keys[:-1],
        F.col(keys[-1]).alias("_c"),
        "_id",
        F.row_number().over(in_key).cast("bigint").alias("_p"),
        (rows - F.col("rows")).alias("rows_before"),
        (total - F.col("total")).alias("before"),
        rows.alias("end_n"),
        (total if by_size else F.max("last").over(so_far)).alias("end_place"),
    )


def _entries(hot: DataFrame, chunks: DataFrame, keys: list[str], order: list[str], rule: Rule) -> DataFrame:
    """Rows that can be the first start of their chunk: the key's row ``n`` and its place,
    the groups from there on, and the last start in the chunk."""
    fields = ["_id", "_c", "_p", "n", "place", "groups", "exit_n", "exit_at"]
    schema = "_id bigint, _c int, _p bigint, n bigint, place bigint, groups bigint, exit_n bigint, exit_at bigint"

    def summarise(chunk: tuple, v: np.ndarray) -> list[np.ndarray]:
        *named, rows_before, before = chunk
        following = rule.next_starts(v).tolist()
        last, count = [0] * len(v), [0] * len(v)
        for i in range(len(v) - 1, -1, -1):
            n = following[i]
            last[i], count[i] = (i, 1) if n >= len(v) else (last[n], count[n] + 1)
        size = len(rule.head(v))
        ends = np.array(last[:size])
        columns = [rows_before + 1 + np.arange(size), rule.places(v, before)[:size], np.array(count[:size]), rows_before + 1 + ends, rule.begins(v, before)[ends]]
        return [*[np.full(size, x) for x in named], *columns]

    def record(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if f == "_c" else pa.int64()) for f, c in zip(fields, columns)], names=fields)

    def all_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come chunk by chunk; of a chunk that goes on in the next batch only values are held."""
        chunk, held, parts, size = None, [], [], 0
        for batch in batches:
            new = batch.column("_new").to_numpy(zero_copy_only=False)
            values = batch.column("_v").to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(new)
            named = [batch.column(c).take(pa.array(begins)).to_pylist() for c in ("_id", "_c", "_p", "rows_before", "before")]
            held.append(values[: begins[0] if len(begins) else len(values)])
            for i, low in enumerate(begins):
                if chunk is not None:
                    parts.append(summarise(chunk, np.concatenate(held)))
                    size += len(parts[-1][0])
                if size >= 100_000:
                    yield record(parts)
                    parts, size = [], 0
                chunk = tuple(c[i] for c in named)
                held = [values[low : begins[i + 1] if i + 1 < len(begins) else len(values)]]
        if chunk is not None:
            parts.append(summarise(chunk, np.concatenate(held)))
        if parts:
            yield record(parts)

    # One row per chunk: at most rows / rows_per_chunk, plus one per hot key.
    small = broadcast_if_small(chunks.withColumnsRenamed({k: f"_small{k}" for k in keys[:-1]}))
    matched = F.col(keys[-1]) == F.col("_c")
    for k in keys[:-1]:
        matched &= F.col(k).eqNullSafe(F.col(f"_small{k}"))
    rows = hot.join(small, matched).select("_id", "_c", "_p", "rows_before", "before", *order, "_v")
    # As in cut(): each chunk in one task, in order.  Its size is what arrange() aimed at.
    w = Window.partitionBy("_id", "_c").orderBy(*order)
    rows = rows.withColumn("_new", F.row_number().over(w) == 1).sortWithinPartitions("_id", "_c", *order)
    return rows.select("_id", "_c", "_p", "rows_before", "before", "_v", "_new").mapInArrow(all_chunks, schema)


def _pointers(entries: DataFrame, chunks: DataFrame, rule: Rule) -> DataFrame:
    """From each entry to the one its last start leads to: ``n``, ``next`` and the groups between."""
    by_place = chunks.select("_id", F.col("end_place").alias("_bound"))
    leads = entries.withColumn("place", F.col("exit_at") + rule.reach)
    leads = count_at_most(leads, by_place, {"_id": "_id"}, F.col("place") - 1, "_to")
    to, by_row = F.col("_to"), F.lit(None).cast("bigint")
    if isinstance(rule, ByCountOrSpan):
        by_row = F.col("exit_n") + rule.rows
        by_end = chunks.select("_id", F.col("end_n").alias("_bound"))
        leads = count_at_most(leads, by_end, {"_id": "_id"}, by_row - 1, "_to_row")
        to = F.least(to, F.col("_to_row"))
    # A row past the limit is over at once, but the next start is in a later chunk all the same.
    # The chunk after the last one does not exist, and the way ends.
    target = chunks.select(F.col("_id").alias("_key"), F.col("_p").alias("_next"), "end_n")
    leads = leads.withColumns({"to": F.greatest(to, F.col("_p")) + 1, "by_row": by_row})
    asked = leads.join(broadcast_if_small(target), (F.col("_id") == F.col("_key")) & (F.col("to") == F.col("_next"))).select(
        "_id", F.col("to").alias("_p"), "place", F.lit(0).alias("is_entry"), "n", "groups",
        F.when(F.col("by_row") <= F.col("end_n"), F.col("by_row")).alias("by_row"),
    )
    there = entries.select("_id", "_p", "place", F.lit(1).alias("is_entry"), "n")
    # Backwards, the last entry seen is the first one at or after the place.
    back = Window.partitionBy("_id", "_p").orderBy(F.desc("place"), F.desc("is_entry"), F.desc("n"))
    at = F.last(F.when(F.col("is_entry") == 1, F.col("n")), ignorenulls=True).over(back)
    both = there.unionByName(asked, allowMissingColumns=True).withColumn("at", at).where("is_entry = 0")
    return both.select("_id", "n", F.least("at", "by_row").alias("next"), "groups")


def _marked(marked: DataFrame, pointers: DataFrame) -> DataFrame:
    """Entries on the way from each key's first row, with the groups before them.

    After ``i`` rounds the first ``2 ** i`` entries are marked and pointers are as long.
    """
    while True:
        step = marked.join(pointers, ["_id", "n"]).select("_id", F.col("next").alias("n"), (F.col("before") + F.col("groups")).alias("before"))
        step = written(step, "marked")
        if step.isEmpty():
            return marked
        marked = written(marked.unionByName(step), "marked")
        ahead = pointers.select("_id", F.col("n").alias("next"), F.col("next").alias("then"), F.col("groups").alias("more"))
        pointers = written(
            pointers.join(ahead, ["_id", "next"]).select("_id", "n", F.col("then").alias("next"), (F.col("groups") + F.col("more")).alias("groups")),
            "pointers",
        )

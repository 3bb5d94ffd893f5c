"""Finite automata along an ordered key, for keys of any size.

What a run of rows does to an automaton is a map from states to states, and maps compose.  So
each chunk of a hot key is reduced to its map, all chunks in parallel; the maps before a
chunk give the state it starts in; and then all chunks are labelled in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.plans.ordered import CHUNK, Arranged


@dataclass(frozen=True)
class Automaton:
    """``moves``: (state, symbol) -> (next state, whether the row fires).  A symbol without a move in
    a state, or a null, changes nothing and does not fire."""

    start: str
    moves: Mapping[tuple[str, str], tuple[str, bool]]

    @property
    def states(self) -> list[str]:
        """The start state first."""
        named = {s for s, _ in self.moves} | {s for s, _ in self.moves.values()}
        return [self.start, *sorted(named - {self.start})]

    def table(self) -> tuple[dict[str | None, tuple[int, ...]], dict[str | None, tuple[bool, ...]]]:
        """For each symbol the next state, and whether it fires, by state."""
        states = self.states
        at = {s: i for i, s in enumerate(states)}
        after: dict[str | None, tuple[int, ...]] = {}
        fires: dict[str | None, tuple[bool, ...]] = {}
        for symbol in {a for _, a in self.moves}:
            found = [self.moves.get((s, symbol), (s, False)) for s in states]
            after[symbol] = tuple(at[s] for s, _ in found)
            fires[symbol] = tuple(bool(f) for _, f in found)
        return after, fires


def run_automaton(rows: Arranged, machine: Automaton, symbol: str, state: str, fires: str) -> DataFrame:
    """Add ``state``, the state after each row, and ``fires``; ``symbol`` is a string column."""
    columns, table = rows.df.columns, rows.table
    if rows.split:
        starts = _starts(rows, machine, symbol)
        matched = F.lit(True)
        for i, k in enumerate(rows.group):
            matched &= table[k].eqNullSafe(starts[f"_k{i}"])
        # One row per chunk of a hot key.
        table = table.join(F.broadcast(starts), matched, "left").select(*[table[c] for c in table.columns], "_start")
    else:
        table = table.withColumn("_start", F.lit(None).cast("int"))
    w = Window.partitionBy(*rows.group).orderBy(*rows.order)
    table = (
        table.withColumns({"_symbol": F.col(symbol), "_first": F.row_number().over(w) == 1})
        .sortWithinPartitions(*rows.group, *rows.order)
        .select(*columns, "_symbol", "_first", "_start")
    )
    schema = T.StructType([*rows.df.schema.fields, T.StructField(state, T.StringType()), T.StructField(fires, T.BooleanType())])
    names = machine.states
    after, firing = machine.table()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = 0
        for batch in batches:
            states, fired = [], []
            symbols, firsts, starts = (batch.column(c).to_pylist() for c in ("_symbol", "_first", "_start"))
            for a, first, start in zip(symbols, firsts, starts):
                if first:
                    now = start or 0
                fired.append(firing[a][now] if a in firing else False)
                now = after[a][now] if a in after else now
                states.append(names[now])
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(states, pa.string()), pa.array(fired, pa.bool_())], names=schema.names)

    return table.mapInArrow(label, schema)


def _starts(rows: Arranged, machine: Automaton, symbol: str) -> DataFrame:
    """The state in which each chunk of a hot key starts."""
    keys = [f"_k{i}" for i in range(len(rows.group))]
    order = [f"_o{i}" for i in range(len(rows.order))]
    hot = rows.table.where(F.col(CHUNK).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(rows.group, keys)],
        *[F.col(o).alias(n) for o, n in zip(rows.order, order)],
        F.col(symbol).alias("_symbol"),
    )
    fields = [T.StructField(n, hot.schema[n].dataType) for n in keys]
    identity = tuple(range(len(machine.states)))
    after, _ = machine.table()

    def reduced(chunk: pd.DataFrame) -> pd.DataFrame:
        # There are few different maps, so each composition is looked up.
        known: dict[tuple, tuple[int, ...]] = {}
        whole = identity
        for a in chunk.sort_values(order, na_position="first")["_symbol"].to_numpy():
            if a in after:
                step = (whole, a)
                if step not in known:
                    known[step] = tuple(after[a][s] for s in whole)
                whole = known[step]
        return pd.DataFrame([[*(chunk[n].iloc[0] for n in keys), list(whole)]], columns=[*keys, "_map"])

    def followed(chunks: pd.DataFrame) -> pd.DataFrame:
        chunks = chunks.sort_values(keys[-1])
        now, starts = 0, []
        for own in chunks["_map"]:
            starts.append(now)
            now = int(own[now])
        return chunks[keys].assign(_start=np.array(starts, np.int32))

    # A chunk is one group here: its size is what arrange() aimed at.
    maps = hot.groupBy(*keys).applyInPandas(reduced, T.StructType([*fields, T.StructField("_map", T.ArrayType(T.IntegerType()))]))
    # One row per chunk.
    return maps.groupBy(*keys[:-1]).applyInPandas(followed, T.StructType([*fields, T.StructField("_start", T.IntegerType())]))

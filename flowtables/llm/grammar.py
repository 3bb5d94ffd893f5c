"""Re-Pair over a table of symbol sequences: the pairs that are most frequent in all of them become rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.plans.sizes import delete_table, write_table

Rules = list[tuple[int, int]]

#: Rules at most, and pairs looked at a round.  Only the time depends on them: what is no rule stays as it is.
MOST_RULES, PAIRS = 4096, 256
#: A round that saves less than this share of all symbols is the last.
LEAST_SAVED = 0.01


def compress(sequences: DataFrame, terminals: int, name: str = "codes") -> tuple[DataFrame, Rules]:
    """Sequences (an array<int> column of symbols below ``terminals``) in symbols of a grammar.

    Rule ``i`` is symbol ``terminals + i`` and stands for two earlier symbols.  Each round counts
    the neighbours in all sequences, takes the most frequent pairs of which no two share a
    symbol, and replaces them from left to right.  Only counts of pairs come to the driver.
    """
    rules: Rules = []
    schema = sequences.schema
    path, table = write_table(sequences, "sequences")
    while True:
        chosen: Rules = []
        used: set[int] = set()
        for pair, n in _pairs(table, name):
            a, b = pair >> 32, pair & 0xFFFFFFFF
            if n > 1 and not {a, b} & used and len(rules) + len(chosen) < MOST_RULES:
                chosen.append((a, b))
                used |= {a, b}
        if not chosen:
            return table, rules
        before = table.agg(F.sum(F.size(name))).first()[0]
        new_path, new = write_table(table.mapInArrow(_replace(name, chosen, terminals + len(rules)), schema), "sequences")
        delete_table(table.sparkSession, path)
        path, table = new_path, new
        rules += chosen
        if table.agg(F.sum(F.size(name))).first()[0] > before * (1 - LEAST_SAVED):
            return table, rules


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All symbols, and where each sequence starts (one more than sequences)."""
    ends = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), ends - ends[0]


def _neighbours(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of neighbours as longs, and whether both are of one sequence."""
    inside = np.ones(max(len(symbols) - 1, 0), bool)
    cuts = starts[1:-1]
    inside[cuts[(cuts > 0) & (cuts < len(symbols))] - 1] = False
    wide = symbols.astype(np.int64)
    return (wide[:-1] << 32) | wide[1:], inside


def _pairs(table: DataFrame, name: str) -> list[tuple[int, int]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, inside = _neighbours(*_flat(batch.column(name)))
            pair, n = np.unique(pairs[inside], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    counts = table.select(name).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return [(r.pair, r.n) for r in counts.orderBy(F.desc("n"), "pair").limit(PAIRS).collect()]


def _replace(name: str, chosen: Rules, first: int):
    keys = np.array([a << 32 | b for a, b in chosen], np.int64)
    order = np.argsort(keys)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols, starts = _flat(batch.column(name))
            pairs, inside = _neighbours(symbols, starts)
            rule = order[np.minimum(np.searchsorted(keys[order], pairs), len(keys) - 1)]
            match = inside & (keys[rule] == pairs)
            # Of matches that overlap (a run of one symbol), every second is taken.
            at = np.arange(len(match))
            first_of_run = np.maximum.accumulate(np.where(match & ~np.concatenate([[False], match[:-1]]), at, -1)) if len(match) else at
            match &= (at - first_of_run) % 2 == 0
            out = symbols.copy()
            hit = np.flatnonzero(match)
            out[hit] = first + rule[hit]
            kept = np.ones(len(symbols), bool)
            kept[hit + 1] = False
            ends = np.concatenate([[0], np.cumsum(kept)])[starts]
            column = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out[kept].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([column if c == name else batch.column(c) for c in batch.schema.names], names=batch.schema.names)

    return replace

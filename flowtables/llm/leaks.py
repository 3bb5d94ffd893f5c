"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.columns import apart
from flowtables.llm.words import mix64, pieces, shingles, word_hashes
from flowtables.plans.sizes import written

THRESHOLD = 0.8
#: Chance at least with which an item of the smallest size is a candidate.
RECALL = 0.9999
#: Shingles of items that are sent to executors at once: 16 bytes each for a size class.
BLOCK_SHINGLES = 1_000_000
#: Size classes: documents of at most 64, 256, 1024, ... shingles.
FIRST_CLASS, CLASS_STEP = 64, 4


def size_class(n: np.ndarray) -> np.ndarray:
    """The least class whose bound is no less than ``n`` shingles."""
    return np.maximum(0, np.ceil(np.log(np.maximum(n, 1) / FIRST_CLASS) / math.log(CLASS_STEP) - 1e-9)).astype(np.int64)


def bins_for(bound: int, fewest: int, recall: float = RECALL) -> int:
    """Bins of the one-permutation MinHash for documents of up to ``bound`` shingles, so
    that of ``fewest`` shared shingles one at least is the least of its bin, in the
    document and in the item, with a chance of ``recall``.

    With ``b`` bins a shingle is hidden by a smaller one with a chance below
    1 - (1 - exp(-x)) / x for x = bound / b, and so are all of them with that chance to
    the power of ``fewest``."""
    hidden = (1 - recall) ** (1 / fewest)
    b = 1
    while True:
        x = 2 * bound / b  # the item's own shingles count, too
        if 1 - (1 - math.exp(-x)) / x <= hidden:
            return b
        b *= 2


def minima(hashes: np.ndarray, bins: int) -> np.ndarray:
    """The least of ascending hashes in each of ``bins`` bins (a power of two): the bin is
    in the low bits, the order in all."""
    _, first = np.unique(hashes & np.uint64(bins - 1), return_index=True)
    return hashes[first]


class ItemIndex:
    """Signatures of a block of items for every size class, made as classes are met."""

    def __init__(self, ids: list[int], sets: list[np.ndarray], threshold: float):
        self.ids, self.sets, self.threshold = ids, sets, threshold
        self.needed = [max(1, math.ceil(threshold * len(s) - 1e-9)) for s in sets]
        self.classes: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}

    def of(self, klass: int) -> tuple[int, np.ndarray, np.ndarray]:
        if klass not in self.classes:
            bins = bins_for(FIRST_CLASS * CLASS_STEP**klass, min(self.needed))
            least = [minima(s, bins) for s in self.sets]
            owner = np.repeat(np.arange(len(least)), [len(x) for x in least])
            value = np.concatenate(least)
            order = np.argsort(value, kind="stable")
            self.classes[klass] = bins, value[order], owner[order]
        return self.classes[klass]

    def search(self, own: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, shared shingles, shingles of the item) for a document's distinct hashes."""
        bins, values, owners = self.of(int(size_class(np.array([len(own)]))[0]))
        sketch = np.sort(minima(own, bins))
        low, high = np.searchsorted(values, sketch, "left"), np.searchsorted(values, sketch, "right")
        hit = np.flatnonzero(high > low)
        if not len(hit):
            return
        spans = [owners[a:b] for a, b in zip(low[hit], high[hit])]
        for i in np.unique(np.concatenate(spans)).tolist():
            shared = len(np.intersect1d(own, self.sets[i], assume_unique=True))
            if shared >= self.needed[i]:
                yield i, shared, len(self.sets[i])


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    runs, at = shingles(*word_hashes(texts))
    return mix64(runs ^ np.uint64(0x9E3779B97F4A7C15)), at


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            runs, at = _hashed(batch["text"])
            sets = [np.sort(runs[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
            out = {"item_id": batch["item_id"], "n": pa.array(np.diff(at)), "shingles": pa.array(sets, pa.binary())}
            yield pa.RecordBatch.from_pydict(out)

    named = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return named.mapInArrow(hashed, "item_id long, n long, shingles binary").where("n > 0")


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, shared, item_shingles, containment`` for every document that
    holds at least ``threshold`` of an item's distinct runs of five words.

    Documents fall into classes by their number of shingles.  Each class has a number
    of MinHash bins that grows with its bound, so that a short item is found inside a
    document hundreds of times as long: any least shingle that document and item share
    in a bin makes a candidate, and candidates are verified on all shingles (64-bit
    hashes of them).  Items are taken in blocks of at most ``BLOCK_SHINGLES`` shingles
    (or one item); a block is sent to all tasks, and documents are read once for each,
    without a shuffle.

    Items and documents of fewer than five words have one shingle, of all their words;
    those without words, null or empty, match nothing.  Rows of equal id are searched
    each; a pair comes once for each such row, and items of equal id are items of their
    own.  Other columns are not read.
    """
    spark = docs.sparkSession
    items = written(_items(benchmark, item_id, item_text), "items")
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, shared long, item_shingles long, containment double"
    found = None
    for block in _blocks(items):
        sent = spark.sparkContext.broadcast([(r.item_id, bytes(r.shingles)) for r in block])
        part = named.mapInArrow(_searcher(sent, threshold), schema)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def _blocks(items: DataFrame) -> Iterator[list]:
    """Items in blocks of bounded size; one block at a time is on the driver."""
    block, size = [], 0
    for row in items.orderBy("item_id", "shingles").toLocalIterator():
        if block and size + row.n > BLOCK_SHINGLES:
            yield block
            block, size = [], 0
        block.append(row)
        size += row.n
    if block:
        yield block


_INDEX: dict = {}


def _searcher(sent, threshold: float):
    key = uuid.uuid4().hex

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _INDEX.get(key)
        if index is None:
            _INDEX.clear()
            ids, sets = zip(*sent.value)
            index = _INDEX[key] = ItemIndex(list(ids), [np.frombuffer(s, np.uint64) for s in sets], threshold)
        for batch in pieces(batches, "text"):
            runs, at = _hashed(batch["text"])
            rows = []
            for doc, a, b in zip(batch["doc_id"].to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                if b > a:
                    for i, shared, n in index.search(np.sort(runs[a:b])):
                        rows.append((doc, index.ids[i], shared, n, shared / n))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.float64()]
                names = ["doc_id", "item_id", "shared", "item_shingles", "containment"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return search


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows whose text holds an item.  A row with a null id stays if
    no row with a null id holds one."""
    leaks = find_leaks(docs, benchmark, doc_id=doc_id, text=text, **settings).select(F.col("doc_id").alias("_leak")).distinct()
    named, own = apart(docs)
    return named.join(leaks, F.col(own[doc_id]).eqNullSafe(F.col("_leak")), "left_anti").toDF(*docs.columns)


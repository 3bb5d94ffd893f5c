"""Shards of near equal size: ranges of a key between sampled splitters, dealt out by size."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowtables.llm.columns import apart
from flowtables.plans.pin import pin
from flowtables.plans.sizes import written

#: Ranges for each shard in the first cut, and samples for each range.
RANGES_PER_SHARD, SAMPLES_PER_RANGE = 32, 32
#: Rows that are numbered together.
CELL_ROWS = 1_000_000
#: A range is overfull beyond this many times its fair share.
OVERFULL = 2.0
RANGE_KEYS = ("_key", "_tie")


def _unit(*columns: Column) -> Column:
    """A number in [0, 1) from a hash of columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))


def _rank(bounds: list, key: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``key``: a binary search in the row."""
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def further(low: Column, step: Column) -> Column:
        at = low + step
        return F.when((at <= len(bounds)) & (F.get(array, at - 1) <= key), at).otherwise(low)

    return F.aggregate(steps, F.lit(0), further)


def _quantiles(rows: DataFrame, column: str, by: list[str], pieces: Column, share: Column) -> DataFrame:
    """Size-weighted sample of ``column`` in each group ``by``, and its ``pieces``-quantiles
    ``bounds``.  ``share`` is the mean number of samples for a byte.  A row above one
    sample counts as many times as its size asks for."""
    expected = F.col("_size") * share
    sampled = rows.where(_unit(*[F.col(c) for c in RANGE_KEYS if c in rows.columns], F.lit(len(by))) < expected)
    weight = F.greatest(F.lit(1), F.round(expected)).cast("long")
    points = sampled.groupBy(*by, column).agg(F.sum(weight).alias("w"), F.first(pieces).alias("n"))
    running = Window.partitionBy(*by).orderBy(column)
    whole = Window.partitionBy(*by)
    cut = points.withColumns({"end": F.sum("w").over(running), "all": F.sum("w").over(whole)})
    # the first key whose running weight reaches a new multiple of a piece's weight
    slot = lambda c: F.floor(c * F.col("n") / F.col("all"))
    edges = cut.where(slot(F.col("end")) > slot(F.col("end") - F.col("w")))
    return edges.groupBy(*by).agg(F.sort_array(F.collect_set(column)).alias("bounds"))


def shard(
    docs: DataFrame, shards: int, size: Column, key: Column, tie: Column, shard_col: str = "shard", slot_col: str = "slot"
) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... in each shard).

    Law ``bytes``: the sums of ``size`` (a positive number) of the shards are near equal.
    Rows of equal ``key`` (a long) stay together, unless they alone exceed what a
    shard should hold; then they are cut by ``tie`` (a long).

    1. Keys are drawn with a chance proportional to size; quantiles of the sample are
       splitters of ``RANGES_PER_SHARD`` ranges for each shard.
    2. All rows are summed by range.  Ranges above ``OVERFULL`` times their share are cut
       again, between keys, until none is left or a range has one key; a key that alone
       exceeds a shard's share is cut between ties in the same way.  Here keys (ties) are
       summed first and drawn by their sums, so many copies of a small row are not missed.
    3. Ranges, whose number does not depend on the input, go to shards by size, the
       largest first to the shard that has least.
    4. Slots count rows in cells of a range, whose number follows the rows, so that no
       task numbers more than about ``CELL_ROWS`` of them.

    Size, key and tie are stored as computed once only if ``docs`` is: give columns
    that are cheap, or a written table.  Rows that are equal in key and tie get
    distinct slots in no fixed order.  Null keys and ties count as 0, null sizes as 1.
    An empty table gives an empty result.  Columns of ``docs`` named like the two new ones
    are replaced.
    """
    docs = docs.drop(shard_col, slot_col)
    own = docs.columns
    rows = docs.withColumns(
        {
            "_size": F.coalesce(size.cast("long"), F.lit(1)),
            "_key": F.coalesce(key.cast("long"), F.lit(0)),
            "_tie": F.coalesce(tie.cast("long"), F.lit(0)),
        }
    )
    narrow = written(rows.select("_size", *RANGE_KEYS), "keys")
    total = narrow.agg(F.sum("_size")).first()[0]
    if not total:
        return rows.select(*own, F.lit(0).alias(shard_col), F.lit(0).cast("long").alias(slot_col)).where("false")
    ranges = shards * RANGES_PER_SHARD
    fair, most = total / ranges, total / shards
    first = _quantiles(narrow, "_key", [], F.lit(ranges), F.lit(ranges * SAMPLES_PER_RANGE / total)).first()
    keys, ties = sorted(first.bounds) if first else [], {}

    def place() -> tuple[Column, Column]:
        """The number of a row's range, and of its part among the ties of a split key."""
        part = F.lit(0)
        for k, bounds in ties.items():
            part = F.when(F.col("_key") == k, _rank(bounds, F.col("_tie"))).otherwise(part)
        return _rank(keys, F.col("_key")), part

    def sums() -> list:
        at, part = place()
        grouped = narrow.groupBy(at.alias("range"), part.alias("part")).agg(
            F.sum("_size").alias("size"), F.count("*").alias("rows"), F.min("_key").alias("low"),
            F.max("_key").alias("high"), F.min("_tie").alias("low_tie"), F.max("_tie").alias("high_tie"),
        )
        return grouped.collect()  # one row for each range

    # each pass cuts every range of ``wide`` and ``heavy`` between its lowest and highest, so it ends;
    # ``found`` is that of the last cuts
    while True:
        found = sums()
        wide = [r for r in found if r.size > OVERFULL * fair and r.low < r.high]
        heavy = [r for r in found if r.size > OVERFULL * fair and r.size > most / 2 and r.low == r.high and r.low_tie < r.high_tie]
        heavy = [r for r in heavy if sum(x.size for x in found if x.low == x.high == r.low) > most]
        if not wide and not heavy:
            break
        at, part = place()
        spark, placed = docs.sparkSession, pin(narrow, _range=at, _part=part)
        for column, group in (("_key", wide), ("_tie", heavy)):
            if not group:
                continue
            share = spark.createDataFrame(
                [(r.range, r.part, max(2, int(r.size / fair) + 1), SAMPLES_PER_RANGE / fair) for r in group],
                "_range int, _part int, _pieces int, _share double",
            )
            inside = placed.join(F.broadcast(share), ["_range", "_part"]).groupBy("_range", "_part", column)
            inside = inside.agg(*[F.max(c).alias(c) for c in ("_pieces", "_share")], F.sum("_size").alias("_size"))
            cuts = _quantiles(inside, column, ["_range", "_part"], F.col("_pieces"), F.col("_share")).collect()
            bounds = {(r["_range"], r["_part"]): list(r.bounds) for r in cuts}
            for r in group:
                low, high = (r.low, r.high) if column == "_key" else (r.low_tie, r.high_tie)
                cuts_here = bounds.get((r.range, r.part), [])
                # a sampled key starts a range, and if many rows may have it, ends it, too
                before, after = {b for b in cuts_here if b > low}, {b + 1 for b in cuts_here if b < high}
                new = before | after if column == "_key" else before or after
                new = new or {high}  # where the sample holds no cut, the highest goes alone
                if column == "_key":
                    keys = sorted({*keys, *new})
                else:
                    ties[r.low] = sorted({*ties.get(r.low, []), *new})
    held = [(0, s) for s in range(shards)]
    home, cells = {}, {}
    for r in sorted(found, key=lambda r: (-r.size, r.range, r.part)):
        least, s = heapq.heappop(held)
        heapq.heappush(held, (least + r.size, s))
        home[(r.range, r.part)], cells[(r.range, r.part)] = s, -(-r.rows // CELL_ROWS)

    table = docs.sparkSession.createDataFrame(
        [(a, b, s, cells[(a, b)]) for (a, b), s in home.items()], f"_range int, _part int, {shard_col} int, _cells int"
    )
    at, part = place()
    cell = F.pmod(F.xxhash64("_key", "_tie"), F.col("_cells")).cast("int").alias("_cell")
    lost = F.raise_error(F.lit("a row is in no range that was dealt: the input changed between reads")).cast("int")

    def dealt(df: DataFrame, *more: str) -> DataFrame:
        held = pin(df, _range=at, _part=part).join(F.broadcast(table), ["_range", "_part"], "left")
        return held.select(*more, F.coalesce(shard_col, lost).alias(shard_col), "_range", "_part", cell)

    counts = dealt(narrow).groupBy(shard_col, "_range", "_part", "_cell").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(shard_col).orderBy("_range", "_part", "_cell")) - F.col("n")
    starts = counts.select("_range", "_part", "_cell", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range", "_part", "_cell").orderBy(*RANGE_KEYS, "_size"))
    return (
        dealt(rows, *own, "_size", *RANGE_KEYS)
        .withColumn("_in", inside)
        .join(starts, ["_range", "_part", "_cell"])
        .select(*own, shard_col, (F.col("_before") + F.col("_in") - 1).alias(slot_col))
    )


def shard_documents(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``shard`` by the hash of the text, so that equal texts stay together; the size is
    the text's bytes plus one.  All columns of ``docs`` are kept."""
    kept = docs.drop("shard", "slot")
    docs, own = apart(docs)
    body = F.col(own[text])
    size = F.coalesce(F.octet_length(body), F.lit(0)) + 1
    docs = docs.drop(*[own[c] for c in ("shard", "slot") if c in own])
    return shard(docs, shards, size, F.xxhash64(body), F.xxhash64(F.col(own[doc_id]))).toDF(*kept.columns, "shard", "slot")


def shard_digests(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of all documents."""
    body = F.col("text")
    narrow = written(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("text_hash"),
        ),
        "documents",
    )
    dealt = shard(narrow, shards, F.col("size"), F.col("text_hash"), F.xxhash64("doc_id"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

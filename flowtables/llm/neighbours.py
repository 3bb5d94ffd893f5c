"""Vectors with a high cosine: NN-descent with lists that grow, and an audit against brute force."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowtables.llm.components import connected_components
from flowtables.llm.near_texts import _groups
from flowtables.plans.sizes import broadcast_if_small, delete_table, write_table, written

THRESHOLD = 0.93
#: Neighbours of a list at first; cosine below which a neighbour leads nowhere.
LIST, LEAST = 12, 0.5
#: Share of the pairs at the threshold that have a code in common in a start, vectors that share
#: a code on average, and vectors that are compared at a time.
START_RECALL, BUCKET, LOT = 0.999, 12, 128
#: Members of a neighbourhood that meet in a round; they are other ones in each round.  Room of a list
#: beyond which a group whose lists are still saturated is compared as a whole.
MEMBERS, MOST_ROOM = 48, 96
#: Rounds of a descent and descents, at most, before groups are compared as a whole; recall of the audit.
ROUNDS, DESCENTS, RECALL = 8, 4, 0.995
#: Queries of an audit at first and at most, of all vectors and of those that have another at ``NEAR``;
#: links that make an audit large enough.
AUDIT, MOST_AUDIT, AUDIT_LINKED, NEAR = 400, 1 << 13, 100, 0.85
#: Numbers in a block of vectors that are compared as a whole, and rows of a product at a time.
BLOCK, ROWS = 1 << 18, 512


def _finite(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def _unit(vectors: pa.Array) -> list[bytes]:
    out = []
    for v in vectors:
        x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
        x = x / np.abs(x).max()  # no overflow of squares
        out.append((x / np.sqrt(x @ x)).tobytes())
    return out


def unit_vectors(classes: DataFrame) -> DataFrame:
    """``node, g, unit``: vectors of length one; only those of equal label and dimension are compared."""

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["node"], batch["g"], pa.array(_unit(batch["v"]), pa.binary())], ["node", "g", "unit"])

    group = F.xxhash64("label", F.size("v")).alias("g")
    return classes.select("node", group, "v").mapInArrow(units, "node long, g long, unit binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_buffer(), np.float64) for x in column])


def _best(nodes: np.ndarray, cosines: np.ndarray, keep: np.ndarray) -> tuple[list, list, list]:
    """Of each row the ``keep`` nearest others from ``LEAST`` on: (node, neighbour, cosine)."""
    np.fill_diagonal(cosines, -2)
    a, b, c = [], [], []
    good = cosines >= LEAST
    for i in np.flatnonzero(good.any(axis=1)):
        near = np.flatnonzero(good[i])
        if len(near) > keep[i]:
            near = near[np.argpartition(-cosines[i, near], keep[i] - 1)[: keep[i]]]
        a.append(np.full(len(near), nodes[i]))
        b.append(nodes[near])
        c.append(cosines[i, near])
    return a, b, c


def _lists(found: list[tuple[list, list, list]]) -> Iterator[pa.RecordBatch]:
    a, b, c = ([x for part in found for x in part[k]] for k in range(3))
    if a:
        arrays = [pa.array(np.concatenate(x)) for x in (a, b, c)]
        yield pa.RecordBatch.from_arrays(arrays, ["node", "other", "cosine"])


def table_counts(bits: np.ndarray, threshold: float) -> np.ndarray:
    """Tables in which a pair at the threshold shares a code of ``bits`` at least once, with a
    chance of ``START_RECALL``."""
    one_side = 1 - np.arccos(min(1.0, max(-1.0, threshold))) / np.pi
    same = np.minimum(one_side**bits, START_RECALL)
    return np.ceil(np.log(1 - START_RECALL) / np.log(1 - same)).astype(np.int64)


def start_lists(vectors: DataFrame, seed: int, threshold: float) -> DataFrame:
    """``node, other, cosine`` from vectors on the same side of random hyperplanes, in runs of
    ``LOT`` along another direction.  The number of hyperplanes follows the logarithm
    of a group's size, and the number of tables that of hyperplanes."""
    sizes = vectors.groupBy("g").agg(F.count("*").alias("size"))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                units = [np.frombuffer(x.as_buffer(), np.float64) for x in part["unit"]]
                g, size = part["g"].to_numpy(), part["size"].to_numpy()
                bits = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2) / BUCKET))).astype(np.int64)
                tables = table_counts(bits, threshold)
                for dim in {len(u) for u in units}:
                    fit = np.array([len(u) == dim for u in units])
                    for table in range(tables[fit].max()):
                        rows = np.flatnonzero(fit & (tables > table))
                        x, at = np.stack([units[i] for i in rows]), pa.array(rows)
                        planes = np.random.default_rng([seed, table, dim]).normal(size=(dim, 49))
                        side = x @ planes
                        code = ((side[:, :48] > 0) & (np.arange(48) < bits[rows, None])) @ (1 << np.arange(48, dtype=np.int64))
                        yield pa.RecordBatch.from_arrays(
                            [part["g"].take(at), pa.array(np.full(len(rows), table, np.int32)), pa.array(code), pa.array(side[:, 48]),
                             part["node"].take(at), part["unit"].take(at)],
                            ["g", "table", "code", "side", "node", "unit"],
                        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the second half of the lot before
        for batch in batches:
            rows = pa.Table.from_batches([b for b in (last, batch) if b is not None]).combine_chunks().to_batches()
            if not rows:
                continue
            table = pa.Table.from_batches(rows).combine_chunks()
            keys = [table[k].to_numpy() for k in ("g", "table", "code")]
            nodes, units, found = table["node"].to_numpy(), table["unit"].combine_chunks(), []
            change = np.zeros(len(nodes), bool)
            for k in keys:
                change[1:] |= k[1:] != k[:-1]
            heads = [0, *np.flatnonzero(change).tolist(), len(nodes)]
            for a, b in zip(heads, heads[1:]):
                for i in range(a, max(a + 1, b - LOT // 2), LOT // 2):
                    j = min(b, i + LOT)
                    if j - i > 1:
                        x = _matrix(units.slice(i, j - i))
                        found.append(_best(nodes[i:j], x @ x.T, np.full(j - i, LIST)))
            yield from _lists(found)
            last = table.slice(max(heads[-2], len(nodes) - LOT // 2)).combine_chunks().to_batches()
            last = last[0] if last else None

    sized = vectors.join(broadcast_if_small(sizes), "g")
    coded = sized.mapInArrow(codes, "g long, table int, code long, side double, node long, unit binary")
    ordered = coded.repartition("g", "table", "code").sortWithinPartitions("g", "table", "code", "side", "node")
    return ordered.mapInArrow(compare, "node long, other long, cosine double")


def meet_neighbours(lists: DataFrame, vectors: DataFrame, room: DataFrame, seed: int) -> DataFrame:
    """``node, other, cosine`` of vectors that are in the list of one node, or have it in theirs."""
    both = lists.select(F.col("node").alias("centre"), F.col("other").alias("node")).union(lists.select("other", "node"))
    both = both.union(vectors.join(lists.select("node").distinct(), "node", "left_semi").select("node", F.col("node").alias("same")))
    turn = F.row_number().over(Window.partitionBy("centre").orderBy(F.xxhash64("centre", "node", F.lit(seed))))
    some = both.distinct().withColumn("at", turn).where(F.col("at") <= MEMBERS).drop("at")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, ["centre"]):
            centre, nodes, keep = (batch[k].to_numpy() for k in ("centre", "node", "room"))
            units, found = batch["unit"], []
            heads = np.append(np.flatnonzero(np.diff(centre, prepend=centre[0] - 1 if centre[0] > -(1 << 62) else centre[0] + 1)), len(centre))
            for a, b in zip(heads, heads[1:]):
                if b - a > 2:
                    x = _matrix(units.slice(a, b - a))
                    found.append(_best(nodes[a:b], x @ x.T, keep[a:b]))
            yield from _lists(found)

    with_units = some.join(vectors.select("node", "unit"), "node").join(room, "node", "left")
    rows = with_units.select("centre", "node", F.coalesce("room", F.lit(LIST)).cast("long").alias("room"), "unit")
    return rows.repartition("centre").sortWithinPartitions("centre", "node").mapInArrow(meet, "node long, other long, cosine double")


def _shortened(found: DataFrame, room: DataFrame) -> DataFrame:
    """The nearest others of each node, as many as it has room for."""
    nearest = Window.partitionBy("node").orderBy(F.desc("cosine"), "other")
    once = found.groupBy("node", "other").agg(F.max("cosine").alias("cosine")).withColumn("at", F.row_number().over(nearest))
    return once.join(room, "node", "left").where(F.col("at") <= F.coalesce("room", F.lit(LIST))).select("node", "other", "cosine")


def audit(vectors: DataFrame, links: DataFrame, lists: DataFrame, threshold: float) -> bool:
    """Whether ``links`` (``node, other``, both ways) hold, of the links that vectors have by brute
    force against all vectors, a mean share of ``RECALL``: each vector with links counts
    the same, and vectors of few and of many links (by powers of two) pass on their own.
    Asked are those of least hash, and of those with an other at ``NEAR`` or above in
    ``lists`` as many, until ``AUDIT_LINKED`` have links or ``MOST_AUDIT`` or all are asked.
    Where links are rare few or none of the asked have any; what they have must be held."""
    n, asked = vectors.count(), AUDIT
    near = written(lists.where(F.col("cosine") >= min(NEAR, threshold)).select("node").distinct(), "near")
    while True:
        order = F.xxhash64("node", F.lit(5))
        some = vectors.join(near, "node", "left_semi").orderBy(order).limit(asked)
        true = _brute_force(vectors, vectors.orderBy(order).limit(asked).union(some).dropDuplicates(["node"]), threshold)
        found = links.select("node", "other", F.lit(1).alias("held"))
        shares = true.join(found, ["node", "other"], "left").groupBy("node").agg(F.count("*").alias("n"), F.avg(F.coalesce("held", F.lit(0))).alias("share"))
        by_size = shares.groupBy(F.floor(F.log2("n")).alias("size")).agg(F.avg("share").alias("share"), F.count("*").alias("n")).collect()
        if any(r.share < RECALL for r in by_size):
            return False
        if asked >= min(n, MOST_AUDIT) or sum(r.n for r in by_size) >= AUDIT_LINKED:
            return True
        asked = min(asked * 6, MOST_AUDIT)


def _saturated(lists: DataFrame, room: DataFrame, threshold: float) -> DataFrame:
    """``node, room, full``: whether a list has no room left and holds links only."""
    state = lists.groupBy("node").agg(F.count("*").alias("n"), F.min("cosine").alias("least")).join(room, "node", "left")
    state = state.withColumn("room", F.coalesce("room", F.lit(LIST)))
    return state.select("node", "room", ((F.col("n") >= F.col("room")) & (F.col("least") >= threshold)).alias("full"))


def _brute_force(vectors: DataFrame, asked: DataFrame, threshold: float) -> DataFrame:
    """``node, other``: the links of the vectors ``asked``, at most twice ``MOST_AUDIT``, with all vectors."""
    queries = asked.collect()
    sent = vectors.sparkSession.sparkContext.broadcast([(r.node, r.g, bytes(r.unit)) for r in queries])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for node, g, unit in sent.value:
            nodes, rows = held.setdefault((g, len(unit)), ([], []))
            nodes.append(node)
            rows.append(np.frombuffer(unit, np.float64))
        held = {k: (np.array(a), np.stack(b)) for k, (a, b) in held.items()}
        for batch in batches:
            g, nodes = batch["g"].to_numpy(), batch["node"].to_numpy()
            wide = np.fromiter((len(x.as_buffer()) for x in batch["unit"]), np.int64, len(nodes))
            a, b = [], []
            for key, (asked, rows) in held.items():
                at = np.flatnonzero((g == key[0]) & (wide == key[1]))
                for part in (at[i : i + 4096] for i in range(0, len(at), 4096)):
                    i, j = np.nonzero(rows @ _matrix(batch["unit"].take(pa.array(part))).T >= threshold)
                    other = asked[i] != nodes[part][j]
                    a.append(asked[i][other])
                    b.append(nodes[part][j][other])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["node", "other"])

    return written(vectors.mapInArrow(search, "node long, other long"), "audit")


def _roots(near: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the ``roots`` of the first row that links reach."""
    out, open_ = roots.copy(), near.any(axis=1)
    while open_.any():
        first = int(open_.argmax())
        edge = np.array([first])
        open_[first] = False
        while len(edge):
            edge = np.flatnonzero(near[edge].any(axis=0) & open_)
            open_[edge] = False
            out[edge] = roots[first]
    return out


def compared_as_a_whole(vectors: DataFrame, copies: DataFrame, threshold: float) -> DataFrame:
    """``node, links, other`` from all pairs of a group, block by block: how many ``copies`` of others in
    the two blocks a node is linked with, and one node that these links reach.  A row
    for each node and pair of blocks with links, none for a link."""
    sizes = vectors.groupBy("g").agg(F.count("*").alias("size"), F.max(F.octet_length("unit")).alias("wide"))
    blocks = F.ceil(F.col("size") / F.greatest(F.lit(64), F.floor(F.lit(BLOCK * 8) / F.col("wide")))).cast("int")
    placed = vectors.join(broadcast_if_small(sizes), "g").join(copies, "node")
    placed = placed.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node", F.lit(9)), F.col("blocks")).cast("int"))
    met = placed.select("g", "own", "node", "copies", "unit", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
    met = met.select("g", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), "own", "node", "copies", "unit")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("own", "ascending"), ("node", "ascending")]).combine_chunks()
        own, node, copies = (table[k].to_numpy() for k in ("own", "node", "copies"))
        x = _matrix(table["unit"].combine_chunks() if hasattr(table["unit"], "combine_chunks") else table["unit"])
        near = np.zeros((len(x), len(x)), bool)
        for i in range(0, len(x), ROWS):
            near[i : i + ROWS] = x[i : i + ROWS] @ x.T >= threshold
        near |= near.T
        np.fill_diagonal(near, False)
        if own[0] != own[-1]:  # links inside a block are those of its own pair
            near &= own[:, None] != own[None, :]
        elif table["low"][0] != table["high"][0]:
            near[:] = False  # the other block is empty
        links = np.concatenate([near[i : i + ROWS] @ copies for i in range(0, len(x), ROWS)])
        some = np.flatnonzero(links)
        return pa.table({"node": node[some], "links": links[some], "other": _roots(near, node)[some]})

    return met.groupBy("g", "low", "high").applyInArrow(compare, "node long, links long, other long")


def link_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: ``vec_id, n_links`` (other vectors of equal label with a cosine of at least
    ``threshold``), ``component_id`` (smallest id that links reach), ``kept`` (whether that is its own).

    1. Equal vectors of equal label are one node with a number of copies.
    2. Lists of near nodes start from nodes that random hyperplanes do not part.
    3. NN-descent: nodes that are in one list, or have one node in theirs, meet; lists keep the
       nearest.  A list that holds links only is saturated and gets twice the room, up to
       ``MOST_ROOM``.  Nodes in a large neighbourhood meet a part at a time, another in each
       round.  It ends when a round finds hardly any new link and no list can grow.  Labels
       with a list that is still saturated then leave the descent: all their pairs are
       compared, block by block, which makes no row for a link.
    4. An audit compares some nodes with all others; below a recall of ``RECALL`` lists get another
       start from new hyperplanes and descend again, ``DESCENTS`` times at most.  If the audit
       is still not passed then, all other labels are compared like that, too.
    5. Pairs at the threshold or above, by cosine in double precision, are links.

    Vectors that are null, empty, zero, or hold null or non-finite components, and those
    with a null label, have no links and are components of their own; so are vectors of
    another dimension to each other.  Repeated rows are copies, linked with each other.  A
    null id is the smallest.  Other columns are not read.
    """
    named = rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v"))
    named = named.withColumn("fit", F.col("label").isNotNull() & _finite(F.col("v")))
    named = written(named.withColumn("node", F.when(F.col("fit"), F.xxhash64("label", "v"))).drop("fit"), "vectors")
    fit = named.where("node is not null")
    classes = written(
        fit.groupBy("node").agg(F.min(F.struct("vec_id")).alias("first"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("v").alias("v")),
        "classes",
    )
    vectors = written(unit_vectors(classes), "units")
    spark = rows.sparkSession
    room = spark.createDataFrame([], "node long, room int")
    lists = spark.createDataFrame([], "node long, other long, cosine double")
    old = None
    enough = F.col("cosine") >= threshold
    crowded = vectors.limit(0)
    for descent in range(DESCENTS):
        path, lists = write_table(_shortened(lists.unionByName(start_lists(vectors, descent, threshold)), room), "lists")
        links = lists.where(enough).count()
        for turn in range(ROUNDS):
            state = _saturated(lists, room, threshold)
            more = F.when(F.col("full") & (F.col("room") < MOST_ROOM), 2).otherwise(1)
            room = written(state.select("node", (F.col("room") * more).cast("int").alias("room")), "room")
            met = meet_neighbours(lists, vectors, room, descent * ROUNDS + turn)
            old, (path, lists) = path, write_table(_shortened(lists.unionByName(met), room), "lists")
            delete_table(spark, old)
            before, links = links, lists.where(enough).count()
            if links <= before * 1.0005 and not _saturated(lists, room, threshold).where(F.col("full") & (F.col("room") < MOST_ROOM)).limit(1).count():
                break
        groups = vectors.join(_saturated(lists, room, threshold).where("full").select("node"), "node").select("g").distinct()
        split = written(vectors.join(groups.withColumn("crowd", F.lit(True)), "g", "left"), "groups")
        crowded = crowded.unionByName(split.where("crowd").drop("crowd"))
        vectors = split.where("crowd is null").drop("crowd")
        path, lists = write_table(lists.join(vectors.select("node"), "node", "left_semi"), "lists")
        ends = lists.where(enough).select("node", "other")
        linked = written(ends.union(ends.select("other", "node")).distinct(), "linked")
        if audit(vectors, linked, lists, threshold):
            whole = crowded
            break
    else:
        whole = crowded.unionByName(vectors)
    if whole.limit(1).count():
        compared = written(compared_as_a_whole(whole, classes.select("node", "copies"), threshold), "compared")
        linked = linked.join(whole.select("node"), "node", "left_anti")
    else:
        compared = spark.createDataFrame([], "node long, links long, other long")
    copies = classes.select(F.col("node").alias("other"), F.col("copies").alias("weight"))
    counts = linked.join(copies, "other").select("node", F.col("weight").alias("links")).unionByName(compared.select("node", "links"))
    counts = counts.groupBy("node").agg(F.sum("links").alias("links"))
    edges = linked.select("node", "other").unionByName(compared.where("node <> other").select("node", "other"))
    members = connected_components(edges, "node", "other")
    least = members.join(classes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("group"))
    groups = members.join(least, "component").select("node", "group")
    judged = (
        classes.select("node", "first", "copies").join(counts, "node", "left").join(groups, "node", "left")
        .select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("group", "first").alias("group"))
    )
    out = named.select("vec_id", "node").join(judged, "node", "left")
    component = F.when(F.col("group").isNull(), F.col("vec_id")).otherwise(F.col("group.vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

"""A Merkle manifest: digests go up a tree by time-forward processing, proofs come down again.

A node's label is its level and its place in the level.  Nodes are swept in the order of
labels: what a node computes waits in a queue, ordered by label, until its parent is due.
Inside a block of ``2 ** BITS`` neighbours of a level that queue is a heap; between blocks it is
a written table that Spark sorts by tree, block and place, so it may be of any size.  The way
back is the same sweep in reverse: every block first gets what is above it, one row, and hands
each of its nodes the siblings from there to the root.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.plans.sizes import broadcast_if_small, write_table, written

#: Levels of a block: 1 024 nodes, the digests of 2 047 in a task at a time.
BITS = 10

Label = tuple[int, int]


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of values: of each its bytes in UTF-8, ``:`` and itself, or ``-`` for a null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof of ``manifest`` lead to."""
    sibling = lambda s: F.substring(s, 2, 64)
    joined = lambda a, s: F.when(s.startswith("<"), F.concat(sibling(s), a)).when(s.startswith(">"), F.concat(a, sibling(s))).otherwise(a)
    return F.aggregate(proof, leaf, lambda a, s: F.sha2(joined(a, s), 256))


def siblings_digest(proof: Column) -> Column:
    """One digest of a proof's siblings, the lowest first."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.substring(s, 2, 64)), ""), 256)


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    tree: str = "lang",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Every row as a leaf of its ``tree``, with its way to the root of all trees.

    Returns ``key``, ``leaf`` (the digest of ``columns``), ``subroot`` (of its tree), ``root``,
    ``proof`` and the columns of ``carry``.  A proof has one string a level, the lowest first:
    ``<`` or ``>`` and the digest of the sibling on that side, or nothing where a node is the
    only child.  Leaves of a tree ascend by key, trees by name, nulls first; rows of one key
    ascend by digest, and equal rows take places next to each other.  A null tree is a tree;
    other columns are not read; an empty table has no rows.

    Texts are read once.  What is shuffled after that are digests: once to number the rows, once
    up and once down.  No tree, tree name or row repeated often is a task of its own, for rows
    are numbered over ranges of (tree, key, digest, row).
    """
    carry = carry or {}
    rows = docs.select(
        F.col(key).alias("key"), F.col(tree).alias("name"), leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
        *[c.alias(f"carry_{n}") for n, c in carry.items()], F.monotonically_increasing_id().alias("row"),
    )
    ranked = _numbered(written(rows, "leaves"), ["name", "key", "digest", "row"])[0]
    trees, count = _numbered(ranked.groupBy("name").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")), ["name"])
    trees = broadcast_if_small(trees.select(F.col("name").alias("tree_name"), F.col("rank").alias("tree"), "first", "n"))
    leaves = ranked.join(trees, ranked["name"].eqNullSafe(trees["tree_name"])).select(
        "tree", (F.col("rank") - F.col("first")).alias("place"), "n", "digest", "key", *[f"carry_{n}" for n in carry]
    )
    rounds = _up(leaves.select("tree", "place", "n", "digest"))
    subroots = rounds[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(count).cast("long").alias("n"), "digest")
    tops = _up(written(subroots, "subroots"))
    # The root hears of itself; then every node, down to the leaves, of what is above it.
    told = tops[-1].select("tree", "place", F.array().cast("array<string>").alias("proof"), F.col("digest").alias("root"), F.lit(None).cast("string").alias("subroot"))
    for nodes in reversed(tops[:-1]):
        told = _down(nodes, told)
    subroots = tops[0].select(F.col("place").alias("tree_no"), F.col("digest").alias("own"))
    told = told.join(subroots, F.col("place") == F.col("tree_no")).select(
        F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "proof", "root", F.col("own").alias("subroot")
    )
    for nodes in reversed(rounds[1:-1]):
        told = _down(nodes, told)
    if len(rounds) > 1:
        leaves = _down(leaves, told)
    else:  # every tree is a leaf
        leaves = leaves.join(told.withColumnsRenamed({"place": "top"}), "tree")
    return leaves.select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "proof", *[F.col(f"carry_{n}").alias(n) for n in carry]
    )


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """``manifest`` of ``documents`` with digests of proofs, and what ``fold`` makes of rows whose
    ``n_chars`` was raised by one: those with a CRC-32 of the id that 7 divides (a null id has none)."""
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(38,0)") + 1  # of any integer type
    other = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text"))
    found = manifest(docs, carry={"tampered": F.when(changed, other)})
    folded = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", siblings_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Rows with their ``rank`` in an order, from 0, and how many they are."""
    spark = df.sparkSession
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            own = [pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=schema.names)
            at += n

    ranges = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    rows = written(ranges.sortWithinPartitions(*order).mapInArrow(number, schema), "numbered")
    # One row a range: as many as Spark has shuffle partitions.
    firsts, total = [], 0
    for part, n in sorted(rows.groupBy("part").count().collect()):
        firsts.append((part, total))
        total += n
    firsts = spark.createDataFrame(firsts, "part int, before long")
    return rows.join(F.broadcast(firsts), "part").withColumn("rank", F.col("before") + F.col("at")).drop("part", "before", "at"), total


def _width(n: int, level: int) -> int:
    """Nodes of a level above ``n`` nodes."""
    return -(-n >> level)


def _sweep(first: int, n: int, digests: list[str]) -> dict[Label, str]:
    """All nodes on the ``BITS`` levels over a block of a level of ``n`` nodes, by label."""
    queue: list[tuple[Label, str]] = [((0, first + i), d) for i, d in enumerate(digests)]
    nodes: dict[Label, str] = {}
    left = ""
    while queue:
        (level, place), digest = heapq.heappop(queue)
        nodes[level, place] = digest
        width = _width(n, level)
        if level == BITS or width == 1:
            continue
        if place % 2 == 0 and place + 1 < width:
            left = digest  # its sibling is next
            continue
        run = left + digest if place % 2 else digest
        heapq.heappush(queue, ((level + 1, place >> 1), sha256(run.encode()).hexdigest()))
    return nodes


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, of rows that are sorted by tree and block."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        trees, blocks = rest["tree"].to_numpy(), rest["block"].to_numpy()
        ends = ((trees[1:] != trees[:-1]) | (blocks[1:] != blocks[:-1])).nonzero()[0] + 1
        start = 0
        for end in ends.tolist():
            yield rest.slice(start, end - start)
            start = end
        rest = rest.slice(start)
    if rest is not None and rest.num_rows:
        yield rest


def _by_block(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _up(nodes: DataFrame) -> list[DataFrame]:
    """Nodes, the nodes ``BITS`` levels above, and so on until each tree is one node."""
    schema = "tree long, place long, n long, digest string"

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            tree, first, n = (block[c][0].as_py() for c in ("tree", "place", "n"))
            nodes = _sweep(first, n, block["digest"].to_pylist())
            top = next(reversed(nodes.values()))
            yield pa.RecordBatch.from_pydict({"tree": [tree], "place": [first >> BITS], "n": [_width(n, BITS)], "digest": [top]})

    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = rounds[-1].withColumn("block", F.shiftright("place", BITS))
        rounds.append(written(_by_block(below).mapInArrow(forward, schema), "nodes"))
        most = _width(most, BITS)
    return rounds


def _down(nodes: DataFrame, told: DataFrame) -> DataFrame:
    """Nodes with ``proof``, ``root`` and ``subroot``, by what the nodes ``BITS`` levels above were told."""
    news = T.StructType([f for f in told.schema.fields if f.name in ("proof", "root", "subroot")])
    schema = T.StructType([*nodes.schema.fields, *news])
    names = nodes.columns

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            # The row from above is the first, for its place is -1.
            above = {c: block[c][0].as_py() for c in news.names}
            block = block.slice(1)
            if not block.num_rows:
                continue
            first, n = block["place"][0].as_py(), block["n"][0].as_py()
            digests = _sweep(first, n, block["digest"].to_pylist())
            proofs: dict[Label, list[str]] = {}
            for level, place in sorted(digests, reverse=True):
                parent = proofs.get((level + 1, place >> 1))
                if parent is None:
                    proofs[level, place] = above["proof"]
                    continue
                other = digests.get((level, place ^ 1))
                proofs[level, place] = ["" if other is None else "<>"[1 - place % 2] + other, *parent]
            rows = block.num_rows
            own = [pa.array([proofs[0, first + i] for i in range(rows)], pa.list_(pa.string()))]
            own += [pa.array([above[c]] * rows, pa.string()) for c in news.names[1:]]
            table = pa.Table.from_arrays([*[block[c].combine_chunks() for c in names], *own], names=schema.names)
            yield from table.to_batches()

    mine = nodes.withColumn("block", F.shiftright("place", BITS))
    theirs = told.select("tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), *news.names)
    return _by_block(mine.unionByName(theirs, allowMissingColumns=True)).mapInArrow(backward, schema)

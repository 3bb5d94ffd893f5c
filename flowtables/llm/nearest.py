"""Nearest vectors by cosine: an HNSW graph for each shard, kept as a table of neighbour arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.llm import hnsw
from flowtables.llm.neighbours import _finite
from flowtables.plans.sizes import written

#: Vectors of a shard, and numbers in all of its vectors, at most; vectors below which shards of idle cores would not pay.
SHARD_ROWS, SHARD_NUMBERS, LEAST_ROWS = 1 << 16, 1 << 24, 1 << 10
#: Width of a search, at least this many times the neighbours asked for; queries of a lot.
SEARCH_WIDTH, LOT = 128, 256


@dataclass(frozen=True)
class Index:
    """``nodes`` has a row for each different vector: shard, dim, node (its place in the shard's
    flat arrays), class_id, vector, depth (layers that hold it) and links (its neighbours' places,
    layer by layer, -1 where there is none).  ``classes`` has the rows behind it: class_id, vector
    and members (vec_id and row, the least of them), ``rows`` every row that takes part."""

    nodes: DataFrame
    classes: DataFrame
    rows: DataFrame
    shards: int
    neighbours: int


def build_index(df: DataFrame, neighbours: int = 5, id_column: str = "vec_id", vector: str = "embedding") -> Index:
    """An index of every row with a vector that is not null or zero and has no null and no
    component that is not finite.

    Equal vectors are one node, however many rows have them, for lists full of copies would lead
    nowhere; of their rows the ``neighbours + 1`` of least id (nulls last) are kept as members, which
    is all that a search can return.  Shards are by hash, so they are even, and hold ``SHARD_ROWS``
    vectors at most.  Vectors of different lengths share shards but not graphs.
    """
    spark = df.sparkSession
    rows = df.where(_finite(F.col(vector))).select(
        F.col(id_column).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.monotonically_increasing_id().alias("row")
    )
    rows = written(rows, "vectors")
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("row")]
    place = F.row_number().over(Window.partitionBy("vector").orderBy(*by_id))
    classes = rows.withColumn("place", place).where(F.col("place") <= neighbours + 1).groupBy("vector").agg(
        F.array_sort(F.collect_list(F.struct("place", "vec_id", "row"))).alias("members")
    )
    classes = written(classes.select("vector", F.col("members")[0]["row"].alias("class_id"), "members"), "classes")
    count, dim = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    most = max(1, min(SHARD_ROWS, SHARD_NUMBERS // (dim or 1)))
    shards = max(1, -(-count // most), min(spark.sparkContext.defaultParallelism, count // LEAST_ROWS))
    order = F.xxhash64("class_id")
    schema = "shard int, dim int, node int, class_id long, vector array<double>, depth int, links array<int>"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ("shard", "dim")):
            vectors = _matrix(table["vector"], table["dim"][0].as_py())
            layers = hnsw.build(_units(vectors))
            depth = np.sum([np.arange(table.num_rows) < len(x) for x in layers], axis=0)
            flat = np.full((table.num_rows, sum(x.shape[1] for x in layers)), -1, np.int32)
            at = 0
            for links in layers:
                flat[: len(links), at : at + links.shape[1]] = links
                at += links.shape[1]
            ends = 2 * hnsw.M + (depth - 1) * hnsw.M
            links = [flat[i, :end] for i, end in enumerate(ends.tolist())]
            own = {"node": pa.array(np.arange(table.num_rows, dtype=np.int32)), "depth": pa.array(depth.astype(np.int32)), "links": pa.array(links, pa.list_(pa.int32()))}
            names = [f.split()[0] for f in schema.split(", ")]
            yield from pa.table([own[c] if c in own else table[c] for c in names], names=names).to_batches(max_chunksize=4096)

    placed = classes.select(
        F.pmod(order, F.lit(shards)).cast("int").alias("shard"), F.size("vector").alias("dim"), order.alias("place"), "class_id", "vector"
    )
    placed = placed.repartitionById(shards, "shard").sortWithinPartitions("shard", "dim", "place", "class_id")
    return Index(written(placed.mapInArrow(build, schema), "graph"), classes, rows, shards, neighbours)


def search_index(index: Index, asks: Column) -> DataFrame:
    """The nearest rows of each row that ``asks`` (over vec_id), itself excluded: query_id, query_row,
    rank, vec_id, score.

    Every query goes to every shard and the shards' results are merged.  A shard finds candidates in
    single precision; their cosines are then computed in double precision on the vectors as given,
    and decide, ties going to the smaller id.  Equal query vectors are searched for once.
    """
    k = index.neighbours
    asking = index.rows.where(asks)
    wanted = index.classes.join(asking.select("vector").distinct(), "vector").select("class_id", "vector", "members")
    wanted = written(wanted, "queries")
    sent = wanted.select(F.explode(F.sequence(F.lit(0), F.lit(index.shards - 1))).alias("shard"), F.size("vector").alias("dim"), F.lit(1 << 31).cast("long").alias("node"), "class_id", "vector")
    rows = index.nodes.withColumn("node", F.col("node").cast("long")).unionByName(sent, allowMissingColumns=True)
    rows = rows.repartitionById(index.shards, "shard").sortWithinPartitions("shard", "dim", "node")
    found = rows.mapInArrow(_search_shards(k), "query_class long, class_id long, score double")
    # Itself is the nearest of all: its other members come first.
    own = wanted.select(F.col("class_id").alias("query_class"), "class_id", _cosine("vector").alias("score"))
    hits = found.unionByName(own).join(index.classes.select("class_id", "members"), "class_id")
    hits = hits.select("query_class", "score", F.inline("members")).select("query_class", F.struct((-F.col("score")).alias("far"), F.col("vec_id").isNull().alias("no_id"), "vec_id", "row").alias("hit"))
    best = hits.withColumn("place", F.row_number().over(Window.partitionBy("query_class").orderBy("hit"))).where(F.col("place") <= k + 1)
    best = best.groupBy("query_class").agg(F.array_sort(F.collect_list("hit")).alias("hits"))
    best = wanted.select(F.col("class_id").alias("query_class"), "vector").join(best, "query_class")
    mine = asking.select(F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"), "vector").join(best, "vector")
    others = F.slice(F.filter("hits", lambda h: h["row"] != F.col("query_row")), 1, k)
    return mine.select("query_id", "query_row", F.posexplode(others).alias("place", "hit")).select(
        "query_id", "query_row", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score")
    )


def nearest_vectors(df: DataFrame, every: int = 50, neighbours: int = 5) -> DataFrame:
    """For each row whose ``vec_id`` is divisible by ``every``: the ``neighbours`` nearest other rows.

    Rows: query_id, rank (from 1), vec_id, score.  A null id asks nothing but is found, after others
    at the same cosine.  Rows of one id are different rows: each asks, and each is found by the
    other.  Vectors of other lengths are not compared; a query without candidates has no rows.
    """
    index = build_index(df, neighbours)
    return search_index(index, F.col("vec_id") % every == 0).select("query_id", "rank", "vec_id", "score")


def recall(df: DataFrame, found: DataFrame, sample: int = 200, neighbours: int = 5) -> float:
    """The share of the true nearest rows of a sample of queries (those of the least hashes) that
    ``found`` has; queries are compared with all rows, block by block."""
    asked = found.select("query_id").distinct().orderBy(F.xxhash64("query_id")).limit(sample)
    vectors = df.where(_finite(F.col("embedding"))).select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    queries = [(r.vec_id, np.array(r.vector)) for r in vectors.join(F.broadcast(asked.withColumnRenamed("query_id", "vec_id")), "vec_id").collect()]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vector").offsets.to_numpy())
            for at, (query_id, query) in enumerate(queries):
                fits = np.flatnonzero(sizes == len(query))
                if not len(fits):
                    continue
                x = _matrix(pa.chunked_array([batch.column("vector").take(pa.array(fits))]), len(query))
                score = _scores(x, query)
                best = np.argsort(-score)[: neighbours + 1]
                yield pa.RecordBatch.from_pydict({"at": [at] * len(best), "query_id": [query_id] * len(best), "vec_id": batch.column("vec_id").take(pa.array(fits[best])), "score": score[best]})

    every = vectors.mapInArrow(compare, "at long, query_id long, vec_id long, score double").where(~F.col("query_id").eqNullSafe(F.col("vec_id")))
    nth = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "vec_id"))
    truth = every.withColumn("nth", nth).where(F.col("nth") <= neighbours).groupBy("at", "query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    # A row at the cosine of the last true one is as near.
    hits = found.join(truth, "query_id").groupBy("at").agg(F.least(F.max("n"), F.sum((F.col("score") >= F.col("least") - 1e-12).cast("int"))).alias("hits"))
    return truth.join(hits, "at", "left").agg(F.sum(F.coalesce("hits", F.lit(0))) / F.sum("n")).first()[0] or 1.0


def _cosine(vector: str) -> Column:
    """Of a vector with itself, as ``_scores`` has it."""

    @F.pandas_udf("double")
    def own(vectors):  # noqa: ANN001, ANN202
        return vectors.map(lambda v: _scores(np.asarray(v)[None], np.asarray(v))[0])

    return own(vector)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times a power of two, which changes no cosine and keeps squares in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def _scores(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines of rows with a query, in double precision."""
    x, query = _scaled(x), _scaled(query)
    return np.einsum("ij,j->i", x, query) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("j,j->", query, query)))


def _units(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return (x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]).astype(np.float32)


def _matrix(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) for c in vectors.chunks if len(c)])


def _runs(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each key, of rows sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in key])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            own = tuple(keys[:, a].tolist())
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = own
    if held:
        yield pa.Table.from_batches(held)


def _search_shards(k: int):
    """Searches of the queries behind each shard's nodes, a lot at a time."""
    width = max(SEARCH_WIDTH, 8 * k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = graph = None
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "dim")])
            asking = batch.column("depth").is_null().to_numpy(zero_copy_only=False)
            steps = (keys[:, 1:] != keys[:, :-1]).any(axis=0) | (asking[1:] != asking[:-1])
            edges = [0, *(np.flatnonzero(steps) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                part, own = batch.slice(a, b - a), tuple(keys[:, a].tolist())
                if own != key:
                    key, graph, held = own, None, []
                if not asking[a]:
                    held.append(part)
                    continue
                if graph is None:
                    if not held:  # no vector of this length
                        continue
                    graph, held = _graph(pa.Table.from_batches(held), key[1]), []
                for at in range(0, part.num_rows, LOT):
                    yield _answers(graph, part.slice(at, LOT), key[1], width, k)

    return run


def _graph(nodes: pa.Table, dim: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    vectors = _matrix(nodes["vector"], dim)
    depth = nodes["depth"].to_numpy()
    flat = np.concatenate([c.flatten().to_numpy() for c in nodes["links"].chunks if len(c)])
    # Nodes are in the order of depth, so a layer is a strided part of each run of equal depth.
    starts = np.concatenate([[0], np.cumsum(2 * hnsw.M + (depth - 1) * hnsw.M)])
    layers = []
    for layer in range(int(depth[0])):
        count, width = int((depth > layer).sum()), hnsw.M if layer else 2 * hnsw.M
        first = starts[:count] + (hnsw.M * (layer + 1) if layer else 0)
        layers.append(flat[first[:, None] + np.arange(width)])
    return layers, _units(vectors), vectors, nodes["class_id"].to_numpy()


def _answers(graph, part: pa.RecordBatch, dim: int, width: int, k: int) -> pa.RecordBatch:  # noqa: ANN001
    layers, units, vectors, classes = graph
    queries, asked = _matrix(pa.chunked_array([part.column("vector")]), dim), part.column("class_id").to_numpy()
    ids, near = hnsw.search(layers, units, _units(queries), min(width, len(units)))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for query, own, nodes, cosine in zip(queries, asked, ids, near):
        nodes = nodes[(cosine > -np.inf) & (classes[nodes] != own)]
        score = _scores(vectors[nodes], query)
        best = np.lexsort((classes[nodes], -score))
        if len(best) > k:  # and all that are as near as the last of them
            best = best[score[best] >= score[best[k - 1]]]
        out.append((np.full(len(best), own), classes[nodes][best], score[best]))
    columns = [np.concatenate(c) for c in zip(*out)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_class", "class_id", "score"])

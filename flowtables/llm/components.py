"""Connected components by repeated local contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.plans.sizes import delete_table, write_table

MOST_ROUNDS = 200


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node that an edge names; the component is the
    smallest node that links reach.  Edges are undirected; nulls, loops and repeats
    do no harm.  Nodes may be of any type that Spark orders and hashes.

    In each round every node moves to the node of least hash among itself and its
    neighbours, and edges move with their ends.  What is left is a constant share of
    the nodes, so rounds grow as the logarithm of the input, also along paths.  A
    node's minimum is a partial aggregate, so a node with very many edges costs one
    row per task; joins on such a node are plain equi-joins, which Spark splits.
    Each round writes its edges and moves to the shared folder; edges of the round
    before are deleted.
    """
    spark = edges.sparkSession
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    path, left = write_table(_ordered(ends), "links")
    moves = []
    for _ in range(MOST_ROUNDS):
        if left.isEmpty():
            break
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.struct(F.xxhash64("v").alias("h"), F.col("v").alias("n"))).alias("m"))
        own = F.struct(F.xxhash64("u").alias("h"), F.col("u").alias("n"))
        _, move = write_table(least.select(F.col("u").alias("node"), F.least("m", own)["n"].alias("to")), "moves")
        moves.append(move)
        moved = (
            left.join(move.select(F.col("node").alias("u"), F.col("to").alias("u2")), "u")
            .join(move.select(F.col("node").alias("v"), F.col("to").alias("v2")), "v")
            .select(F.col("u2").alias("u"), F.col("v2").alias("v"))
            .where("u <> v")
        )
        old, (path, left) = path, write_table(_ordered(moved), "links")
        delete_table(spark, old)
    else:
        raise RuntimeError("components did not settle")
    if not moves:
        return left.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = moves[-1].withColumnRenamed("to", "root")
    for move in reversed(moves[:-1]):
        further = roots.select(F.col("node").alias("to"), F.col("root").alias("further"))
        roots = move.join(further, "to", "left").select("node", F.coalesce("further", "to").alias("root"))
    _, roots = write_table(roots, "roots")
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(least, "root").select("node", "component")


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

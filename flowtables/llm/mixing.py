"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowtables.llm.columns import apart
from flowtables.plans.sizes import written

#: Documents that are rounded together; each such block leaves one fraction at most.
BLOCK = 2_000


def word_count(text: Column) -> Column:
    """Runs of anything but space, tab and the other ASCII line and page breaks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code point order, null last, take ``weights`` in turn, and share ``share``
    times the sum of all sizes by weight.  A target stops at ``most`` times its source's
    size; what is over goes to the others by weight, until none is above.  That is
    min(cap, level * weight) for the level at which the targets add up: sources are
    taken by cap / weight, and the level is the first that the next cap does not hold
    back.  One row per source is all that is ordered here.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int")
    weighted = sizes.withColumn("w", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)).withColumn(
        "cap", F.col("source_size") * F.lit(float(most))
    )
    filled = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) * F.lit(float(share)) - (F.sum("cap").over(filled) - F.col("cap"))) / (
        F.sum("w").over(whole) - (F.sum("w").over(filled) - F.col("w"))
    )
    ranked = weighted.withColumns({"level": level, "at": F.row_number().over(filled)})
    free = ranked.withColumn("first", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("at"))).over(whole))
    chosen = F.max(F.when(F.col("at") == F.col("first"), F.col("level"))).over(whole)
    target = F.when(chosen.isNull(), F.col("cap")).otherwise(F.least("cap", chosen * F.col("w")))
    return free.select("source", "source_size", target.alias("target"))


def pivot(p: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Round fractions so that at most one stays, and sum(p * size) stays as it is.

    Two fractions meet; what one gives in words the other takes, in the direction
    that ``draw`` (in [0, 1)) chooses with the odds that keep each one's expectation,
    until one of them is 0 or 1.  The other meets the next."""
    out, open_ = p.copy(), -1
    for i in np.flatnonzero((p > 0) & (p < 1)):
        if open_ < 0:
            open_ = i
            continue
        a, b, s, t = out[open_], out[i], size[open_], size[i]
        up, down = min((1 - a) * s, b * t), min(a * s, (1 - b) * t)
        move = up if draw[i] * (up + down) < down else -down
        # an end that is reached is set, not computed
        out[open_] = 1.0 if move == (1 - a) * s else 0.0 if move == -a * s else a + move / s
        out[i] = 0.0 if move == b * t else 1.0 if move == -(1 - b) * t else b - move / t
        if not 0 < out[open_] < 1:
            open_ = i if 0 < out[i] < 1 else -1
    return out


def round_copies(rows: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """``rows`` (``doc_id, source, size, tie, rate``) with ``copies``: the whole part of ``rate``
    or one more, so that size * copies adds up to size * rate in each source but for the
    last fraction, which goes to the nearer side.

    Blocks of a source are rounded in parallel, from long documents to short ones, so
    that documents of like size meet and what is left over is short.  The fractions that blocks leave, one each, form new blocks, and so on: a tree
    of as many levels as the logarithm of the rows to base ``block``.  Draws come from a
    hash of the row, so reruns agree.  A source that holds most rows is many blocks.
    """
    hashed = F.xxhash64("doc_id", "size", "tie", F.lit(seed))
    fraction = F.col("rate") - F.floor("rate")
    # a document without words weighs nothing either way
    fraction = F.when(F.col("size") > 0, fraction).otherwise(0.0)
    rows = rows.withColumns(
        {"whole": F.floor("rate"), "p": fraction, "hash": hashed, "draw": F.shiftrightunsigned(hashed, 11).cast("double") / float(1 << 53)}
    )
    schema = rows.schema.add("block", "long")

    def rounded(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks follow each other in a sorted partition; one may go on in the next batch."""
        rest = None
        for pdf in groups:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            ends = np.flatnonzero(_new_block(pdf)[1:]) + 1
            cut = ends[-1] if len(ends) else 0
            rest = pdf.iloc[cut:]
            yield from done(pdf.iloc[:cut])
        if rest is not None:
            yield from done(rest)

    def done(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if len(pdf):
            edges = [*np.flatnonzero(_new_block(pdf)), len(pdf)]
            p, size, draw = (pdf[c].to_numpy("float64", copy=True) for c in ("p", "size", "draw"))
            for a, b in zip(edges, edges[1:]):
                p[a:b] = pivot(p[a:b], size[a:b], draw[a:b])
            yield pdf.assign(p=p)

    finished, level = [], 0
    counts = rows.groupBy("source").agg(F.count("*").alias("n"))
    while True:
        blocks = F.ceil(F.col("n") / F.lit(block))
        spread = F.pmod(F.xxhash64("hash", F.lit(level)), blocks)
        cut = rows.join(counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).withColumn("block", spread).drop("n", "s")
        sorted_ = cut.repartition("source", "block").sortWithinPartitions("source", "block", F.desc("size"), "hash")
        after = written(sorted_.mapInPandas(rounded, schema).drop("block"), "rounded")
        open_ = after.where("p > 0 and p < 1")
        counts = written(open_.groupBy("source").agg(F.count("*").alias("n")), "fractions")
        finished.append(after.where("p = 0 or p = 1"))
        if counts.where("n > 1").isEmpty():
            finished.append(open_.withColumn("p", (F.col("p") >= 0.5).cast("double")))
            break
        rows, level = open_, level + 1
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.withColumn("copies", (F.col("whole") + F.col("p")).cast("int")).drop("whole", "p", "hash", "draw")


def _new_block(pdf: pd.DataFrame) -> np.ndarray:
    source, block = pdf["source"], pdf["block"].to_numpy()
    code = pd.factorize(source, use_na_sentinel=True)[0]
    return np.concatenate([[True], (code[1:] != code[:-1]) | (block[1:] != block[:-1])]) if len(pdf) else np.zeros(0, bool)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """How often each document is taken: ``doc_id, size, tie, source, source_size, target,
    copies``, one row per row of ``docs``; ``tie`` is a hash of the text.

    A source's rate is its target by its size; each document gets the whole part of the
    rate, or one more by ``round_copies``.  With a rate of at most ``most``, a whole
    number, no document is taken more than ``most`` times.  Null and empty texts have no
    words and get the whole part of the rate; a source without words has target 0 and
    rate 0.  Null is a source of its own, after all others.  Equal rows are rows of
    their own.  Columns besides the three named are not read.
    """
    narrow = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            F.xxhash64(text).alias("tie"),
        ),
        "words",
    )
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights, share, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    named = targets.select(F.col("source").alias("s"), "source_size", "target", rate.alias("rate"))
    rows = narrow.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return round_copies(rows, seed).drop("rate")


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """``docs`` with every row repeated as often as ``mix`` takes it, all columns kept.

    Rows meet their number by document id, source and hash of the text; where several
    rows agree in all three, they are told apart by their place among them."""
    taken = mix(docs, doc_id=doc_id, text=text, source=source, **settings)
    names, (docs, named) = docs.columns, apart(docs)
    doc_id, text, source = (named[c] for c in (doc_id, text, source))
    keys = {"_id": "doc_id", "_source": "source", "_tie": "tie"}
    lists = taken.groupBy(*[F.col(v).alias(k) for k, v in keys.items()]).agg(F.sort_array(F.collect_list("copies")).alias("_copies"))
    own = docs.columns
    rows = docs.withColumns({"_id": F.col(doc_id), "_source": F.col(source), "_tie": F.xxhash64(text)})
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    joined = rows.alias("r").join(lists.alias("l"), same).select("r.*", "l._copies")
    place = F.row_number().over(Window.partitionBy("_id", "_source", "_tie").orderBy("_tie"))
    several = F.when(F.size("_copies") > 1, F.get("_copies", place - 1)).otherwise(F.get("_copies", F.lit(0)))
    counted = joined.withColumn("_n", several).where("_n > 0")
    return counted.select(*own, F.explode(F.sequence(F.lit(1), "_n")).alias("_copy")).drop("_copy").toDF(*names)


def mix_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of all documents, and ``copies``."""
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")

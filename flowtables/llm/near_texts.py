"""Texts that share most of their runs of five words: a MinHash LSH forest, verified exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.llm.columns import apart
from flowtables.llm.components import connected_components
from flowtables.llm.words import mix64, pieces, shingles, word_hashes
from flowtables.plans.sizes import written

THRESHOLD = 0.8
#: Trees of the forest, hashes along a path of a tree, and the chance with which two
#: texts at the threshold must meet.
TREES, DEPTH, RECALL = 20, 8, 0.9999
#: Texts of a bucket that are compared in one go; larger buckets are cut in blocks.
BLOCK = 256
HASHES_AT_A_TIME = 1 << 15

_SEEDS = np.random.default_rng(7).integers(1, 1 << 62, (TREES * DEPTH, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prefix_length(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Hashes of a path that two texts must share: as many as the depth, one less each
    time the chance to share them in some tree is below ``recall`` at the threshold."""
    for length in range(DEPTH, 1, -1):
        if 1 - (1 - threshold**length) ** TREES >= recall:
            return length
    return 1


def signatures(hashes: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each text with shingles the hash of the first ``length`` hashes of its path in each
    tree: a row for each text, a column for each tree."""
    full = np.flatnonzero(np.diff(starts))
    out = np.zeros((len(full), TREES), np.uint64)
    heads = starts[:-1][full]
    least = np.empty(len(full), np.uint64)
    for tree in range(TREES):
        key = np.full(len(full), tree + 1, np.uint64)
        for step in range(length):
            a, b = _SEEDS[tree * DEPTH + step]
            least[:] = np.iinfo(np.uint64).max
            for at in range(0, len(hashes), HASHES_AT_A_TIME):
                part = (hashes[at : at + HASHES_AT_A_TIME] ^ a) * b
                first, last = np.searchsorted(heads, [at, at + len(part)], "right")
                cuts = heads[first:last] - at
                if first and (not len(cuts) or cuts[0] > 0):  # a text that goes on
                    cuts, first = np.concatenate([[0], cuts]), first - 1
                cuts = cuts[cuts < len(part)]
                low = np.minimum.reduceat(part, cuts)
                least[first : first + len(cuts)] = np.minimum(least[first : first + len(cuts)], low)
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + least)
        out[:, tree] = key
    return out


def _fingerprint(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, th, fp, n, keys`` of ``doc_id, text``: hash of the text, fingerprint and number of its
    shingles (null and 0 without words), and a key for each tree."""
    length = prefix_length()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            hashes, at = shingles(*word_hashes(batch["text"]))
            n = np.diff(at)
            keys = iter(signatures(hashes, at, length).view(np.int64))
            prints = [_fingerprint(hashes[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:])]
            paths = [next(keys) if k else None for k in n]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["th"], pa.array(prints, pa.binary()), pa.array(n), pa.array(paths, pa.list_(pa.int64()))],
                ["doc_id", "th", "fp", "n", "keys"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(sketch, f"doc_id {kind}, th long, fp binary, n long, keys array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``fp, own``: the shingles of the texts that ``wanted`` (``doc_id, th``) names, computed again."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            hashes, at = shingles(*word_hashes(batch["text"]))
            own = [hashes[a:b] for a, b in zip(at[:-1], at[1:]) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_fingerprint(x) for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())], ["fp", "own"]
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.th") == F.col("w.th"))
    some = rows.join(wanted.alias("w"), same, "left_semi").select("text")
    # repeated rows give a set more than once
    return some.mapInArrow(sets, "fp binary, own binary").dropDuplicates(["fp"])


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches of whole groups from rows that are sorted by ``key``."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in key:
            column = batch[k].to_numpy(zero_copy_only=False)
            change[1:] |= column[1:] != column[:-1]
            if rest:
                change[0] |= column[0] != rest[-1][k][-1].as_py()
        cuts = np.flatnonzero(change)
        if not len(cuts):
            rest.append(batch)
            continue
        if rest or cuts[0]:
            if cuts[0]:
                rest.append(batch.slice(0, cuts[0]))
            yield _one(rest)
        if cuts[-1] > cuts[0]:
            yield batch.slice(cuts[0], cuts[-1] - cuts[0])
        rest = [batch.slice(cuts[-1])]
    if rest:
        yield _one(rest)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    return table.to_batches(max_chunksize=table.num_rows)[0]


def _candidates(batch: pa.RecordBatch, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of a group that are to be compared there: the bucket's tree is the
    first in which they meet, their blocks are the group's two, and neither is too long
    for the other."""
    gid = [batch[k].to_numpy(zero_copy_only=False) for k in ("key", "i", "j")]
    edges = np.zeros(batch.num_rows, bool)
    edges[0] = True
    for column in gid:
        edges[1:] |= column[1:] != column[:-1]
    heads = np.append(np.flatnonzero(edges), batch.num_rows)
    sizes = np.diff(heads)
    # pairs of neighbours at distance 1, 2, ...: a group of g rows takes g - 1 steps
    number = np.repeat(np.arange(len(sizes)), sizes)
    keys = np.stack(batch["keys"].values.to_numpy(zero_copy_only=False)[batch["keys"].offsets.to_numpy()[0] :].reshape(-1, TREES))[: batch.num_rows]
    tree, n, block = (batch[k].to_numpy(zero_copy_only=False) for k in ("tree", "n", "block"))
    out_a, out_b = [], []
    for step in range(1, int(sizes.max())):
        a = np.flatnonzero(number[step:] == number[:-step])
        if not len(a):
            break
        b = a + step
        across = (gid[1][a] == gid[2][a]) | (block[a] != block[b])
        near = np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) - 1e-9
        a, b = a[across & near], b[across & near]
        first = (keys[a] == keys[b]).argmax(axis=1) == tree[a]
        out_a.append(a[first])
        out_b.append(b[first])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (empty, empty)


def _involved(threshold: float):
    """Rows that have something to compare in their group, the group's key with them."""

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, ["key", "i", "j"]):
            a, b = _candidates(batch, threshold)
            if len(a):
                yield batch.take(pa.array(np.unique(np.concatenate([a, b]))))

    return involved


def _verified(threshold: float):
    """For each row of a group its links by exact similarity, in documents, and the row
    of least fingerprint that the group's links join it to."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _groups(batches, ["key", "i", "j"]):
            a, b = _candidates(batch, threshold)
            if not len(a):
                continue
            own = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch["own"]]
            size = np.fromiter(map(len, own), np.int64, len(own))
            shared = _shared(own, a, b)
            good = shared >= threshold * (size[a] + size[b] - shared) - 1e-9
            a, b = a[good], b[good]
            if not len(a):
                continue
            copies = batch["copies"].to_numpy()
            links = np.zeros(len(own), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = np.arange(len(own))
            while True:  # least row number of what is linked
                low = np.minimum(root[a], root[b])
                before = root.copy()
                np.minimum.at(root, a, low)
                np.minimum.at(root, b, low)
                root = root[root]
                if (root == before).all():
                    break
            rows = np.flatnonzero(links)
            prints = batch["fp"]
            yield pa.RecordBatch.from_arrays(
                [prints.take(pa.array(rows)), pa.array(links[rows]), prints.take(pa.array(root[rows]))], ["fp", "links", "root"]
            )

    return verified


def _shared(own: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many shingles each pair of rows shares.  Rows that meet many others become
    bits over the shingles that more than one row has; others are merged in pairs."""
    times = np.bincount(np.concatenate([a, b]), minlength=len(own))
    out = np.zeros(len(a), np.int64)
    many = (times[a] >= 8) & (times[b] >= 8)
    few = np.flatnonzero(~many)
    for k in few.tolist():
        out[k] = len(np.intersect1d(own[a[k]], own[b[k]], assume_unique=True))
    dense = np.flatnonzero(many)
    # rows of one cluster are near each other: a few hundred at a time bound the bits
    order = dense[np.lexsort((b[dense], a[dense]))]
    for at in range(0, len(order), 1 << 14):
        part = order[at : at + (1 << 14)]
        rows = np.unique(np.concatenate([a[part], b[part]]))
        for lot in np.array_split(rows, max(1, len(rows) // 512)) if len(rows) > 1024 else [None]:
            here = part if lot is None else part[np.isin(a[part], lot)]
            out[here] = _bits(own, a[here], b[here])
    return out


def _bits(own: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not len(a):
        return np.zeros(0, np.int64)
    rows = np.unique(np.concatenate([a, b]))
    values, counts = np.unique(np.concatenate([own[r] for r in rows]), return_counts=True)
    values = values[counts > 1]
    wide = -(-max(1, len(values)) // 64)
    if len(rows) * wide > 1 << 24:  # too many bits: merge in pairs
        return np.array([len(np.intersect1d(own[x], own[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)
    bits = np.zeros((len(rows), wide * 8), np.uint8)
    for i, r in enumerate(rows):
        at = np.searchsorted(values, own[r])
        at = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == own[r])]
        line = np.zeros(wide * 64, np.uint8)
        line[at] = 1
        bits[i] = np.packbits(line)
    words = bits.view(np.uint64)
    x, y = np.searchsorted(rows, a), np.searchsorted(rows, b)
    out = np.empty(len(a), np.int64)
    step = max(1, (1 << 20) // wide)
    for k in range(0, len(a), step):
        out[k : k + step] = np.bitwise_count(words[x[k : k + step]] & words[y[k : k + step]]).sum(axis=1)
    return out


def join_near_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, th`` (hash of the text), ``class_id`` (smallest id of the group that links
    reach), ``copy_of`` (smallest id with the same shingles), ``n_links`` (other rows with a
    Jaccard similarity of at least ``threshold``), and ``kept``: one row of each group, the one
    of smallest id.

    Shingles are distinct runs of five words (runs of letters, digits and characters
    beyond ASCII, in lower case); a text of fewer words has one, of all its words.

    1. Texts with equal shingles are one class from here on, with a number of copies.
    2. Each class has a path of MinHashes in each of ``TREES`` prefix tries.  Classes meet
       where they share a prefix; prefixes start at full depth and are shortened until
       classes at the threshold meet with a chance of ``RECALL``.
    3. Classes that meet are compared in blocks of ``BLOCK``: the rows of a bucket are
       copied to pairs of blocks, not to pairs of rows.  Each pair is looked at in the
       first tree where it meets, and verified on all shingles (64-bit hashes).  A block
       returns one row per class, with its number of links and what it is joined to.
    4. Groups are connected components of these.

    Texts without words, null or empty, have no links and are groups of their own.  A
    null id counts as the smallest.  Repeated rows are copies of each other; of rows that
    agree in id and text one is kept.  Other columns are not read.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = written(sketches(named), "sketches")
    smallest = F.min(F.struct("doc_id", "th"))
    classes = written(
        rows.where("fp is not null").groupBy("fp").agg(
            smallest.alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("keys").alias("keys")
        ),
        "classes",
    )
    paths = classes.select("fp", F.posexplode("keys").alias("tree", "key"))
    met = paths.groupBy("key").agg(F.count("*").alias("met")).where("met > 1")
    buckets = paths.join(met, "key").join(classes.select("fp", "n", "copies", "keys"), "fp")
    # a bucket's rows go to all pairs of blocks that their own block is in
    blocks = F.ceil(F.col("met") / F.lit(BLOCK)).cast("int")
    own = buckets.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("fp"), blocks).cast("int")})
    paired = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = paired.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "tree", "fp", "n", "copies", "keys")
    by = ["key", "i", "j"]
    ordered = grouped.repartition(*by).sortWithinPartitions(*by, "fp")
    involved = written(ordered.mapInArrow(_involved(threshold), grouped.schema), "involved")
    wanted = involved.select("fp").distinct().join(classes, "fp").select("first.doc_id", "first.th")
    sets = written(shingle_sets(named, wanted), "sets")
    compared = involved.join(sets, "fp").repartition(*by).sortWithinPartitions(*by, "fp")
    found = written(compared.mapInArrow(_verified(threshold), "fp binary, links long, root binary"), "found")
    links = found.groupBy("fp").agg(F.sum("links").alias("links"))
    members = connected_components(found, "fp", "root").withColumnRenamed("node", "fp")
    linked = members.join(links, "fp").join(classes.select("fp", "first"), "fp")
    least = linked.groupBy("component").agg(F.min("first").alias("group"))
    groups = linked.join(least, "component").select("fp", "links", "group")
    judged = classes.select("fp", "first", "copies").join(groups, "fp", "left").select(
        "fp", "first", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("group", "first").alias("group")
    )
    alone = F.col("group").isNull()
    out = rows.drop("keys", "n").join(judged, "fp", "left")
    is_first = F.col("doc_id").eqNullSafe(F.col("group.doc_id")) & (F.col("th") == F.col("group.th"))
    return out.select(
        "doc_id",
        "th",
        F.when(alone, F.col("doc_id")).otherwise(F.col("group.doc_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("copy_of"),
        F.when(alone, F.lit(0)).otherwise(F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
        (alone | is_first).alias("kept"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each group that ``join_near_texts`` finds, all columns kept.  The rows
    that go are named by id and text; of several rows that agree in both, and are kept,
    the first by all columns, as JSON, stays."""
    names, (docs, own) = docs.columns, apart(docs)
    doc_id, text = own[doc_id], own[text]
    judged = join_near_texts(docs, doc_id, text, **settings)
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("th").alias("_th")).distinct()
    hashed = docs.withColumn("_h", F.xxhash64(text))
    left = hashed.join(gone, F.col(doc_id).eqNullSafe(F.col("_gone")) & (F.col("_h") == F.col("_th")), "left_anti")
    # only rows with words can be copies; the text's hash stands for the text
    twins = judged.where("kept and n_links > 0").groupBy("doc_id", "th").agg(F.count("*").alias("n")).where("n > 1")
    if twins.isEmpty():
        return left.drop("_h").toDF(*names)
    several = twins.select(F.col("doc_id").alias("_twin"), F.col("th").alias("_th"))
    same = F.col(doc_id).eqNullSafe(F.col("_twin")) & (F.col("_h") == F.col("_th"))
    every = F.struct(*docs.columns)
    first = left.join(several, same, "left_semi").groupBy(doc_id, "_h").agg(F.min_by(every, F.to_json(every)).alias("_row")).select("_row.*")
    return left.join(several, same, "left_anti").drop("_h").unionByName(first).toDF(*names)

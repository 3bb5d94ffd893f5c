"""Reading partitioned logs from start positions and checkpoints."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.plans.ordered import arrange, run_count
from flowtables.plans.sizes import broadcast_if_small

STARTS = ("TRIM_HORIZON", "LATEST", "AT_SEQUENCE_NUMBER", "AFTER_SEQUENCE_NUMBER", "AT_TIMESTAMP")


def read_log(
    log: DataFrame,
    start: str,
    sequence: int | None = None,
    timestamp: datetime | str | None = None,
    positions: DataFrame | None = None,
    shard: str = "shard",
    seq: str = "seq",
    at: str = "ts",
) -> DataFrame:
    """Records of a log from a start position on.

    One position for all shards is a literal predicate, which reaches the file
    scan.  ``positions`` gives one per shard: the shard column and ``sequence`` or
    ``timestamp``; shards without a row there are not read.  ``LATEST`` needs the
    ``sequence`` per shard at which the log ended when reading began
    (:func:`log_ends`).
    """
    if start not in STARTS:
        raise ValueError(f"unknown start {start!r}, use one of {STARTS}")
    if start == "TRIM_HORIZON":
        return log
    by_time = start == "AT_TIMESTAMP"
    field, literal = ("timestamp", timestamp) if by_time else ("sequence", sequence)
    if positions is None:
        if literal is None:
            raise ValueError(f"{start} needs a {field}, for all shards or in positions")
        if by_time:
            literal = F.lit(literal).cast(log.schema[at].dataType)
        return log.where(_from(start, log, seq, at, F.lit(literal) if not by_time else literal))
    if field not in positions.columns:
        raise ValueError(f"{start} needs a column {field!r} in positions")
    where = broadcast_if_small(
        positions.select(F.col(shard).alias("_shard"), F.col(field).alias("_from"))
    )
    on = (log[shard] == F.col("_shard")) & _from(start, log, seq, at, F.col("_from"))
    return log.join(where, on, "inner").select(*[log[c] for c in log.columns])


def _from(start: str, log: DataFrame, seq: str, at: str, position: Column) -> Column:
    if start == "AT_TIMESTAMP":
        return log[at] >= position
    return log[seq] >= position if start == "AT_SEQUENCE_NUMBER" else log[seq] > position


def log_ends(log: DataFrame, shard: str = "shard", seq: str = "seq") -> DataFrame:
    """The last sequence number of each shard, as positions for ``LATEST``."""
    return log.groupBy(shard).agg(F.max(seq).alias("sequence"))


def resume_from(
    log: DataFrame,
    checkpoints: DataFrame,
    partition: str = "partition_id",
    offset: str = "offset",
    default: int = -1,
) -> DataFrame:
    """Records after each partition's checkpoint; partitions without one start
    after offset ``default``."""
    done = broadcast_if_small(
        checkpoints.select(F.col(partition).alias("_p"), F.col(offset).alias("_done"))
    )
    return (
        log.join(done, log[partition] == F.col("_p"), "left")
        .where(F.col(offset) > F.coalesce(F.col("_done"), F.lit(default)))
        .select(*[log[c] for c in log.columns])
    )


def checkpoint(
    log: DataFrame,
    partition: str = "partition_id",
    offset: str = "offset",
    seq: str = "seq",
    stream: str = "",
    group: str = "",
) -> DataFrame:
    """The event with the highest offset of each partition, as a checkpoint row."""
    top = F.max(F.struct(F.col(offset).alias("offset"), F.col(seq).alias("sequence_number")))
    return log.groupBy(partition).agg(top.alias("_top")).select(
        F.lit(stream).alias("stream"),
        F.lit(group).alias("consumer_group"),
        partition,
        "_top.offset",
        "_top.sequence_number",
    )


def newest_checkpoints(checkpoints: DataFrame, partition: str = "partition_id") -> DataFrame:
    """The latest checkpoint per stream, consumer group and partition of a
    checkpoint table that is only ever appended to."""
    key = ["stream", "consumer_group", partition]
    return checkpoints.groupBy(*key).agg(
        F.max(F.struct("offset", "sequence_number")).alias("_top")
    ).select(*key, "_top.offset", "_top.sequence_number")


def checkpoint_every(
    log: DataFrame,
    n: int,
    partition: str = "partition_id",
    order: str = "offset",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Every ``n``-th event of a partition, where a checkpoint is due; adds
    ``events_so_far``."""
    if n < 1:
        raise ValueError("n must be at least 1")
    rows = arrange(log, partition, order, rows_per_chunk).scan(events_so_far=run_count())
    return rows.df.where(F.col("events_so_far") % n == 0)


def partition_counts(log: DataFrame, partition: str = "partition_id") -> DataFrame:
    """Events per partition; works on streams too (update or complete mode)."""
    return log.groupBy(partition).agg(F.count(F.lit(1)).alias("events"))

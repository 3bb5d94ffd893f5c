"""A log in partitions: offsets, limits, restarts, and an end."""

import pytest
from pyspark.sql import functions as F

from flowtables.sources.partitioned_log import (
    append_log,
    await_closed,
    close_partitions,
    tail_partitions,
)


def part(spark, low, high):
    df = spark.range(low, high).select(F.col("id").alias("seq"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("shard"))
    return df.repartition(4)


def collect(stream, state, sizes, out):
    def keep(batch, batch_id):
        rows = batch.collect()
        sizes.append(len(rows))
        out.extend(r.seq for r in rows)

    return stream.writeStream.option("checkpointLocation", state).foreachBatch(keep).trigger(processingTime="0 seconds").start()


def test_tail_ends_when_all_partitions_are_closed(spark, tmp_path):
    path, state = f"file://{tmp_path}/log", f"{tmp_path}/state"
    append_log(part(spark, 0, 90), path, "shard", "seq")
    schema = part(spark, 0, 1).schema
    sizes, out = [], []
    query = collect(tail_partitions(spark, path, schema, limit=7, records_per_trigger=20), state, sizes, out)
    append_log(part(spark, 90, 120), path, "shard", "seq")
    close_partitions(path, ["a"])
    query.processAllAvailable()
    assert query.isActive
    close_partitions(path, ["b"])
    await_closed(query)
    assert not query.isActive and sorted(out) == list(range(120))
    assert max(sizes) <= 40
    for shard in (0, 1):  # a partition is in order
        mine = [s for s in out if (s % 3 == 0) == (shard == 0)]
        assert len(mine) == len(set(mine))


def test_a_query_that_starts_again_goes_on(spark, tmp_path):
    path, state = f"file://{tmp_path}/log", f"{tmp_path}/state"
    append_log(part(spark, 0, 30), path, "shard", "seq")
    schema, out, sizes = part(spark, 0, 1).schema, [], []
    query = collect(tail_partitions(spark, path, schema, records_per_trigger=5), state, sizes, out)
    query.processAllAvailable()
    query.stop()
    assert sorted(out) == list(range(30))
    append_log(part(spark, 30, 70), path, "shard", "seq")
    close_partitions(path, ["a", "b"])
    await_closed(collect(tail_partitions(spark, path, schema, records_per_trigger=5), state, sizes, out))
    assert sorted(out) == list(range(70))


def test_latest_reads_only_what_comes_later(spark, tmp_path):
    path, state = f"file://{tmp_path}/log", f"{tmp_path}/state"
    append_log(part(spark, 0, 30), path, "shard", "seq")
    schema, out = part(spark, 0, 1).schema, []
    query = collect(tail_partitions(spark, path, schema, start="LATEST"), state, [], out)
    query.processAllAvailable()
    append_log(part(spark, 30, 40), path, "shard", "seq")
    close_partitions(path, ["a", "b"])
    await_closed(query)
    assert sorted(out) == list(range(30, 40))


def test_limits(spark, tmp_path):
    schema = part(spark, 0, 1).schema
    with pytest.raises(ValueError, match="limit"):
        tail_partitions(spark, f"file://{tmp_path}", schema, limit=10_001)
    with pytest.raises(ValueError, match="start"):
        tail_partitions(spark, f"file://{tmp_path}", schema, start="EARLIEST")

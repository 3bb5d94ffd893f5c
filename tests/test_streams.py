"""Streaming operators over several micro-batches equal their batch forms."""

import random
import time
from datetime import datetime, timedelta

import pytest
from models import groups_within
from pyspark.sql import functions as F

from flowtables.operators.batching import grouped_within
from flowtables.plans.sizes import scratch_path
from flowtables.sources.log import newest_checkpoints, partition_counts
from flowtables.streaming.keyed import (
    bounded_buffer_stream,
    grouped_within_stream,
    presence_stream,
    redeliver_stream,
)
from flowtables.streaming.rpc import correlate_rpc_stream
from flowtables.streaming.runs import rocksdb_state, run_available, stream_with_checkpoints, tail_log

T0 = datetime(2024, 1, 1)
SCHEMA = "k string, i bigint, ts timestamp_ntz, kind string"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def rows():
    rng, rows, t = random.Random(4), [], 0
    for i in range(240):
        t += rng.choice([0, 1, 3, 10])
        rows.append((rng.choice("aaab"), i, at(t), rng.choice(["put", "put", "get"])))
    return rows


@pytest.fixture(scope="module")
def folder(spark, rows):
    """The rows in six files, read one per micro-batch in order."""
    path = scratch_path(spark, "stream-input")
    for n in range(6):
        part = spark.createDataFrame(rows[n * 40 : n * 40 + 40], SCHEMA)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def tail(spark, folder):
    return tail_log(spark, folder, SCHEMA, max_files=1)


def test_counts_and_checkpoints(spark, folder, rows):
    counts = run_available(partition_counts(tail(spark, folder), "k"), "counts", "complete").collect()
    assert {r["k"]: r["events"] for r in counts} == {k: sum(x[0] == k for x in rows) for k in "ab"}
    last = {k: max(x[1] for x in rows if x[0] == k) for k in "ab"}
    for delivery in ("at_least_once", "at_most_once"):
        path, seen = scratch_path(spark, delivery), []
        writer = stream_with_checkpoints(
            tail(spark, folder), lambda b, n: seen.append((n, b.count())), path, "k", "i", "i", delivery=delivery
        )
        writer.trigger(availableNow=True).start().awaitTermination()
        assert [n for _, n in seen] == [40] * 6
        # What was checkpointed before is not handled again.
        if delivery == "at_most_once":
            again = stream_with_checkpoints(
                tail(spark, folder), lambda b, n: seen.append((n, -1)), path, "k", "i", "i", delivery=delivery
            ).option("checkpointLocation", f"{path}/lost")
            again.trigger(availableNow=True).start().awaitTermination()
            assert len(seen) == 6
        table = newest_checkpoints(spark.read.parquet(f"{path}/checkpoints").drop("batch"), "k").collect()
        assert {r["k"]: r["offset"] for r in table} == last


def test_groups_close_by_count_time_and_watermark(spark, folder, rows):
    groups = grouped_within_stream(tail(spark, folder), 4, 12, "k", "i", "ts", "0 seconds")
    got = {(r["k"], r["group_no"]): tuple(r["items"]) for r in run_available(groups, "groups", keyed=True).collect()}
    now = max(r[2] for r in rows)
    expected = {}
    for k in "ab":
        mine = [r for r in rows if r[0] == k]
        numbers = groups_within([(r[2] - T0).total_seconds() for r in mine], 4, 12)
        for no in set(numbers):
            members = [r for r, n in zip(mine, numbers) if n == no]
            if len(members) == 4 or no < max(numbers) or members[0][2] + timedelta(seconds=12) <= now:
                expected[(k, no)] = tuple(r[1] for r in members)
    assert got == expected


def interleaved(spark, tmp_path):
    """Keys of different pace, in files of which each has rows of some keys only."""
    values = [("abcd"[k], 100 * k + i, i * (k + 1) * 3 + 7 * (i // 5)) for k in range(4) for i in range(40)]
    for n in range(8):
        own = [(k, i, T0 + timedelta(seconds=t)) for k, i, t in values if n in (i % 100 // 10 * 2, i % 100 // 10 * 2 + 1) and (n % 2 == "abcd".index(k) % 2)]
        spark.createDataFrame(own, "k string, i long, ts timestamp").coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
    return spark.createDataFrame([(k, i, T0 + timedelta(seconds=t)) for k, i, t in values], "k string, i long, ts timestamp")


def test_groups_by_the_time_of_each_key(spark, tmp_path):
    table = interleaved(spark, tmp_path)
    batch = grouped_within(table, 4, 12, "k", "i", "ts").groupBy("k", "group_no").agg(F.sort_array(F.collect_list("i")).alias("items"))
    batch = {(r.k, r.group_no): r["items"] for r in batch.collect()}
    last = {k: max(no for x, no in batch if x == k) for k, _ in batch}
    closed = {(k, no): items for (k, no), items in batch.items() if no < last[k] or len(items) == 4}
    for max_files in (1, 3, 1000):
        stream = tail_log(spark, str(tmp_path / "part*"), table.schema, max_files=max_files)
        out = run_available(grouped_within_stream(stream, 4, 12, "k", "i", "ts"), f"own_{max_files}", keyed=True).collect()
        assert not any(r.late for r in out)
        assert {(r.k, r.group_no): r["items"] for r in out} == closed


def test_marks_of_time_close_groups_and_rows_before_it_are_late(spark, tmp_path):
    schema = "k string, i long, ts timestamp"
    parts = [[("a", 1, 0), ("a", 2, 5)], [("b", 3, 100), ("a", None, 30)], [("a", 4, 29), ("a", 5, 31)], [("a", None, 43), ("b", None, 101)]]
    for n, part in enumerate(parts):
        rows = [(k, i, T0 + timedelta(seconds=t)) for k, i, t in part]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
    stream = tail_log(spark, str(tmp_path / "part*"), spark.createDataFrame([], schema).schema, max_files=1)
    out = run_available(grouped_within_stream(stream, 9, 12, "k", "i", "ts"), "marks", keyed=True).collect()
    assert sorted((r.k, r.group_no or 0, r["items"], r.late) for r in out) == [
        ("a", 0, [4], True), ("a", 1, [1, 2], False), ("a", 2, [5], False),
    ]


def test_idle_keys_close_by_the_clock(spark, tmp_path):
    rows = [("a", 1, T0), ("b", 2, T0)]
    spark.createDataFrame(rows, "k string, i long, ts timestamp").write.parquet(str(tmp_path / "part0"))
    stream = tail_log(spark, str(tmp_path / "part*"), spark.read.parquet(str(tmp_path / "part0")).schema)
    groups, out = grouped_within_stream(stream, 9, 12, "k", "i", "ts", idle=0.5), []
    with rocksdb_state(spark):
        query = groups.writeStream.option("checkpointLocation", str(tmp_path / "state")).foreachBatch(lambda b, n: out.extend(b.collect())).trigger(processingTime="1 second").start()
        try:
            deadline = time.monotonic() + 60
            while len(out) < 2 and time.monotonic() < deadline:
                time.sleep(0.2)
        finally:
            query.stop()
    assert sorted((r.k, r.group_no, r["items"]) for r in out) == [("a", 1, [1]), ("b", 1, [2])]
    with pytest.raises(ValueError, match="not both"):
        grouped_within_stream(stream, 9, 12, "k", "i", "ts", "1 second", 1)


@pytest.mark.parametrize("strategy", ["drop_head", "drop_tail", "drop_new", "drop_buffer"])
def test_buffer_with_reads(spark, folder, rows, strategy):
    log = tail(spark, folder).withColumn("poll", F.col("kind") == "get")
    out = run_available(bounded_buffer_stream(log, 2, strategy, "k", "i", "poll"), "buffer", keyed=True).collect()
    expected = []
    for k in "ab":
        items, demand = [], 0
        for _, i, _, kind in (r for r in rows if r[0] == k):
            if kind == "get":
                if items:
                    expected.append((k, items.pop(0), "delivered", i))
                else:
                    demand += 1
            elif demand:
                demand -= 1
                expected.append((k, i, "delivered", i))
            elif len(items) < 2:
                items.append(i)
            elif strategy == "drop_new":
                expected.append((k, i, "dropped", i))
            else:
                gone = {"drop_head": items[:1], "drop_tail": items[-1:], "drop_buffer": items[:]}[strategy]
                expected += [(k, g, "dropped", i) for g in gone]
                items = [x for x in items if x not in gone] + [i]
    assert sorted(tuple(r) for r in out) == sorted(expected)


def test_redelivery_until_settled(spark):
    path = scratch_path(spark, "redelivery-input")
    batches = [
        [("m1", at(0), False), ("m2", at(1), False)],
        [("m2", at(5), True)],
        [("m3", at(25), False)],
        [("m1", at(31), True)],
        [("m3", at(60), True)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, "m string, ts timestamp_ntz, done boolean").coalesce(1).write.mode("append").parquet(path)
    log = tail_log(spark, path, "m string, ts timestamp_ntz, done boolean", max_files=1)
    out = run_available(redeliver_stream(log, 10, "m", "ts", "done"), "redelivery", keyed=True).collect()
    got = sorted((r["m"], r["receive_count"], (r["delivered_at"] - T0).seconds) for r in out)
    assert got == [
        ("m1", 1, 0), ("m1", 2, 10), ("m1", 3, 20), ("m1", 4, 30), ("m2", 1, 1),
        ("m3", 1, 25), ("m3", 2, 35), ("m3", 3, 45), ("m3", 4, 55),
    ]


def test_redelivery_holds_messages_in_buckets(spark):
    """20 000 messages take no row of state and no timer each; all are delivered twice."""
    path, rows = scratch_path(spark, "redelivery-many"), []
    schema = "m bigint, ts timestamp_ntz, done boolean"
    spark.range(20_000).selectExpr(
        "id + 9007199254740992 as m", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id % 5) as ts", "false as done"
    ).coalesce(1).write.parquet(path)
    spark.createDataFrame([(None, at(16), True)], schema).coalesce(1).write.mode("append").parquet(path)
    stream = redeliver_stream(tail_log(spark, path, schema), 10, "m", "ts", "done", 2)

    def keep(batch, n):
        rows.extend(batch.collect())

    with rocksdb_state(spark):
        writer = stream.writeStream.option("checkpointLocation", scratch_path(spark, "redelivery-state"))
        query = writer.foreachBatch(keep).trigger(availableNow=True).start()
        query.awaitTermination()
    states = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    expected = {(i + 2**53, n, at(i % 5 + 10 * (n - 1))) for i in range(20_000) for n in (1, 2)}
    assert len(rows) == len(expected) and {tuple(r) for r in rows} == expected
    assert 0 < max(states) <= 3 * 2048


def test_redelivery_of_messages_that_share_a_bucket(spark, monkeypatch):
    monkeypatch.setattr("flowtables.streaming.keyed.BUCKETS", 3)
    rng, path, now, batches = random.Random(6), scratch_path(spark, "redelivery-shared"), 0, []
    schema = "m bigint, ts timestamp_ntz, done boolean"
    for _ in range(4):
        batch = []
        for _ in range(60):
            now += rng.choice([0, 0, 1, 4])
            batch.append((rng.choice([None, *range(2**60, 2**60 + 24)]), now, rng.choice([True, False, False, None])))
        batches.append(batch)
        rows = [(m, at(t), done) for m, t, done in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    first, end, expected = {}, {}, set()
    for m, t, done in (r for b in batches for r in b):
        if done:
            if m in first:
                end.setdefault(m, t)
        else:
            first.setdefault(m, t)
    for m, t in first.items():
        expected |= {(m, n + 1, at(t + 5 * n)) for n in range(9) if n == 0 or t + 5 * n <= min(now, end.get(m, now))}
    log = tail_log(spark, path, schema, max_files=1)
    got = run_available(redeliver_stream(log, 5, "m", "ts", "done", 9), "redelivery", keyed=True).collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_redelivery_leaves_late_rows_out(spark):
    path = scratch_path(spark, "redelivery-late")
    schema = "m string, ts timestamp_ntz, done boolean"
    for batch in [("m1", at(0), False)], [("m2", at(100), True)], [("m3", at(200), False)], [("m4", at(5), False), ("m5", at(201), False)]:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    log = tail_log(spark, path, schema, max_files=1)
    out = run_available(redeliver_stream(log, 150, "m", "ts", "done"), "redelivery", keyed=True).collect()
    assert {tuple(r) for r in out} == {("m1", 1, at(0)), ("m1", 2, at(150)), ("m3", 1, at(200)), ("m5", 1, at(201))}


def test_presence(spark):
    path = scratch_path(spark, "presence-input")
    schema = "connection_id string, ts timestamp_ntz, event_type string, error string"
    batches = [
        [("a", at(0), "connected", None), ("b", at(1), "connected", None)],
        [("a", at(2), "disconnected", None), ("b", at(3), "received", None), ("b", at(4), "connected", None)],
        [("b", at(9), "disconnected", "lost"), ("c", at(9), "disconnected", None), ("a", at(9), "connected", None)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    out = run_available(presence_stream(tail_log(spark, path, schema, max_files=1)), "presence", keyed=True).collect()
    got = sorted((r["connection_id"], (r["started_at"] - T0).seconds, (r["ended_at"] - T0).seconds, r["outcome"]) for r in out)
    assert got == [("a", 0, 2, "stopped"), ("b", 1, 4, "replaced"), ("b", 4, 9, "failed")]


def test_rpc_pairs(spark):
    path = scratch_path(spark, "rpc-input")
    schema = "id string, at timestamp, reply boolean"
    batches = [
        [("x", at(0), False), ("y", at(1), False), ("y", at(2), True)],
        [("y", at(5), True), ("x", at(40), True)],
        [("z", at(100), False), ("z", at(100), True)],
        [("z", at(300), False), ("z", at(300), True)],
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    log = tail_log(spark, path, schema, max_files=1)
    requests = log.where("not reply").selectExpr("id AS correlation_id", "at AS requested_at")
    replies = log.where("reply").selectExpr("id AS correlation_id", "at AS replied_at")
    pairs = run_available(correlate_rpc_stream(requests, replies, "10 seconds"), "rpc").collect()
    seconds = lambda v: None if v is None else (v - T0).seconds
    got = sorted((r["correlation_id"], seconds(r["requested_at"]), seconds(r["replied_at"]) or -1) for r in pairs)
    assert got == [("x", 0, -1), ("y", 1, 2), ("y", 1, 5), ("z", 100, 100), ("z", 300, 300)]

"""Queries that do the whole job of their operator, row by row."""

from collections import defaultdict
from datetime import datetime, timedelta

import duckdb
import pytest
from models import emitted
from test_queries import SF_DIR, pytestmark  # noqa: F401

from flowtables.catalog import QUERIES

EPOCH = datetime(1970, 1, 1)


def _events(columns: str) -> list[tuple]:
    return duckdb.sql(f"SELECT {columns} FROM '{SF_DIR}/events.parquet' ORDER BY event_id").fetchall()


def _throttled(spark, name: str, rows: list[tuple], rate: float, burst: float) -> None:
    shards = defaultdict(list)
    for shard, seq, at, cost in rows:
        shards[shard].append((seq, at, cost))
    expected = {}
    for shard, own in shards.items():
        times = emitted([at for _, at, _ in own], [cost for *_, cost in own], rate, burst)
        expected |= {(shard, seq): t for (seq, *_), t in zip(own, times)}
    got = {(r.shard, r.seq): r.emit_us / 1e6 for r in QUERIES[name](spark, SF_DIR).collect()}
    assert got.keys() == expected.keys()
    assert got == pytest.approx(expected, abs=1e-3, rel=1e-12)


def test_throttle_records_emits_every_record(spark):
    rows = _events("user_id % 4, event_id, epoch_us(ts) / 1e6, 1")
    _throttled(spark, "throttle_records", rows, 0.001, 5)


def test_throttle_bytes_emits_every_record(spark):
    rows = _events("user_id % 4, event_id, epoch_us(ts) / 1e6, strlen(props) + strlen(CAST(user_id AS VARCHAR))")
    _throttled(spark, "throttle_bytes", rows, 0.0125, 64)


def test_publish_results_sends_every_record(spark):
    got = {r.seq: (r.ok, r.attempts, r.error_code) for r in QUERIES["publish_results"](spark, SF_DIR).collect()}
    expected = {}
    for (seq,) in _events("event_id"):
        faults = seq % 8
        expected[seq] = (True, faults + 1, None) if faults <= 5 else (False, 6, "throttled")
    assert got == expected


def test_correlate_batch_pairs_what_was_sent(spark):
    got = {r.seq: (r.ok, r.answered) for r in QUERIES["correlate_batch"](spark, SF_DIR).collect()}
    assert got == {seq: (seq % 8 <= 2, True) for (seq,) in _events("event_id")}


def test_stream_bounded_buffer_delivers_or_drops_each_item(spark):
    expected, buffers, demand = set(), defaultdict(list), defaultdict(int)
    for seq, user, kind in _events("event_id, user_id, event_type"):
        buffer = buffers[user]
        if kind in ("click", "view"):
            if buffer:
                expected.add((user, buffer.pop(0), "delivered", seq))
            else:
                demand[user] += 1
        elif demand[user]:
            demand[user] -= 1
            expected.add((user, seq, "delivered", seq))
        else:
            if len(buffer) == 3:
                expected.add((user, buffer.pop(0), "dropped", seq))
            buffer.append(seq)
    got = QUERIES["stream_bounded_buffer"](spark, SF_DIR).select("user_id", "item", "outcome", "cause").collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_stream_redelivery_gives_every_receive(spark):
    events = [(f"{user}/{seq // 1500}", ms, kind == "purchase") for seq, user, ms, kind in _events("event_id, user_id, epoch_us(ts) // 1000, event_type")]
    now, first, expected = max(ms for _, ms, _ in events), {}, set()
    for message, ms, settles in events:
        if not settles:
            first[message] = min(ms, first.get(message, ms))
    for message, start in first.items():
        settled = min((ms for m, ms, s in events if m == message and s and ms >= start), default=None)
        for n in range(5):
            at = start + n * 36_000_000
            if n == 0 or (at <= now and (settled is None or at <= settled)):
                expected.add((message, n + 1, at))
    got = QUERIES["stream_redelivery"](spark, SF_DIR).selectExpr("message", "receive_count", "delivered_at").collect()
    when = {(r.message, r.receive_count, (r.delivered_at - EPOCH) // timedelta(milliseconds=1)) for r in got}
    assert len(got) == len(expected) and when == expected

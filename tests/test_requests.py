"""Publishing with a ledger, rates, and attempts from a log."""

import os
import time
import uuid

import pytest
from models import fail_until
from pyspark.sql import functions as F

from flowtables.operators.publish import PublishSettings, attempt_results, paced
from flowtables.sinks.requests import publish_committed


def delivered(folder):
    """Ids that arrived, however often."""
    ids = []
    for name in os.listdir(folder):
        ids += open(f"{folder}/{name}").read().split()
    return sorted(map(int, ids))


def transport(folder, dies=None, late=False, outcome=False):
    """Delivers to files; the worker dies once where the id ``dies`` comes up: before it is sent, or
    ``late``, after it was and before that is known."""
    os.makedirs(folder, exist_ok=True)

    def connect():
        def send(records, attempt):
            mine = any(r["i"] == dies for r in records) and not os.path.exists(f"{folder}.died")
            if mine and not late:
                open(f"{folder}.died", "w").close()
                os._exit(1)
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                out.write(" ".join(str(r["i"]) for r in records))
            if mine:
                open(f"{folder}.died", "w").close()
                os._exit(1)
            return [None] * len(records)

        if outcome:
            send.outcome = lambda records: [None] * len(records) if {r["i"] for r in records} <= set(
                int(i) for name in os.listdir(folder) for i in open(f"{folder}/{name}").read().split()
            ) else None
        return send

    return connect


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([("ab"[i % 2], i) for i in range(60)], "k string, i int").repartition(3)


@pytest.mark.parametrize("late", [False, True])
def test_a_task_that_dies_sends_nothing_twice(spark, rows, tmp_path, late):
    folder, ledger = f"{tmp_path}/out", f"file://{tmp_path}/publication"
    own = transport(folder, dies=41, late=late, outcome=late)
    settings = PublishSettings(batch_size=4, wait=False, parallelism=2)
    with pytest.raises(Exception):
        publish_committed(rows, own, "k", "i", ledger, settings).collect()
    before = delivered(folder)
    assert before and len(before) < 60 and (41 in before) == late
    got = publish_committed(rows, own, "k", "i", ledger, settings).collect()
    assert delivered(folder) == list(range(60))
    assert sorted((r.k, r.i) for r in got) == sorted(("ab"[i % 2], i) for i in range(60)) and all(r.ok for r in got)
    # and again: nothing is left to send
    assert publish_committed(rows, own, "k", "i", ledger, settings).count() == 60
    assert delivered(folder) == list(range(60))


def test_failed_rows_are_sent_by_the_next_call(spark, tmp_path):
    df = spark.createDataFrame([("k", i, 3 if i == 4 else 0) for i in range(9)], "k string, i int, fails int")
    ledger = f"file://{tmp_path}/publication"
    first = publish_committed(df, fail_until("fails"), "k", "i", ledger, PublishSettings(batch_size=4, max_retries=1, wait=False))
    assert [(r.i, r.attempts, r.error_code) for r in first.where("NOT ok").collect()] == [(4, 2, "throttled")]
    second = publish_committed(df, fail_until("fails"), "k", "i", ledger, PublishSettings(batch_size=4, max_retries=5, wait=False))
    assert second.where("ok").count() == 9 and second.where("i = 4").first().attempts == 4


def test_nothing_to_publish(spark, tmp_path):
    df = spark.createDataFrame([], "k string, i int")
    assert publish_committed(df, fail_until("i"), "k", "i", f"file://{tmp_path}/publication").collect() == []


def test_bytes_and_records_a_second():
    sent = []
    slow = paced(lambda records, attempt: sent.append(len(records)), PublishSettings(bytes_per_second=1000))
    start = time.monotonic()
    for _ in range(4):
        slow([{"body": "é" * 25, "n": 7}], 1)  # 50 bytes
    assert 0.14 <= time.monotonic() - start < 1 and sent == [1] * 4
    both = paced(lambda records, attempt: None, PublishSettings(records_per_second=100, bytes_per_second=100, parallelism=2, record_bytes=lambda r: r["n"]))
    start = time.monotonic()
    for _ in range(3):
        both([{"n": 5}], 1)  # 5 of 50 bytes a second for this task
    assert 0.19 <= time.monotonic() - start < 1
    with pytest.raises(ValueError):
        PublishSettings(bytes_per_second=0)


def test_attempts_from_a_log(spark):
    log = [("a", 1, "x"), ("a", 2, "y"), ("a", 3, None), ("a", 4, "z"), ("b", 1, None), ("c", 1, "x"), ("c", 2, "y"), (None, 1, "x"), (None, 2, None)]
    df = spark.createDataFrame(log, "r string, at int, error string").repartition(3)
    got = {r.r: tuple(r)[1:] for r in attempt_results(df, "r", "at", "error").collect()}
    assert got == {"a": (True, 3, None, 1500), "b": (True, 1, None, 0), "c": (False, 2, "y", 500), None: (True, 2, None, 500)}
    assert attempt_results(df.where(F.lit(False)), "r", "at", "error").collect() == []

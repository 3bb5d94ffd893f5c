"""A queue as a table of versions equals the operators that rewrite the state."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowtables.operators.queues import after_receive, apply_actions, queue_receive
from flowtables.sources.queue_table import QueueTable, StaleVersion

SCHEMA = "queue string, msg_id long, enqueued_at timestamp_ntz, delay_s int, ttl_s int, visible_at timestamp_ntz, receive_count int"


def now():
    return F.expr("timestamp_ntz'2024-01-02'")


@pytest.fixture
def messages(spark):
    rows = [("ab"[i % 2], i // 2 if i < 40 else i, datetime(2024, 1, 1, 0, i % 60), i % 3, None, None, 0) for i in range(200)]
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.select("queue", "msg_id", "visible_at", "receive_count").collect()))


def test_receives_and_actions_over_versions(spark, messages, tmp_path):
    queue = QueueTable(spark, f"file://{tmp_path}/queue", messages.schema)
    assert queue.read().isEmpty() and queue.version().number == 0
    queue.send(messages)
    model = messages
    for _ in range(3):
        got = queue.receive(now(), 4, 30)
        want = queue_receive(model, now(), 4, 30)
        assert rows(got) == rows(want) and got.count() == 8
        model = spark.createDataFrame(after_receive(model, want).collect(), messages.schema)
        assert rows(queue.read()) == rows(model)
    actions = spark.createDataFrame(
        [("a", 1, "delete", None, 1), ("a", 2, "change_visibility", 90, 2), ("b", 1, "ignore", None, 3), ("b", 99, "delete", None, 4), ("b", 999, "delete", None, 5)],
        "queue string, msg_id long, action string, visibility_s int, action_seq long",
    )
    before = queue.version()
    queue.act(actions, now())
    model = spark.createDataFrame(apply_actions(model, actions, now()).collect(), messages.schema)
    assert rows(queue.read()) == rows(model) and queue.read().count() == 198
    # a delta has what changed, and a reader of the version before still sees that
    delta = queue.version().deltas[-1]
    assert spark.read.parquet(f"{tmp_path}/queue/{delta}").count() == 3
    assert queue.read(before).count() == 200
    queue.compact()
    assert queue.version().deltas == () and rows(queue.read()) == rows(model)
    queue.send(messages.where("msg_id = 1"))  # sent again after its deletion
    assert queue.read().count() == 199
    assert len(queue.vacuum(1)) >= 4 and queue.read().count() == 199
    assert len([n for n in os.listdir(f"{tmp_path}/queue") if not n.startswith("_")]) == 2


def test_two_writers_of_a_version(spark, messages, tmp_path):
    queue = QueueTable(spark, f"file://{tmp_path}/queue", messages.schema)
    queue.send(messages)
    before = queue.version()
    queue.receive(now(), 2, 30)
    with pytest.raises(StaleVersion):
        queue._commit(before, before.bases, ("delta-lost",))
    # a manifest that was not written to its end is no version
    (tmp_path / "queue" / "_versions" / "000000000009").write_text("[[")
    assert queue.version().number == 2 and queue.read().count() == 200

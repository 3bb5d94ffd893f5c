"""Routing, fan-out, queues, replies and publishing on small tables."""

import random

import pytest
from models import fail_until, topic_match
from pyspark.sql import functions as F

from flowtables.functions import rules, topics
from flowtables.operators.fanout import inbox_sizes, recipients_per_command
from flowtables.operators.policy import with_error_policy
from flowtables.operators.publish import (
    PublishSettings,
    batch_status,
    publish,
    publish_once,
)
from flowtables.operators.queues import apply_actions, queue_receive
from flowtables.operators.routing import route, route_lists, route_replies, unroutable
from flowtables.operators.rpc import correlate_batch, correlate_rpc


def topology(spark, kinds, bindings):
    exchanges = spark.createDataFrame(kinds, "exchange string, type string")
    table = spark.createDataFrame(bindings, "queue string, exchange string, routing_key string, args map<string,string>")
    return exchanges, table


def messages(spark, rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "message_id bigint, exchange string, routing_key string, headers map<string,string>",
    )


def test_topic_patterns_equal_the_recursive_rule(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "b", "a.b"[:1], "x-1"])
    keys = sorted({".".join(word() for _ in range(rng.randint(0, 6))) for _ in range(60)})
    patterns = sorted({".".join(rng.choice(["*", "#", word()]) for _ in range(rng.randint(0, 6))) for _ in range(120)})
    expected = {(f"q{p}", k) for p, pat in enumerate(patterns) for k, key in enumerate(keys) if topic_match(pat, key)}
    table = topology(spark, [("t", "topic")], [(f"q{p}", "t", pat, None) for p, pat in enumerate(patterns)])
    sent = messages(spark, [("t", key, None) for key in keys])
    for broadcast_rows in (1000, 0):
        got = route(sent, *table, broadcast_rows=broadcast_rows).select("queue", "message_id").collect()
        assert len(got) == len(expected)
        assert {tuple(r) for r in got} == expected
    pairs = spark.createDataFrame([(p, k) for p in patterns for k in keys], "p string, k string")
    direct = pairs.select("p", "k", topics.topic_matches(F.col("p"), F.col("k")).alias("m")).collect()
    assert all(r["m"] == topic_match(r["p"], r["k"]) for r in direct)


def test_fanout_reaches_every_queue_once(spark):
    table = topology(spark, [("f", "fanout")], [(f"q{i}", "f", "", None) for i in range(4)] + [("q0", "f", "again", None)])
    sent = messages(spark, [("f", "", None)] * 5)
    got = route(sent, *table).groupBy("queue").count().collect()
    assert {r["queue"]: r["count"] for r in got} == {f"q{i}": 5 for i in range(4)}


def test_header_bindings(spark):
    table = topology(
        spark,
        [("h", "headers")],
        [
            ("all", "h", "", {"a": "1", "b": "2"}),
            ("any", "h", "", {"a": "1", "b": "2", "x-match": "any"}),
            ("every", "h", "", {}),
        ],
    )
    sent = messages(
        spark,
        [("h", "", {"a": "1", "b": "2"}), ("h", "", {"a": "1"}), ("h", "", {"a": "9"}), ("h", "", None)],
    )
    for rows in (100, 0):
        got = sorted((r["message_id"], r["queue"]) for r in route(sent, *table, broadcast_rows=rows).collect())
        assert got == [(0, "all"), (0, "any"), (0, "every"), (1, "any"), (1, "every"), (2, "every"), (3, "every")]


def test_default_exchange_and_unroutable(spark):
    table = topology(spark, [("d", "direct")], [("q", "d", "k", None)])
    queues = spark.createDataFrame([("q",)], "queue string")
    sent = messages(spark, [("", "q", None), ("", "nowhere", None), ("d", "k", None), ("d", "x", None), ("no", "k", None)])
    routed = route(sent, *table, queues)
    assert sorted(r["message_id"] for r in routed.collect()) == [0, 2]
    assert sorted(r["message_id"] for r in unroutable(sent, routed).collect()) == [1, 3, 4]


def test_reply_to(spark):
    df = spark.createDataFrame([(1, "q"), (2, None)], "id int, reply_to string")
    assert [r["target_queue"] for r in route_replies(df, on_missing="skip").collect()] == ["q"]
    with pytest.raises(Exception, match="no reply-to"):
        route_replies(df).collect()


def test_fan_out_counts(spark):
    connections = spark.createDataFrame([(c,) for c in "abcde"], "connection_id string")
    members = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "a"), ("h", "e")], "grp string, connection_id string")
    rows = [
        (1, "send", "a", None, None), (2, "send", "zz", None, None),
        (3, "group", None, "g", ["b", "e", "b"]), (4, "group", None, "none", None),
        (5, "broadcast", None, None, ["a", "zz", "a"]), (6, "broadcast", None, None, None),
    ]
    commands = spark.createDataFrame(rows, "command_id int, kind string, connection_id string, grp string, excluded array<string>")
    counts = {r[0]: r[1] for r in recipients_per_command(commands, connections, members).collect()}
    assert counts == {1: 1, 2: 0, 3: 1, 4: 0, 5: 4, 6: 5}
    inbox = {r[0]: r[1] for r in inbox_sizes(commands, connections, members).collect()}
    assert inbox == {"a": 3, "b": 2, "c": 2, "d": 2, "e": 2}


def queue(spark, rows):
    return spark.createDataFrame(
        rows,
        "queue string, msg_id int, enqueued_at timestamp_ntz, delay_s int, ttl_s int, visible_at timestamp_ntz, receive_count int",
    )


def test_queue_rules(spark):
    from datetime import datetime

    t = lambda s: datetime(2024, 1, 1, 0, 0, s)
    now = F.lit(t(30))
    table = queue(
        spark,
        [
            ("q", 1, t(0), None, None, None, 0),
            ("q", 2, t(1), 40, None, None, 0),  # still delayed
            ("q", 3, t(2), 0, 10, None, 0),  # expired
            ("q", 4, t(3), 0, None, t(40), 1),  # held by someone
            ("q", 5, t(4), 0, None, t(30), 1),  # visible again
            ("q", 6, t(5), 0, None, None, 0),
            ("p", 7, t(6), 0, 25, None, 0),
        ],
    )
    got = {r["msg_id"]: (r["visible_at"], r["receive_count"]) for r in queue_receive(table, now, 2, 20).collect()}
    assert got == {1: (t(50), 1), 5: (t(50), 2), 7: (t(50), 1)}
    actions = spark.createDataFrame(
        [(1, "change_visibility", 5, 1), (1, "delete", None, 2), (1, "change_visibility", 9, 3),
         (5, "change_visibility", 5, 1), (5, "change_visibility", 7, 2), (6, "ignore", None, 1)],
        "msg_id int, action string, visibility_s int, action_seq int",
    )
    state = {r["msg_id"]: r["visible_at"] for r in apply_actions(table, actions, now).collect()}
    assert 1 not in state and state[5] == t(37) and state[6] is None and state[4] == t(40)


def test_rpc_counts(spark):
    requests = spark.createDataFrame(
        [("a", {"expectedReplies": "2"}), ("b", {"expectedReplies": "x"}), ("c", None), ("d", {"expectedReplies": "0"})],
        "correlation_id string, headers map<string,string>",
    )
    replies = spark.createDataFrame([("a",), ("b",), ("b",)], "correlation_id string")
    got = {r["correlation_id"]: (r["expected"], r["received"], r["complete"]) for r in correlate_rpc(requests, replies).collect()}
    assert got == {"a": (2, 1, False), "b": (1, 2, True), "c": (1, 0, False), "d": (0, 0, True)}


def bound(spark, bindings):
    exchanges = spark.createDataFrame([("d", "direct"), ("f", "fanout"), ("t", "topic"), ("h", "headers")], "exchange string, type string")
    return exchanges, spark.createDataFrame(bindings, "queue string, exchange string, routing_key string, args map<string,string>")


def test_rows_and_probes_route_alike(spark, capsys):
    draw = random.Random(4)
    word = lambda: draw.choice(["a", "b", "c", "*", "#"])
    bindings = [(f"t{i}", "t", ".".join(word() for _ in range(draw.choice([1, 2, 2, 3, 6]))), None) for i in range(12)]
    bindings = [b for b in bindings if not set(b[2].split(".")[1:-1]) & {"a", "b", "c"} or "#" not in b[2]]
    bindings += [("d1", "d", "a.b", {}), ("d1", "d", "b", None), ("f1", "f", "x", None), ("f2", "f", None, None), ("empty", "d", None, None)]
    bindings += [("h1", "h", "", {"k": "1"}), ("h2", "h", "", {"k": "1", "m": "2"}), ("h3", "h", "", {"k": "1", "m": "2", "x-match": "any"}),
                 ("h4", "h", "", {"k": None}), ("h5", "h", "", {"k": None, "m": "2", "x-match": "any"}), ("h6", "h", "", {}), ("h7", "h", "", {"m": "2", "k": None})]
    keys = [None, "", "a", "b", "a.b", "b.a.c", "a.b.c.a.b.c", "c.c"]
    headers = [None, {}, {"k": "1"}, {"k": "2"}, {"k": None}, {"m": "2"}, {"k": "1", "m": "2"}, {"k": "9", "m": "2"}]
    rows = [(i, e, k, h) for i, (e, k, h) in enumerate((e, k, h) for e in ("d", "f", "t", "h", "none", None) for k in keys for h in headers)]
    messages = spark.createDataFrame(rows, "message_id int, exchange string, routing_key string, headers map<string,string>")
    pairs = lambda d: sorted((r.message_id, r.queue) for r in d.select("message_id", "queue").collect())
    by_row = route(messages, *bound(spark, bindings))
    by_row.explain()
    plan = capsys.readouterr().out
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    want = pairs(by_row)
    assert len(set(want)) == len(want)
    assert pairs(route(messages, *bound(spark, bindings), broadcast_rows=1)) == want
    reached = {(r[3] or {}).get("k", "missing"): {q for m, q in want if m == r[0]} for r in rows if r[1] == "h" and r[2] == "a" and len(r[3] or {}) == 1}
    assert {"h1", "h3", "h4", "h5", "h6"} <= reached["1"] and reached["2"] == {"h4", "h5", "h6"} == reached[None]
    lists = route_lists(messages, *bound(spark, bindings)).collect()
    assert len(lists) == len(rows) and sorted((r.message_id, q) for r in lists for q in r.queues) == want
    listed = route_lists(messages, *bound(spark, bindings), broadcast_rows=1).collect()
    assert sorted((r.message_id, q) for r in listed for q in r.queues) == want and len(listed) == len(rows)


@pytest.mark.parametrize("pattern", ["", "a", "*", "#", "a.b", "*.b", "#.b", "a.#", "a.*.c", "*.x.#", "#.x.*", "#.x.#", "a.b.c.d", "a.b.c.d.e", "#.#", "a.#.b", "*.*", "a..b", "#.a.b.c.d.e"])
def test_entries_of_patterns(spark, pattern):
    p = F.col("p")
    row = spark.createDataFrame([(pattern,)], "p string").select(
        topics.index_mask(p).alias("mask"), topics.index_key(topics.words(p), topics.index_mask(p)).alias("key"),
        topics.fixed_count(p).alias("words"), F.when(~topics.exact_mask(p), topics.topic_regex(p)).alias("regex"),
    ).first()
    assert topics.index_entry(pattern) == tuple(row)


def test_batch_entries_meet_their_own_result(spark):
    requests = spark.createDataFrame([(0, i, f"m{i}") for i in range(3)], "batch_no int, idx int, body string")
    responses = spark.createDataFrame([(0, 2, "r2"), (0, 0, "r0")], "batch_no int, idx int, result string")
    got = {r["body"]: (r["result"], r["answered"]) for r in correlate_batch(requests, responses).collect()}
    assert got == {"m0": ("r0", True), "m1": (None, False), "m2": ("r2", True)}


def records(spark, faults):
    return spark.createDataFrame([("s", i, f) for i, f in enumerate(faults)], "k string, i int, fail_until int").repartition(3)


def test_publish_retries_only_what_failed(spark):
    settings = PublishSettings(batch_size=4, max_retries=3, wait=False)
    sent = publish(records(spark, [0, 1, 3, 4, 0, 9]), fail_until("fail_until"), "k", "i", settings, rows_per_chunk=2)
    got = {r["i"]: (r["batch_no"], r["idx"], r["ok"], r["attempts"], r["waited_ms"]) for r in sent.collect()}
    assert got == {
        0: (0, 0, True, 1, 0), 1: (0, 1, True, 2, 500), 2: (0, 2, True, 4, 3500),
        3: (0, 3, False, 4, 3500), 4: (1, 0, True, 1, 0), 5: (1, 1, False, 4, 3500),
    }


def test_publish_stops_after_the_last_retry(spark):
    settings = PublishSettings(batch_size=4, max_retries=1, policy="stop", wait=False)
    with pytest.raises(Exception, match="records failed after 2 attempts"):
        publish(records(spark, [0, 5]), fail_until("fail_until"), "k", "i", settings).collect()


def test_atomic_batches(spark):
    settings = PublishSettings(batch_size=2, max_retries=1, atomic=True, wait=False)
    sent = publish(records(spark, [0, 1, 0, 5]), fail_until("fail_until"), "k", "i", settings)
    got = {r["i"]: (r["ok"], r["attempts"]) for r in sent.collect()}
    assert got == {0: (True, 2), 1: (True, 2), 2: (False, 2), 3: (False, 2)}
    status = {r["batch_no"]: (r["ok"], r["failed"]) for r in batch_status(sent, "k").collect()}
    assert status == {0: (True, 0), 1: (False, 2)}


def test_publish_once_sends_once(spark):
    counter = spark.sparkContext.accumulator(0)

    class Counting:
        def __call__(self):
            def send(rows, attempt):
                counter.add(len(rows))
                return [None] * len(rows)

            return send

    sent = publish_once(records(spark, [0] * 50), Counting(), "k", "i", PublishSettings(batch_size=7, wait=False))
    assert sent.count() == 50 and sent.where("ok").count() == 50
    assert counter.value == 50


def test_batches_larger_than_an_arrow_batch(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        settings = PublishSettings(batch_size=20, wait=False)
        sent = publish(records(spark, [0, 2] * 30), fail_until("fail_until"), "k", "i", settings)
        got = sent.collect()
        assert len(got) == 60 and {r["batch_no"] for r in got} == {0, 1, 2}
        assert all(r["attempts"] == r["fail_until"] + 1 for r in got)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_settings_are_checked():
    with pytest.raises(ValueError):
        PublishSettings(batch_size=0)
    with pytest.raises(ValueError):
        PublishSettings(backoff="quadratic")
    with pytest.raises(ValueError):
        rules.check_receive(11)
    with pytest.raises(ValueError):
        rules.check_receive(10, buffer=5)
    assert [rules.backoff_ms(a) for a in (1, 2, 3)] == [500, 1000, 2000]
    assert [rules.backoff_ms(a, "linear") for a in (1, 2, 3)] == [500, 1000, 1500]


def test_attribute_names(spark):
    names = ["ok", "a.b-c_*", "", ".x", "x.", "a..b", "a b", "é", "x" * 257, ".*", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(rules.attribute_name_error("n")).collect()]
    assert got == [
        None, None, "empty", "dots", "dots", "dots", "illegal_character", "illegal_character", "too_long", None, "empty",
    ]


def test_error_policy(spark):
    df = spark.createDataFrame([(1, None), (2, "bad")], "i int, e string")
    assert [r["i"] for r in with_error_policy(df, "e", "skip").collect()] == [1]
    good, bad = with_error_policy(df, "e", "dead_letter")
    assert good.columns == ["i"] and [r["e"] for r in bad.collect()] == ["bad"]
    with pytest.raises(Exception, match="bad"):
        with_error_policy(df, "e", "stop").count()
    with pytest.raises(ValueError):
        with_error_policy(df, "e", "retry")

"""Every ordered operator gives the same rows whether a hot key is cut or not.

The table has one key with two thirds of the rows; chunks are a few dozen rows,
so that key has many.  Rows arrive shuffled over several partitions.
"""

import random
from collections import defaultdict
from datetime import timezone

import pytest
from models import (
    buffered,
    emitted,
    first_fit,
    groups_by_size,
    groups_within,
    settled,
)
from pyspark.sql import functions as F

from flowtables.operators import batching, markup, presence, rotation, settlement, shaping
from flowtables.plans import ordered
from flowtables.plans.automata import Automaton
from flowtables.sources import log

CHUNK_ROWS = 40
HOT = 1500


def make(seed=7):
    rng = random.Random(seed)
    rows = []
    for key, n in (("hot", HOT), ("warm", 400), ("cold", 30), (None, 300), ("one", 1)):
        t = 0
        for i in range(n):
            t += rng.choice([0, 1, 1, 2, 5, 40])
            rows.append((key, i, t, rng.choice([1, 3, 10, 25, 60, 120]), rng.choice("abcd")))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def df(spark, rows):
    shuffled = random.Random(1).sample(rows, len(rows))
    table = spark.createDataFrame(shuffled, "k string, i bigint, t bigint, size bigint, kind string")
    return table.withColumn("ts", F.timestamp_seconds("t")).repartition(5).persist()


def by_key(rows):
    keys = defaultdict(list)
    for r in rows:
        keys[r[0]].append(r)
    return keys


def result(df, *columns):
    return {(r["k"], r["i"]): tuple(r[c] for c in columns) for r in df.collect()}


def same(df, operator, *args, **kwargs):
    cut = operator(df, *args, rows_per_chunk=CHUNK_ROWS, **kwargs)
    whole = operator(df, *args, rows_per_chunk=0, **kwargs)
    a, b = sorted(map(repr, cut.collect())), sorted(map(repr, whole.collect()))
    assert a == b
    return cut


def test_hot_keys_are_cut_into_even_chunks(df):
    rows = ordered.arrange(df, "k", "i", CHUNK_ROWS)
    assert rows.split
    sizes = {
        (r["k"], r[ordered.CHUNK]): r["count"] for r in rows.table.groupBy("k", ordered.CHUNK).count().collect()
    }
    hot = [n for (k, c), n in sizes.items() if k == "hot"]
    assert len(hot) > 10 and max(hot) < 6 * CHUNK_ROWS
    assert sizes[("one", None)] == 1
    # Chunks are ranges of the order.
    spans = rows.table.where("k = 'hot'").groupBy(ordered.CHUNK).agg(F.min("i"), F.max("i")).orderBy(ordered.CHUNK)
    spans = spans.collect()
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_all_scans_equal_plain_windows(df):
    scans = dict(
        n=ordered.run_count(),
        s=ordered.run_sum("size"),
        sx=ordered.run_sum("size", exclusive=True),
        sr=ordered.run_sum("size", reverse=True),
        srx=ordered.run_sum("size", reverse=True, exclusive=True),
        hi=ordered.run_max("t"),
        lo=ordered.run_min(F.struct("size", "i"), reverse=True),
        last=ordered.last_value(F.when(F.col("size") > 100, F.col("i"))),
        lastx=ordered.last_value(F.when(F.col("size") > 100, F.col("i")), exclusive=True),
        before=ordered.previous(F.when(F.col("size") > 5, F.col("size"))),
        after=ordered.following(F.when(F.col("size") > 5, F.col("size"))),
        total=ordered.key_total("size"),
        first=ordered.key_total("t", "min"),
    )
    names = list(scans)
    cut = ordered.arrange(df, "k", "i", CHUNK_ROWS).scan(**scans)
    whole = ordered.arrange(df, "k", "i", 0).scan(**scans)
    assert cut.split and not whole.split
    assert result(cut.df, *names) == result(whole.df, *names)


def test_scans_can_be_chained(df):
    def chain(chunk):
        rows = ordered.arrange(df, "k", "i", chunk).scan(a=ordered.run_sum("size"))
        return result(rows.scan(b=ordered.run_max(F.col("a") % 97)).df, "a", "b")

    assert chain(CHUNK_ROWS) == chain(0)


def test_order_of_several_columns(spark):
    data = [("x", i // 50, i % 50, i) for i in range(1000)]
    table = spark.createDataFrame(random.Random(3).sample(data, 1000), "k string, a int, b int, v int").repartition(4)
    rows = ordered.arrange(table, "k", ("a", "b"), 30).scan(n=ordered.run_count())
    assert rows.split
    assert all(r["n"] == r["v"] + 1 for r in rows.df.collect())


def test_pack_greedy(df, rows):
    got = result(same(df, batching.pack_greedy, 200, "size", "k", "i"), "batch_no")
    for key, items in by_key(rows).items():
        model = groups_by_size([r[3] for r in items], 200)
        assert [got[(key, r[1])][0] for r in items] == model


@pytest.mark.parametrize("limit", [1, 119, 1000, 20_000, 100_000])
def test_pack_greedy_limits(df, rows, limit):
    got = result(batching.pack_greedy(df, limit, "size", "k", "i", rows_per_chunk=CHUNK_ROWS), "batch_no")
    for key, items in by_key(rows).items():
        assert [got[(key, r[1])][0] for r in items] == groups_by_size([r[3] for r in items], limit)


@pytest.mark.parametrize("n,seconds", [(1, 10), (7, 30), (50, 100), (1000, 3), (10_000, 10_000_000)])
def test_grouped_within_open(df, rows, n, seconds):
    got = result(
        batching.grouped_within(df, n, seconds, "k", "i", "ts", rows_per_chunk=CHUNK_ROWS), "group_no"
    )
    for key, items in by_key(rows).items():
        assert [got[(key, r[1])][0] for r in items] == groups_within([r[2] for r in items], n, seconds)


def test_grouped_within_tick(df, rows):
    got = result(same(df, batching.grouped_within, 4, 60, "k", "i", "ts", mode="tick"), "tick", "group_no")
    for key, items in by_key(rows).items():
        seen = defaultdict(int)
        for r in items:
            tick = (r[2] - items[0][2]) // 60
            assert got[(key, r[1])] == (tick, seen[tick] // 4 + 1)
            seen[tick] += 1


def test_pack_first_fit(df, rows):
    got = result(same(df, batching.pack_first_fit, 130, "size", "k", "i", list_size=25), "list_no", "batch_no")
    for key, items in by_key(rows).items():
        for low in range(0, len(items), 25):
            part = items[low : low + 25]
            model = first_fit([r[3] for r in part], 130)
            assert [got[(key, r[1])] for r in part] == [(low // 25, m) for m in model]


def test_first_fit_leaves_oversize_rows_out(df):
    out = batching.pack_first_fit(df, 100, "size", "k", "i", list_size=10)
    assert out.where("size > 100 and batch_no is not null").isEmpty()
    assert out.where("size <= 100 and batch_no is null").isEmpty()


@pytest.mark.parametrize("strategy", ["drop_head", "drop_tail", "drop_new", "drop_buffer"])
@pytest.mark.parametrize("capacity", [1, 7, 30, 400, 5000])
def test_bounded_buffer(df, rows, strategy, capacity):
    kept = result(shaping.bounded_buffer(df, capacity, strategy, "k", "i", rows_per_chunk=CHUNK_ROWS))
    for key, items in by_key(rows).items():
        model = buffered(len(items), capacity, strategy)
        assert sorted(i for k, i in kept if k == key) == model


def test_bounded_buffer_can_fail(df):
    assert shaping.bounded_buffer(df, 10_000, "fail", "k", "i").count() == df.count()
    with pytest.raises(Exception, match="overflown"):
        shaping.bounded_buffer(df, 100, "fail", "k", "i").collect()


def test_throttle(df, rows):
    got = result(same(df, shaping.throttle, 2.0, 150, "k", "i", "ts", "size"), "emit_us")
    for key, items in by_key(rows).items():
        model = emitted([r[2] for r in items], [r[3] for r in items], 2.0, 150)
        assert all(abs(got[(key, r[1])][0] / 1e6 - m) < 1e-5 for r, m in zip(items, model))


def test_simple_running_operators(df):
    same(df, batching.batch_by_count, 7, "k", "i")
    same(df, shaping.in_flight, F.when(F.col("kind") == "a", -1).otherwise(1), 10, "k", "i")
    same(df, shaping.take_while, F.col("size") < 120, "k", "i", inclusive=True)
    same(df, rotation.rotate, F.col("size") == 60, "k", "i")
    same(df, rotation.rotate_by_time, "k", "i", "ts", name=F.date_format("ts", "HH:mm"))
    same(df, log.checkpoint_every, 10, "k", "i")


def test_rotation_numbers_rows_of_a_file(df, rows):
    got = result(rotation.rotate(df, F.col("size") == 120, "k", "i", rows_per_chunk=CHUNK_ROWS), "file_no", "row_no")
    for key, items in by_key(rows).items():
        file_no = row_no = 0
        for r in items:
            if r[3] == 120:
                file_no, row_no = file_no + 1, 0
            row_no += 1
            assert got.get((key, r[1])) == ((file_no, row_no) if file_no else None)


def test_sessions(df):
    events = df.selectExpr(
        "k AS connection_id", "i", "ts", "if(kind in ('a', 'b'), 'connected', 'disconnected') AS event_type",
        "if(kind = 'd', 'lost', null) AS error",
    )
    same(events, presence.connection_sessions, order=("i",))


def test_settle(spark):
    rng = random.Random(11)
    deliveries, actions, seq = [], [], 0
    channels = {"hot": 700, "cold": 20}
    for channel, n in channels.items():
        for tag in range(1, n + 1):
            deliveries.append((channel, tag))
            if rng.random() < 0.4:
                seq += 1
                covered = rng.randint(max(1, tag - 30), tag)
                actions.append(
                    (channel, covered, seq, rng.choice(["ack", "nack"]), rng.random() < 0.3, rng.random() < 0.5)
                )
    d = spark.createDataFrame(deliveries, "channel string, delivery_tag bigint").repartition(4)
    a = spark.createDataFrame(
        actions, "channel string, delivery_tag bigint, action_seq bigint, action string, multiple boolean, requeue boolean"
    ).repartition(3)
    for chunk in (25, 0):
        got = settlement.settle(d, a, rows_per_chunk=chunk).collect()
        assert len(got) == len(deliveries)
        for channel, n in channels.items():
            model = settled(
                range(1, n + 1), [(s, t, x, m, r) for c, t, s, x, m, r in actions if c == channel]
            )
            mine = {r["delivery_tag"]: (r["state"], r["settled_by"]) for r in got if r["channel"] == channel}
            assert mine == model


def test_markup_of_one_endless_document(spark):
    items = "".join(f"<item><![CDATA[{i}]]>&amp;x</item>" for i in range(300))
    docs = spark.createDataFrame([(1, f"<doc><elem>{items}</elem><other>no</other></doc>")], "doc_id int, xml string")
    events = markup.markup_events(docs, "doc_id", "xml")
    for chunk in (30, 0):
        merged = markup.coalesce_text(events, 100, rows_per_chunk=chunk)
        inside = markup.subslice(merged, ["doc", "elem", "item"], rows_per_chunk=chunk).orderBy("seq").collect()
        assert [r["text"] for r in inside] == [f"{i}&x" for i in range(300)]
        ends = markup.with_documents(events, "doc_id", rows_per_chunk=chunk)
        kinds = [r["kind"] for r in ends.orderBy("seq").collect()]
        assert kinds[0] == "start_document" and kinds[-1] == "end_document" and kinds.count("end_document") == 1
        assert markup.well_formed(events, rows_per_chunk=chunk).first()["well_formed"]


def test_a_trigger_that_remembers(df, rows):
    # a file opens at every third b, unless an a came in between
    machine = Automaton("0", {("0", "b"): ("1", False), ("1", "b"): ("2", False), ("2", "b"): ("0", True), ("1", "a"): ("0", False), ("2", "a"): ("0", False)})
    got = {}
    for chunk in (CHUNK_ROWS, 0):
        got[chunk] = result(rotation.rotate_by_automaton(df, machine, F.col("kind"), "k", "i", rows_per_chunk=chunk), "file_no", "row_no")
    assert got[CHUNK_ROWS] == got[0]
    want = {}
    for key, items in by_key(rows).items():
        count, file_no, row_no = 0, 0, 0
        for r in items:
            count = 0 if r[4] == "a" else count + (r[4] == "b")
            row_no += 1
            if count == 3:
                count, file_no, row_no = 0, file_no + 1, 1
            if file_no:
                want[(key, r[1])] = (file_no, row_no)
    assert got[0] == want


def test_rate_use(df, rows):
    got = {(r.k, r.started_at.replace(tzinfo=timezone.utc).timestamp()): (r["rows"], r.used, r.over) for r in shaping.rate_use(df, 300, "1 minute", "k", "ts", F.col("size")).collect()}
    want = defaultdict(lambda: [0, 0])
    for k, _, t, size, _ in rows:
        want[(k, float(t // 60 * 60))][0] += 1
        want[(k, float(t // 60 * 60))][1] += size
    assert got == {w: (n, used, max(used - 300, 0)) for w, (n, used) in want.items()}
    with pytest.raises(ValueError):
        shaping.rate_use(df, 0, "1 minute", "k", "ts")


@pytest.mark.parametrize("which", ["last", "first", "first_and_last", "last_batch"])
def test_retain(df, rows, which):
    got = result(shaping.retain(df, 70, which, "k", "i", rows_per_chunk=CHUNK_ROWS))
    keep = {"last": lambda n: range(max(n - 70, 0), n), "first": lambda n: range(min(n, 70)),
            "first_and_last": lambda n: [*range(min(n, 69)), n - 1], "last_batch": lambda n: range((n - 1) // 70 * 70, n)}[which]
    assert set(got) == {(k, items[e][1]) for k, items in by_key(rows).items() for e in keep(len(items))}

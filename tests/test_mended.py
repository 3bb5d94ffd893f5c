"""Cases that were wrong once."""

from datetime import datetime

from models import fail_until
from pyspark.sql import functions as F

from flowtables.functions.json import extract_json
from flowtables.functions.markup import unescape
from flowtables.functions.topics import topic_matches
from flowtables.operators.csv_records import csv_parse, csv_to_map
from flowtables.operators.markup import markup_events, well_formed
from flowtables.operators.publish import PublishSettings, publish
from flowtables.operators.queues import action_results, after_receive, apply_actions
from flowtables.operators.rotation import rotate_by_time
from flowtables.operators.routing import route
from flowtables.sources.csv_files import csv_scan
from flowtables.streaming.keyed import grouped_within_stream
from flowtables.streaming.runs import run_available, tail_log


def test_references_are_read_once_and_bad_ones_stay(spark):
    texts = ["&#38;lt;", "&amp;#65;", "&#1114112;", "&#99999999999;", "&#xFFFFFFFFFFFFFFFFFFFF;", "&#xD800;", "&#0;", "&#x41;&#0066; &lt;&", "plain"]
    want = ["&lt;", "&#65;", *texts[2:7], "AB <&", "plain"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(unescape(F.col("t")).alias("u")).collect()
    assert [r.u for r in rows] == want


def test_bytes_that_are_no_text_have_no_value(spark):
    rows = spark.createDataFrame([(bytearray(b'{"k": 1}'),), (bytearray(b'{"k": "\xff"}'),)], "body binary")
    assert [r.value and r.value.k for r in extract_json(rows, "body", "k long").collect()] == [1, None]


def test_rows_before_the_first_time_are_in_a_file(spark):
    at = [None, None, datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 6)]
    df = spark.createDataFrame([("a", i, t) for i, t in enumerate(at)], "key string, seq int, at timestamp")
    assert rotate_by_time(df, "key", "seq", "at").count() == 4


def test_equal_ids_in_two_queues(spark):
    now = datetime(2024, 1, 1)
    schema = "queue string, msg_id long, visible_at timestamp, receive_count int"
    messages = spark.createDataFrame([("a", 1, now, 0), ("b", 1, now, 0)], schema)
    received = spark.createDataFrame([("a", 1, now, 1)], schema)
    assert {(r.queue, r.receive_count) for r in after_receive(messages, received).collect()} == {("a", 1), ("b", 0)}
    actions = spark.createDataFrame([("a", 1, "delete", None, 0), ("c", 1, "delete", None, 1)], "queue string, msg_id long, action string, visibility_s int, action_seq long")
    assert [r.queue for r in apply_actions(messages, actions, F.lit(now)).collect()] == ["b"]
    assert {(r.queue, r.result) for r in action_results(messages, actions).collect()} == {("a", "deleted"), ("c", "not_found")}


def test_what_has_no_end_is_an_error_and_raw_text_has_any_case(spark):
    docs = [
        (1, "<a>x<!-- open <b>"),
        (2, '<!DOCTYPE d [<!ENTITY e "]>"><!-- it\'s ]> -->]><d/>'),
        (3, "<p><SCRIPT>if (a <b) x = '</p>'</SCRIPT></p>"),
        (4, "<a>t</a>"),
        (5, "<a><![CDATA[x]]></a><!-->"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    events = markup_events(df, "doc_id", "text", html=True)
    got = {}
    for r in events.orderBy("doc_id", "seq").collect():
        got.setdefault(r.doc_id, []).append((r.kind, r.name or r.text))
    assert got[1] == [("start_element", "a"), ("characters", "x"), ("error", "<!-- open <b>")]
    assert got[2] == [("start_element", "d"), ("end_element", "d")]
    assert got[3][1:4] == [("start_element", "SCRIPT"), ("characters", "if (a <b) x = '</p>'"), ("end_element", "SCRIPT")]
    assert got[5][-1] == ("error", "<!-->")
    assert {r.doc_id: r.well_formed for r in well_formed(events).collect()} == {1: False, 2: True, 3: True, 4: True, 5: False}


def test_private_use_character_at_the_start_is_text(spark):
    df = spark.createDataFrame([("\ue000abc,\ue000",), ("\\abc,d",)], "t string")
    assert [r.fields for r in csv_parse(df, "t", on_error="stop").collect()] == [["\ue000abc", "\ue000"], ["\\abc", "d"]]


def test_byte_order_mark_only_at_the_start_of_a_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffa,b\n\ufeffc,d\n", encoding="utf-8")
    for multiline in (True, False):
        got = csv_scan(spark, str(tmp_path), multiline=multiline, on_error="stop").collect()
        assert sorted(r.fields for r in got) == [["a", "b"], ["\ufeffc", "d"]]


def test_files_with_carriage_returns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a,b\r"c\rd",e\r\r"f')
    got = sorted(csv_scan(spark, str(tmp_path), line_end="\r").collect(), key=lambda r: r.line)
    assert [(r.line, r.fields, r.error and r.error.reason) for r in got] == [
        (1, ["a", "b"], None),
        (2, ["c\rd", "e"], None),
        (4, [""], None),
        (5, None, "unterminated_quote"),
    ]


def test_each_file_has_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text("v,id\nz,3\n")
    rows = csv_to_map(csv_scan(spark, str(tmp_path), on_error="stop").drop("record"), order="line", by="file")
    assert sorted((r.record["id"], r.record["v"]) for r in rows.collect()) == [("1", "x"), ("2", "y"), ("3", "z")]


def test_topic_patterns_agree_with_their_expression(spark):
    patterns = ["#", "#.w", "#.w.#", "*.w", "a.#.w", "*.*.*.*.*.w", "#.a.b", "a.b.#", "#.a.*", "#.#", "a", "", "*", "#.b.*.*.*.*", "w.#.#.w"]
    keys = ["", "w", "a.w", "a.b.w", "x.w.y", "a.a.a.a.a.w", "a.b", "q.a.b", "a.b.c", "w.w", "a", "b.1.2.3.4", "z", "w..w", ".", "a.b.1.2.3.4"]
    messages = spark.createDataFrame([(i, "t", k) for i, k in enumerate(keys)], "message_id long, exchange string, routing_key string")
    messages = messages.withColumn("headers", F.lit(None).cast("map<string,string>"))
    exchanges = spark.createDataFrame([("t", "topic")], "exchange string, type string")
    bindings = spark.createDataFrame([(p, "t", p) for p in patterns], "queue string, exchange string, routing_key string")
    bindings = bindings.withColumn("args", F.lit(None).cast("map<string,string>"))
    want = messages.crossJoin(spark.createDataFrame([(p,) for p in patterns], "queue string"))
    want = want.where(topic_matches(F.col("queue"), F.col("routing_key")))
    want = sorted((r.routing_key, r.queue) for r in want.collect())
    for broadcast_rows in (100, 1):
        got = route(messages, exchanges, bindings, broadcast_rows=broadcast_rows)
        assert sorted((r.routing_key, r.queue) for r in got.collect()) == want


def test_given_batches_are_sent_until_they_are_taken(spark):
    rows = [("k", i, i // 3, 4 if i == 4 else 0) for i in range(8)]
    df = spark.createDataFrame(rows, "k string, i int, bin int, fails int")
    settings = PublishSettings(max_retries=1, policy="retry", wait=False, records_per_second=10_000)
    got = publish(df, fail_until("fails"), "k", "i", settings, batch="bin").orderBy("i").collect()
    assert [(r.batch_no, r.idx) for r in got] == [(i // 3, i % 3) for i in range(8)]
    assert all(r.ok for r in got) and got[4].attempts == 5 and got[4].waited_ms == 2000


def test_rows_of_slow_keys_are_not_lost(spark, tmp_path):
    schema = "k string, i long, ts timestamp"
    parts = [[("a", 1, 0), ("a", 2, 1)], [("a", 3, 500)], [("b", 4, 0), ("b", 5, 1)], [("b", 6, 900), ("a", 7, 900)]]
    for n, part in enumerate(parts):
        values = [(k, i, datetime.fromtimestamp(1_700_000_000 + t)) for k, i, t in part]
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(str(tmp_path / f"part{n}"))
    for max_files, late in ((1, {4, 5}), (1000, set())):
        stream = tail_log(spark, str(tmp_path / "part*"), spark.createDataFrame([], schema).schema, max_files=max_files)
        groups = grouped_within_stream(stream, 2, 10, "k", "i", "ts", "0 seconds")
        out = run_available(groups, f"groups_{max_files}", keyed=True).collect()
        assert {i for r in out if r.late for i in r["items"]} == late
        # The last group of each key is open still.
        assert {1, 2, 3, 4, 5} <= {i for r in out for i in r["items"]}

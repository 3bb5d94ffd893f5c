"""Bounds of a key are looked up by pages, never as one array in each row."""

from bisect import bisect_right

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowtables.functions import intervals
from flowtables.operators.markup import markup_events, with_documents
from flowtables.plans import ordered
from flowtables.sources import csv_files


def test_count_at_most_by_pages(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BOUNDS_PER_PAGE", 4)
    looked, plain = [], ordered.broadcast_if_small
    monkeypatch.setattr(ordered, "broadcast_if_small", lambda df: looked.append(plain(df)) or looked[-1])
    bounds = {"a": list(range(0, 300, 3)), None: [5], "c": list(range(16)), "d": list(range(64))}
    table = spark.createDataFrame([(k, b) for k, own in bounds.items() for b in own], "b string, _bound long")
    values = [-1, 0, 1, 5, 14, 15, 16, 62, 63, 64, 191, 192, 193, 297, 400]
    rows = spark.createDataFrame([(k, v) for k in [*bounds, "none"] for v in values], "k string, v long")
    got = {(r.k, r.v): r.n for r in ordered.count_at_most(rows, table, {"k": "b"}, F.col("v"), "n").collect()}
    assert got == {(k, v): bisect_right(bounds[k], v) if k in bounds else None for k in [*bounds, "none"] for v in values}
    assert len(looked) == 4 and all(p.agg(F.max(F.size("_bounds"))).first()[0] <= 4 for p in looked)


def test_a_split_is_framed_in_pieces(spark, tmp_path, monkeypatch):
    """Records go over the ends of pieces, and no piece has more lines than it should."""
    records = [(str(i), "\n".join(f'{i} "{j}"' for j in range(i % 6))) for i in range(60)]
    text = "".join('{},"{}"\n'.format(a, b.replace('"', '""')) for a, b in records)
    (tmp_path / "a.csv").write_text(text)
    seen, plain = [], csv_files.arrange_by
    monkeypatch.setattr(csv_files, "LINES_PER_CHUNK", 3)
    monkeypatch.setattr(csv_files, "arrange_by", lambda *a: seen.append(plain(*a)) or seen[-1])
    got = csv_files.csv_scan(spark, str(tmp_path), on_error="stop").orderBy("line").collect()
    assert [tuple(r.fields) for r in got] == records
    assert seen[0].table.groupBy(*seen[0].group).count().agg(F.max("count")).first()[0] == 3


def test_slices_of_a_large_batch_come_in_parts(monkeypatch):
    tokens = [["<a>", f"t{i}", "<b>", "x", "</b>", "</a>"] * (i % 4) for i in range(200)]
    batch = pa.record_batch([pa.array(range(200)), pa.array(tokens, pa.list_(pa.string()))], names=["doc_id", "tokens"])
    whole = pa.Table.from_batches(intervals.slices(iter([batch]), ["a"], False, False)).to_pylist()
    monkeypatch.setattr(intervals, "BYTES", batch.column(1).nbytes // 10)
    parts = list(intervals.slices(iter([batch, batch.slice(0, 0)]), ["a"], False, False))
    assert len(parts) >= 10 and pa.Table.from_batches(parts).to_pylist() == whole
    assert [p["token"] for p in whole[1]["pieces"]] == ["t1", "<b>", "x", "</b>"]


@pytest.mark.parametrize("html", [False, True])
def test_documents_are_marked_without_a_shuffle(spark, capsys, html):
    texts = ['<?xml version="1.0"?><a><b/>t</a><c/> x <?pi q?><d>1</d></e><f></f>', "<?p 1?><?p 2?><a/>", "</a></b><c></c><d>", "plain", "", None,
             "<a><script>x</script></a><style></style><br><!-- open", "<a/><a/><?q r?><x:br/>"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = markup_events(df, "id", "t", html=html, documents=True)
    expected = with_documents(markup_events(df, "id", "t", html=html), "id", rows_per_chunk=0)
    assert sorted(map(repr, got.select(*expected.columns).collect())) == sorted(map(repr, expected.collect()))
    got.explain()
    assert "Exchange" not in capsys.readouterr().out

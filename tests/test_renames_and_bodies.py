"""Renamed files, JSON bodies both ways, receive limits, and first-fit packing of many batches."""

import os
import random
import time

import pytest
from models import first_fit
from pyspark.sql import functions as F

from flowtables.functions.json import extract, extract_json, write_body, write_json
from flowtables.operators.batching import pack_first_fit, pack_greedy
from flowtables.operators.queues import queue_receive
from flowtables.sources.directory import directory_renames, list_directory


def named(df):
    return {r.path.rpartition("/")[2]: (r.change, r.renamed_from and r.renamed_from.rpartition("/")[2]) for r in df.collect()}


def test_renamed_files_are_modified(spark, tmp_path):
    for name, text in [("a", "1"), ("b", "2"), ("c", "3"), ("same1", "x"), ("same2", "x"), ("same3", "x"), ("stays", "y")]:
        (tmp_path / name).write_text(text)
    before = spark.createDataFrame(list_directory(spark, f"file://{tmp_path}", fingerprint=True).collect())
    os.rename(tmp_path / "a", tmp_path / "a2")  # renamed
    (tmp_path / "b").write_text("22")  # changed
    os.rename(tmp_path / "c", tmp_path / "c2")
    (tmp_path / "c2").write_text("33")  # another file by then
    os.rename(tmp_path / "same1", tmp_path / "z1")  # alike: in the order of paths
    os.rename(tmp_path / "same2", tmp_path / "y1")
    os.remove(tmp_path / "same3")
    (tmp_path / "new").write_text("y")  # like one that stays
    after = list_directory(spark, f"file://{tmp_path}", fingerprint=True)
    assert named(directory_renames(before, after)) == {
        "a2": ("Modification", "a"), "b": ("Modification", None), "c": ("Deletion", None), "c2": ("Creation", None),
        "y1": ("Modification", "same1"), "z1": ("Modification", "same2"), "same3": ("Deletion", None), "new": ("Creation", None),
    }


def test_many_files_that_are_alike(spark):
    schema = "path string, modified_at int, length int, fingerprint string"
    before = spark.createDataFrame([(f"/old/{i:04d}", 0, 0, "empty") for i in range(500)] + [("/none", 0, 1, None)], schema)
    after = spark.createDataFrame([(f"/new/{i:04d}", 1, 0, "empty") for i in range(480)] + [("/none2", 0, 1, None)], schema)
    got = {r.path: (r.change, r.renamed_from) for r in directory_renames(before, after, rows_per_chunk=50).collect()}
    assert {k: v for k, v in got.items() if k.startswith("/new")} == {f"/new/{i:04d}": ("Modification", f"/old/{i:04d}") for i in range(480)}
    assert {k: v for k, v in got.items() if not k.startswith("/new")} == {
        **{f"/old/{i:04d}": ("Deletion", None) for i in range(480, 500)}, "/none": ("Deletion", None), "/none2": ("Creation", None),
    }


def test_bodies_are_written_and_read(spark):
    df = spark.createDataFrame([(1, "é\"\n", 2.5), (2, None, None)], "id int, name string, value double")
    body = write_json(df, columns=["name", "value"])
    assert body.columns == ["id", "body"] and dict(body.dtypes)["body"] == "binary"
    read = extract_json(body, "body", "name string, value double").select("id", "value.*")
    assert sorted(map(tuple, read.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    text = write_json(df, binary=False)
    assert text.columns == ["body"] and text.where(F.get_json_object("body", "$.id") == "2").first().body == '{"id":2}'
    own = write_body(df, lambda d: F.concat_ws("|", d["id"], d["name"]), ["id", "name"])
    assert extract(own, "body", lambda b: F.split(b, r"\|")[0]).where("value = '2'").first().body == "2"


def test_receive_limits(spark):
    for n in (0, 11):
        with pytest.raises(ValueError, match="max_messages"):
            queue_receive(spark.range(1), F.current_timestamp(), n, 30)


def test_first_fit_of_many_open_batches(spark):
    draw = random.Random(8)
    small = [draw.randint(0, 30) for _ in range(900)]
    df = spark.createDataFrame([("k", i, s) for i, s in enumerate(small)], "k string, i int, size int").repartition(3)
    got = {r.i: r.batch_no for r in pack_first_fit(df, 29, "size", "k", "i", list_size=300).collect()}
    for low in (0, 300, 600):
        assert [got[i] for i in range(low, low + 300)] == first_fit(small[low : low + 300], 29)
    rows = spark.range(200_000).select(F.lit("k").alias("k"), F.col("id").alias("i"), (F.pmod(F.xxhash64("id"), F.lit(61)) + 40).alias("size"))
    rows.write.mode("overwrite").format("noop").save()

    def seconds(packed):
        start = time.monotonic()
        most = packed.agg(F.max("batch_no")).first()[0]
        return time.monotonic() - start, most

    seconds(pack_greedy(rows, 1000, "size", "k", "i"))
    greedy, _ = seconds(pack_greedy(rows, 1000, "size", "k", "i"))
    fit, batches = seconds(pack_first_fit(rows, 1000, "size", "k", "i", list_size=200_000))
    assert batches > 10_000 and fit < max(3 * greedy, 10)

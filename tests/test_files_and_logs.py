"""Log positions, rotated files, directory listings, merges."""

import pytest
from pyspark.sql import functions as F

from flowtables.functions.json import extract, extract_json
from flowtables.operators import batching, rotation
from flowtables.operators.merge import concat_ordered, merge_tagged
from flowtables.plans.sizes import scratch_path, shared_dir, written
from flowtables.sinks.rotating import rotate_write
from flowtables.sources.directory import directory_changes, list_directory
from flowtables.sources.log import log_ends, read_log, resume_from


def lines(spark):
    data = [("a", i, c * 1000 + "\n") for i, c in enumerate("abcdef")]
    return spark.createDataFrame(data, "k string, seq bigint, line string")


def test_size_rotation(spark):
    files = rotation.rotate_by_size(lines(spark), 2002, F.octet_length("line"), "k", "seq")
    got = files.groupBy("file_no").agg(F.sum(F.octet_length("line")).alias("n")).orderBy("file_no").collect()
    assert [(r["file_no"], r["n"]) for r in got] == [(1, 2002), (2, 2002), (3, 2002)]


def test_single_trigger_and_no_trigger(spark):
    one = rotation.rotate(lines(spark), F.col("seq") == 0, "k", "seq")
    assert one.groupBy("file_no").agg(F.sum(F.octet_length("line"))).collect()[0][1] == 6006
    assert rotation.rotate(lines(spark), F.lit(False), "k", "seq").count() == 0
    assert rotation.rotate(lines(spark).limit(0), F.lit(True), "k", "seq").count() == 0


def test_rotated_files_on_disk(spark):
    df = spark.createDataFrame([("x", i, f"line {i}") for i in range(95)], "k string, seq bigint, line string")
    files = rotation.rotate(df.repartition(4), F.col("seq") % 40 == 5, "k", "seq")
    path = scratch_path(spark, "rotated")
    rotate_write(files, path, "line", "k", "seq", row_no="row_no", rows_per_part=16)
    out = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()
    content = {}
    for r in sorted(out, key=lambda r: r["path"]):
        file_no, part = r["path"].split("file_no=")[1].split("/")[:2]
        content[(int(file_no), int(part[5:]))] = bytes(r["content"]).decode().splitlines()
    assert sorted(content) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (2, 2), (3, 0)]
    joined = {n: sum((v for (f, _), v in sorted(content.items()) if f == n), []) for n in (1, 2, 3)}
    assert joined[1] == [f"line {i}" for i in range(5, 45)] and joined[3] == [f"line {i}" for i in range(85, 95)]


def test_rotated_files_with_own_writer(spark):
    files = rotation.rotate(lines(spark), F.col("seq") % 2 == 0, "k", "seq")
    path = scratch_path(spark, "own-writer")
    rotate_write(files, path, "line", "k", "seq", writer=lambda rows, p: rows.write.partitionBy("file_no").parquet(p))
    assert spark.read.parquet(path).groupBy("file_no").count().count() == 3


def test_directory_listings(spark):
    path = scratch_path(spark, "listing")
    spark.createDataFrame([("one",)], "v string").coalesce(1).write.mode("append").text(path)
    before = written(list_directory(spark, path), "before")
    spark.createDataFrame([("two",)], "v string").coalesce(1).write.mode("append").text(path)
    after = list_directory(spark, path)
    changes = directory_changes(before, after).collect()
    assert [r["change"] for r in changes] == ["Creation"]
    schema = "path string, modified_at int, length int"
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 1, 1)], schema)
    new = spark.createDataFrame([("b", 2, 1), ("c", 1, 1), ("d", 1, 1)], schema)
    got = {r["path"]: r["change"] for r in directory_changes(old, new).collect()}
    assert got == {"a": "Deletion", "b": "Modification", "d": "Creation"}


def log(spark):
    return spark.createDataFrame(
        [(s, i, f"2024-01-0{i + 1} 00:00:00") for s in (0, 1) for i in range(5)], "shard int, seq bigint, t string"
    ).withColumn("ts", F.col("t").cast("timestamp"))


def test_start_positions(spark):
    df = log(spark)
    seqs = lambda d: sorted((r["shard"], r["seq"]) for r in d.collect())
    assert len(seqs(read_log(df, "TRIM_HORIZON"))) == 10
    assert seqs(read_log(df, "AT_SEQUENCE_NUMBER", sequence=4)) == [(0, 4), (1, 4)]
    assert seqs(read_log(df, "AFTER_SEQUENCE_NUMBER", sequence=3)) == [(0, 4), (1, 4)]
    assert seqs(read_log(df, "AT_TIMESTAMP", timestamp="2024-01-05 00:00:00")) == [(0, 4), (1, 4)]
    ends = log_ends(df.where("seq <= 3 + shard"))
    assert seqs(read_log(df, "LATEST", positions=ends)) == [(0, 4)]
    only = spark.createDataFrame([(1, 2)], "shard int, sequence bigint")
    assert seqs(read_log(df, "AT_SEQUENCE_NUMBER", positions=only)) == [(1, 2), (1, 3), (1, 4)]
    for start in ("AT_SEQUENCE_NUMBER", "AT_TIMESTAMP", "LATEST", "SOMEWHERE"):
        with pytest.raises(ValueError):
            read_log(df, start)


def test_resume(spark):
    done = spark.createDataFrame([(1, 3)], "shard int, seq bigint")
    got = resume_from(log(spark), done, "shard", "seq").collect()
    assert sorted((r["shard"], r["seq"]) for r in got) == [(0, i) for i in range(5)] + [(1, 4)]


def test_literal_positions_reach_the_scan(spark, capsys):
    path = scratch_path(spark, "log")
    log(spark).write.parquet(path)
    read_log(spark.read.parquet(path), "AFTER_SEQUENCE_NUMBER", sequence=3).select("shard").explain()
    plan = capsys.readouterr().out
    assert "GreaterThan(seq,3)" in plan and "ReadSchema: struct<shard:int,seq:bigint>" in plan


def test_batches_are_collected_in_order(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)], "k string, i int").repartition(4)
    batches = batching.collect_batches(batching.batch_by_count(df, 4, "k", "i"), ["k", "batch_no"], "idx", ["i"])
    assert {r["batch_no"]: r["items"] for r in batches.collect()} == {0: [0, 1, 2, 3], 1: [4, 5, 6, 7], 2: [8, 9]}


def test_bodies(spark):
    df = spark.createDataFrame([(b'{"a": 1}',), (b"no json",)], "body binary")
    assert [r["value"] and r["value"]["a"] for r in extract_json(df, "body", "a int").collect()] == [1, None]
    assert extract(df, "body", F.octet_length).first()["value"] == 8


def test_merge(spark):
    a, b = spark.range(2), spark.range(5, 6)
    assert sorted(map(tuple, merge_tagged({"a": a, "b": b}).collect())) == [(0, "a"), (1, "a"), (5, "b")]
    got = concat_ordered(b, a, order="id").orderBy("part_no", "id").collect()
    assert [r["id"] for r in got] == [5, 0, 1]


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark)).rstrip("/")

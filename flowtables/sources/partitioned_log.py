"""A log in partitions of ordered segments, and a streaming reader with an offset for each.

A log is a folder: every append is a folder of its own, counted from 0, with segments (Parquet
files) by partition.  A record's offset is its place in its partition.  Segments never change, so
footers tell all offsets and no record is read to find where a micro-batch ends.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from flowtables.functions.rules import MAX_FETCH, check_fetch

_CLOSED = "_closed"


def append_log(df: DataFrame, path: str, shard: str, order: str) -> None:
    """Append rows to the partitions that ``shard`` names, in ``order``.  A partition may have
    several segments an append: rows are ranged by (shard, order), so no partition is one task."""
    files, base = fs.FileSystem.from_uri(path)
    number = len(_appends(files, base))
    ranged = df.withColumn("_shard", F.col(shard).cast("string")).repartitionByRange("_shard", order)
    ranged.sortWithinPartitions("_shard", order).write.partitionBy("_shard").parquet(f"{path}/append={number:012d}")


def close_partitions(path: str, shards: list[str]) -> None:
    """No more records come to these partitions."""
    files, base = fs.FileSystem.from_uri(path)
    files.create_dir(f"{base}/{_CLOSED}", recursive=True)
    for shard in shards:
        with files.open_output_stream(f"{base}/{_CLOSED}/{shard}") as out:
            out.write(b"")


def _appends(files: fs.FileSystem, base: str) -> list[str]:
    """Folders of appends that are complete."""
    found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
    names = sorted(f.path for f in found if f.type == fs.FileType.Directory and "/append=" in f.path)
    return [n for n in names if files.get_file_info(f"{n}/_SUCCESS").type == fs.FileType.File]


@dataclass
class Range(InputPartition):
    """Rows ``low`` to ``high`` (excluded) of a segment."""

    segment: str
    low: int
    high: int


class _Segments:
    """Segments of each partition with the offsets they start at, in order."""

    def __init__(self, path: str):
        self.files, self.base = fs.FileSystem.from_uri(path)
        self.seen: set[str] = set()
        self.of: dict[str, list[tuple[int, int, str]]] = {}

    def refresh(self) -> None:
        for append in _appends(self.files, self.base):
            if append in self.seen:
                continue
            found = self.files.get_file_info(fs.FileSelector(append, recursive=True))
            for name in sorted(f.path for f in found if f.path.endswith(".parquet")):
                shard = name.rpartition("/")[0].rpartition("/_shard=")[2]
                segments = self.of.setdefault(shard, [])
                start = segments[-1][1] if segments else 0
                rows = pq.read_metadata(name, filesystem=self.files).num_rows
                segments.append((start, start + rows, name))
            self.seen.add(append)

    def end(self, shard: str) -> int:
        return self.of[shard][-1][1] if shard in self.of else 0

    def closed(self) -> set[str]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.base}/{_CLOSED}", allow_not_found=True))
        return {f.base_name for f in found}

    def ranges(self, shard: str, low: int, high: int) -> Iterator[Range]:
        for start, end, name in self.of.get(shard, []):
            a, b = max(low, start), min(high, end)
            if a < b:
                yield Range(name, a - start, b - start)


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.limit = int(options.get("limit", MAX_FETCH))
        check_fetch(self.limit)
        self.each = int(options.get("recordspertrigger", 100 * MAX_FETCH))
        self.latest = options.get("start", "TRIM_HORIZON") == "LATEST"
        self.path = options["path"]
        self.segments = _Segments(self.path)
        self.at: dict[str, int] = {}

    def initialOffset(self) -> dict:
        self.segments.refresh()
        self.at = {shard: self.segments.end(shard) if self.latest else 0 for shard in self.segments.of}
        return {"at": dict(self.at), "closed": False}

    def latestOffset(self) -> dict:
        # Told closed before listing: what came before the mark is listed then.
        closed = self.segments.closed()
        self.segments.refresh()
        for shard in self.segments.of:
            at = self.at.get(shard, 0)
            self.at[shard] = min(at + self.each, self.segments.end(shard))
        done = closed >= set(self.segments.of) and all(self.at[s] == self.segments.end(s) for s in self.segments.of)
        return {"at": dict(self.at), "closed": bool(closed) and done}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.segments.refresh()
        for shard, at in end["at"].items():  # of a query that starts again
            self.at[shard] = max(at, self.at.get(shard, 0))
        return [r for shard, high in end["at"].items() for r in self.segments.ranges(shard, start["at"].get(shard, 0), high)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        at = 0
        files = fs.FileSystem.from_uri(self.path)[0]
        with pq.ParquetFile(partition.segment, filesystem=files) as segment:
            for fetch in segment.iter_batches(batch_size=self.limit):
                low, high = max(partition.low - at, 0), min(partition.high - at, fetch.num_rows)
                at += fetch.num_rows
                if low < high:
                    yield fetch.slice(low, high - low)
                if at >= partition.high:
                    return


class PartitionedLog(DataSource):
    """``format("partitioned_log")`` with ``path``, ``limit`` (records a fetch, 10 000 at most),
    ``recordsPerTrigger`` (of each partition) and ``start`` (TRIM_HORIZON or LATEST)."""

    @classmethod
    def name(cls) -> str:
        return "partitioned_log"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def tail_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    limit: int = MAX_FETCH,
    records_per_trigger: int | None = None,
    start: str = "TRIM_HORIZON",
) -> DataFrame:
    """A stream of the records of all partitions, those that come later included.

    Each partition has its offset in the query's checkpoint.  A micro-batch takes in
    ``records_per_trigger`` records of each partition (of a query that starts again, one such
    step more at most), and a fetch has ``limit`` records at most.
    """
    check_fetch(limit)
    if start not in ("TRIM_HORIZON", "LATEST"):
        raise ValueError("start must be 'TRIM_HORIZON' or 'LATEST'")
    if records_per_trigger is not None and records_per_trigger < 1:
        raise ValueError("records_per_trigger must be positive")
    spark.dataSource.register(PartitionedLog)
    reader = spark.readStream.format("partitioned_log").schema(schema).options(path=path, limit=str(limit), start=start)
    if records_per_trigger is not None:
        reader = reader.option("recordsPerTrigger", str(records_per_trigger))
    return reader.load()


def await_closed(query: StreamingQuery, poll_seconds: float = 0.2) -> None:
    """Wait until every partition is closed and read to its end, then stop the query."""
    while query.isActive:
        progress = query.lastProgress
        if progress is not None and all(_is_closed(s["endOffset"]) for s in json.loads(progress.json)["sources"]):
            query.processAllAvailable()
            query.stop()
            return
        time.sleep(poll_seconds)
    if query.exception() is not None:
        raise query.exception()


def _is_closed(offset: str | dict | None) -> bool:
    found = json.loads(offset) if isinstance(offset, str) else offset
    return bool(found) and bool(found.get("closed"))

"""Requests that are sent once, whatever is run again: a data source with a ledger."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from flowtables.operators.publish import (
    RESULT,
    PublishSettings,
    Send,
    ordered_requests,
    paced,
    result_columns,
    send_request,
    whole_requests,
)


@dataclass
class Written(WriterCommitMessage):
    """What a task sent, and what it found in the ledger."""

    requests: int
    known: int


def publish_committed(
    df: DataFrame,
    transport: Callable[[], Send],
    key: str | Sequence[str],
    order: str | Sequence[str],
    path: str,
    settings: PublishSettings = PublishSettings(),
    payload: Sequence[str] | None = None,
    rows_per_chunk: int | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Send every row once and return what became of it, like :func:`publish`: the key and order
    columns, ``batch_no``, ``idx``, ``ok``, ``attempts``, ``error_code`` and ``waited_ms``.

    ``path`` is a folder that driver and executors share, one for each publication.  A task notes
    each request in the ledger there as soon as it is answered: one small file, written aside and
    then renamed.  A task that runs again skips what the ledger has, and so does a later call
    after a failure: it sends only rows whose key and order the ledger does not have as sent.

    Between an answer and its note nobody knows.  The request's intent is noted before it is sent;
    if ``transport()`` has an attribute ``outcome``, it is asked for the error codes of the records
    of such a request (None: it knows nothing of it), else the request is sent again with the
    same records.  Two attempts of a task at the same time would both send: leave speculation off.
    """
    spark = df.sparkSession
    ids = [*([key] if isinstance(key, str) else key), *([order] if isinstance(order, str) else order)]
    fields = [df.schema[c] for c in ids] + [T.StructField("batch_no", T.LongType()), T.StructField("idx", T.LongType()), *RESULT.fields]
    schema = T.StructType([_nullable(f) for f in fields])
    sent = _ledger(spark, path, schema)
    todo = df
    if sent is not None:
        done = sent.where("ok").select(*[F.col(c).alias(f"_done{i}") for i, c in enumerate(ids)]).distinct()
        same = F.lit(True)
        for i, c in enumerate(ids):
            same &= df[c].eqNullSafe(done[f"_done{i}"])
        todo = df.join(done, same, "left_anti")
    requests = ordered_requests(todo, key, order, settings, batch, rows_per_chunk)
    source = _source(transport, ids, list(payload or df.columns), path, settings)
    spark.dataSource.register(source)
    requests.write.format(source.name()).mode("append").save()
    # Of a row that failed before and was sent now, the newest note counts.
    notes = _ledger(spark, path, schema)
    if notes is None:
        return spark.createDataFrame([], schema)
    newest = notes.groupBy(*ids).agg(F.max_by(F.struct(*schema.names[len(ids) :]), F.struct("ok", "noted")).alias("_note"))
    return newest.select(*ids, "_note.*")


def _nullable(field: T.StructField) -> T.StructField:
    return T.StructField(field.name, field.dataType, True)


def _ledger(spark, path: str, schema: T.StructType) -> DataFrame | None:
    files, base = fs.FileSystem.from_uri(path)
    if files.get_file_info(f"{base}/ledger").type == fs.FileType.NotFound:
        return None
    noted = T.StructType([*schema.fields, T.StructField("noted", T.LongType())])
    return spark.read.schema(noted).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{path}/ledger")


def _source(transport, ids: list[str], payload: list[str], path: str, settings: PublishSettings) -> type[DataSource]:
    """A data source of its own for each publication, since options hold no functions."""
    run = uuid.uuid4().hex
    name = f"requests_{run}"

    class Requests(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
            return Writer()

    class Writer(DataSourceArrowWriter):
        def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
            own = transport()
            return write_requests(iterator, own, paced(own, settings), ids, payload, path, run, settings)

        def commit(self, messages: list[WriterCommitMessage | None]) -> None:
            files, base = fs.FileSystem.from_uri(path)
            files.create_dir(f"{base}/ledger")
            with files.open_output_stream(f"{base}/_COMMITTED") as out:
                out.write(b"requests %d known %d\n" % (sum(m.requests for m in messages if m), sum(m.known for m in messages if m)))

        def abort(self, messages: list[WriterCommitMessage | None]) -> None:
            """Nothing is taken back: the ledger says what was sent, and the next call goes on from there."""

    return Requests


def write_requests(
    parts: Iterator[pa.RecordBatch],
    own: Send,
    send: Send,
    ids: list[str],
    payload: list[str],
    path: str,
    run: str,
    settings: PublishSettings,
) -> Written:
    """Send what the ledger does not have of this run, and note each request."""
    files, base = fs.FileSystem.from_uri(path)
    for folder in ("ledger", "intents"):
        files.create_dir(f"{base}/{folder}", recursive=True)
    is_there = lambda name: files.get_file_info(name).type == fs.FileType.File
    message = Written(0, 0)
    for rows, ends in whole_requests(parts):
        records = rows.select(payload).to_pylist()
        names = rows.select(ids)
        for low, high in zip([0, *ends], ends):
            own_ids = names.slice(low, high - low)
            request = sha256(repr(own_ids.to_pylist()).encode()).hexdigest()
            note, intent = f"{base}/ledger/{request[:2]}/{request}-{run}.parquet", f"{base}/intents/{request}"
            if is_there(note):
                message.known += 1
                continue
            results = None
            if is_there(intent) and (outcome := getattr(own, "outcome", None)):
                codes = outcome(records[low:high])
                results = codes and [(not c, 1, c or None, 0) for c in codes]
            if results is None:
                with files.open_output_stream(intent) as out:
                    out.write(b"")
                results = send_request(send, records[low:high], settings)
            message.requests += 1
            _note(files, note, own_ids, rows.select(["batch_no", "idx"]).slice(low, high - low), results)
            files.delete_file(intent)
    return message


def _note(files: fs.FileSystem, name: str, ids: pa.Table, places: pa.Table, results: list[tuple]) -> None:
    files.create_dir(name.rpartition("/")[0], recursive=True)
    columns = [*ids.columns, *[c.cast(pa.int64()) for c in places.columns], *result_columns(results), pa.array([time.time_ns()] * len(results))]
    table = pa.table(columns, names=[*ids.column_names, *places.column_names, *RESULT.names, "noted"])
    aside = f"{name}.{uuid.uuid4().hex}.tmp"
    pq.write_table(table, aside, filesystem=files)
    files.move(aside, name)

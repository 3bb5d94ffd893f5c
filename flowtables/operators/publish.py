"""Publishing records in batches through a transport, with retries.

A transport is what talks to the outside.  ``publish`` cuts batches, sends them,
sends again what failed, and returns what became of every record.  Batches of a
hot key are spread over tasks like any others.

Tasks may run twice (a lost executor, speculation), so delivery is at least once:
a transport should use the record id to recognise what it has already sent.  The
result is evaluated with the query; use :func:`publish_once` to send and keep
the results as a table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions.rules import backoff_ms
from flowtables.operators.batching import batch_by_count
from flowtables.plans.sizes import written

#: (records of one request, attempt from 1) -> error code per record, None if sent.
Send = Callable[[list[dict], int], Sequence[str | None]]

RESULT = T.StructType(
    [
        T.StructField("ok", T.BooleanType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("waited_ms", T.LongType()),
    ]
)


def text_bytes(record: dict) -> int:
    """Bytes of a record's texts (in UTF-8) and binaries."""
    return sum(len(v.encode()) if isinstance(v, str) else len(v) for v in record.values() if isinstance(v, str | bytes | bytearray))


@dataclass(frozen=True)
class PublishSettings:
    """``policy`` says what happens to records that still fail after
    ``max_retries`` retries: ``stop`` fails the query, ``skip`` reports them as
    failed, ``retry`` goes on sending, with the longest delay so far, until they are
    taken.  ``atomic``: one failed record fails, and repeats, its whole batch.
    ``records_per_second`` and ``bytes_per_second`` bound what is sent, attempts included: with
    ``parallelism``, by all tasks together, else by each task.  The bytes of a record are what
    ``record_bytes`` says, by default those of its texts and binaries.
    ``wait=False`` only adds the delays up, for transports that need none.
    ``parallelism`` is the number of tasks, each with one request in flight;
    without it Spark chooses."""

    batch_size: int = 500
    max_retries: int = 5
    backoff: str = "exponential"
    backoff_ms: int = 500
    policy: str = "skip"
    atomic: bool = False
    wait: bool = True
    parallelism: int | None = None
    records_per_second: float | None = None
    bytes_per_second: float | None = None
    record_bytes: Callable[[dict], int] = text_bytes

    def __post_init__(self):
        if self.batch_size < 1 or self.max_retries < 0:
            raise ValueError("batch_size must be positive and max_retries not negative")
        if self.policy not in ("stop", "skip", "retry"):
            raise ValueError("policy must be 'stop', 'skip' or 'retry'")
        for rate in ("records_per_second", "bytes_per_second"):
            if getattr(self, rate) is not None and getattr(self, rate) <= 0:
                raise ValueError(f"{rate} must be positive")
        backoff_ms(1, self.backoff, self.backoff_ms)


def publish(
    df: DataFrame,
    transport: Callable[[], Send],
    key: str | Sequence[str],
    order: str | Sequence[str],
    settings: PublishSettings = PublishSettings(),
    payload: Sequence[str] | None = None,
    rows_per_chunk: int | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Send every row; returns all columns plus ``batch_no``, ``idx``, ``ok``,
    ``attempts``, ``error_code`` and ``waited_ms``.

    ``transport`` is called once per task and returns the send function, which
    gets the ``payload`` columns of a request's records as dicts.  Other columns
    pass through.  With ``batch``, the number of a row's batch inside its key is
    given in that column (as by ``pack_first_fit``), and no batches are cut.
    """
    requests = ordered_requests(df, key, order, settings, batch, rows_per_chunk)
    payload = list(payload or df.columns)
    columns = requests.columns[:-1]
    schema = T.StructType([*requests.schema.fields[:-1], *RESULT.fields])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        send = paced(transport(), settings)
        for rows, ends in whole_requests(parts):
            results: list[tuple] = []
            records = rows.select(payload).to_pylist()
            for low, high in zip([0, *ends], ends):
                results += send_request(send, records[low:high], settings)
            out = [rows.column(c).combine_chunks() for c in columns]
            yield pa.RecordBatch.from_arrays([*out, *result_columns(results)], names=schema.names)

    return requests.mapInArrow(run, schema)


def ordered_requests(
    df: DataFrame,
    key: str | Sequence[str],
    order: str | Sequence[str],
    settings: PublishSettings,
    batch: str | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Rows with ``batch_no`` and ``idx``, request after request in each task; ``_last`` marks the
    last row of each."""
    keys = [key] if isinstance(key, str) else list(key)
    if batch is None:
        batches = batch_by_count(df, settings.batch_size, keys, order, rows_per_chunk)
    else:
        orders = [order] if isinstance(order, str) else list(order)
        # One request's worth of rows each.
        given = Window.partitionBy(*keys, batch).orderBy(*orders)
        batches = df.withColumns({"batch_no": F.col(batch), "idx": F.row_number().over(given) - 1})
    # Requests of one key need not share a task, and sending is slow.
    tasks = [settings.parallelism] if settings.parallelism else []
    batches = batches.repartition(*tasks, *keys, "batch_no")
    columns = batches.columns
    in_batch = Window.partitionBy(*keys, "batch_no").orderBy("idx")
    return (
        batches.withColumn("_last", F.lead(F.lit(True)).over(in_batch).isNull())
        .sortWithinPartitions(*keys, "batch_no", "idx")
        .select(*columns, "_last")
    )


def whole_requests(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Rows of whole requests, and where each request ends."""
    held = None  # start of a request that goes on in the next part
    for part in parts:
        rows = pa.Table.from_batches([part])
        rows = rows if held is None else pa.concat_tables([held, rows])
        ends = (np.flatnonzero(rows.column("_last").to_numpy()) + 1).tolist()
        done = ends[-1] if ends else 0
        held = rows.slice(done)
        if done:
            yield rows.slice(0, done), ends


def result_columns(results: Sequence[tuple]) -> list[pa.Array]:
    """``RESULT`` as arrays."""
    ok, attempts, errors, waited = zip(*results)
    return [pa.array(ok), pa.array(attempts, pa.int32()), pa.array(errors, pa.string()), pa.array(waited, pa.int64())]


def paced(send: Send, settings: PublishSettings) -> Send:
    """The same, waiting until what was sent before has had its time."""
    share = settings.parallelism or 1
    limits: list[tuple[float, Callable[[list[dict]], int]]] = []
    if settings.records_per_second is not None:
        limits.append((settings.records_per_second / share, len))
    if settings.bytes_per_second is not None:
        limits.append((settings.bytes_per_second / share, lambda records: sum(map(settings.record_bytes, records))))
    if not limits:
        return send
    ready = time.monotonic()

    def sent(records: list[dict], attempt: int) -> Sequence[str | None]:
        nonlocal ready
        time.sleep(max(0.0, ready - time.monotonic()))
        ready = max(ready, time.monotonic()) + max(amount(records) / rate for rate, amount in limits)
        return send(records, attempt)

    return sent


def send_request(send: Send, records: list[dict], settings: PublishSettings) -> list[tuple]:
    """Send one request until nothing fails or the retries are used up; returns
    (ok, attempts, error code, waited) per record."""
    errors: list[str | None] = [None] * len(records)
    attempts, waited = [0] * len(records), [0] * len(records)
    pending = list(range(len(records)))
    delay, attempt = 0, 1
    while True:
        codes = send([records[i] for i in pending], attempt)
        if len(codes) != len(pending):
            raise ValueError("the transport must answer for every record")
        for i, code in zip(pending, codes):
            errors[i], attempts[i], waited[i] = code or None, attempt, delay
        failed = [i for i in pending if errors[i]]
        if not failed:
            break
        if attempt > settings.max_retries and settings.policy != "retry":
            if settings.policy == "stop":
                raise RuntimeError(
                    f"{len(failed)} records failed after {attempt} attempts: {errors[failed[0]]}"
                )
            if settings.atomic:
                errors = [e or "batch_failed" for e in errors]
            break
        pause = backoff_ms(min(attempt, max(settings.max_retries, 1)), settings.backoff, settings.backoff_ms)
        delay += pause
        if settings.wait:
            time.sleep(pause / 1000)
        pending, attempt = pending if settings.atomic else failed, attempt + 1
    return [(e is None, a, e, w) for e, a, w in zip(errors, attempts, waited)]


def publish_once(df: DataFrame, transport: Callable[[], Send], *args, **kwargs) -> DataFrame:
    """Publish now and return the results as a written table, so that looking at
    them twice does not send twice."""
    return written(publish(df, transport, *args, **kwargs), "publish")


def publish_metrics(results: DataFrame, key: str) -> DataFrame:
    """Per key: records, sent, failed, retried, requests' worth of attempts, and
    the error codes seen."""
    return results.groupBy(key).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("ok")).alias("sent"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.count_if(F.col("attempts") > 1).alias("retried"),
        F.sum("attempts").cast("bigint").alias("attempts"),
        F.array_sort(F.collect_set("error_code")).alias("error_codes"),
    )


def attempt_results(
    attempts: DataFrame, record: str | Sequence[str], order: str | Sequence[str], error: str, first_ms: int = 500, backoff: str = "exponential"
) -> DataFrame:
    """What became of records by a log of attempts: one row a record with ``ok``, ``attempts``,
    ``error_code`` and ``waited_ms``, as :func:`publish` returns them.

    Attempts count along ``order`` up to the first without ``error``; later ones are not needed and
    do not count.  A record without such an attempt failed with its last error.
    """
    records = [record] if isinstance(record, str) else list(record)
    orders = [order] if isinstance(order, str) else list(order)
    at = F.struct(*orders)
    attempts = attempts.select(*records, at.alias("_at"), F.col(error).alias("_error"))
    sent = attempts.where("_error IS NULL").groupBy(*records).agg(F.min("_at").alias("_sent"))
    first = {c: f"_r{i}" for i, c in enumerate(records)}
    sent = sent.withColumnsRenamed(first)
    same = F.lit(True)
    for c, n in first.items():
        same &= attempts[c].eqNullSafe(sent[n])
    needed = attempts.join(sent, same, "left").where(F.col("_sent").isNull() | (F.col("_at") <= F.col("_sent")))
    results = needed.groupBy(*records).agg(
        F.bool_or(F.col("_error").isNull()).alias("ok"),
        F.count(F.lit(1)).cast("int").alias("attempts"),
        F.max_by("_error", "_at").alias("error_code"),  # null if the last one was sent
    )
    pauses = F.transform(F.sequence(F.lit(1), F.greatest(F.col("attempts") - 1, F.lit(1))), lambda a: backoff_ms(a, backoff, first_ms))
    waited = F.aggregate(pauses, F.lit(0).cast("bigint"), lambda total, ms: total + ms)
    return results.withColumn("waited_ms", F.when(F.col("attempts") > 1, waited).otherwise(F.lit(0)).cast("bigint"))


def batch_status(results: DataFrame, key: str) -> DataFrame:
    """All-or-nothing outcome per batch: ``ok`` only if every record was sent."""
    return results.groupBy(key, "batch_no").agg(
        F.bool_and("ok").alias("ok"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(~F.col("ok")).alias("failed"),
    )

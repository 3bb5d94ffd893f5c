"""Starting, bounding and finishing streaming queries."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager, nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowtables.plans.sizes import scratch_path
from flowtables.sources.log import checkpoint
from flowtables.sources.partitioned_log import await_closed

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def tail_log(
    spark: SparkSession,
    path: str,
    schema,
    file_format: str = "parquet",
    max_files: int | None = 1000,
    max_bytes: str | None = None,
    **options: str,
) -> DataFrame:
    """Read a growing folder as a stream.  ``max_files`` or ``max_bytes`` bound what
    one micro-batch takes in, and with it the rows a stateful operator sees of one
    key at a time."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    elif max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The keyed-state operators need this state store; other streams of the
    session keep theirs."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def run_available(
    stream: DataFrame, name: str, output_mode: str = "append", keyed: bool = False
) -> DataFrame:
    """Read all input there is, then stop; returns the output as a table.
    ``keyed`` is for streams with an operator of ``streaming.keyed``.

    Every micro-batch overwrites its own folder, so a batch that is repeated
    after a failure is not in the output twice.  In complete mode the last batch
    is the output.
    """
    return _collected(stream, name, output_mode, keyed, {"availableNow": True}, lambda query: query.awaitTermination())


def run_until_closed(
    stream: DataFrame, name: str, output_mode: str = "append", keyed: bool = False
) -> DataFrame:
    """:func:`run_available` for streams of :func:`tail_partitions`: read until all partitions are
    closed, however long that takes."""
    return _collected(stream, name, output_mode, keyed, {"processingTime": "0 seconds"}, await_closed)


def _collected(
    stream: DataFrame, name: str, output_mode: str, keyed: bool, trigger: dict, wait: Callable[[StreamingQuery], None]
) -> DataFrame:
    spark = stream.sparkSession
    path = scratch_path(spark, name)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={batch_id}")

    with rocksdb_state(spark) if keyed else nullcontext():
        wait(
            stream.writeStream.outputMode(output_mode)
            .option("checkpointLocation", f"{path}/state")
            .trigger(**trigger)
            .foreachBatch(keep)
            .start()
        )
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    out = spark.read.schema(schema).option("basePath", f"{path}/out").parquet(f"{path}/out")
    if output_mode == "complete":
        last = out.agg(F.max("batch")).scalar()
        out = out.where(F.col("batch") == last)
    return out.drop("batch")


def stream_with_checkpoints(
    log: DataFrame,
    handle: Callable[[DataFrame, int], None],
    path: str,
    partition: str = "partition_id",
    offset: str = "offset",
    seq: str = "seq",
    stream: str = "",
    group: str = "",
    delivery: str = "at_least_once",
):
    """A writer that hands each micro-batch to ``handle(batch, batch_id)`` and
    appends the checkpoints it reached to the table at ``path``/checkpoints;
    call ``start()`` on it.

    ``at_least_once`` checkpoints after the batch is handled, so a failure in
    between repeats it.  ``at_most_once`` checkpoints before, and a batch that is
    already there is not handled again.
    """
    if delivery not in ("at_least_once", "at_most_once"):
        raise ValueError("delivery must be 'at_least_once' or 'at_most_once'")
    table = f"{path}/checkpoints"

    def reached(batch: DataFrame, batch_id: int) -> None:
        rows = checkpoint(batch, partition, offset, seq, stream, group)
        rows.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    def is_there(spark: SparkSession, batch_id: int) -> bool:
        try:
            spark.read.parquet(f"{table}/batch={batch_id}")
        except AnalysisException:
            return False
        return True

    def step(batch: DataFrame, batch_id: int) -> None:
        if delivery == "at_most_once":
            if is_there(batch.sparkSession, batch_id):
                return
            reached(batch, batch_id)
            handle(batch, batch_id)
        else:
            handle(batch, batch_id)
            reached(batch, batch_id)

    return log.writeStream.option("checkpointLocation", f"{path}/state").foreachBatch(step)

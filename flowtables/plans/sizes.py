"""Size checks for broadcasts, and the shared folder for written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows, and most bytes as Spark counts them, that a lookup side may have and
#: still be broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
#: Whether shuffle files go at the end of a query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A lookup side, written once and counted: with a broadcast hint up to
    ``max_rows`` rows and ``max_bytes`` bytes of files; beyond that without, so that
    Spark joins by shuffle and splits skewed partitions at run time."""
    path, side = write_table(df, "side")
    small = side.count() <= max_rows and table_bytes(df.sparkSession, path) <= max_bytes
    return F.broadcast(side) if small else side


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or else
    the context's checkpoint folder.  A session on one machine (``local[n]``) that
    names neither gets a folder of that machine, where all its tasks run; a cluster
    that names neither is an error, because executors would not see each other's
    files."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if context.master == "local" or context.master.startswith("local["):
        return f"file://{spark.conf.get('spark.local.dir', '/tmp').split(',')[0].rstrip('/')}"
    raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder, which goes when
    the application ends."""
    own = f"{shared_dir(spark)}/flowtables/{spark.sparkContext.applicationId}"
    folder, files = _path(spark, own)
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """Write ``df`` once to the shared folder: the path, and the rows read back.
    Cuts the lineage and makes sure that what is behind ``df`` runs only once.  Shuffle files
    of the write go when it ends, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return path, spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``write_table`` for rows that are needed until the application ends."""
    return write_table(df, name)[1]


def delete_table(spark: SparkSession, path: str) -> None:
    """Delete what ``write_table`` wrote, once nothing reads it any more."""
    folder, files = _path(spark, path)
    files.delete(folder, True)


def table_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a written table."""
    folder, files = _path(spark, path)
    return files.getContentSummary(folder).getLength()

"""Registry of the queries this package answers over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` with the SQL that must
    give the same rows, if the computation can be said in SQL."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a partitioned log."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 4).cast("int").alias("shard"),
        F.col("event_id").alias("seq"),
        "ts",
        "user_id",
        "event_type",
        F.col("props").alias("body"),
    )


LOG = """log AS (
  SELECT CAST(user_id % 4 AS INTEGER) AS shard, event_id AS seq, ts, user_id, event_type, props AS body
  FROM events)"""


def refusing(column: str, code: str = "throttled"):
    """A transport for ``publish`` that takes a record once the attempt number exceeds its ``column``."""
    return lambda: lambda records, attempt: [code if attempt <= r[column] else None for r in records]

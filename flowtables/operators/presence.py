"""Connection sessions from connect and disconnect events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.functions.times import micros
from flowtables.plans.ordered import arrange, following


def connection_sessions(
    events: DataFrame,
    connection: str = "connection_id",
    kind: str = "event_type",
    at: str = "ts",
    error: str = "error",
    order: tuple[str, ...] | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """One row per ``connected`` event with the end of its session.

    The session ends at the next event of the connection.  If that is a
    ``disconnected`` event, ``outcome`` is ``stopped`` (no error, the client said
    goodbye) or ``failed``; if it is another connect, ``replaced``; if there is
    none, the session is ``open`` and has no end.
    """
    order = order or (at,)
    columns = list(dict.fromkeys([connection, kind, at, error, *order]))
    ends = events.where(F.col(kind).isin("connected", "disconnected")).select(*columns)
    rows = arrange(ends, connection, order, rows_per_chunk)
    rows = rows.scan(_next=following(F.struct(F.col(kind).alias("k"), F.col(at).alias("t"), F.col(error).alias("e"))))
    outcome = (
        F.when(F.col("_next").isNull(), "open")
        .when(F.col("_next.k") == "connected", "replaced")
        .when(F.col("_next.e").isNull(), "stopped")
        .otherwise("failed")
    )
    return rows.df.where(F.col(kind) == "connected").select(
        F.col(connection),
        *[F.col(o) for o in order if o != at],
        F.col(at).alias("started_at"),
        F.col("_next.t").alias("ended_at"),
        outcome.alias("outcome"),
        ((micros("_next.t") - micros(at)) / 1_000_000).alias("seconds"),
    )

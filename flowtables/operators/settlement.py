"""Settling deliveries by acknowledgements, single or for all tags up to one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.plans.ordered import arrange, run_min


def settle(
    deliveries: DataFrame,
    actions: DataFrame,
    channel: str = "channel",
    tag: str = "delivery_tag",
    delivered_seq: str | None = None,
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """First action that settles each delivery.

    ``deliveries`` has one row per ``(channel, tag)``; ``actions`` has the channel
    and tag columns, ``action_seq`` (unique, in time order), ``action`` (``ack`` or
    ``nack``), ``multiple`` (settles all open tags up to its own) and ``requeue``.
    Adds ``state`` (``open``, ``acked``, ``requeued`` or ``dropped``) and
    ``settled_by``, the ``action_seq``.  A delivery is settled at most once.

    An action should come after the deliveries it covers.  With ``delivered_seq``,
    a column on the clock of ``action_seq``, ``premature`` flags deliveries that
    were settled by an earlier action.

    The earliest ``multiple`` action at or above a tag is a running minimum from
    the highest tag down, so no delivery is paired with every action above it.
    """
    outcome = F.struct(
        F.col("action_seq").alias("seq"),
        F.when(F.col("action") == "ack", "acked")
        .when(F.coalesce(F.col("requeue"), F.lit(True)), "requeued")
        .otherwise("dropped")
        .alias("state"),
    )
    seq_type = actions.schema["action_seq"].dataType
    none = F.lit(None).cast(f"struct<seq:{seq_type.simpleString()},state:string>")
    multiple = F.coalesce(F.col("multiple"), F.lit(False))

    covering = actions.where(multiple).select(
        F.col(channel), F.col(tag), F.lit(1).alias("_kind"), F.col("action_seq").alias("_seq"), outcome.alias("_out")
    )
    tags = deliveries.select(
        F.col(channel),
        F.col(tag),
        F.lit(0).alias("_kind"),
        F.lit(None).cast(seq_type).alias("_seq"),
        none.alias("_out"),
        F.struct(*deliveries.columns).alias("_row"),
    )
    line = tags.unionByName(covering, allowMissingColumns=True)
    rows = arrange(line, channel, (tag, "_kind", "_seq"), rows_per_chunk)
    rows = rows.scan(_multi=run_min("_out", reverse=True))
    delivered = rows.df.where(F.col("_kind") == 0).select(channel, tag, "_row", "_multi")

    single = (
        actions.where(~multiple)
        .groupBy(F.col(channel).alias("_channel"), F.col(tag).alias("_tag"))
        .agg(F.min(outcome).alias("_single"))
    )
    on = (F.col(channel) == F.col("_channel")) & (F.col(tag) == F.col("_tag"))
    first = F.least(F.col("_multi"), F.col("_single"))
    out = delivered.join(single, on, "left").select(
        "_row.*",
        F.coalesce(first["state"], F.lit("open")).alias("state"),
        first["seq"].alias("settled_by"),
    )
    if delivered_seq is not None:
        early = F.coalesce(F.col("settled_by") < F.col(delivered_seq), F.lit(False))
        out = out.withColumn("premature", early)
    return out


def redelivered(settled: DataFrame, **columns: Column) -> DataFrame:
    """The deliveries that come back after a nack with requeue, flagged as such."""
    back = settled.where(F.col("state") == "requeued").drop("state", "settled_by")
    return back.withColumns({"redeliver": F.lit(True), **columns})

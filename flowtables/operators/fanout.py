"""Commands to one connection, to a group, or to everyone, with exclusions.

A broadcast to a million connections is one command, not a million rows: the
connections are addressed by a rule (all but these).  :func:`address` gives that
rule per command.  Who received how much is then counted without ever pairing
commands with connections: totals per group, minus the exclusions that really
hit a recipient.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtables.plans.sizes import broadcast_if_small


def address(commands: DataFrame) -> DataFrame:
    """Resolve commands to one send each.

    ``commands``: ``command_id``, ``kind`` (``send``, ``group`` or ``broadcast``),
    ``connection_id``, ``grp``, ``excluded`` (array).  Adds ``target`` (client,
    group_except or all_except), ``address`` and ``except_ids``, sorted.
    """
    none = F.array().cast("array<string>")
    excluded = F.array_sort(F.array_distinct(F.coalesce(F.col("excluded"), none)))
    kind = F.col("kind")
    return commands.withColumns(
        {
            "target": F.when(kind == "send", "client")
            .when(kind == "group", "group_except")
            .when(kind == "broadcast", "all_except")
            .otherwise(F.raise_error(F.concat(F.lit("unknown command kind "), kind)).cast("string")),
            "address": F.when(kind == "send", F.col("connection_id")).when(
                kind == "group", F.col("grp")
            ),
            "except_ids": F.when(kind == "send", none).otherwise(excluded),
        }
    )


def _exclusions(commands: DataFrame, connections: DataFrame, members: DataFrame) -> DataFrame:
    """Exclusions that take a recipient away: command_id, connection_id."""
    named = commands.where("kind <> 'send'").select(
        "command_id", "kind", "grp", F.explode(F.array_distinct("excluded")).alias("connection_id")
    )
    all_but = named.where("kind = 'broadcast'").join(
        connections.select("connection_id"), "connection_id", "left_semi"
    )
    group_but = named.where("kind = 'group'").join(
        members.select("grp", "connection_id").distinct(), ["grp", "connection_id"], "left_semi"
    )
    return all_but.unionByName(group_but).select("command_id", "connection_id")


def recipients_per_command(
    commands: DataFrame, connections: DataFrame, members: DataFrame
) -> DataFrame:
    """``command_id``, ``recipients``: how many connections each command reaches.

    ``connections``: ``connection_id``; ``members``: ``grp``, ``connection_id``.
    """
    sends = (
        commands.where("kind = 'send'")
        .select("command_id", "connection_id")
        .join(connections.select("connection_id", F.lit(1).alias("_hit")), "connection_id", "left")
        .select("command_id", F.coalesce(F.col("_hit"), F.lit(0)).cast("bigint").alias("n"))
    )
    sizes = (
        members.select("grp", "connection_id")
        .distinct()
        .groupBy("grp")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("kind", F.lit("group"))
        .unionByName(
            connections.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit("").alias("grp"), "n", F.lit("broadcast").alias("kind")
            )
        )
    )
    # One row per group: most commands may name the same one, so that side stays put.
    reach = (
        commands.where("kind <> 'send'")
        .select("command_id", "kind", F.when(F.col("kind") == "group", F.col("grp")).otherwise("").alias("grp"))
        .join(broadcast_if_small(sizes), ["kind", "grp"], "left")
        .select("command_id", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))
    )
    minus = _exclusions(commands, connections, members).select(
        "command_id", F.lit(-1).cast("bigint").alias("n")
    )
    return (
        sends.unionByName(reach)
        .unionByName(minus)
        .groupBy("command_id")
        .agg(F.sum("n").alias("recipients"))
    )


def inbox_sizes(commands: DataFrame, connections: DataFrame, members: DataFrame) -> DataFrame:
    """``connection_id``, ``received``: how many commands reach each connection."""
    direct = (
        commands.where("kind = 'send'")
        .groupBy("connection_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_group = (
        commands.where("kind = 'group'").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    )
    by_group = (
        members.select("grp", "connection_id")
        .distinct()
        .join(broadcast_if_small(per_group), "grp")
        .select("connection_id", "n")
    )
    minus = _exclusions(commands, connections, members).select(
        "connection_id", F.lit(-1).cast("bigint").alias("n")
    )
    counts = (
        direct.unionByName(by_group)
        .unionByName(minus)
        .groupBy("connection_id")
        .agg(F.sum("n").alias("_n"))
    )
    broadcasts = commands.where("kind = 'broadcast'").agg(F.count(F.lit(1))).scalar()
    received = F.coalesce(F.col("_n"), F.lit(0)) + broadcasts
    return (
        connections.select("connection_id")
        .join(counts, "connection_id", "left")
        .select("connection_id", received.cast("bigint").alias("received"))
    )

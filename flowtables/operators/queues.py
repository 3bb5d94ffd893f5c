"""Queues as state tables: receiving, visibility, actions on messages.

State columns: ``queue``, ``msg_id``, ``enqueued_at``, ``delay_s``, ``ttl_s``,
``visible_at``, ``receive_count``.  Each operator returns rows of a new state;
write them as the next version of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowtables.functions import rules
from flowtables.functions.times import plus_seconds


def eligible(now: Column) -> Column:
    """True if a message can be received at ``now``: its delay is over, nobody
    else holds it, and it has not expired."""
    seconds = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (
        (plus_seconds("enqueued_at", seconds("delay_s")) <= now)
        & (F.coalesce(F.col("visible_at"), F.col("enqueued_at")) <= now)
        & (F.col("ttl_s").isNull() | (plus_seconds("enqueued_at", seconds("ttl_s")) > now))
    )


def queue_receive(
    messages: DataFrame, now: Column, max_messages: int, visibility_s: int
) -> DataFrame:
    """The oldest eligible messages of every queue, at most ``max_messages`` each (10, which is
    what one request may ask for), with their new ``visible_at`` and ``receive_count``.

    The limit on the row number reaches the map side of the shuffle, so a queue
    of any length sends ``max_messages`` rows per task.
    """
    rules.check_receive(max_messages)
    oldest = Window.partitionBy("queue").orderBy("enqueued_at", "msg_id")
    return (
        messages.where(eligible(now))
        .withColumn("_n", F.row_number().over(oldest))
        .where(F.col("_n") <= max_messages)
        .drop("_n")
        .withColumn("visible_at", plus_seconds(now, visibility_s))
        .withColumn("receive_count", F.col("receive_count") + 1)
    )


def after_receive(messages: DataFrame, received: DataFrame) -> DataFrame:
    """State after a receive: received messages are hidden, the rest unchanged."""
    new = received.select(
        "queue", "msg_id", F.col("visible_at").alias("_v"), F.col("receive_count").alias("_c")
    )
    return (
        messages.join(new, ["queue", "msg_id"], "left")
        .withColumn("visible_at", F.coalesce("_v", "visible_at"))
        .withColumn("receive_count", F.coalesce("_c", "receive_count"))
        .select(*messages.columns)
    )


def _message(messages: DataFrame, actions: DataFrame) -> list[str]:
    """What names a message: its queue, too, where actions say it."""
    return ["queue", "msg_id"] if "queue" in messages.columns and "queue" in actions.columns else ["msg_id"]


def _changes(actions: DataFrame, message: list[str]) -> DataFrame:
    """One row per message: deleted, or its last visibility change."""
    delete = F.col("action") == "delete"
    change = F.when(F.col("action") == "change_visibility", F.col("action_seq"))
    return actions.groupBy(*message).agg(
        F.max(delete).alias("_deleted"),
        F.max_by(F.col("visibility_s").cast("int"), change).alias("_visibility"),
    )


def apply_actions(messages: DataFrame, actions: DataFrame, now: Column) -> DataFrame:
    """State after ``actions`` (``queue`` where ids repeat, ``msg_id``, ``action``, ``visibility_s``,
    ``action_seq``; action is delete, change_visibility or ignore).  Delete wins;
    of several visibility changes the last one counts.  Fractions of a second of
    a timeout are cut off."""
    message = _message(messages, actions)
    changed = messages.join(_changes(actions, message), message, "left")
    return (
        changed.where(~F.coalesce(F.col("_deleted"), F.lit(False)))
        .withColumn(
            "visible_at",
            F.when(F.col("_visibility").isNotNull(), plus_seconds(now, "_visibility")).otherwise(
                F.col("visible_at")
            ),
        )
        .select(*messages.columns)
    )


def action_results(messages: DataFrame, actions: DataFrame) -> DataFrame:
    """One row per action: its columns and ``result`` (deleted,
    visibility_changed, ignored, not_found, or why it is not allowed)."""
    message = _message(messages, actions)
    known = messages.select(*message, F.lit(True).alias("_known"))
    invalid = rules.visibility_error(F.col("action"), F.col("visibility_s"))
    done = (
        F.when(F.col("action") == "ignore", "ignored")
        .when(F.col("_known").isNull(), "not_found")
        .when(F.col("action") == "delete", "deleted")
        .when(F.col("action") == "change_visibility", "visibility_changed")
        .otherwise("unknown_action")
    )
    return (
        actions.join(known, message, "left")
        .withColumn("result", F.coalesce(invalid, done))
        .select(*actions.columns, "result")
    )


def validate_actions(actions: DataFrame) -> DataFrame:
    """Actions with ``error``: null, or why the action is not allowed."""
    return actions.withColumn(
        "error", rules.visibility_error(F.col("action"), F.col("visibility_s"))
    )


def validate_attribute_names(df: DataFrame, name: str) -> DataFrame:
    """Rows with ``error``: null, or why the attribute name is not allowed."""
    return df.withColumn("error", rules.attribute_name_error(name))

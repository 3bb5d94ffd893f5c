"""Checks of names and numbers, and retry delays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Service limits.
MAX_VISIBILITY_SECONDS = 43_200
MAX_NAME_LENGTH = 256
MAX_RECEIVE = 10
MAX_WAIT_SECONDS = 20
MAX_FETCH = 10_000

# Delays between attempts to connect, in milliseconds.
CONNECT_DELAYS = (100, 500, 1000, 2000, 4000, 8000)

# The attribute names a queue knows.
QUEUE_ATTRIBUTES = (
    "All",
    "ApproximateFirstReceiveTimestamp",
    "ApproximateReceiveCount",
    "SenderId",
    "SentTimestamp",
    "MessageDeduplicationId",
    "MessageGroupId",
    "SequenceNumber",
    "Policy",
    "VisibilityTimeout",
    "MaximumMessageSize",
    "MessageRetentionPeriod",
    "ApproximateNumberOfMessages",
    "ApproximateNumberOfMessagesNotVisible",
    "CreatedTimestamp",
    "LastModifiedTimestamp",
    "QueueArn",
    "ApproximateNumberOfMessagesDelayed",
    "DelaySeconds",
    "ReceiveMessageWaitTimeSeconds",
    "RedrivePolicy",
    "FifoQueue",
    "ContentBasedDeduplication",
    "KmsMasterKeyId",
    "KmsDataKeyReusePeriodSeconds",
)


def attribute_name_error(name: str | Column) -> Column:
    """Why a message attribute name is not allowed, or null: ``empty``,
    ``illegal_character``, ``dots`` (leading, trailing or doubled; ``.*`` may
    lead) or ``too_long``."""
    name = F.col(name) if isinstance(name, str) else name
    return (
        F.when(name.isNull() | (name == ""), "empty")
        .when(~name.rlike(r"^[0-9a-zA-Z_\-.*]+$"), "illegal_character")
        .when(name.rlike(r"^\.[^*]|\.\.|\.$"), "dots")
        .when(F.length(name) > MAX_NAME_LENGTH, "too_long")
    )


def is_queue_attribute(name: str | Column) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    return name.isin(*QUEUE_ATTRIBUTES)


def visibility_error(action: Column, seconds: Column) -> Column:
    """Why a visibility change is not allowed, or null."""
    changes = action == "change_visibility"
    return F.when(changes & seconds.isNull(), "visibility_missing").when(
        changes & ((seconds < 0) | (seconds > MAX_VISIBILITY_SECONDS)), "visibility_out_of_range"
    )


def check_receive(max_messages: int, wait_seconds: int = 0, buffer: int | None = None) -> None:
    """Limits of a receive request."""
    if not 1 <= max_messages <= MAX_RECEIVE:
        raise ValueError(f"max_messages must be 1..{MAX_RECEIVE}")
    if not 0 <= wait_seconds <= MAX_WAIT_SECONDS:
        raise ValueError(f"wait_seconds must be 0..{MAX_WAIT_SECONDS}")
    if buffer is not None and buffer < max_messages:
        raise ValueError("a batch must fit into the buffer")


def check_fetch(limit: int) -> None:
    """Limit of records per fetch from a log."""
    if not 1 <= limit <= MAX_FETCH:
        raise ValueError(f"limit must be 1..{MAX_FETCH}")


def backoff_ms(attempt: Column | int, kind: str = "exponential", first_ms: int = 500):
    """Delay after failed attempt number ``attempt`` (from 1), in milliseconds.
    ``ladder`` takes the fixed connect delays, and the last one from then on."""
    is_column = isinstance(attempt, Column)
    if kind == "exponential":
        if is_column:
            return (first_ms * F.pow(F.lit(2), attempt - 1)).cast("bigint")
        return first_ms * 2 ** (attempt - 1)
    if kind == "linear":
        return attempt * first_ms
    if kind == "ladder":
        steps = len(CONNECT_DELAYS)
        if is_column:
            ladder = F.array(*[F.lit(d).cast("bigint") for d in CONNECT_DELAYS])
            return F.element_at(ladder, F.least(attempt, F.lit(steps)).cast("int"))
        return CONNECT_DELAYS[min(attempt, steps) - 1]
    raise ValueError(f"unknown backoff {kind!r}")

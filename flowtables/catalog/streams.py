"""Streaming forms, run over all input there is and then stopped."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.catalog.base import log, query, table
from flowtables.functions.times import micros
from flowtables.plans.sizes import scratch_path
from flowtables.sources.log import newest_checkpoints, partition_counts
from flowtables.sources.partitioned_log import append_log, close_partitions, tail_partitions
from flowtables.streaming.keyed import (
    bounded_buffer_stream,
    grouped_within_stream,
    presence_stream,
    redeliver_stream,
)
from flowtables.streaming.rpc import correlate_rpc_stream
from flowtables.streaming.runs import run_available, run_until_closed, stream_with_checkpoints, tail_log


def _events(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # A pattern, because a stream takes a plain path for a folder.
    return tail_log(spark, f"{sf_dir}/event*.parquet", schema)


@query("SELECT CAST(user_id % 4 AS INTEGER) AS shard, count(*) AS events FROM events GROUP BY 1")
def stream_partition_counts(spark, sf_dir):
    """A log in four partitions, written in two appends, read to its end with an offset for each."""
    path = scratch_path(spark, "log")
    records = log(spark, sf_dir).select("shard", "seq", "body")
    for half in (0, 1):
        append_log(records.where(F.col("seq") % 2 == half), path, "shard", "seq")
    close_partitions(path, ["0", "1", "2", "3"])
    stream = tail_partitions(spark, path, records.schema, records_per_trigger=1_000_000)
    return run_until_closed(partition_counts(stream, "shard"), "counts", "complete")


@query("SELECT CAST(user_id % 4 AS INTEGER) AS shard, count(*) AS events FROM events GROUP BY 1")
def stream_file_counts(spark, sf_dir):
    """The same from a folder of files, read as a stream."""
    shards = _events(spark, sf_dir).select((F.col("user_id") % 4).cast("int").alias("shard"))
    return run_available(partition_counts(shards, "shard"), "counts", "complete")


@query(
    """SELECT 'events' AS stream, 'readers' AS consumer_group, user_id AS partition_id,
      max(event_id) AS "offset", max(event_id) AS sequence_number FROM events GROUP BY user_id"""
)
def stream_checkpoints(spark, sf_dir):
    """The checkpoint table after a stream has read the log; records are written
    once per micro-batch."""
    path = scratch_path(spark, "checkpoints")
    log = _events(spark, sf_dir).selectExpr(
        "user_id AS partition_id", "event_id AS offset", "event_id AS seq", "props AS body"
    )

    def handle(batch, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/records/batch={batch_id}")

    writer = stream_with_checkpoints(log, handle, path, stream="events", group="readers")
    writer.trigger(availableNow=True).start().awaitTermination()
    return newest_checkpoints(spark.read.parquet(f"{path}/checkpoints").drop("batch"))


@query(
    """WITH RECURSIVE o AS (
      SELECT event_id, user_id, ts, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
    g AS (
      SELECT event_id, user_id, rn, ts, 1 AS group_no, 1 AS cnt, t AS t0 FROM o WHERE rn = 1
      UNION ALL
      SELECT o.event_id, o.user_id, o.rn, o.ts,
        CASE WHEN g.cnt < 5 AND o.t < g.t0 + 43200000000 THEN g.group_no ELSE g.group_no + 1 END,
        CASE WHEN g.cnt < 5 AND o.t < g.t0 + 43200000000 THEN g.cnt + 1 ELSE 1 END,
        CASE WHEN g.cnt < 5 AND o.t < g.t0 + 43200000000 THEN g.t0 ELSE o.t END
      FROM g JOIN o ON o.user_id = g.user_id AND o.rn = g.rn + 1)
    SELECT * EXCLUDE (last_no) FROM (SELECT user_id, CAST(group_no AS BIGINT) AS group_no, max(group_no) OVER (PARTITION BY user_id) AS last_no, min(ts) AS first_at, max(ts) AS last_at,
      CAST(count(*) AS INTEGER) AS "rows", string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS items
    FROM g GROUP BY user_id, group_no) WHERE "rows" = 5 OR group_no < last_no"""
)
def stream_grouped_by_key(spark, sf_dir):
    """Groups by the time of each user, a few files at a time: all but the last, open ones."""
    groups = grouped_within_stream(_events(spark, sf_dir), 5, 12 * 3600, "user_id", "event_id", "ts")
    out = run_available(groups, "own_groups", keyed=True).drop("late")
    return out.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@query(
    """WITH RECURSIVE o AS (
      SELECT event_id, user_id, ts, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
    g AS (
      SELECT event_id, user_id, rn, ts, 1 AS group_no, 1 AS cnt, t AS t0 FROM o WHERE rn = 1
      UNION ALL
      SELECT o.event_id, o.user_id, o.rn, o.ts,
        CASE WHEN g.cnt < 5 AND o.t < g.t0 + 43200000000 THEN g.group_no ELSE g.group_no + 1 END,
        CASE WHEN g.cnt < 5 AND o.t < g.t0 + 43200000000 THEN g.cnt + 1 ELSE 1 END,
        CASE WHEN g.cnt < 5 AND o.t < g.t0 + 43200000000 THEN g.t0 ELSE o.t END
      FROM g JOIN o ON o.user_id = g.user_id AND o.rn = g.rn + 1)
    SELECT user_id, CAST(group_no AS BIGINT) AS group_no, min(ts) AS first_at, max(ts) AS last_at,
      CAST(count(*) AS INTEGER) AS "rows", string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS items
    FROM g GROUP BY user_id, group_no
    HAVING count(*) = 5 OR epoch_ms(min(ts) + INTERVAL 12 HOUR + INTERVAL 999 MICROSECOND) <= (SELECT epoch_ms(max(ts)) FROM events)"""
)
def stream_grouped_within(spark, sf_dir):
    """Groups that are closed once the last event has been read."""
    groups = grouped_within_stream(_events(spark, sf_dir), 5, 12 * 3600, "user_id", "event_id", "ts", "0 seconds")
    out = run_available(groups, "groups", keyed=True).drop("late")
    return out.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@query(
    """SELECT user_id, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS started_at,
      count(*) FILTER (event_type NOT IN ('click', 'view')) AS arrived, count(*) FILTER (event_type IN ('click', 'view')) AS taken,
      greatest(count(*) FILTER (event_type NOT IN ('click', 'view')) - count(*) FILTER (event_type IN ('click', 'view')) - 1, 0) AS over
    FROM events GROUP BY ALL"""
)
def stream_backlog(spark, sf_dir):
    """How many rows arrive for each user in six hours, how many reads take one, and by how many that
    exceeds a buffer of one."""
    reads = F.col("event_type").isin("click", "view")
    taken, arrived = F.count_if(reads), F.count_if(~reads)
    use = _events(spark, sf_dir).groupBy("user_id", F.window("ts", "6 hours")["start"].alias("started_at")).agg(
        arrived.alias("arrived"), taken.alias("taken"), F.greatest(arrived - taken - 1, F.lit(0)).alias("over")
    )
    return run_available(use, "backlog", "complete")


@query(
    """WITH RECURSIVE o AS (
      SELECT event_id, user_id, event_type IN ('click', 'view') AS poll,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
    g AS (
      SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS buf, CAST(0 AS BIGINT) AS demand,
        CAST(NULL AS BIGINT) AS item, '' AS outcome, CAST(NULL AS BIGINT) AS cause FROM o WHERE rn = 1
      UNION ALL
      SELECT o.user_id, o.rn,
        CASE WHEN poll OR len(buf) = 3 THEN list_concat(buf[2:], CASE WHEN poll THEN CAST([] AS BIGINT[]) ELSE [o.event_id] END)
          WHEN demand > 0 THEN buf ELSE list_append(buf, o.event_id) END,
        CASE WHEN poll AND len(buf) = 0 THEN demand + 1 WHEN NOT poll AND demand > 0 THEN demand - 1 ELSE demand END,
        CASE WHEN poll OR len(buf) = 3 THEN buf[1] WHEN demand > 0 THEN o.event_id END,
        CASE WHEN poll OR demand > 0 THEN 'delivered' ELSE 'dropped' END,
        o.event_id
      FROM g JOIN o ON o.user_id = g.user_id AND o.rn = g.rn + 1)
    SELECT user_id, item, outcome, cause FROM g WHERE item IS NOT NULL"""
)
def stream_bounded_buffer(spark, sf_dir):
    """Clicks and views read what the other events put into each user's buffer."""
    log = _events(spark, sf_dir).withColumn("poll", F.col("event_type").isin("click", "view"))
    buffer = bounded_buffer_stream(log, 3, "drop_head", "user_id", "event_id", "poll")
    return run_available(buffer, "buffer", keyed=True)


@query(
    """WITH e AS (SELECT user_id || '/' || (event_id // 1500) AS message, ts, event_type = 'purchase' AS settles FROM events),
    m AS (SELECT message, min(ts) FILTER (NOT settles) AS delivered_at, max(ts) FILTER (settles) AS settled_at, max(ts) AS seen_at FROM e GROUP BY message)
    SELECT message, delivered_at, CAST(floor(date_diff('microsecond', delivered_at, seen_at) / 36000000000) AS BIGINT) AS overdue
    FROM m WHERE delivered_at IS NOT NULL AND (settled_at IS NULL OR settled_at < delivered_at)"""
)
def stream_unsettled(spark, sf_dir):
    """A message per user and 1500 events: those that no purchase of the user has settled, and how
    often ten hours have passed since."""
    log = _events(spark, sf_dir).select(
        F.concat_ws("/", "user_id", F.floor(F.col("event_id") / 1500).cast("string")).alias("message"),
        "ts",
        (F.col("event_type") == "purchase").alias("settles"),
    )
    state = log.groupBy("message").agg(
        F.min(F.when(~F.col("settles"), F.col("ts"))).alias("delivered_at"),
        F.max(F.when(F.col("settles"), F.col("ts"))).alias("settled_at"),
        F.max("ts").alias("seen_at"),
    )
    unsettled = F.col("delivered_at").isNotNull() & (F.col("settled_at").isNull() | (F.col("settled_at") < F.col("delivered_at")))
    waited = F.floor((micros("seen_at") - micros("delivered_at")) / 36_000_000_000).cast("bigint")
    return run_available(state, "unsettled", "complete").where(unsettled).select("message", "delivered_at", waited.alias("overdue"))


@query(
    """WITH e AS (SELECT user_id || '/' || (event_id // 1500) AS message, epoch_us(ts) // 1000 AS t, event_type = 'purchase' AS settles FROM events),
    m AS (SELECT message, min(t) AS t0 FROM e WHERE NOT settles GROUP BY message),
    s AS (SELECT m.message, m.t0, min(e.t) AS t1 FROM m LEFT JOIN e ON e.message = m.message AND settles AND e.t >= m.t0 GROUP BY ALL),
    r AS (SELECT *, unnest(range(1, 6)) AS receive_count, (SELECT epoch_us(max(ts)) // 1000 FROM events) AS now FROM s)
    SELECT message, CAST(receive_count AS INTEGER) AS receive_count,
      make_timestamp((t0 + (receive_count - 1) * 36000000) * 1000) AS delivered_at
    FROM r WHERE receive_count = 1 OR (t0 + (receive_count - 1) * 36000000 <= now
      AND (t1 IS NULL OR t0 + (receive_count - 1) * 36000000 <= t1))"""
)
def stream_redelivery(spark, sf_dir):
    """A message per user and 1500 events; it is delivered again every ten hours
    until the user's next purchase, five times at most."""
    log = _events(spark, sf_dir).select(
        F.concat_ws("/", "user_id", F.floor(F.col("event_id") / 1500).cast("string")).alias("message"),
        "ts",
        (F.col("event_type") == "purchase").alias("settles"),
    )
    deliveries = redeliver_stream(log, 36_000, "message", "ts", "settles", 5)
    return run_available(deliveries, "redelivery", keyed=True)


@query(
    """WITH e AS (
      SELECT user_id AS connection_id, event_id, ts,
        CASE event_type WHEN 'signup' THEN 'connected' ELSE 'disconnected' END AS kind,
        CASE WHEN event_type = 'error' AND value > 50 THEN 'lost' END AS error
      FROM events WHERE event_type IN ('signup', 'error')),
    n AS (SELECT *, lead(kind) OVER w AS k, lead(ts) OVER w AS t, lead(error) OVER w AS e FROM e
      WINDOW w AS (PARTITION BY connection_id ORDER BY event_id))
    SELECT connection_id, ts AS started_at, t AS ended_at,
      CASE WHEN k = 'connected' THEN 'replaced' WHEN e IS NULL THEN 'stopped' ELSE 'failed' END AS outcome
    FROM n WHERE kind = 'connected' AND k IS NOT NULL"""
)
def stream_presence(spark, sf_dir):
    events = _events(spark, sf_dir).selectExpr(
        "user_id AS connection_id",
        "event_id",
        "ts",
        "case event_type when 'signup' then 'connected' when 'error' then 'disconnected' end AS event_type",
        "case when event_type = 'error' and value > 50 then 'lost' end AS error",
    )
    return run_available(presence_stream(events, order="event_id"), "presence", keyed=True)


@query(
    """WITH q AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    r AS (SELECT event_id AS reply_id, user_id, ts FROM events WHERE event_type = 'signup')
    SELECT q.event_id, q.user_id AS correlation_id, r.reply_id
    FROM q LEFT JOIN r ON r.user_id = q.user_id AND r.ts >= q.ts AND r.ts <= q.ts + INTERVAL 12 HOUR
    WHERE r.reply_id IS NOT NULL OR q.ts + INTERVAL 12 HOUR < (
      SELECT least(max(ts) FILTER (event_type = 'purchase'), max(ts) FILTER (event_type = 'signup')) FROM events)"""
)
def stream_rpc(spark, sf_dir):
    """Purchases as requests, the user's signups in the next 12 hours as replies;
    a request that can still be answered is not out yet."""
    log = _events(spark, sf_dir).withColumn("at", F.col("ts").cast("timestamp"))
    requests = log.where("event_type = 'purchase'").selectExpr(
        "event_id", "user_id AS correlation_id", "at AS requested_at"
    )
    replies = log.where("event_type = 'signup'").selectExpr(
        "event_id AS reply_id", "user_id AS correlation_id", "at AS replied_at"
    )
    pairs = correlate_rpc_stream(requests, replies, "12 hours")
    return run_available(pairs, "rpc").select("event_id", "correlation_id", "reply_id")

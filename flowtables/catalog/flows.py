"""Batches, packing, shaping, rotation, sessions and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.catalog.base import LOG, log, query, refusing, table
from flowtables.operators.batching import (
    batch_by_count,
    collect_batches,
    grouped_within,
    pack_first_fit,
    pack_greedy,
)
from flowtables.operators.presence import connection_sessions
from flowtables.operators.publish import PublishSettings, attempt_results, batch_status, publish, publish_metrics
from flowtables.operators.rotation import rotate, rotate_by_automaton, rotate_by_size, rotate_by_time
from flowtables.operators.shaping import in_flight, rate_use, retain, take_while, throttle
from flowtables.plans.automata import Automaton

_NUMBERED = f"""{LOG}, n AS (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY seq) - 1 AS pos,
    count(*) OVER (PARTITION BY shard) AS total FROM log)"""


@query(
    f"""WITH {_NUMBERED}
    SELECT shard, seq, pos // 500 AS batch_no, CAST(pos % 500 AS INTEGER) AS idx FROM n"""
)
def batch_count(spark, sf_dir):
    return batch_by_count(log(spark, sf_dir).select("shard", "seq"), 500, "shard", "seq")


@query(
    f"""WITH {_NUMBERED}
    SELECT shard, pos // 500 AS batch_no, string_agg(CAST(seq AS VARCHAR), ',' ORDER BY seq) AS items
    FROM n GROUP BY ALL"""
)
def batch_collect(spark, sf_dir):
    numbered = batch_by_count(log(spark, sf_dir).select("shard", "seq"), 500, "shard", "seq")
    batches = collect_batches(numbered, ["shard", "batch_no"], "idx", ["seq"])
    return batches.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@query(
    """WITH t AS (
      SELECT event_id, user_id, epoch_us(ts) AS t, min(epoch_us(ts)) OVER (PARTITION BY user_id) AS t0 FROM events),
    k AS (SELECT event_id, user_id, (t - t0) // 21600000000 AS tick FROM t)
    SELECT event_id, user_id, tick,
      (row_number() OVER (PARTITION BY user_id, tick ORDER BY event_id) - 1) // 3 + 1 AS group_no
    FROM k"""
)
def grouped_within_tick(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    grouped = grouped_within(events, 3, 6 * 3600, "user_id", "event_id", "ts", mode="tick")
    return grouped.drop("ts")


@query(
    """WITH RECURSIVE o AS (
      SELECT event_id, user_id, epoch_us(ts) AS t,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
    g AS (
      SELECT event_id, user_id, rn, 1 AS group_no, 1 AS cnt, t AS t0 FROM o WHERE rn = 1
      UNION ALL
      SELECT o.event_id, o.user_id, o.rn,
        CASE WHEN g.cnt < 5 AND o.t < g.t0 + 43200000000 THEN g.group_no ELSE g.group_no + 1 END,
        CASE WHEN g.cnt < 5 AND o.t < g.t0 + 43200000000 THEN g.cnt + 1 ELSE 1 END,
        CASE WHEN g.cnt < 5 AND o.t < g.t0 + 43200000000 THEN g.t0 ELSE o.t END
      FROM g JOIN o ON o.user_id = g.user_id AND o.rn = g.rn + 1)
    SELECT event_id, user_id, CAST(group_no AS BIGINT) AS group_no FROM g"""
)
def grouped_within_open(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return grouped_within(events, 5, 12 * 3600, "user_id", "event_id", "ts").drop("ts")


def _packed(limit: int, name: str) -> str:
    return f"""WITH RECURSIVE o AS (
      SELECT doc_id, source, strlen(text) AS len,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents),
    g AS (
      SELECT doc_id, source, rn, len, 1 AS no, len AS size FROM o WHERE rn = 1
      UNION ALL
      SELECT o.doc_id, o.source, o.rn, o.len,
        CASE WHEN g.size + o.len > {limit} THEN g.no + 1 ELSE g.no END,
        CASE WHEN g.size + o.len > {limit} THEN o.len ELSE g.size + o.len END
      FROM g JOIN o ON o.source = g.source AND o.rn = g.rn + 1)
    SELECT doc_id, source, CAST(len AS BIGINT) AS len, CAST(no AS BIGINT) AS {name} FROM g"""


def _document_sizes(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", "source", F.octet_length("text").cast("bigint").alias("len"))


@query(_packed(20_000, "batch_no"), name="pack_greedy")
def pack_greedy_query(spark, sf_dir):
    return pack_greedy(_document_sizes(spark, sf_dir), 20_000, "len", "source", "doc_id")


@query(_packed(20_000, "batch_no"))
def pack_greedy_chunked(spark, sf_dir):
    """The same, with every source cut into chunks as a hot key is."""
    return pack_greedy(_document_sizes(spark, sf_dir), 20_000, "len", "source", "doc_id", rows_per_chunk=64)


@query(_packed(100_000, "file_no"))
def rotate_size_chunked(spark, sf_dir):
    """Files of some ten chunks of rows each."""
    return rotate_by_size(_document_sizes(spark, sf_dir), 100_000, "len", "source", "doc_id", rows_per_chunk=8)


@query(_packed(100_000, "file_no"))
def rotate_size(spark, sf_dir):
    return rotate_by_size(_document_sizes(spark, sf_dir), 100_000, "len", "source", "doc_id")


@query(
    """WITH RECURSIVE o AS (
      SELECT event_id, user_id, (rn - 1) // 20 AS list_no, (rn - 1) % 20 AS pos, size FROM (
        SELECT event_id, user_id, CAST(floor(value * 10) AS BIGINT) AS size,
          row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)),
    g AS (
      SELECT event_id, user_id, list_no, pos, size,
        CASE WHEN size > 1500 THEN CAST([] AS BIGINT[]) ELSE [size] END AS loads,
        CASE WHEN size > 1500 THEN NULL ELSE 1 END AS batch_no
      FROM o WHERE pos = 0
      UNION ALL
      SELECT s.event_id, s.user_id, s.list_no, s.pos, s.size,
        CASE WHEN s.size > 1500 THEN s.loads
          WHEN s.at > len(s.loads) THEN list_append(s.loads, s.size)
          ELSE list_transform(s.loads, lambda x, i: CASE WHEN i = s.at THEN x + s.size ELSE x END) END,
        CASE WHEN s.size > 1500 THEN NULL ELSE s.at END
      FROM (
        SELECT o.*, g.loads,
          CAST(coalesce(nullif(list_position(list_transform(g.loads, lambda x: x + o.size <= 1500), true), 0),
            len(g.loads) + 1) AS INTEGER) AS at
        FROM g JOIN o ON o.user_id = g.user_id AND o.list_no = g.list_no AND o.pos = g.pos + 1) s)
    SELECT event_id, user_id, list_no, CAST(batch_no AS INTEGER) AS batch_no FROM g""",
    name="pack_first_fit",
)
def pack_first_fit_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    size = F.floor(F.col("value") * 10).cast("bigint")
    return pack_first_fit(events, 1500, size, "user_id", "event_id", list_size=20).drop("value")


def _rate(cost: str, limit: int, hours: int) -> str:
    return f"""WITH {LOG}, u AS (
      SELECT shard, time_bucket(INTERVAL {hours} HOUR, ts, TIMESTAMP '1970-01-01') AS started_at, count(*) AS "rows", CAST(sum({cost}) AS BIGINT) AS used
      FROM log GROUP BY ALL)
    SELECT *, used / {limit}.0::DOUBLE AS share, greatest(used - {limit}, 0) AS over FROM u"""


@query(_rate("1", 5, 2))
def rate_use_records(spark, sf_dir):
    """Records of each shard and two hours against a limit of 5."""
    return rate_use(log(spark, sf_dir).select("shard", "ts"), 5, "2 hours", "shard", "ts")


@query(_rate("strlen(body) + strlen(CAST(user_id AS VARCHAR))", 45, 2))
def rate_use_bytes(spark, sf_dir):
    """Bytes of each shard and two hours against a limit of 45."""
    cost = F.octet_length("body") + F.octet_length(F.col("user_id").cast("string"))
    return rate_use(log(spark, sf_dir), 45, "2 hours", "shard", "ts", cost)


def _throttled(cost: str, rate: float, burst: float) -> str:
    return f"""WITH {LOG}, c AS (SELECT shard, seq, epoch_us(ts) AS t, {cost} AS cost FROM log),
    s AS (SELECT *, CAST(sum(cost) OVER w AS DOUBLE) AS s, max(t) OVER w AS arrived FROM c
      WINDOW w AS (PARTITION BY shard ORDER BY seq ROWS UNBOUNDED PRECEDING)),
    m AS (SELECT *, max(t - (s - cost) * (1000000.0::DOUBLE / {rate}::DOUBLE)) OVER (
        PARTITION BY shard ORDER BY seq ROWS UNBOUNDED PRECEDING) AS credit FROM s)
    SELECT shard, seq,
      CAST(round(greatest(CAST(arrived AS DOUBLE),
        credit + (s - {burst}::DOUBLE) * (1000000.0::DOUBLE / {rate}::DOUBLE))) AS BIGINT) AS emit_us FROM m"""


@query(_throttled("1", 0.001, 5))
def throttle_records(spark, sf_dir):
    """When each record leaves a shaper of 0.001 records a second for its shard."""
    records = log(spark, sf_dir).select("shard", "seq", "ts")
    return throttle(records, 0.001, 5, "shard", "seq", "ts").drop("ts")


@query(_throttled("strlen(body) + strlen(CAST(user_id AS VARCHAR))", 0.0125, 64))
def throttle_bytes(spark, sf_dir):
    """When each record leaves a shaper of 0.0125 bytes a second for its shard."""
    records = log(spark, sf_dir)
    cost = F.octet_length("body") + F.octet_length(F.col("user_id").cast("string"))
    shaped = throttle(records, 0.0125, 64, "shard", "seq", "ts", cost)
    return shaped.select("shard", "seq", "emit_us")


_CAPACITY = 300


def _buffer(strategy: str, which: str, kept: str) -> None:
    sql = f"WITH {_NUMBERED}, e AS (SELECT shard, seq, pos AS e, total AS n FROM n) SELECT shard, seq FROM e WHERE {kept}"

    @query(sql, name=f"buffer_{strategy}")
    def run(spark, sf_dir):
        records = log(spark, sf_dir).select("shard", "seq")
        return retain(records, _CAPACITY, which, "shard", "seq")


_buffer("drop_head", "last", f"n - e <= {_CAPACITY}")
_buffer("drop_tail", "first_and_last", f"n <= {_CAPACITY} OR e < {_CAPACITY} - 1 OR e = n - 1")
_buffer("drop_new", "first", f"e < {_CAPACITY}")
_buffer("drop_buffer", "last_batch", f"e >= ((n - 1) // {_CAPACITY}) * {_CAPACITY}")


@query(
    """WITH d AS (
      SELECT event_id, user_id,
        CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 1 WHEN event_type = 'error' THEN -1 ELSE 0 END AS d
      FROM events),
    s AS (SELECT event_id, user_id, CAST(sum(d) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS in_flight FROM d)
    SELECT *, in_flight > 10 AS over_prefetch FROM s""",
    name="in_flight",
)
def in_flight_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    change = F.expr("case when event_type in ('click', 'view', 'purchase') then 1 when event_type = 'error' then -1 else 0 end")
    return in_flight(events, change, 10, "user_id", "event_id").drop("event_type")


@query(
    """SELECT event_id, user_id FROM (
      SELECT event_id, user_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY event_id) AS f FROM events) WHERE f = 0""",
    name="take_while",
)
def take_while_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return take_while(events, F.col("event_type") != "error", "user_id", "event_id").drop("event_type")


@query(
    """WITH f AS (
      SELECT event_id, user_id, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY event_id) AS file_no FROM events)
    SELECT event_id, user_id, CAST(file_no AS BIGINT) AS file_no,
      row_number() OVER (PARTITION BY user_id, file_no ORDER BY event_id) AS row_no
    FROM f WHERE file_no > 0"""
)
def rotate_trigger(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return rotate(events, F.col("event_type") == "signup", "user_id", "event_id").drop("event_type")


# A signup opens a file if there was an error since the last file.
_AFTER_ERRORS = Automaton("clean", {("clean", "error"): ("dirty", False), ("dirty", "signup"): ("clean", True)})


@query(
    """WITH marks AS (
      SELECT event_id, user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before
      FROM events WHERE event_type IN ('error', 'signup')),
    o AS (
      SELECT event_id, user_id, CASE WHEN event_type = 'signup' AND before = 'error' THEN 1 ELSE 0 END AS fires FROM marks
      UNION ALL SELECT event_id, user_id, 0 FROM events WHERE event_type NOT IN ('error', 'signup')),
    f AS (SELECT event_id, user_id, CAST(sum(fires) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS file_no FROM o)
    SELECT *, row_number() OVER (PARTITION BY user_id, file_no ORDER BY event_id) AS row_no FROM f WHERE file_no > 0"""
)
def rotate_automaton(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    files = rotate_by_automaton(events, _AFTER_ERRORS, F.col("event_type"), "user_id", "event_id")
    return files.drop("event_type")


@query(
    f"""WITH {LOG}, h AS (SELECT shard, seq, 'stream-' || strftime(ts, '%Y-%m-%d_%H') || '.log' AS file_name FROM log),
    b AS (SELECT *, CASE WHEN lag(file_name) OVER (PARTITION BY shard ORDER BY seq) = file_name THEN 0 ELSE 1 END AS o FROM h),
    f AS (SELECT shard, seq, file_name, CAST(sum(o) OVER (PARTITION BY shard ORDER BY seq) AS BIGINT) AS file_no FROM b)
    SELECT *, row_number() OVER (PARTITION BY shard, file_no ORDER BY seq) AS row_no FROM f"""
)
def rotate_time(spark, sf_dir):
    return rotate_by_time(log(spark, sf_dir).select("shard", "seq", "ts"), "shard", "seq", "ts").drop("ts")


@query(
    """WITH e AS (
      SELECT user_id AS connection_id, event_id, ts,
        CASE event_type WHEN 'signup' THEN 'connected' ELSE 'disconnected' END AS kind,
        CASE WHEN event_type = 'error' AND value > 50 THEN 'lost' END AS error
      FROM events WHERE event_type IN ('signup', 'error')),
    n AS (SELECT *, lead(kind) OVER w AS k, lead(ts) OVER w AS t, lead(error) OVER w AS e FROM e
      WINDOW w AS (PARTITION BY connection_id ORDER BY event_id))
    SELECT connection_id, event_id, ts AS started_at, t AS ended_at,
      CASE WHEN k IS NULL THEN 'open' WHEN k = 'connected' THEN 'replaced' WHEN e IS NULL THEN 'stopped' ELSE 'failed' END AS outcome,
      (epoch_us(t) - epoch_us(ts)) / 1000000.0::DOUBLE AS seconds
    FROM n WHERE kind = 'connected'"""
)
def sessions(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("connection_id"),
        "event_id",
        "ts",
        F.expr("case event_type when 'signup' then 'connected' when 'error' then 'disconnected' end").alias("event_type"),
        F.expr("case when event_type = 'error' and value > 50 then 'lost' end").alias("error"),
    )
    return connection_sessions(events, order=("event_id",))


# Four events are the attempts to send one record: errors and views failed.
_ATTEMPTS = """attempts AS (
  SELECT event_id // 4 AS record, event_id // 4 % 4 AS shard, event_id,
    CASE event_type WHEN 'error' THEN 'refused' WHEN 'view' THEN 'timeout' END AS error FROM events),
  firsts AS (SELECT record, min(event_id) AS first FROM attempts WHERE error IS NULL GROUP BY record),
  results AS (
    SELECT shard, record, first IS NOT NULL AS ok, CAST(count(*) AS INTEGER) AS attempts, arg_max(error, event_id) FILTER (error IS NOT NULL AND first IS NULL) AS error_code
    FROM attempts LEFT JOIN firsts USING (record) WHERE first IS NULL OR event_id <= first GROUP BY shard, record, first)"""


def _results(spark, sf_dir):
    attempts = table(spark, sf_dir, "events").selectExpr(
        "cast(event_id div 4 as bigint) AS record", "cast(event_id div 4 % 4 as bigint) AS shard", "event_id",
        "case event_type when 'error' then 'refused' when 'view' then 'timeout' end AS error",
    )
    return attempt_results(attempts, ("shard", "record"), "event_id", "error")


@query(
    f"""WITH {_ATTEMPTS}
    SELECT shard, record, ok, attempts, CASE WHEN NOT ok THEN error_code END AS error_code,
      CAST(500 * (pow(2, attempts - 1) - 1) AS BIGINT) AS waited_ms FROM results"""
)
def publish_log(spark, sf_dir):
    """Results of records from a log of the attempts to send them."""
    return _results(spark, sf_dir)


# A record whose fault count is f is sent at attempt f + 1, if that is at most 6.
@query(
    f"""WITH {_NUMBERED}, p AS (
      SELECT shard, seq, pos // 100 AS batch_no, CAST(pos % 100 AS INTEGER) AS idx, seq % 8 AS f FROM n)
    SELECT shard, seq, batch_no, idx, f <= 5 AS ok, CAST(least(f + 1, 6) AS INTEGER) AS attempts,
      CASE WHEN f > 5 THEN 'throttled' END AS error_code,
      CAST(500 * (pow(2, least(f, 5)) - 1) AS BIGINT) AS waited_ms FROM p"""
)
def publish_results(spark, sf_dir):
    """All records of the log sent in batches, with retries, and what became of each."""
    records = log(spark, sf_dir).select("shard", "seq", (F.col("seq") % 8).cast("int").alias("faults"))
    settings = PublishSettings(batch_size=100, max_retries=5, wait=False)
    return publish(records, refusing("faults"), "shard", "seq", settings, ["faults"]).drop("faults")


@query(
    f"""WITH {_ATTEMPTS}
    SELECT shard, count(*) AS records, count(*) FILTER (ok) AS sent, count(*) FILTER (NOT ok) AS failed,
      count(*) FILTER (attempts > 1) AS retried, CAST(sum(attempts) AS BIGINT) AS attempts,
      coalesce(string_agg(DISTINCT CASE WHEN NOT ok THEN error_code END, ',' ORDER BY CASE WHEN NOT ok THEN error_code END), '') AS error_codes
    FROM results GROUP BY shard""",
    name="publish_metrics",
)
def publish_metrics_query(spark, sf_dir):
    metrics = publish_metrics(_results(spark, sf_dir), "shard")
    return metrics.withColumn("error_codes", F.array_join("error_codes", ","))


@query(
    f"""WITH {_ATTEMPTS}
    SELECT shard, record // 40 AS batch_no, bool_and(ok) AS ok, count(*) AS records, count(*) FILTER (NOT ok) AS failed
    FROM results GROUP BY shard, record // 40"""
)
def publish_atomic(spark, sf_dir):
    """Batches of ten records, which are sent as a whole or not at all."""
    return batch_status(_results(spark, sf_dir).withColumn("batch_no", F.expr("record div 40")), "shard")

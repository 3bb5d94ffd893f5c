"""Routing, fan-out, queues, settlement and request/reply."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.catalog.base import query, refusing, table
from flowtables.operators.batching import batch_by_count
from flowtables.operators.fanout import address, inbox_sizes, recipients_per_command
from flowtables.operators.publish import PublishSettings, publish
from flowtables.operators.queues import (
    action_results,
    after_receive,
    apply_actions,
    queue_receive,
    validate_actions,
    validate_attribute_names,
)
from flowtables.operators.routing import route, route_lists, route_replies
from flowtables.operators.rpc import correlate_batch, correlate_rpc
from flowtables.operators.settlement import redelivered, settle
from flowtables.operators.shaping import in_flight
from flowtables.plans.ordered import arrange, run_sum
from flowtables.plans.sizes import scratch_path, written
from flowtables.sources.queue_table import QueueTable

# --- routing -----------------------------------------------------------------


def _messages(spark, sf_dir):
    """``events`` as messages to four exchanges and the default one."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("message_id"),
        F.expr("element_at(array('d', 'f', 't', 'h', ''), cast(event_id % 5 + 1 as int))").alias("exchange"),
        F.expr(
            "case event_id % 5 when 4 then concat('q_', event_type) else concat(event_type, '.u', user_id % 10) end"
        ).alias("routing_key"),
        F.expr("map('kind', event_type, 'size', if(value > 50, 'large', 'small'))").alias("headers"),
        "user_id",
    )


def _topology(spark):
    exchanges = spark.sql(
        "SELECT * FROM VALUES ('d', 'direct'), ('f', 'fanout'), ('t', 'topic'), ('h', 'headers') AS t(exchange, type)"
    )
    bindings = spark.sql(
        """SELECT queue, exchange, routing_key, from_json(args, 'map<string,string>') AS args FROM VALUES
        ('q_click', 'd', 'click.u1', '{}'), ('q_some', 'd', 'click.u1', '{}'), ('q_some', 'd', 'view.u2', '{}'),
        ('q_all1', 'f', '', '{}'), ('q_all2', 'f', '', '{}'),
        ('q_err', 't', 'error.*', '{}'), ('q_any', 't', '#', '{}'), ('q_u3', 't', '*.u3', '{}'),
        ('q_u3', 't', 'view.#', '{}'), ('q_deep', 't', '#.u5', '{}'), ('q_none', 't', '*.*.*', '{}'),
        ('q_pv', 'h', '', '{"kind":"purchase"}'),
        ('q_big', 'h', '', '{"kind":"view","size":"large","x-match":"all"}'),
        ('q_either', 'h', '', '{"kind":"error","size":"large","x-match":"any"}')
        AS t(queue, exchange, routing_key, args)"""
    )
    queues = spark.sql("SELECT * FROM VALUES ('q_click'), ('q_view'), ('q_err'), ('q_purchase') AS t(queue)")
    return exchanges, bindings, queues


def _routed(spark, sf_dir):
    messages = _messages(spark, sf_dir)
    return messages, route(messages, *_topology(spark))


_MESSAGES = """m AS (
  SELECT event_id AS message_id, event_type, user_id, ['d', 'f', 't', 'h', ''][event_id % 5 + 1] AS exchange,
    CASE event_id % 5 WHEN 4 THEN 'q_' || event_type ELSE event_type || '.u' || (user_id % 10) END AS routing_key,
    CASE WHEN value > 50 THEN 'large' ELSE 'small' END AS size
  FROM events)"""
_DIRECT = """direct AS (
  SELECT message_id, user_id, exchange, b.queue FROM m
  JOIN (VALUES ('q_click', 'click.u1'), ('q_some', 'click.u1'), ('q_some', 'view.u2')) AS b(queue, rk)
    ON exchange = 'd' AND routing_key = b.rk
  UNION ALL SELECT message_id, user_id, exchange, routing_key FROM m
  WHERE exchange = '' AND routing_key IN ('q_click', 'q_view', 'q_err', 'q_purchase'))"""
_FANOUT = """fanout AS (
  SELECT message_id, user_id, exchange, b.queue FROM m
  JOIN (VALUES ('q_all1'), ('q_all2')) AS b(queue) ON exchange = 'f')"""
_TOPIC = r"""topic AS (
  SELECT DISTINCT message_id, user_id, exchange, b.queue FROM m
  JOIN (VALUES ('q_err', '^error\.[^.]*\.$'), ('q_any', '^([^.]*\.)*$'), ('q_u3', '^[^.]*\.u3\.$'),
    ('q_u3', '^view\.([^.]*\.)*$'), ('q_deep', '^([^.]*\.)*u5\.$'), ('q_none', '^[^.]*\.[^.]*\.[^.]*\.$')) AS b(queue, re)
    ON exchange = 't' AND regexp_matches(routing_key || '.', b.re))"""
_HEADERS = """headers AS (
  SELECT DISTINCT message_id, user_id, exchange, b.queue FROM m
  JOIN (VALUES ('q_pv'), ('q_big'), ('q_either')) AS b(queue)
    ON exchange = 'h' AND CASE b.queue WHEN 'q_pv' THEN event_type = 'purchase'
      WHEN 'q_big' THEN event_type = 'view' AND size = 'large' ELSE event_type = 'error' OR size = 'large' END)"""
_ROUTED = f"""{_MESSAGES}, {_DIRECT}, {_FANOUT}, {_TOPIC}, {_HEADERS}, routed AS (
  SELECT * FROM direct UNION ALL SELECT * FROM fanout UNION ALL SELECT * FROM topic UNION ALL SELECT * FROM headers)"""


def _route_kind(name: str, exchanges: str):
    @query(
        f"WITH {_ROUTED} SELECT message_id, exchange, queue FROM routed WHERE exchange IN ({exchanges})",
        name=f"route_{name}",
    )
    def run(spark, sf_dir):
        messages = _messages(spark, sf_dir).where(f"exchange in ({exchanges})")
        return route(messages, *_topology(spark)).select("message_id", "exchange", "queue")


_route_kind("direct", "'d', ''")
_route_kind("fanout", "'f'")
_route_kind("topic", "'t'")
_route_kind("headers", "'h'")


@query(f"WITH {_ROUTED} SELECT message_id, exchange, queue FROM routed")
def route_by_shuffle(spark, sf_dir):
    """All exchanges, with the plan for bindings too many to broadcast."""
    messages = _messages(spark, sf_dir)
    return route(messages, *_topology(spark), broadcast_rows=0).select("message_id", "exchange", "queue")


@query(
    f"""WITH {_ROUTED}, n AS (
      SELECT queue, row_number() OVER (PARTITION BY queue ORDER BY message_id) - 1 AS pos FROM routed)
    SELECT queue, count(*) AS messages, count(DISTINCT pos // 100) AS batches FROM n GROUP BY queue"""
)
def route_batches(spark, sf_dir):
    routed = _routed(spark, sf_dir)[1].select("queue", "message_id")
    batches = batch_by_count(routed, 100, "queue", "message_id")
    return batches.groupBy("queue").agg(
        F.count(F.lit(1)).alias("messages"), (F.max("batch_no") + 1).alias("batches")
    )


@query(
    f"""WITH {_ROUTED} SELECT message_id, exchange, routing_key FROM m
    WHERE message_id NOT IN (SELECT message_id FROM routed)""",
    name="unroutable",
)
def unroutable_query(spark, sf_dir):
    """Messages are read once: each has the list of its queues."""
    lists = route_lists(_messages(spark, sf_dir), *_topology(spark))
    return lists.where(F.size("queues") == 0).select("message_id", "exchange", "routing_key")


@query(
    """SELECT conv_id, turn, 'replies_' || role AS target_queue FROM conversations WHERE role <> 'system'"""
)
def reply_route(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") != "system", F.concat(F.lit("replies_"), "role")).alias("reply_to"),
    )
    return route_replies(turns, on_missing="skip").drop("reply_to")


# --- fan-out -----------------------------------------------------------------


def _commands(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS command_id",
        "case when event_type in ('click', 'view') then 'send' when event_type = 'purchase' then 'group' else 'broadcast' end AS kind",
        "case when event_type in ('click', 'view') then cast(user_id as string) end AS connection_id",
        "case when event_type = 'purchase' then concat('NATION_', user_id % 25) end AS grp",
        "array(cast(user_id as string), cast(event_id as string)) AS excluded",
    )


def _connections(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    connections = customers.select(F.col("c_custkey").cast("string").alias("connection_id"))
    members = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("grp"), F.col("c_custkey").cast("string").alias("connection_id")
    )
    return connections, members


_COMMANDS = """c AS (
  SELECT event_id AS command_id,
    CASE WHEN event_type IN ('click', 'view') THEN 'send' WHEN event_type = 'purchase' THEN 'group' ELSE 'broadcast' END AS kind,
    CASE WHEN event_type IN ('click', 'view') THEN CAST(user_id AS VARCHAR) END AS connection_id,
    CASE WHEN event_type = 'purchase' THEN 'NATION_' || (user_id % 25) END AS grp,
    CAST(user_id AS VARCHAR) AS x1, CAST(event_id AS VARCHAR) AS x2
  FROM events),
  conn AS (SELECT CAST(c_custkey AS VARCHAR) AS connection_id, n_name AS grp
    FROM customer JOIN nation ON c_nationkey = n_nationkey),
  reached AS (
    SELECT command_id, conn.connection_id FROM c JOIN conn ON kind = 'send' AND conn.connection_id = c.connection_id
    UNION ALL SELECT command_id, conn.connection_id FROM c JOIN conn
      ON kind = 'group' AND conn.grp = c.grp AND conn.connection_id NOT IN (x1, x2)
    UNION ALL SELECT command_id, conn.connection_id FROM c JOIN conn
      ON kind = 'broadcast' AND conn.connection_id NOT IN (x1, x2))"""


@query(
    f"""WITH {_COMMANDS}
    SELECT command_id, CASE kind WHEN 'send' THEN 'client' WHEN 'group' THEN 'group_except' ELSE 'all_except' END AS target,
      coalesce(connection_id, grp) AS address,
      CASE WHEN kind = 'send' THEN '' WHEN x1 = x2 THEN x1 ELSE least(x1, x2) || ',' || greatest(x1, x2) END AS except_ids
    FROM c"""
)
def fan_out_address(spark, sf_dir):
    addressed = address(_commands(spark, sf_dir))
    return addressed.select("command_id", "target", "address", F.array_join("except_ids", ",").alias("except_ids"))


@query(
    f"""WITH {_COMMANDS} SELECT c.command_id, count(r.connection_id) AS recipients
    FROM c LEFT JOIN reached r ON r.command_id = c.command_id GROUP BY c.command_id"""
)
def fan_out_recipients(spark, sf_dir):
    return recipients_per_command(_commands(spark, sf_dir), *_connections(spark, sf_dir))


@query(
    f"""WITH {_COMMANDS} SELECT conn.connection_id, count(r.command_id) AS received
    FROM conn LEFT JOIN reached r ON r.connection_id = conn.connection_id GROUP BY conn.connection_id"""
)
def fan_out_inboxes(spark, sf_dir):
    return inbox_sizes(_commands(spark, sf_dir), *_connections(spark, sf_dir))


# --- queues ------------------------------------------------------------------



def _now():
    return F.expr("timestamp_ntz'2024-01-15'")


def _queue(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_type AS queue",
        "event_id AS msg_id",
        "ts AS enqueued_at",
        "cast(event_id % 60 as int) AS delay_s",
        "case when event_id % 3 = 0 then 86400 end AS ttl_s",
        "case when event_id % 5 = 0 then ts + interval 20 days end AS visible_at",
        "cast(event_id % 2 as int) AS receive_count",
    )


def _actions(spark, sf_dir):
    """Two actions per event: one on the message itself, one on an older message."""
    events = table(spark, sf_dir, "events")
    kind = "case event_type when 'view' then 'delete' when 'click' then 'change_visibility' else 'ignore' end AS action"
    own = events.selectExpr(
        "event_id AS msg_id", kind, "case when event_type = 'click' then cast(event_id % 600 as int) end AS visibility_s",
        "event_id * 2 AS action_seq",
    )
    older = events.selectExpr(
        "event_id - user_id AS msg_id", kind, "case when event_type = 'click' then cast(event_id * 7 as int) end AS visibility_s",
        "event_id * 2 + 1 AS action_seq",
    )
    return own.unionByName(older)


_QUEUE = """q AS (
  SELECT event_type AS queue, event_id AS msg_id, ts AS enqueued_at, CAST(event_id % 60 AS INTEGER) AS delay_s,
    CASE WHEN event_id % 3 = 0 THEN 86400 END AS ttl_s,
    CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 20 DAY END AS visible_at, CAST(event_id % 2 AS INTEGER) AS receive_count
  FROM events),
  received AS (
    SELECT queue, msg_id, TIMESTAMP '2024-01-15 00:00:30' AS visible_at, receive_count + 1 AS receive_count FROM (
      SELECT *, row_number() OVER (PARTITION BY queue ORDER BY enqueued_at, msg_id) AS n FROM q
      WHERE enqueued_at + to_seconds(delay_s) <= TIMESTAMP '2024-01-15'
        AND coalesce(visible_at, enqueued_at) <= TIMESTAMP '2024-01-15'
        AND (ttl_s IS NULL OR enqueued_at + to_seconds(ttl_s) > TIMESTAMP '2024-01-15'))
    WHERE n <= 10)"""
_ACTIONS = """a AS (
  SELECT event_id AS msg_id, CASE event_type WHEN 'view' THEN 'delete' WHEN 'click' THEN 'change_visibility' ELSE 'ignore' END AS action,
    CASE WHEN event_type = 'click' THEN CAST(event_id % 600 AS INTEGER) END AS visibility_s, event_id * 2 AS action_seq FROM events
  UNION ALL SELECT event_id - user_id, CASE event_type WHEN 'view' THEN 'delete' WHEN 'click' THEN 'change_visibility' ELSE 'ignore' END,
    CASE WHEN event_type = 'click' THEN CAST(event_id * 7 AS INTEGER) END, event_id * 2 + 1 FROM events)"""


@query(f"WITH {_QUEUE} SELECT queue, msg_id, visible_at, receive_count FROM received", name="queue_receive")
def queue_receive_query(spark, sf_dir):
    return queue_receive(_queue(spark, sf_dir), _now(), 10, 30).select(
        "queue", "msg_id", "visible_at", "receive_count"
    )


@query(
    f"""WITH {_QUEUE} SELECT q.queue, q.msg_id, coalesce(r.visible_at, q.visible_at) AS visible_at,
      coalesce(r.receive_count, q.receive_count) AS receive_count
    FROM q LEFT JOIN received r ON r.msg_id = q.msg_id"""
)
def queue_after_receive(spark, sf_dir):
    messages = _queue(spark, sf_dir)
    received = queue_receive(messages, _now(), 10, 30)
    return after_receive(messages, received).select("queue", "msg_id", "visible_at", "receive_count")


@query(
    f"""WITH {_QUEUE}, {_ACTIONS}, v AS (
      SELECT msg_id, arg_max(visibility_s, action_seq) AS s FROM a WHERE action = 'change_visibility' GROUP BY msg_id)
    SELECT q.queue, q.msg_id, coalesce(TIMESTAMP '2024-01-15' + to_seconds(v.s), q.visible_at) AS visible_at
    FROM q LEFT JOIN v ON v.msg_id = q.msg_id
    WHERE q.msg_id NOT IN (SELECT msg_id FROM a WHERE action = 'delete')""",
    name="apply_actions",
)
def apply_actions_query(spark, sf_dir):
    state = apply_actions(_queue(spark, sf_dir), _actions(spark, sf_dir), _now())
    return state.select("queue", "msg_id", "visible_at")


@query(
    f"""WITH {_QUEUE}, {_ACTIONS}, v AS (
      SELECT msg_id, arg_max(visibility_s, action_seq) AS s FROM a WHERE action = 'change_visibility' GROUP BY msg_id)
    SELECT q.queue, q.msg_id, coalesce(TIMESTAMP '2024-01-15' + to_seconds(v.s), r.visible_at, q.visible_at) AS visible_at,
      coalesce(r.receive_count, q.receive_count) AS receive_count
    FROM q LEFT JOIN v ON v.msg_id = q.msg_id LEFT JOIN received r ON r.msg_id = q.msg_id
    WHERE q.msg_id NOT IN (SELECT msg_id FROM a WHERE action = 'delete')"""
)
def queue_versions(spark, sf_dir):
    """A queue's third version: sent, received from, acted on."""
    messages = _queue(spark, sf_dir)
    queue = QueueTable(spark, scratch_path(spark, "queue"), messages.schema)
    queue.send(messages)
    queue.receive(_now(), 10, 30)
    queue.act(_actions(spark, sf_dir), _now())
    return queue.read().select("queue", "msg_id", "visible_at", "receive_count")


@query(
    f"""WITH {_ACTIONS} SELECT a.msg_id, action, visibility_s, action_seq,
      CASE WHEN action = 'change_visibility' AND visibility_s NOT BETWEEN 0 AND 43200 THEN 'visibility_out_of_range'
        WHEN action = 'ignore' THEN 'ignored' WHEN e.event_id IS NULL THEN 'not_found'
        WHEN action = 'delete' THEN 'deleted' ELSE 'visibility_changed' END AS result
    FROM a LEFT JOIN events e ON e.event_id = a.msg_id""",
    name="action_results",
)
def action_results_query(spark, sf_dir):
    return action_results(_queue(spark, sf_dir), _actions(spark, sf_dir))


@query(
    f"""WITH {_ACTIONS} SELECT *, CASE WHEN action = 'change_visibility' AND visibility_s NOT BETWEEN 0 AND 43200
      THEN 'visibility_out_of_range' END AS error FROM a""",
    name="validate_actions",
)
def validate_actions_query(spark, sf_dir):
    return validate_actions(_actions(spark, sf_dir))


@query(
    r"""WITH n AS (
      SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN replace(p_name, ' ', '_') WHEN 1 THEN '.' || p_brand
        WHEN 2 THEN p_type || '..' || p_size WHEN 3 THEN p_type || '.' WHEN 4 THEN '' ELSE p_brand END AS name FROM part)
    SELECT p_partkey, name, CASE WHEN name = '' THEN 'empty'
      WHEN NOT regexp_full_match(name, '[0-9a-zA-Z_\-.*]+') THEN 'illegal_character'
      WHEN regexp_matches(name, '^\.[^*]|\.\.|\.$') THEN 'dots'
      WHEN length(name) > 256 THEN 'too_long' END AS error FROM n"""
)
def validate_names(spark, sf_dir):
    names = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        """case p_size % 6 when 0 then replace(p_name, ' ', '_') when 1 then concat('.', p_brand)
           when 2 then concat(p_type, '..', p_size) when 3 then concat(p_type, '.') when 4 then '' else p_brand end AS name""",
    )
    return validate_attribute_names(names, "name")


# --- settlement --------------------------------------------------------------


def _channel(spark, sf_dir):
    """Deliveries and settlements of each user, on one clock."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    is_delivery = F.expr("case when event_type in ('error', 'signup') then 0 else 1 end").cast("bigint")
    rows = arrange(events.withColumn("_one", is_delivery), "user_id", "event_id").scan(tag=run_sum("_one")).df
    deliveries = rows.where("_one = 1").selectExpr(
        "user_id AS channel", "tag AS delivery_tag", "event_id AS delivered_seq"
    )
    actions = rows.where("_one = 0 and tag > 0").selectExpr(
        "user_id AS channel",
        "tag AS delivery_tag",
        "event_id AS action_seq",
        "if(event_type = 'signup', 'ack', 'nack') AS action",
        "event_type = 'signup' AS multiple",
        "event_id % 2 = 0 AS requeue",
    )
    return deliveries, actions


_SETTLED = """t AS (
  SELECT event_id, user_id AS channel, event_type,
    CAST(sum(CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS tag
  FROM events),
  d AS (SELECT channel, tag AS delivery_tag, event_id AS delivered_seq FROM t WHERE event_type NOT IN ('error', 'signup')),
  a AS (SELECT channel, tag, event_id AS action_seq, event_type, event_id % 2 = 0 AS requeue FROM t
    WHERE event_type IN ('error', 'signup') AND tag > 0),
  f AS (SELECT d.channel, d.delivery_tag, min(action_seq) AS settled_by FROM d JOIN a
    ON a.channel = d.channel AND (a.tag = d.delivery_tag OR (a.event_type = 'signup' AND a.tag >= d.delivery_tag))
    GROUP BY ALL),
  settled AS (SELECT d.*, CASE WHEN f.settled_by IS NULL THEN 'open' WHEN a.event_type = 'signup' THEN 'acked'
      WHEN a.requeue THEN 'requeued' ELSE 'dropped' END AS state, f.settled_by
    FROM d LEFT JOIN f ON f.channel = d.channel AND f.delivery_tag = d.delivery_tag
    LEFT JOIN a ON a.action_seq = f.settled_by)"""


@query(f"WITH {_SETTLED} SELECT *, coalesce(settled_by < delivered_seq, false) AS premature FROM settled", name="settle")
def settle_query(spark, sf_dir):
    return settle(*_channel(spark, sf_dir), delivered_seq="delivered_seq")


@query(
    f"""WITH {_SETTLED} SELECT channel, delivery_tag, delivered_seq, true AS redeliver FROM settled WHERE state = 'requeued'""",
    name="redelivered",
)
def redelivered_query(spark, sf_dir):
    return redelivered(settle(*_channel(spark, sf_dir)))


@query(
    f"""WITH {_SETTLED}, e AS (
      SELECT channel, delivered_seq AS seq, 1 AS d FROM settled
      UNION ALL SELECT channel, settled_by, -count(*) FROM settled WHERE settled_by IS NOT NULL GROUP BY ALL),
    s AS (SELECT channel, seq, CAST(sum(d) OVER (PARTITION BY channel ORDER BY seq) AS BIGINT) AS in_flight FROM e)
    SELECT *, in_flight > 10 AS over_prefetch FROM s"""
)
def unacked_gauge(spark, sf_dir):
    """Open deliveries over time; an action counts as many as it settles."""
    settled = written(settle(*_channel(spark, sf_dir)), "settled")
    opened = settled.select("channel", F.col("delivered_seq").alias("seq"), F.lit(1).cast("bigint").alias("d"))
    closed = (
        settled.where("settled_by is not null")
        .groupBy("channel", F.col("settled_by").alias("seq"))
        .agg((-F.count(F.lit(1))).alias("d"))
    )
    return in_flight(opened.unionByName(closed), "d", 10, "channel", "seq").drop("d")


# --- request / reply ---------------------------------------------------------


def _calls(spark, sf_dir):
    """User turns as requests; every other turn replies to the turn before it."""
    turns = table(spark, sf_dir, "conversations")
    requests = turns.where("role = 'user'").selectExpr(
        "concat_ws(':', conv_id, turn) AS correlation_id",
        """case conv_id % 3 when 0 then map('expectedReplies', '2') when 1 then map('expectedReplies', 'many')
           else map('other', '1') end AS headers""",
    )
    replies = turns.where("role <> 'user'").selectExpr("concat_ws(':', conv_id, turn - 1) AS correlation_id", "turn")
    return requests, replies


@query(
    """WITH r AS (SELECT concat_ws(':', conv_id, turn - 1) AS correlation_id, count(*) AS n FROM conversations WHERE role <> 'user' GROUP BY 1),
    q AS (SELECT concat_ws(':', conv_id, turn) AS correlation_id, CASE WHEN conv_id % 3 = 0 THEN 2 ELSE 1 END AS expected
      FROM conversations WHERE role = 'user')
    SELECT q.correlation_id, CAST(coalesce(n, 0) AS BIGINT) AS received, CAST(expected AS INTEGER) AS expected,
      expected - coalesce(n, 0) AS outstanding, expected <= coalesce(n, 0) AS complete
    FROM q LEFT JOIN r ON r.correlation_id = q.correlation_id"""
)
def rpc_correlate(spark, sf_dir):
    return correlate_rpc(*_calls(spark, sf_dir)).drop("headers")


@query(
    """WITH n AS (SELECT event_id, event_type, user_id % 4 AS shard,
        row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS pos FROM events)
    SELECT CAST(shard AS INTEGER) AS shard, event_id AS seq, pos // 50 AS batch_no, CAST(pos % 50 AS INTEGER) AS idx,
      CASE WHEN event_type <> 'view' THEN event_type <> 'error' END AS ok, event_type <> 'view' AS answered FROM n""",
    name="correlate_unanswered",
)
def correlate_unanswered_query(spark, sf_dir):
    """Requests paired with the result at their position in the batch; some have none."""
    records = table(spark, sf_dir, "events").selectExpr("cast(user_id % 4 as int) AS shard", "event_id AS seq", "event_type")
    requests = batch_by_count(records, 50, "shard", "seq")
    # Errors are refused, views get no answer.
    responses = requests.where("event_type <> 'view'").selectExpr("shard", "batch_no", "idx", "event_type <> 'error' AS ok")
    return correlate_batch(requests.drop("event_type"), responses, ("shard", "batch_no", "idx"))


@query(
    """WITH n AS (SELECT event_id, user_id % 4 AS shard,
        row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS pos FROM events)
    SELECT CAST(shard AS INTEGER) AS shard, event_id AS seq, pos // 50 AS batch_no, CAST(pos % 50 AS INTEGER) AS idx,
      event_id % 8 <= 2 AS ok, true AS answered FROM n""",
    name="correlate_batch",
)
def correlate_batch_query(spark, sf_dir):
    """Requests, sent in batches with retries, paired with the result at their position in the batch."""
    records = table(spark, sf_dir, "events").selectExpr(
        "cast(user_id % 4 as int) AS shard", "event_id AS seq", "cast(event_id % 8 as int) AS faults"
    )
    requests = batch_by_count(records, 50, "shard", "seq").drop("faults")
    settings = PublishSettings(batch_size=50, max_retries=2, wait=False)
    sent = publish(records, refusing("faults"), "shard", "seq", settings, ["faults"])
    responses = sent.select("shard", "batch_no", "idx", "ok")
    return correlate_batch(requests, responses, ("shard", "batch_no", "idx"))

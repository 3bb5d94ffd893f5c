"""Logs, checkpoints, directory listings and merged inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.catalog.base import LOG, log, query, table
from flowtables.functions.json import extract_json, write_json
from flowtables.operators.merge import collect_kind, concat_ordered, merge_tagged
from flowtables.sources.directory import directory_changes, directory_renames
from flowtables.sources.log import (
    checkpoint,
    checkpoint_every,
    log_ends,
    newest_checkpoints,
    partition_counts,
    read_log,
    resume_from,
)

_RECORD = ("shard", "seq", "body")


@query(f"WITH {LOG} SELECT shard, seq, body FROM log")
def log_trim_horizon(spark, sf_dir):
    return read_log(log(spark, sf_dir), "TRIM_HORIZON").select(*_RECORD)


@query(
    f"""WITH {LOG}, ends AS (
      SELECT shard, max(seq) AS last FROM log WHERE ts < TIMESTAMP '2024-01-20' GROUP BY shard)
    SELECT log.shard, seq, body FROM log JOIN ends ON log.shard = ends.shard AND seq > last"""
)
def log_latest(spark, sf_dir):
    records = log(spark, sf_dir)
    at_start = log_ends(records.where("ts < timestamp_ntz'2024-01-20'"))
    return read_log(records, "LATEST", positions=at_start).select(*_RECORD)


_FIRST_PURCHASE = f"""WITH {LOG}, starts AS (
      SELECT shard, min(seq) AS start FROM log WHERE event_type = 'purchase' GROUP BY shard)
    SELECT log.shard, seq, body FROM log JOIN starts ON log.shard = starts.shard AND seq """


def _first_purchase(records):
    return records.where("event_type = 'purchase'").groupBy("shard").agg(F.min("seq").alias("sequence"))


@query(_FIRST_PURCHASE + ">= start")
def log_at_seq(spark, sf_dir):
    records = log(spark, sf_dir)
    positions = _first_purchase(records)
    return read_log(records, "AT_SEQUENCE_NUMBER", positions=positions).select(*_RECORD)


@query(_FIRST_PURCHASE + "> start")
def log_after_seq(spark, sf_dir):
    records = log(spark, sf_dir)
    positions = _first_purchase(records)
    return read_log(records, "AFTER_SEQUENCE_NUMBER", positions=positions).select(*_RECORD)


@query(f"WITH {LOG} SELECT shard, seq, body FROM log WHERE ts >= TIMESTAMP '2024-01-15 12:00:00'")
def log_at_ts(spark, sf_dir):
    records = log(spark, sf_dir)
    return read_log(records, "AT_TIMESTAMP", timestamp="2024-01-15 12:00:00").select(*_RECORD)


_PARTITIONED = "SELECT user_id AS partition_id, event_id AS \"offset\", event_id AS seq, ts FROM events"


def _partitioned(spark, sf_dir):
    """``events`` as a log with one partition per user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("partition_id"),
        F.col("event_id").alias("offset"),
        F.col("event_id").alias("seq"),
        "ts",
    )


@query(
    f"""WITH l AS ({_PARTITIONED}), c AS (
      SELECT partition_id, max("offset") AS done FROM l WHERE ts < TIMESTAMP '2024-01-03' GROUP BY 1)
    SELECT l.partition_id, l."offset" FROM l LEFT JOIN c ON l.partition_id = c.partition_id
    WHERE l."offset" > coalesce(c.done, -1)"""
)
def log_resume(spark, sf_dir):
    records = _partitioned(spark, sf_dir)
    checkpoints = checkpoint(records.where("ts < timestamp_ntz'2024-01-03'"))
    return resume_from(records, checkpoints).select("partition_id", "offset")


@query(
    f"""WITH l AS ({_PARTITIONED})
    SELECT 'events' AS stream, 'readers' AS consumer_group, partition_id, max("offset") AS "offset",
      max(seq) AS sequence_number FROM l GROUP BY partition_id""",
    name="checkpoint",
)
def checkpoint_query(spark, sf_dir):
    return checkpoint(_partitioned(spark, sf_dir), stream="events", group="readers")


@query(
    f"""WITH l AS ({_PARTITIONED})
    SELECT 'events' AS stream, 'readers' AS consumer_group, partition_id, max("offset") AS "offset",
      max(seq) AS sequence_number FROM l GROUP BY partition_id""",
    name="newest_checkpoints",
)
def newest_checkpoints_query(spark, sf_dir):
    """A checkpoint table with one version per day."""
    daily = _partitioned(spark, sf_dir).withColumn("day", F.to_date("ts"))
    rows = daily.groupBy("partition_id", "day").agg(
        F.max("offset").alias("offset"), F.max("seq").alias("sequence_number")
    )
    table_of_checkpoints = rows.select(
        F.lit("events").alias("stream"),
        F.lit("readers").alias("consumer_group"),
        "partition_id",
        "offset",
        "sequence_number",
    )
    return newest_checkpoints(table_of_checkpoints)


@query(
    f"""WITH {LOG}, n AS (
      SELECT shard, seq, row_number() OVER (PARTITION BY shard ORDER BY seq) AS events_so_far FROM log)
    SELECT * FROM n WHERE events_so_far % 50 = 0""",
    name="checkpoint_every",
)
def checkpoint_every_query(spark, sf_dir):
    records = log(spark, sf_dir).select("shard", "seq")
    return checkpoint_every(records, 50, "shard", "seq")


@query(f"WITH {LOG} SELECT shard, count(*) AS events FROM log GROUP BY shard", name="partition_counts")
def partition_counts_query(spark, sf_dir):
    return partition_counts(log(spark, sf_dir), "shard")


@query(
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""
)
def json_extract(spark, sf_dir):
    parsed = extract_json(table(spark, sf_dir, "events"), "props", "k int")
    return parsed.select("event_id", F.col("value.k").alias("k"))


@query("SELECT event_id, event_type, value, user_id FROM events")
def json_body(spark, sf_dir):
    """Bodies written as JSON bytes, and read again."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "user_id")
    bodies = write_json(events, columns=["event_type", "value", "user_id"])
    read = extract_json(bodies, "body", "event_type string, value double, user_id bigint")
    return read.select("event_id", "value.*")


_LISTINGS = """shipped AS (
      SELECT l_orderkey, max(l_shipdate) AS gone, count(*) AS lines FROM lineitem GROUP BY l_orderkey),
    files AS (
      SELECT '/in/' || o_orderkey AS path, o_orderdate AS created, gone, coalesce(lines, 0) AS lines
      FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey),
    before AS (SELECT path, lines AS length FROM files
      WHERE created <= TIMESTAMP '1998-01-01' AND (gone IS NULL OR gone > TIMESTAMP '1998-01-01')),
    after AS (SELECT path, lines + (CASE WHEN gone <= TIMESTAMP '2000-06-01' THEN 1 ELSE 0 END) AS length FROM files
      WHERE created <= TIMESTAMP '1999-01-01' AND (gone IS NULL OR gone > TIMESTAMP '1999-01-01'))"""


@query(
    f"""WITH {_LISTINGS}
    SELECT coalesce(b.path, a.path) AS path,
      CASE WHEN b.path IS NULL THEN 'Creation' WHEN a.path IS NULL THEN 'Deletion' ELSE 'Modification' END AS change
    FROM before b FULL JOIN after a ON a.path = b.path
    WHERE b.path IS NULL OR a.path IS NULL OR a.length <> b.length""",
    name="directory_changes",
)
def directory_changes_query(spark, sf_dir):
    """Two listings of a folder in which each order is a file from its date until
    its last shipment."""
    shipped = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("gone"), F.count(F.lit(1)).alias("lines")
    )
    files = (
        table(spark, sf_dir, "orders")
        .join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.concat(F.lit("/in/"), F.col("o_orderkey").cast("string")).alias("path"),
            F.col("o_orderdate").alias("modified_at"),
            "gone",
            F.coalesce("lines", F.lit(0)).alias("lines"),
        )
    )

    def listing(day: str, length):
        there = f"modified_at <= timestamp_ntz'{day}' and (gone is null or gone > timestamp_ntz'{day}')"
        return files.where(there).select("path", "modified_at", length.alias("length"))

    grown = F.col("lines") + F.when(F.expr("gone <= timestamp_ntz'2000-06-01'"), 1).otherwise(0)
    return directory_changes(listing("1998-01-01", F.col("lines")), listing("1999-01-01", grown))


@query(
    """WITH before AS (SELECT '/new/' || o_orderkey AS path, o_custkey AS fingerprint, o_orderstatus = 'F' AS moved, o_orderkey % 11 = 0 AS gone FROM orders),
    after AS (
      SELECT CASE WHEN moved THEN replace(path, '/new/', '/done/') ELSE path END AS path, fingerprint FROM before WHERE NOT gone),
    lost AS (SELECT path AS renamed_from, fingerprint, row_number() OVER (PARTITION BY fingerprint ORDER BY path) AS nth FROM before WHERE path NOT IN (SELECT path FROM after)),
    fresh AS (SELECT path, fingerprint, row_number() OVER (PARTITION BY fingerprint ORDER BY path) AS nth FROM after WHERE path NOT IN (SELECT path FROM before))
    SELECT coalesce(path, renamed_from) AS path,
      CASE WHEN path IS NULL THEN 'Deletion' WHEN renamed_from IS NULL THEN 'Creation' ELSE 'Modification' END AS change,
      CASE WHEN path IS NOT NULL THEN renamed_from END AS renamed_from
    FROM lost FULL JOIN fresh USING (fingerprint, nth)""",
    name="directory_renames",
)
def directory_renames_query(spark, sf_dir):
    """Files of orders, moved when they are finished; some are gone.  Files of one customer are alike."""
    files = table(spark, sf_dir, "orders").selectExpr(
        "concat('/new/', o_orderkey) AS path", "o_orderdate AS modified_at", "0L AS length", "cast(o_custkey AS string) AS fingerprint",
        "o_orderstatus = 'F' AS moved", "o_orderkey % 11 = 0 AS gone",
    )
    after = files.where("NOT gone").withColumn("path", F.expr("if(moved, replace(path, '/new/', '/done/'), path)"))
    return directory_renames(files, after)


@query(
    """SELECT 'customer' AS branch, CAST(c_custkey AS BIGINT) AS id, c_name AS name FROM customer
    UNION ALL SELECT 'supplier', CAST(s_suppkey AS BIGINT), s_name FROM supplier""",
    name="merge_tagged",
)
def merge_tagged_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return merge_tagged({"customer": customers, "supplier": suppliers})


@query(
    """SELECT 0 AS part_no, CAST(c_custkey AS BIGINT) AS id FROM customer
    UNION ALL SELECT 1, CAST(s_suppkey AS BIGINT) FROM supplier""",
    name="concat_ordered",
)
def concat_ordered_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return concat_ordered(customers, suppliers, order="id").orderBy("part_no", "id")


@query("SELECT event_id, user_id AS buyer, value AS amount FROM events WHERE event_type = 'purchase'", name="collect_kind")
def collect_kind_query(spark, sf_dir):
    return collect_kind(
        table(spark, sf_dir, "events"),
        "event_type",
        "purchase",
        event_id=F.col("event_id"),
        buyer=F.col("user_id"),
        amount=F.col("value"),
    )

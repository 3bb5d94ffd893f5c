"""What plain Spark already says: sums, firsts, flattening, and small functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.catalog.base import LOG, log, query, table
from flowtables.functions.json import extract
from flowtables.functions.rules import backoff_ms, is_queue_attribute
from flowtables.operators.batching import batch_by_count, collect_batches
from flowtables.operators.rotation import rotate_by_time
from flowtables.operators.rpc import correlate_batch
from flowtables.plans.sizes import scratch_path
from flowtables.sinks.rotating import rotate_write


@query("SELECT CAST(sum(event_id) AS BIGINT) AS total, count(*) AS elements FROM events")
def sum_elements(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.agg(F.sum("event_id").alias("total"), F.count(F.lit(1)).alias("elements"))


@query("SELECT event_type, count(DISTINCT user_id % 4) AS branches FROM events GROUP BY event_type")
def distinct_branches(spark, sf_dir):
    tagged = table(spark, sf_dir, "events").withColumn("branch", F.col("user_id") % 4)
    return tagged.groupBy("event_type").agg(F.count_distinct("branch").alias("branches"))


@query("SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 100")
def first_elements(spark, sf_dir):
    """The first hundred elements; the limit is what is asked for."""
    return table(spark, sf_dir, "events").select("event_id", "ts").orderBy("ts", "event_id").limit(100)


@query("SELECT event_id, ts FROM events ORDER BY ts, event_id OFFSET 100")
def skip_elements(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts").orderBy("ts", "event_id").offset(100)


@query(f"WITH {LOG} SELECT shard, seq FROM log")
def flatten_batches(spark, sf_dir):
    """Batches of 100 collected and flattened again."""
    numbered = batch_by_count(log(spark, sf_dir).select("shard", "seq"), 100, "shard", "seq")
    batches = collect_batches(numbered, ["shard", "batch_no"], "idx", ["seq"])
    return batches.select("shard", F.explode("items").alias("seq"))


@query("SELECT conv_id, turn, nullif(trim(text), '') AS body FROM conversations WHERE trim(text) <> ''")
def drop_empty(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select("conv_id", "turn", F.trim("text").alias("body")).where("body <> ''")


@query("SELECT doc_id, strlen(text) AS size, upper(lang) AS lang FROM documents")
def extract_body(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    sized = extract(documents, "text", lambda c: F.octet_length(c).cast("bigint"), "size")
    return extract(sized, "lang", F.upper, "lang").select("doc_id", "size", "lang")


@query(
    """SELECT event_id, CAST(500 * pow(2, event_id % 6) AS BIGINT) AS exponential_ms,
      (event_id % 6 + 1) * 500 AS linear_ms,
      CAST([100, 500, 1000, 2000, 4000, 8000][event_id % 6 + 1] AS BIGINT) AS ladder_ms FROM events"""
)
def backoff_delays(spark, sf_dir):
    attempt = F.col("event_id") % 6 + 1
    return table(spark, sf_dir, "events").select(
        "event_id",
        backoff_ms(attempt).alias("exponential_ms"),
        backoff_ms(attempt, "linear").alias("linear_ms"),
        backoff_ms(attempt, "ladder").alias("ladder_ms"),
    )


@query("SELECT p_partkey, p_size % 2 = 0 AS known FROM part")
def queue_attributes(spark, sf_dir):
    named = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") % 2 == 0, "DelaySeconds").otherwise(F.col("p_name")).alias("name")
    )
    return named.select("p_partkey", is_queue_attribute("name").alias("known"))


@query(
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN 'id-' || event_id END AS message_id,
      event_type <> 'error' AS answered FROM events"""
)
def correlate_entries(spark, sf_dir):
    """Entries paired with results by entry id; errors have none."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    results = events.where("event_type <> 'error'").select(
        "event_id", F.concat(F.lit("id-"), F.col("event_id").cast("string")).alias("message_id")
    )
    return correlate_batch(events, results, ["event_id"]).drop("event_type")


@query(
    f"""WITH {LOG} SELECT shard, CAST(dense_rank() OVER (PARTITION BY shard ORDER BY CAST(ts AS DATE)) AS INTEGER) AS file_no,
      seq || ' ' || body AS line FROM log"""
)
def rotate_files(spark, sf_dir):
    """The log written to daily files per shard, and read back."""
    records = log(spark, sf_dir).select("shard", "seq", "ts", F.concat_ws(" ", "seq", "body").alias("line"))
    daily = F.date_format("ts", "yyyy-MM-dd")
    files = rotate_by_time(records, "shard", "seq", "ts", name=daily)
    path = scratch_path(spark, "rotated")
    rotate_write(files, path, "line", "shard", "seq", row_no="row_no")
    return spark.read.text(path).select("shard", "file_no", F.col("value").alias("line"))

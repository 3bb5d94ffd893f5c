"""Messages to queues through exchanges and bindings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions import topics
from flowtables.plans.pin import pin
from flowtables.plans.sizes import BROADCAST_ROWS, broadcast_if_small, written

#: Parts that each binding is copied to when bindings are too many to broadcast,
#: so that messages of one hot exchange or key meet them in as many tasks.
SALTS = 32

#: Lookups a message may need and still be routed as one row.
ROW_PROBES = 24

#: Before the name of a header that a binding asks for whatever its value.
ANY_VALUE = "\0"


def route(
    messages: DataFrame,
    exchanges: DataFrame,
    bindings: DataFrame,
    queues: DataFrame | None = None,
    message_id: str = "message_id",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per message and queue it reaches: all message columns and ``queue``.

    ``messages``: ``exchange``, ``routing_key``, ``headers`` (map) and an id.
    ``exchanges``: ``exchange``, ``type`` (direct, fanout, topic or headers).
    ``bindings``: ``queue``, ``exchange``, ``routing_key``, ``args`` (map); the
    argument ``x-match`` is ``all`` (default) or ``any``; an argument without a value asks only
    that the header is there.  ``queues``: ``queue``;
    with it, the exchange with the empty name delivers to the queue that the
    routing key names.  A message reaches a queue once, however many bindings
    lead there.

    All kinds share one equi-join.  A binding is filed under a probe key, a
    message looks up the few probe keys it can have: its routing key (direct), a
    constant (fanout), each header (headers), or its first or last words masked in
    at most 31 ways and, for patterns with literal words in the middle only, each of
    its words (topic).  What the probe key leaves open is checked after the join.
    """
    index, entries, masks, doubled = _indexed(messages, exchanges, bindings, queues, broadcast_rows)
    small = entries is not None
    if small and (probes := _row_probes(entries)) is not None:
        lists = _listed(messages, entries, index.schema, probes).where(F.size("queues") > 0)
        return lists.select(*messages.columns, F.explode("queues").alias("queue"))
    # A message to an exchange without bindings reaches nothing.
    kinds = index.select(F.col("b_exchange").alias("_e"), F.col("b_type").alias("_type")).distinct()
    kinds = F.broadcast(kinds) if small else broadcast_if_small(kinds)
    typed = messages.join(kinds, F.col("exchange") == F.col("_e"), "inner")
    words = topics.words(F.coalesce(F.col("routing_key"), F.lit("")))
    typed = pin(typed, _words=F.when(F.col("_type") == "topic", words))
    probed = typed.withColumn("_probe", F.explode(_probes(sorted(masks))))

    on = (
        (F.col("exchange") == F.col("b_exchange"))
        & (F.col("_probe.mask") == F.col("b_mask"))
        & (F.col("_probe.key") == F.col("b_key"))
    )
    if small:
        index = F.broadcast(index)
    else:
        probed = probed.withColumn("_salt", F.pmod(F.xxhash64(message_id), F.lit(SALTS)))
        index = index.withColumn("b_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        on = on & (F.col("_salt") == F.col("b_salt"))
    reached = probed.join(index, on & _rest_matches(), "inner").select(
        *[messages[c] for c in messages.columns], F.col("b_queue").alias("queue")
    )
    # Only through several entries can a message reach a queue twice.
    return reached.dropDuplicates([message_id, "queue"]) if doubled else reached


def route_lists(
    messages: DataFrame,
    exchanges: DataFrame,
    bindings: DataFrame,
    queues: DataFrame | None = None,
    message_id: str = "message_id",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Every message once, with ``queues``, the array of those it reaches (see :func:`route`)."""
    index, entries, _, _ = _indexed(messages, exchanges, bindings, queues, broadcast_rows)
    if entries is not None and (probes := _row_probes(entries)) is not None:
        return _listed(messages, entries, index.schema, probes)
    routed = route(messages.select(message_id, "exchange", "routing_key", "headers"), exchanges, bindings, queues, message_id, broadcast_rows)
    lists = routed.groupBy(F.col(message_id).alias("_id")).agg(F.collect_list("queue").alias("_queues"))
    none = F.array().cast("array<string>")
    joined = messages.join(lists, F.col(message_id) == F.col("_id"), "left")
    return joined.select(*[messages[c] for c in messages.columns], F.coalesce("_queues", none).alias("queues"))


def _indexed(messages: DataFrame, exchanges: DataFrame, bindings: DataFrame, queues: DataFrame | None, broadcast_rows: int):
    """The binding index; its rows if they are few; the masks of topics; whether a queue has
    several entries."""
    entries = _small_index(exchanges, bindings, queues, broadcast_rows)
    if entries is not None:
        masks = {e["b_mask"] for e in entries if e["b_type"] == "topic"}
        doubled = len({(e["b_exchange"], e["b_queue"]) for e in entries}) < len(entries)
        return messages.sparkSession.createDataFrame(entries, _ENTRY), entries, masks, doubled
    index = written(_binding_index(exchanges, bindings, queues), "bindings")
    # One row: at most 2 ** INDEXED_WORDS masks.
    facts = index.agg(
        F.collect_set(F.when(F.col("b_type") == "topic", F.col("b_mask"))).alias("masks"),
        (F.count_distinct("b_exchange", "b_queue") < F.count(F.lit(1))).alias("doubled"),
    ).first()
    return index, None, facts["masks"], facts["doubled"]


_PAIRS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))
_ENTRY = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("b_exchange", "b_queue", "b_type")]
    + [T.StructField("b_mask", T.IntegerType()), T.StructField("b_key", T.StringType()), T.StructField("b_words", T.IntegerType())]
    + [T.StructField("b_regex", T.StringType()), T.StructField("b_pairs", _PAIRS), T.StructField("b_any", T.BooleanType())]
)


def _small_index(exchanges: DataFrame, bindings: DataFrame, queues: DataFrame | None, most: int) -> list[Row] | None:
    """``_binding_index`` on the driver, or None if exchanges, bindings, queues or entries are more than ``most``."""
    tables = [exchanges.select("exchange", "type"), bindings.select("queue", "exchange", "routing_key", "args")]
    tables += [queues.select("queue")] if queues is not None else []
    rows = [t.limit(most + 1).collect() for t in tables]
    if max(map(len, rows)) > most:
        return None
    types: dict[str, list[str]] = {}
    for e in rows[0]:
        if queues is None or e["exchange"] != "":
            types.setdefault(e["exchange"], []).append(e["type"])
    found = [b.asDict() for b in rows[1] if queues is None or b["exchange"] != ""]
    if queues is not None:
        types[""] = ["direct"]
        found += [{"queue": q["queue"], "exchange": "", "routing_key": q["queue"], "args": None} for q in rows[2]]
    entry = Row(*_ENTRY.names)
    out = []
    for b in found:
        args = b["args"] or {}
        pairs = [(k, v) for k, v in args.items() if not k.startswith("x-")]
        any_match = (args.get("x-match") or "all") == "any"
        pattern = b["routing_key"] or ""
        for kind in types.get(b["exchange"], []) if b["exchange"] is not None else []:
            mask, words, regex, own = 0, None, None, None
            if kind == "topic":
                mask, key, words, regex = topics.index_entry(pattern)
                keys = [key]
            elif kind == "headers":
                keys = [ANY_VALUE + k if v is None else f"{k}={v}" for k, v in (pairs if any_match else pairs[:1])] or [""]
                own = pairs
            else:
                keys = {"direct": [pattern], "fanout": [""]}.get(kind, [])
            out += [entry(b["exchange"], b["queue"], kind, mask, k, words, regex, own, any_match) for k in keys]
    return out if len(out) <= most else None


def _row_probes(entries: list[Row]) -> list[tuple[str, int, Column]] | None:
    """The probe keys a message can have, each with the type it is for and its mask: one of its own, one
    for each mask of topics, and one for each header that bindings ask for.  None if they are more
    than ``ROW_PROBES``, or patterns are filed under words at any place."""
    types = {e["b_type"] for e in entries}
    masks = {e["b_mask"] for e in entries if e["b_type"] == "topic"}
    keys = {e["b_key"] for e in entries if e["b_type"] == "headers" and e["b_key"]}
    names = {(k[1:], True) if k.startswith(ANY_VALUE) else (k.partition("=")[0], False) for k in keys}
    if topics.ANYWHERE in masks or 1 + len(masks) + len(names) > ROW_PROBES:
        return None
    own = F.when(F.col("_type") == "direct", F.coalesce(F.col("routing_key"), F.lit(""))).when(F.col("_type").isin("fanout", "headers"), "")
    probes = [("direct", 0, own)] if types - {"topic"} else []
    probes += [("topic", m, F.when(F.col("_type") == "topic", topics.index_key(F.col("_words"), F.lit(m)))) for m in sorted(masks)]
    for name, any_value in sorted(names):
        pair = F.concat(F.lit(f"{name}="), F.try_element_at("headers", F.lit(name)))
        there = F.when(F.map_contains_key("headers", name), ANY_VALUE + name)
        probes.append(("headers", 0, F.when(F.col("_type") == "headers", there if any_value else pair)))
    return probes


def _listed(messages: DataFrame, entries: list[Row], schema: T.StructType, probes: list[tuple[str, int, Column]]) -> DataFrame:
    """Messages with the queues they reach: each probe is looked up in a broadcast table that has one
    row for a key, so a message stays one row, and nothing is shuffled."""
    spark = messages.sparkSession
    under: dict[tuple, list[Row]] = {}
    for e in entries:
        under.setdefault((e["b_exchange"], e["b_mask"], e["b_key"]), []).append(e)
    found = T.StructType([*[schema[c] for c in ("b_exchange", "b_mask", "b_key")], T.StructField("entries", T.ArrayType(schema))])
    types = {(e["b_exchange"], e["b_type"]) for e in entries}
    kinds = F.broadcast(spark.createDataFrame(sorted(types), "_exchange string, _type string"))
    rows = messages.join(kinds, F.col("exchange") == F.col("_exchange"), "left")
    if any(kind == "topic" for kind, _, _ in probes):
        words = topics.words(F.coalesce(F.col("routing_key"), F.lit("")))
        rows = pin(rows, _words=F.when(F.col("_type") == "topic", words))
    rows = rows.select("*", *[probe.alias(f"_probe{i}") for i, (_, _, probe) in enumerate(probes)])
    lists = []
    for i, (kind, mask, _) in enumerate(probes):
        # Direct and fanout entries match by their key, and so do headers bindings that ask for none.
        own = [(e, k, v) for (e, m, k), v in under.items() if m == mask and k is not None and (v[0]["b_type"] == kind or (kind == "direct" and (v[0]["b_type"] == "fanout" or (v[0]["b_type"] == "headers" and k == ""))))]
        side = spark.createDataFrame(own, T.StructType([T.StructField(f"_e{i}", T.StringType()), T.StructField(f"_k{i}", T.StringType()), T.StructField(f"_found{i}", found["entries"].dataType)]))
        rows = rows.join(F.broadcast(side), (F.col("exchange") == F.col(f"_e{i}")) & (F.col(f"_probe{i}") == F.col(f"_k{i}")), "left")
        entry_of = F.col(f"_found{i}")
        if kind == "topic":
            entry_of = F.filter(entry_of, lambda e: _topic_matches(lambda name: e[name]))
        elif kind == "headers":
            entry_of = F.filter(entry_of, lambda e: _headers_match(lambda name: e[name]))
        lists.append(F.coalesce(F.transform(entry_of, lambda e: e["b_queue"]), F.array().cast("array<string>")))
    none = F.array().cast("array<string>")
    return rows.select(*[messages[c] for c in messages.columns], F.array_distinct(F.concat(none, *lists)).alias("queues"))


def _binding_index(exchanges: DataFrame, bindings: DataFrame, queues: DataFrame | None) -> DataFrame:
    no_args = F.create_map().cast("map<string,string>")
    if queues is not None:
        bindings = bindings.where("exchange <> ''").unionByName(
            queues.select(
                "queue",
                F.lit("").alias("exchange"),
                F.col("queue").alias("routing_key"),
                no_args.alias("args"),
            )
        )
        exchanges = exchanges.where("exchange <> ''").unionByName(
            exchanges.sparkSession.range(1).select(F.lit("").alias("exchange"), F.lit("direct").alias("type"))
        )
    pattern = F.coalesce(F.col("routing_key"), F.lit(""))
    args = F.coalesce(F.col("args"), no_args)
    pairs = F.map_entries(F.map_filter(args, lambda k, v: ~k.startswith("x-")))
    any_match = F.coalesce(F.try_element_at(args, F.lit("x-match")), F.lit("all")) == "any"
    topic, headers = F.col("type") == "topic", F.col("type") == "headers"

    # A headers binding is filed under each of its pairs if any may match, else
    # under its first pair; without pairs under the empty key.
    header_keys = (
        F.when(F.size(pairs) == 0, F.array(F.lit("")))
        .when(any_match, F.transform(pairs, _pair_key))
        .otherwise(F.transform(F.slice(pairs, 1, 1), _pair_key))
    )
    mask = F.when(topic, topics.index_mask(pattern)).otherwise(0)
    keys = (
        F.when(F.col("type") == "direct", F.array(pattern))
        .when(F.col("type") == "fanout", F.array(F.lit("")))
        .when(topic, F.array(topics.index_key(topics.words(pattern), F.col("b_mask"))))
        .when(headers, header_keys)
    )
    return (
        bindings.join(exchanges, "exchange")
        .withColumn("b_mask", mask)
        .select(
            F.col("exchange").alias("b_exchange"),
            F.col("queue").alias("b_queue"),
            F.col("type").alias("b_type"),
            "b_mask",
            F.explode(keys).alias("b_key"),
            F.when(topic, topics.fixed_count(pattern)).alias("b_words"),
            F.when(topic & ~topics.exact_mask(pattern), topics.topic_regex(pattern)).alias("b_regex"),
            F.when(headers, pairs).alias("b_pairs"),
            any_match.alias("b_any"),
        )
    )


def _pair_key(pair: Column) -> Column:
    return F.coalesce(F.concat(pair["key"], F.lit("="), pair["value"]), F.concat(F.lit(ANY_VALUE), pair["key"]))


def _probes(masks: list[int]) -> Column:
    """Probe keys of a message, by the type of its exchange."""
    key = F.coalesce(F.col("routing_key"), F.lit(""))

    def probe(mask, value) -> Column:
        return F.struct(F.lit(mask).alias("mask"), value.alias("key"))

    nothing = F.array().cast("array<struct<mask:int,key:string>>")
    # A key with fewer words than a mask asks for has a null there, which joins nothing.
    by_place = [probe(m, topics.index_key(F.col("_words"), F.lit(m))) for m in masks if m != topics.ANYWHERE]
    by_words = F.array(*by_place) if by_place else nothing
    if topics.ANYWHERE in masks:
        anywhere = F.transform(topics.anywhere_keys(F.col("_words")), lambda k: probe(topics.ANYWHERE, k))
        by_words = F.concat(by_words, anywhere)
    entries = F.map_entries(F.coalesce(F.col("headers"), F.create_map().cast("map<string,string>")))
    by_header = F.concat(
        F.array(probe(0, F.lit(""))),
        F.transform(entries, lambda e: probe(0, F.concat(e["key"], F.lit("="), e["value"]))),
        F.transform(entries, lambda e: probe(0, F.concat(F.lit(ANY_VALUE), e["key"]))),
    )
    return (
        F.when(F.col("_type") == "direct", F.array(probe(0, key)))
        .when(F.col("_type") == "fanout", F.array(probe(0, F.lit(""))))
        .when(F.col("_type") == "topic", by_words)
        .when(F.col("_type") == "headers", by_header)
        .otherwise(nothing)
    )


def _rest_matches() -> Column:
    """What a topic or headers binding asks beyond its probe key."""
    return F.when(F.col("b_type") == "topic", _topic_matches(F.col)).when(F.col("b_type") == "headers", _headers_match(F.col)).otherwise(True)


def _topic_matches(of: Callable[[str], Column]) -> Column:
    key = F.coalesce(F.col("routing_key"), F.lit(""))
    n = F.size("_words")
    count_ok = F.when(of("b_words") < 0, n >= -1 - of("b_words")).otherwise(n == of("b_words"))
    dotted = F.when(key == "", F.lit("")).otherwise(F.concat(key, F.lit(".")))
    return count_ok & F.coalesce(F.regexp(dotted, of("b_regex")), F.lit(True))


def _headers_match(of: Callable[[str], Column]) -> Column:
    has = lambda e: F.when(e["value"].isNull(), F.map_contains_key(F.col("headers"), e["key"])).otherwise(
        F.try_element_at(F.col("headers"), e["key"]) == e["value"]
    )
    return of("b_any") | F.coalesce(F.forall(of("b_pairs"), has), F.lit(False))


def unroutable(messages: DataFrame, routed: DataFrame, message_id: str = "message_id") -> DataFrame:
    """Messages that reached no queue; with a ``mandatory`` column they would be
    returned to the sender."""
    return messages.join(routed.select(message_id), message_id, "left_anti")


def route_replies(messages: DataFrame, reply_to: str = "reply_to", on_missing: str = "fail") -> DataFrame:
    """Send each message to the queue its ``reply_to`` names, as ``target_queue``.
    ``on_missing``: ``fail`` the query or ``skip`` the message."""
    if on_missing not in ("fail", "skip"):
        raise ValueError("on_missing must be 'fail' or 'skip'")
    target = F.col(reply_to)
    if on_missing == "skip":
        return messages.where(target.isNotNull()).withColumn("target_queue", target)
    failed = F.raise_error(F.lit("message has no reply-to")).cast("string")
    return messages.withColumn("target_queue", F.coalesce(target, failed))

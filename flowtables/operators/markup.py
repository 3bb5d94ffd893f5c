"""Markup documents as event tables, path filters and text coalescing.

Event columns: the document id, ``seq`` (order in the document, with gaps),
``kind`` (start_document, end_document, start_element, end_element, characters,
cdata, comment, processing_instruction, and error for one of the last three that
has no end: its ``text`` is the rest of the document), ``name``, ``attrs`` and ``text``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowtables.functions import intervals, markup
from flowtables.operators.policy import with_error_policy
from flowtables.plans.ordered import Arranged, arrange, last_value, previous, run_sum
from flowtables.plans.pin import pin

Names = str | Sequence[str]

#: Numbers per token: 0 start of document, 1 to 3 its events, 7 end of document.
_SLOTS = 8

_NO_LEVEL = -(1 << 62)


def markup_events(
    df: DataFrame, id_col: str, text_col: str, html: bool = False, documents: bool = False
) -> DataFrame:
    """Split documents into events; white-space-only text is dropped, names and
    attributes lose their namespace prefix, an element without content gives a
    start and an end.  With ``html``, script and style hold raw text and void
    elements end at once.  With ``documents``, start and end of each document are
    events too; a text may hold several documents."""
    if not documents:
        split = df.select(F.col(id_col), F.posexplode(_tokens(text_col, html)).alias("_pos", "_token"))
        return _events(split, id_col, html)
    # The events of a document come from one row here, so its tokens are marked there, and no events are sorted.
    rows = df.select(F.col(id_col), F.coalesce(_tokens(text_col, html), F.array().cast("array<string>")).alias("_tokens"))
    schema = T.StructType([rows.schema[id_col], T.StructField("pieces", T.DataType.fromDDL(intervals.MARKED))])
    marked = rows.mapInArrow(lambda batches: intervals.marked(batches, html), schema)
    split = marked.select(F.col(id_col), F.inline("pieces").alias("_pos", "_token", "_starts", "_ends"))
    return _events(split, id_col, html)


def _tokens(text_col: str, html: bool) -> Column:
    pattern = markup.HTML_TOKEN if html else markup.XML_TOKEN
    return F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))


def _events(split: DataFrame, id_col: str, html: bool, attributes: bool = True) -> DataFrame:
    """Events of ``_token``, which is at ``_pos``.  Of a token that is ``_within`` a path, an element as
    a whole, only the text is one; a row with ``_is_run`` has its text in ``_run``."""
    token, kind, body = F.col("_token"), F.col("_kind"), F.col("_body")
    sliced, merged = "_within" in split.columns, "_run" in split.columns
    token_kind, text = markup.token_kind(token, html), markup.token_text(token, kind)
    if merged:
        token_kind = F.when(F.col("_is_run"), "characters").otherwise(token_kind)
        text = F.when(F.col("_is_run"), F.col("_run")).otherwise(text)
    tokens = pin(split, _kind=token_kind).where(kind.isNotNull()).withColumn("_name", markup.token_name(token, kind)).withColumn("_text", text)
    attrs = F.lit(None).cast("map<string,string>")
    if attributes:
        no_attrs = F.create_map().cast("map<string,string>")
        tokens = (
            tokens.withColumn("_body", markup.attribute_body(markup.start_tag(token, kind)))
            .withColumn("_names", F.when(body.contains("="), markup.attribute_names(body)))
            .withColumn("_values", F.when(F.col("_names").isNotNull(), markup.attribute_values(body)))
        )
        attrs = F.when(F.size("_names") > 0, markup.attribute_map(F.col("_names"), F.col("_values"))).when(
            body.isNotNull(), no_attrs
        )
    tokens = tokens.withColumn("_attrs", attrs)
    parts = markup.token_events(kind, F.col("_name"), F.col("_attrs"), F.col("_text"))
    sub = F.col("_sub")
    if "_starts" in split.columns:
        none = F.lit(None).cast("string")
        mark = lambda kind: F.struct(F.lit(kind).alias("kind"), none.alias("name"), F.lit(None).cast("map<string,string>").alias("attrs"), none.alias("text"))
        nothing = F.slice(parts, 1, 0)
        before = F.when(F.col("_starts"), F.array(mark("start_document"))).otherwise(nothing)
        after = F.when(F.col("_ends"), F.array(mark("end_document"))).otherwise(nothing)
        parts = F.concat(before, parts, after)
        is_start, is_end = F.col("_event.kind") == "start_document", F.col("_event.kind") == "end_document"
        sub = F.when(is_start, -1).when(is_end, _SLOTS - 2).otherwise(F.col("_sub") - F.col("_starts").cast("int"))
        tokens = tokens.select(id_col, "_pos", "_starts", F.posexplode(parts).alias("_sub", "_event"))
        return tokens.select(id_col, (F.col("_pos").cast("bigint") * _SLOTS + sub + 1).alias("seq"), "_event.*")
    if sliced:
        parts = F.when(F.col("_within"), F.filter(parts, lambda e: e["kind"] == "characters")).otherwise(parts)
        sub = F.when(F.col("_within"), 1).otherwise(sub)
    return tokens.select(id_col, "_pos", *["_within"] * sliced, F.posexplode(parts).alias("_sub", "_event")).select(
        id_col,
        (F.col("_pos").cast("bigint") * _SLOTS + sub + 1).alias("seq"),
        "_event.*",
    )


def subslice_text(
    df: DataFrame,
    id_col: str,
    text_col: str,
    path: Sequence[str],
    html: bool = False,
    attributes: bool = True,
    max_text: int | None = None,
    on_error: str | None = "stop",
    kinds: Sequence[str] | None = None,
) -> DataFrame:
    """What :func:`subslice` keeps of :func:`markup_events`, without events for the rest.

    Elements of the path are intervals of the row's token array, and what is inside is a slice
    of it, so nothing is sorted or shuffled and only those tokens are read.  With ``max_text``,
    runs of text are merged as :func:`coalesce_text` does it, with its ``error`` column and
    ``on_error``.  Without ``attributes``, ``attrs`` is null.  With ``kinds``, only events of these
    kinds; tokens that give none are left out where documents are sliced.
    """
    rows = df.select(F.col(id_col), F.coalesce(_tokens(text_col, html), F.array().cast("array<string>")).alias("_tokens"))
    schema = T.StructType([rows.schema[id_col], T.StructField("pieces", T.DataType.fromDDL(intervals.PIECES))])
    path, merge, kinds = list(path), max_text is not None, None if kinds is None else list(kinds)
    sliced = rows.mapInArrow(lambda batches: intervals.slices(batches, path, html, merge, kinds), schema)
    split = sliced.select(F.col(id_col), F.inline("pieces").alias("_pos", "_token", "_within", "_texts"))
    asked = F.lit(True) if kinds is None else F.col("kind").isin(*kinds)
    if not merge:
        return _events(split.drop("_texts"), id_col, html, attributes).where(asked)
    is_text = lambda t: F.when(t.startswith("<![CDATA["), "cdata").otherwise("characters")
    run = F.array_join(F.transform("_texts", lambda t: markup.token_text(t, is_text(t))), "")
    split = split.withColumns({"_is_run": F.col("_texts").isNotNull(), "_run": run}).drop("_texts")
    merged = _events(split, id_col, html, attributes)
    long = (F.col("kind") == "characters") & (F.length("text") > max_text)
    merged = pin(merged, error=F.when(long, F.lit("text_too_long"))).withColumn("text", F.when(F.col("error").isNull(), F.col("text")))
    merged = merged if on_error is None else with_error_policy(merged, "error", on_error)
    return merged.where(asked)


def _with_depth(rows: Arranged) -> Arranged:
    """``_depth``: elements open after the event."""
    step = F.when(F.col("kind") == "start_element", 1).when(F.col("kind") == "end_element", -1).otherwise(0)
    return rows.with_columns(_depth=step.cast("bigint")).scan(_depth=run_sum("_depth"))


def with_documents(
    events: DataFrame, key: str, order: str = "seq", rows_per_chunk: int | None = None
) -> DataFrame:
    """Add start_document before the first element or processing instruction at
    the top and end_document after a top element's end.  ``seq`` must have the
    gaps that :func:`markup_events` leaves."""
    rows = _with_depth(arrange(events, key, order, rows_per_chunk))
    is_start = F.col("kind") == "start_element"
    is_pi = F.col("kind") == "processing_instruction"
    begins = (is_start & (F.col("_depth") == 1)) | (is_pi & (F.col("_depth") == 0))
    ends = (F.col("kind") == "end_element") & (F.col("_depth") == 0)
    rows = rows.with_columns(_mark=F.when(begins, 1).when(ends, 0))
    rows = rows.scan(_open=last_value("_mark", exclusive=True))
    rows = rows.with_columns(
        _add=F.when((F.col("_mark") == 1) & (F.coalesce(F.col("_open"), F.lit(0)) == 0), "start_document").when(
            F.col("_mark") == 0, "end_document"
        )
    )
    base = F.col("seq") - F.col("seq") % _SLOTS
    extra = F.struct(
        F.when(F.col("_add") == "start_document", base).otherwise(base + _SLOTS - 1).alias("seq"),
        F.col("_add").alias("kind"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("map<string,string>").alias("attrs"),
        F.lit(None).cast("string").alias("text"),
    )
    own = F.struct("seq", "kind", "name", "attrs", "text")
    both = F.when(F.col("_add").isNull(), F.array(own)).otherwise(F.array(own, extra))
    return rows.df.select(key, F.explode(both).alias("_event")).select(key, "_event.*")


def subslice(
    events: DataFrame,
    path: Sequence[str],
    key: Names = "doc_id",
    order: Names = "seq",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Events strictly inside elements whose path from the top is ``path``; the
    tags of those elements are not part of it.  An empty path keeps everything."""
    path = list(path)
    if not path:
        return events
    k = len(path)
    rows = _with_depth(arrange(events, key, order, rows_per_chunk))
    tag = F.col("kind").isin("start_element", "end_element")
    # Depth of the element an event belongs to: its own for tags.
    own = F.when(F.col("kind") == "end_element", F.col("_depth") + 1).otherwise(F.col("_depth"))
    opened = {
        f"_level{i}": F.when((F.col("kind") == "start_element") & (F.col("_depth") == i + 1), F.col("name"))
        for i in range(k)
    }
    rows = rows.with_columns(_own=own, **opened).scan(**{n: last_value(n) for n in opened})
    inside = F.when(tag, F.col("_own") > k).otherwise(F.col("_own") >= k)
    inside = inside & ~F.col("kind").isin("start_document", "end_document")
    for i, name in enumerate(path):
        inside = inside & (F.col(f"_level{i}") == name)
    return rows.df.where(inside).select(*events.columns)


def coalesce_text(
    events: DataFrame,
    max_length: int,
    key: Names = "doc_id",
    order: str = "seq",
    on_error: str | None = "stop",
    rows_per_chunk: int | None = None,
) -> DataFrame:
    """Merge runs of adjacent characters and cdata events into one characters
    event.  A run longer than ``max_length`` characters is an error; with
    ``on_error=None`` it stays as a row without text and with ``error`` set."""
    keys = [key] if isinstance(key, str) else list(key)
    is_text = F.col("kind").isin("characters", "cdata")
    size = F.when(is_text, F.length("text")).otherwise(0).cast("bigint")
    rows = arrange(events, keys, order, rows_per_chunk)
    rows = rows.with_columns(_len=size, _other=F.when(is_text, 0).otherwise(1).cast("bigint"))
    rows = rows.scan(_run=run_sum("_other"), _sum=run_sum("_len"))
    rows = rows.with_columns(_base=F.when(~is_text, F.col("_sum"))).scan(_base=last_value("_base"))
    before = F.col("_sum") - F.col("_len") - F.coalesce(F.col("_base"), F.lit(0))
    # A group is an event that is no text, if any, and the run of text after it.
    # Of a run that is too long only what shows it is collected.
    rest = [c for c in events.columns if c not in keys]
    piece = F.when(is_text & (before <= max_length), F.struct(order, "text", "_len"))
    groups = rows.df.groupBy(*keys, "_run").agg(
        F.first(F.when(~is_text, F.struct(*rest)), ignorenulls=True).alias("_head"),
        F.sort_array(F.collect_list(piece)).alias("_pieces"),
    )
    length = F.aggregate("_pieces", F.lit(0).cast("bigint"), lambda n, p: n + p["_len"])
    groups = pin(groups, _total=length)
    long = F.col("_total") > max_length
    head = {c: F.col(f"_head.{c}") for c in rest}
    text = {c: F.lit(None).cast(events.schema[c].dataType) for c in rest} | {
        order: F.get(F.col(f"_pieces.{order}"), F.lit(0)),
        "kind": F.lit("characters"),
        "text": F.when(~long, F.array_join("_pieces.text", "")),
    }
    error = F.when(long, F.lit("text_too_long"))

    def event(columns: dict, error) -> Column:
        return F.struct(*[columns[c].alias(c) for c in rest], error.cast("string").alias("error"))

    own, run = event(head, F.lit(None)), event(text, error)
    has_own, has_run = F.col("_head").isNotNull(), F.size("_pieces") > 0
    parts = F.when(has_own & has_run, F.array(own, run)).when(has_own, F.array(own)).otherwise(F.array(run))
    merged = groups.select(*keys, F.inline(parts)).select(*events.columns, "error")
    return merged if on_error is None else with_error_policy(merged, "error", on_error)


def well_formed(events: DataFrame, key: str = "doc_id", order: str = "seq", rows_per_chunk: int | None = None) -> DataFrame:
    """``key`` and ``well_formed``: every end tag closes the element opened last,
    nothing stays open, and there is no error event."""
    rows = _with_depth(arrange(events, key, order, rows_per_chunk))
    is_end = F.col("kind") == "end_element"
    is_tag = F.col("kind").isin("start_element", "end_element")
    # Events that are no tags wait in a level that no tag has.
    level = F.when(is_end, F.col("_depth") + 1).when(is_tag, F.col("_depth")).otherwise(_NO_LEVEL)
    levels = rows.df.select(key, order, "kind", F.when(is_tag, F.col("name")).alias("name"), level.alias("_level"))
    per_level = arrange(levels, (key, "_level"), order, rows_per_chunk)
    per_level = per_level.scan(_prev=previous(F.struct("kind", "name")))
    opened = F.coalesce(F.col("_prev.kind") == "start_element", F.lit(False))
    paired = F.when(is_end, opened & (F.col("_prev.name") == F.col("name"))).otherwise(~opened)
    good = F.when(is_tag, (F.col("_level") > 0) & paired).otherwise(F.col("kind") != "error")
    step = F.when(is_end, -1).when(is_tag, 1).otherwise(0)
    return per_level.df.groupBy(key).agg((F.bool_and(good) & (F.sum(step) == 0)).alias("well_formed"))

"""CSV and markup feeds, and error policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtables.catalog.base import query, table
from flowtables.operators.csv_records import csv_format, csv_parse, csv_to_map
from flowtables.operators.markup import markup_events, subslice_text, well_formed
from flowtables.plans.sizes import scratch_path
from flowtables.sinks.csv_files import csv_write
from flowtables.sources.csv_files import csv_scan

# --- CSV ---------------------------------------------------------------------

_DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source"]


def _field(column: str, always: bool = False) -> str:
    text = f"coalesce(CAST({column} AS VARCHAR), '')"
    quoted = f"""'"' || replace(replace({text}, '\\', '\\\\'), '"', '""') || '"'"""
    return quoted if always else f"CASE WHEN regexp_matches({text}, '[\\r\\n,\"\\\\]') THEN {quoted} ELSE {text} END"


def _line(columns, always: bool = False) -> str:
    return " || ',' || ".join(f"({_field(c, always)})" for c in columns)


@query(f"SELECT doc_id, {_line(_DOCUMENT_COLUMNS)} AS line FROM documents")
def csv_format_required(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(*_DOCUMENT_COLUMNS)
    return csv_format(documents, _DOCUMENT_COLUMNS).select("doc_id", "line")


_PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]


@query(f"SELECT p_partkey, {_line(_PART_COLUMNS, True)} AS line FROM part")
def csv_format_always(spark, sf_dir):
    return csv_format(table(spark, sf_dir, "part"), _PART_COLUMNS, always=True).select("p_partkey", "line")


@query("SELECT doc_id, text, lang, source FROM documents", name="csv_parse")
def csv_parse_query(spark, sf_dir):
    """Documents formatted as CSV and parsed again."""
    lines = csv_format(table(spark, sf_dir, "documents").select(*_DOCUMENT_COLUMNS), _DOCUMENT_COLUMNS)
    parsed = csv_parse(lines.select("line"), "line", on_error="stop")
    field = [F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(_DOCUMENT_COLUMNS)]
    return parsed.select(field[0].cast("bigint"), *field[1:])


@query(
    """SELECT c_custkey, 'id' AS name, CAST(c_custkey AS VARCHAR) AS value FROM customer
    UNION ALL SELECT c_custkey, 'name', c_name FROM customer
    UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer""",
    name="csv_to_map",
)
def csv_to_map_query(spark, sf_dir):
    """A header shorter than the record: the rest of the record is cut off."""
    columns = ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"]
    lines = csv_format(table(spark, sf_dir, "customer").select(*columns), columns)
    parsed = csv_parse(lines, "line", on_error="stop")
    mapped = csv_to_map(parsed, header=["id", "name", "segment"])
    return mapped.select("c_custkey", F.explode("record").alias("name", "value"))


@query("SELECT doc_id, text, lang, source FROM documents", name="csv_files")
def csv_files_query(spark, sf_dir):
    """Documents written as CSV files with a byte order mark and header, and read
    back record by record."""
    path = scratch_path(spark, "csv")
    csv_write(
        table(spark, sf_dir, "documents").select(*_DOCUMENT_COLUMNS),
        path,
        _DOCUMENT_COLUMNS,
        line_end="\r\n",
        bom=True,
        header=True,
    )
    rows = csv_scan(spark, path, on_error="stop").where("line > 1")
    mapped = csv_to_map(rows, header=_DOCUMENT_COLUMNS)
    value = {c: F.col("record")[c].alias(c) for c in _DOCUMENT_COLUMNS}
    return mapped.select(*value.values()).withColumn("doc_id", F.col("doc_id").cast("bigint"))


@query(
    """SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name AS name FROM nation""",
)
def csv_header_row(spark, sf_dir):
    """The first record names the fields of all others."""
    nations = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS at", "cast(n_nationkey as string) AS k", "n_name AS name")
    header = spark.sql("SELECT -1 AS at, 'key' AS k, 'nation' AS name")
    lines = csv_format(nations.unionByName(header), ["k", "name"])
    mapped = csv_to_map(csv_parse(lines, "line", on_error="stop"), order="at")
    return mapped.select(F.col("record")["key"].alias("k"), F.col("record")["nation"].alias("name"))


def _bad_lines(spark, sf_dir):
    """Parts as CSV lines, some broken in ways that depend on the part."""
    lines = csv_format(table(spark, sf_dir, "part"), _PART_COLUMNS)
    broken = """case p_size % 7 when 1 then concat(line, '\\\\') when 2 then concat(line, ',"open')
        when 3 then concat(line, ',"a"b') when 4 then concat(line, ',\\\\x') else line end"""
    return lines.select("p_partkey", "p_size", F.expr(broken).alias("line"))


_REASON = """CASE p_size % 7 WHEN 1 THEN 'no_character_after_escape' WHEN 2 THEN 'unterminated_quote'
  WHEN 3 THEN 'delimiter_expected' WHEN 4 THEN 'wrong_escape' END"""


@query("SELECT p_partkey, p_name FROM part WHERE p_size % 7 NOT IN (1, 2, 3, 4)")
def error_policy_skip(spark, sf_dir):
    good = csv_parse(_bad_lines(spark, sf_dir), "line", on_error="skip")
    return good.select("p_partkey", F.get("fields", F.lit(1)).alias("p_name"))


@query(
    f"""WITH l AS (SELECT p_partkey, p_size, length({_line(_PART_COLUMNS)}) AS n FROM part)
    SELECT p_partkey, {_REASON} AS reason,
      CAST(n + CASE p_size % 7 WHEN 1 THEN 0 WHEN 2 THEN 6 WHEN 3 THEN 4 ELSE 1 END AS INTEGER) AS position
    FROM l WHERE p_size % 7 IN (1, 2, 3, 4)"""
)
def error_policy_dead_letter(spark, sf_dir):
    _, bad = csv_parse(_bad_lines(spark, sf_dir), "line", on_error="dead_letter")
    return bad.select("p_partkey", "error.reason", "error.position")


# --- markup ------------------------------------------------------------------
# A document here is the text of one row, which bounds it: rows_per_chunk=0.

_TOKENS = r"""tokens AS (
  SELECT page_id, CAST(i AS BIGINT) AS i, list[i] AS token FROM (
    SELECT page_id, list, unnest(range(1, len(list) + 1)) AS i FROM (
      SELECT page_id, regexp_extract_all(html,
        '(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<![^>]*>|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|</[^>]+>|<[\p{L}_:](?:[^>"'']|"[^"]*"|''[^'']*'')*>|<[\p{L}_:][^>]*>|[^<]+|<') AS list
      FROM pages))),
  named AS (SELECT *, regexp_extract(token, '^</?\s*([^\s/>]+)', 1) AS name,
    regexp_matches(token, '(?s)^<(script|style)\b.*</') AS raw FROM tokens),
  ev AS (
    SELECT page_id, i, 1 AS sub, 'start_element' AS kind, name, NULL AS text, token FROM named WHERE regexp_matches(token, '^<[\p{L}_:]')
    UNION ALL SELECT page_id, i, 2, 'characters', NULL, regexp_extract(token, '(?s)^<[^>]*>(.*)</[^<]*$', 1), token FROM named
      WHERE raw AND regexp_extract(token, '(?s)^<[^>]*>(.*)</[^<]*$', 1) <> ''
    UNION ALL SELECT page_id, i, CASE WHEN raw AND regexp_extract(token, '(?s)^<[^>]*>(.*)</[^<]*$', 1) <> '' THEN 3 ELSE 2 END,
      'end_element', name, NULL, token FROM named
      WHERE raw OR (regexp_matches(token, '^<[\p{L}_:]') AND (token LIKE '%/>' OR lower(name) IN
        ('area','base','br','col','embed','hr','img','input','link','meta','param','source','track','wbr')))
    UNION ALL SELECT page_id, i, 1, 'end_element', name, NULL, token FROM named WHERE token LIKE '</%'
    UNION ALL SELECT page_id, i, 1, 'comment', NULL, token[5:length(token) - 3], token FROM named WHERE token LIKE '<!--%'
    UNION ALL SELECT page_id, i, 1, 'characters', NULL,
      replace(replace(replace(replace(replace(token, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&amp;', '&'), token
      FROM named WHERE (token NOT LIKE '<%' OR token = '<') AND regexp_matches(token, '\S'))"""


def _page_events(spark, sf_dir, **options):
    return markup_events(table(spark, sf_dir, "pages"), "page_id", "html", html=True, **options)


@query(
    f"WITH {_TOKENS} SELECT page_id, (i - 1) * 8 + sub AS seq, kind, name, text FROM ev", name="markup_events"
)
def markup_events_query(spark, sf_dir):
    return _page_events(spark, sf_dir).drop("attrs")


@query(
    rf"""WITH {_TOKENS}, a AS (
      SELECT page_id, (i - 1) * 8 + 1 AS seq,
        unnest(regexp_extract_all(token, '([^\s"''<>/=]+)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)')) AS pair
      FROM (SELECT page_id, i, regexp_extract(token, '^<[^\s/>]+([^>]*)>', 1) AS token FROM ev WHERE kind = 'start_element'))
    SELECT page_id, seq, regexp_extract(pair, '^([^\s"''<>/=]+)', 1) AS name,
      replace(regexp_replace(regexp_extract(pair, '=\s*(.*)$', 1), '^["''](.*)["'']$', '\1'), '&amp;', '&') AS value FROM a"""
)
def markup_attributes(spark, sf_dir):
    events = _page_events(spark, sf_dir).where("kind = 'start_element'")
    return events.select("page_id", "seq", F.explode("attrs").alias("name", "value"))


@query(
    f"""WITH {_TOKENS}, t AS (
      SELECT page_id, name, regexp_matches(token, '^<[^/]') AS opens, ev.kind FROM ev WHERE kind IN ('start_element', 'end_element')),
    p AS (SELECT page_id, name, sum(CASE kind WHEN 'start_element' THEN 1 ELSE -1 END) AS balance FROM t GROUP BY ALL)
    SELECT page_id, sum(abs(balance)) = 0 AS well_formed FROM p GROUP BY page_id"""
)
def markup_well_formed(spark, sf_dir):
    return well_formed(_page_events(spark, sf_dir), "page_id", rows_per_chunk=0)


#: Kinds of events that are no characters.
_NO_TEXT = ["start_element", "end_element", "cdata", "comment", "processing_instruction", "error"]


def _order_documents(spark, sf_dir):
    """One XML document per order, its line items inside.  Partitions are as many as the session asks for:
    their rows are few for Spark's merging of small ones, and are much work."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
        .repartition(tasks, "l_orderkey")
        .withColumn("at", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(F.struct("at", "l_returnflag", "l_quantity"))).alias("items"))
    )
    item = lambda i: F.concat(
        F.lit("<item><flag>"), i["l_returnflag"], F.lit('</flag><qty unit="pc">'), i["l_quantity"].cast("string"), F.lit("</qty></item>")
    )
    chunk = lambda i: F.concat(F.lit("<![CDATA["), i["l_returnflag"], F.lit("]]>&amp;"))
    text = F.concat(
        F.lit('<?xml version="1.0"?>\n<doc id="'),
        F.col("l_orderkey").cast("string"),
        F.lit('">\n <elem>'),
        F.array_join(F.transform("items", item), "\n "),
        F.lit("</elem><other><item>no</item></other><flags>"),
        F.array_join(F.transform("items", chunk), ""),
        F.lit("</flags></doc>"),
    )
    return lines.select(F.col("l_orderkey").alias("doc_id"), text.alias("xml"))


@query(
    """SELECT l_orderkey AS doc_id, l_returnflag AS text, count(*) AS n FROM lineitem GROUP BY ALL
    UNION ALL SELECT l_orderkey, CAST(l_quantity AS VARCHAR), count(*) FROM lineitem GROUP BY ALL""",
    name="subslice",
)
def subslice_query(spark, sf_dir):
    inside = subslice_text(_order_documents(spark, sf_dir), "doc_id", "xml", ["doc", "elem", "item"], attributes=False, kinds=["characters"])
    return inside.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT l_orderkey AS doc_id, 'start_element' AS kind, 'flag' AS name, count(*) AS n FROM lineitem GROUP BY 1
    UNION ALL SELECT l_orderkey, 'end_element', 'flag', count(*) FROM lineitem GROUP BY 1
    UNION ALL SELECT l_orderkey, 'start_element', 'qty', count(*) FROM lineitem GROUP BY 1
    UNION ALL SELECT l_orderkey, 'end_element', 'qty', count(*) FROM lineitem GROUP BY 1"""
)
def subslice_tags(spark, sf_dir):
    inside = subslice_text(_order_documents(spark, sf_dir), "doc_id", "xml", ["doc", "elem", "item"], attributes=False, kinds=_NO_TEXT)
    return inside.groupBy("doc_id", "kind", "name").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT l_orderkey AS doc_id, string_agg(l_returnflag || '&', '' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS text
    FROM lineitem GROUP BY 1""",
    name="coalesce_text",
)
def coalesce_text_query(spark, sf_dir):
    merged = subslice_text(_order_documents(spark, sf_dir), "doc_id", "xml", ["doc", "flags"], max_text=10_000)
    return merged.select("doc_id", "text")


@query(
    f"""WITH {_TOKENS}, t AS (
      SELECT page_id, i, sub, kind, name, text,
        sum(CASE kind WHEN 'start_element' THEN 1 WHEN 'end_element' THEN -1 ELSE 0 END) OVER w AS depth
      FROM ev WINDOW w AS (PARTITION BY page_id ORDER BY i, sub)),
    l AS (
      SELECT *, last_value(CASE WHEN kind = 'start_element' AND depth = 1 THEN name END IGNORE NULLS) OVER w AS first,
        last_value(CASE WHEN kind = 'start_element' AND depth = 2 THEN name END IGNORE NULLS) OVER w AS second
      FROM t WINDOW w AS (PARTITION BY page_id ORDER BY i, sub))
    SELECT page_id, (i - 1) * 8 + sub AS seq, kind, name, text FROM l
    WHERE first = 'html' AND second = 'body'
      AND CASE kind WHEN 'start_element' THEN depth > 2 WHEN 'end_element' THEN depth + 1 > 2 ELSE depth >= 2 END"""
)
def page_bodies(spark, sf_dir):
    """Events inside the body of every page."""
    inside = subslice_text(table(spark, sf_dir, "pages"), "page_id", "html", ["html", "body"], html=True)
    return inside.drop("attrs")


@query(
    """WITH d AS (SELECT DISTINCT l_orderkey AS doc_id FROM lineitem)
    SELECT doc_id, 'start_document' AS kind, 0 + 8 * 2 AS seq FROM d
    UNION ALL SELECT l_orderkey, 'end_document',
      8 * (11 * count(*) + 12) + 7 FROM lineitem GROUP BY 1""",
)
def markup_documents(spark, sf_dir):
    """Where documents start and end in a text."""
    events = markup_events(_order_documents(spark, sf_dir), "doc_id", "xml", documents=True)
    return events.where("kind in ('start_document', 'end_document')").select("doc_id", "kind", "seq")

"""CSV files to records, in parallel also where quoted fields span lines.

A line break ends a record only outside quotes, and whether a line starts inside
quotes depends on everything before it.  Each line alone tells what it does to
that state: keep it, flip it, or set it whatever it was.  So the state before a
line is the last setting plus the flips since.  These are running values: inside
a piece of a split over its lines, then over one row per piece
(:mod:`flowtables.plans.ordered`).  No file is read by one task, and the files are
read twice: for the summaries and for the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowtables.functions.csv import DEFAULT, Dialect, _quoted
from flowtables.operators.csv_records import csv_parse
from flowtables.operators.policy import with_error_policy
from flowtables.plans.ordered import CHUNK, arrange_by
from flowtables.plans.pin import pin

#: Lines of a split that are framed at a time; a split of long lines is more than one task should read.
LINES_PER_CHUNK = 4096

# Byte order marks of other encodings.
BOMS_REJECTED = ("FEFF", "FFFE", "0000FEFF", "FFFE0000")


def csv_scan(
    spark: SparkSession,
    path: str,
    dialect: Dialect = DEFAULT,
    multiline: bool = True,
    on_error: str | None = None,
    line_end: str = "\n",
) -> DataFrame:
    """Records of CSV files: ``file``, ``line`` (where the record starts, from 1),
    ``record``, ``fields`` and ``error``.

    Lines end with LF, CR or CRLF; a UTF-8 byte order mark is skipped, a file with
    a UTF-16 or UTF-32 mark fails the query.  A record may have any number of lines.
    Files are cut at LF; say ``line_end="\\r"`` for files that hold CR only, so that
    they are cut there, and a bad record does not take its neighbours along.
    An opening quote that no other one closes makes the rest of its file an error: one
    row for each of these lines, with reason ``unterminated_quote``.  With
    ``multiline=False`` no field spans lines, which saves the shuffle that brings
    lines of a record together (``line`` is null then).
    """
    if line_end not in ("\n", "\r"):
        raise ValueError("line_end must be a line feed or a carriage return")
    lines = _lines(spark, path, line_end)
    if not multiline:
        framed = lines.select(
            "file",
            F.lit(None).cast("bigint").alias("line"),
            F.col("text").alias("record"),
            F.lit(False).alias("_tail"),
        )
    else:
        framed = _frame(lines, dialect, line_end)
    pieces = framed
    if line_end == "\n":
        pieces = framed.withColumn("record", F.explode(_split_at_cr(F.col("record"), dialect)))
    parsed = csv_parse(pieces, "record", dialect)
    unclosed = F.struct(F.lit("unterminated_quote").alias("reason"), F.length("record").alias("position"))
    parsed = parsed.withColumns(
        {
            "error": F.when(F.col("_tail"), unclosed).otherwise(F.col("error")),
            "fields": F.when(~F.col("_tail"), F.col("fields")),
        }
    ).drop("_tail")
    return parsed if on_error is None else with_error_policy(parsed, "error", on_error)


def _lines(spark: SparkSession, path: str, line_end: str) -> DataFrame:
    """Lines in file order: ``file``, ``block``, ``at`` and ``text``, which keeps
    a CR before an LF.  The reader takes a UTF-8 byte order mark off at offset 0;
    U+FEFF elsewhere is text.  The rejected marks hold bytes that no UTF-8 text has."""
    raw = spark.read.option("lineSep", line_end).text(path)
    start = F.col("_metadata.file_block_start")
    text = F.col("value")
    head = F.hex(F.substring(F.col("value").cast("binary"), 1, 4))
    wrong = F.lit(False)
    for bom in BOMS_REJECTED:
        wrong = wrong | head.startswith(bom)
    checked = F.when(
        (start == 0) & wrong, F.raise_error(F.lit("only UTF-8 files can be read, found another byte order mark")).cast("string")
    ).otherwise(text)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        start.alias("block"),
        F.monotonically_increasing_id().alias("at"),
        checked.alias("text"),
    )


def _opens(text: Column, dialect: Dialect) -> Column:
    """True if a line that starts outside quotes ends inside."""
    d, q = _quoted(dialect.delimiter), _quoted(dialect.quote)
    field = dialect.field.removeprefix(d)
    return F.concat(F.lit(dialect.delimiter), text).rlike(
        rf"^(?:[{d}\r]{field})*+[{d}\r]{q}{dialect.quoted_body}\z"
    )


def _frame(lines: DataFrame, dialect: Dialect, line_end: str) -> DataFrame:
    q, e, d = _quoted(dialect.quote), _quoted(dialect.escape), _quoted(dialect.delimiter)
    text = F.col("text")
    has_quote = text.contains(dialect.quote)
    # A line that starts inside quotes: the rest of the quoted field, then, if
    # the quote closes, what a line does that starts outside.
    body = rf"^{dialect.quoted_body}"
    stays = text.rlike(rf"{body}\z")
    tail = F.regexp_replace(text, rf"{body}{q}", "")
    tail_opens = F.when(
        tail.rlike(rf"^[{d}\r]"),
        _opens(F.substring(tail, F.lit(2), F.length(tail)), dialect),
    ).otherwise(False)
    from_outside = F.when(has_quote, _opens(text, dialect)).otherwise(False)
    # Without a quote, a line stays inside unless it breaks an escape.
    has_escape = text.contains(dialect.escape)
    from_inside = (
        F.when(~has_quote & ~has_escape, True).when(stays, True).when(has_quote, tail_opens).otherwise(False)
    )
    lines = pin(lines, _out=from_outside, _in=from_inside)
    # The lower bits of ``at`` count the rows of a task, which reads its splits one after the other.
    part = F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / LINES_PER_CHUNK)
    rows = arrange_by(lines, "file", ("block", "at"), F.struct("block", part.alias("part")))
    w = Window.partitionBy(*rows.group).orderBy(*rows.order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)

    # Inside a piece of a block, for both states it may begin in: the state before each line
    # and the last line so far that starts a record.
    flip = (F.col("_out") & ~F.col("_in")).cast("int")
    setting = F.when(
        F.col("_out") == F.col("_in"), F.struct(F.col("_out").cast("int").alias("v"), F.col("_flips").alias("f"))
    )
    rows = rows.map(
        lambda df: df.withColumns({"_n": F.row_number().over(w), "_flips": F.coalesce(F.sum(flip).over(w), F.lit(0))})
        .withColumn("_set", F.last(setting, ignorenulls=True).over(before))
        .withColumn("_seen", F.col("_flips") - flip)
        .withColumns({f"_s{h}": _state(h, F.col("_set"), F.col("_seen")) for h in (0, 1)})
        .withColumns({f"_r{h}": F.max(F.when(F.col(f"_s{h}") == 0, F.col("_n"))).over(w) for h in (0, 1)})
    )
    # Pieces one after the other: what state they begin in, which line is first,
    # and where the record that goes on in them has started.
    last = F.struct(*rows.order)
    after = {h: F.when(F.col(f"_s{h}") == 1, F.col("_in")).otherwise(F.col("_out")).cast("int") for h in (0, 1)}
    blocks = rows.summary(
        _lines=F.count(F.lit(1)),
        **{f"_e{h}": F.max_by(after[h], last) for h in (0, 1)},
        **{f"_t{h}": F.max(f"_r{h}") for h in (0, 1)},
    )
    by_block = Window.partitionBy("file").orderBy(CHUNK)
    so_far, upto = by_block.rowsBetween(Window.unboundedPreceding, -1), by_block.rowsBetween(Window.unboundedPreceding, 0)
    block_flip = ((F.col("_e0") == 1) & (F.col("_e1") == 0)).cast("int")
    block_set = F.when(
        F.col("_e0") == F.col("_e1"), F.struct(F.col("_e0").alias("v"), F.col("_bf").alias("f"))
    )
    carry = (
        blocks.withColumns(
            {
                "_first": F.coalesce(F.sum("_lines").over(so_far), F.lit(0)),
                "_bf": F.sum(block_flip).over(upto),
            }
        )
        .withColumn("_bset", F.last(block_set, ignorenulls=True).over(so_far))
        .withColumn("_begin", _state(0, F.col("_bset"), F.col("_bf") - block_flip))
        .withColumn("_t", F.col("_first") + F.when(F.col("_begin") == 0, F.col("_t0")).otherwise(F.col("_t1")))
        .withColumn("_open", F.max("_t").over(so_far))
        # a file that ends inside quotes: its last record has no end
        .withColumn("_end", F.when(F.col("_begin") == 0, F.col("_e0")).otherwise(F.col("_e1")))
        .withColumn("_end", F.max_by("_end", CHUNK).over(Window.partitionBy("file")))
        .withColumn("_unclosed", F.when(F.col("_end") == 1, F.max("_t").over(Window.partitionBy("file"))))
        .select(*rows.group, "_first", "_begin", "_open", "_unclosed")
    )
    started = F.col("_first") + F.when(F.col("_begin") == 0, F.col("_r0")).otherwise(F.col("_r1"))
    numbered = rows.with_carry(carry).select(
        "file",
        F.coalesce(started, F.col("_open")).alias("line"),
        (F.col("_first") + F.col("_n")).alias("_at"),
        "text",
        "_unclosed",
    )
    tail = F.coalesce(F.col("line") == F.col("_unclosed"), F.lit(False))
    return (
        numbered.withColumn("_tail", tail)
        .withColumn("line", F.when(F.col("_tail"), F.col("_at")).otherwise(F.col("line")))
        .groupBy("file", "line", "_tail")
        .agg(F.sort_array(F.collect_list(F.struct("_at", "text"))).alias("_lines"))
        .select("file", "line", F.array_join("_lines.text", line_end).alias("record"), "_tail")
    )


def _state(begin: int, setting: Column, flips: Column) -> Column:
    """1 inside quotes, 0 outside: the last setting and the flips since then, or
    the state at the beginning and all flips."""
    since = F.when(setting.isNull(), F.lit(begin) + flips).otherwise(setting["v"] + flips - setting["f"])
    return F.pmod(since, F.lit(2)).cast("int")


def _split_at_cr(record: Column, dialect: Dialect) -> Column:
    """Records inside one LF-framed text that a lone CR outside quotes ends."""
    d, q = _quoted(dialect.delimiter), _quoted(dialect.quote)
    text = F.regexp_replace(record, r"\r\z", "")
    field = dialect.field.removeprefix(d)
    marked = F.concat(F.lit("\r"), text)
    whole = marked.rlike(rf"^(?:[{d}\r]{field})++\z")
    one = rf"\r({field}(?:{d}{field})*+)"
    pieces = F.regexp_extract_all(marked, F.lit(one), 1)
    return F.when((text.contains("\r")) & whole, pieces).otherwise(F.array(text))

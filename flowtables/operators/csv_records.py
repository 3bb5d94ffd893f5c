"""CSV records in a column: parsing, pairing with a header, formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtables.functions import csv
from flowtables.functions.csv import DEFAULT, Dialect
from flowtables.operators.policy import with_error_policy
from flowtables.plans.pin import pin


def csv_parse(
    df: DataFrame, record: str, dialect: Dialect = DEFAULT, on_error: str | None = None
) -> DataFrame:
    """Parse one record per row into ``fields``.

    A bad record has null ``fields`` and an ``error``: a struct of ``reason`` and
    ``position``, the offset in the record from 0.  Reasons: ``wrong_escape`` (only
    escape, delimiter or, in quotes, the quote may follow),
    ``no_character_after_escape``, ``unterminated_quote``, ``delimiter_expected``
    (after a closing quote), ``line_end_in_record``.  ``on_error`` applies an error
    policy to them (``stop``, ``skip`` or ``dead_letter``).
    """
    prepared, raw, rest = F.col("_prepared"), F.col("_raw"), F.col("_rest")
    bad, good = ~F.col("_covered"), F.col("_good")
    closed = F.col("_after").startswith(dialect.quote)
    position = good + F.col("_skipped") - 1 + F.when(closed, 1).otherwise(0)
    text = pin(df, _text=csv.strip_line_end(F.col(record)))
    leads = F.col("_text").startswith(dialect.escape)
    framed = pin(text, _prepared=csv.prepared(F.col("_text"), dialect), _led=leads).drop("_text")
    fields = pin(framed, _raw=csv.raw_fields(prepared, dialect))
    parsed = (
        pin(fields, _covered=csv.is_covered(prepared, raw, dialect))
        # Only bad records are looked at again, for what is wrong with them.
        .withColumn("_good", F.when(bad, csv.good_length(prepared, dialect)))
        .withColumn("_rest", F.when(bad, F.substring(prepared, good + 1, F.length(prepared))))
        .withColumn("_skipped", csv.skipped_length(rest, dialect))
        .withColumn("_after", F.substring(rest, F.col("_skipped") + 1, F.length(rest)))
        .withColumn(
            "error",
            F.when(
                bad,
                F.struct(
                    csv.error_reason(F.col("_after"), dialect).alias("reason"),
                    position.cast("int").alias("position"),
                ),
            ),
        )
        .withColumn("fields", F.when(~bad, csv.clean_fields(raw, prepared, F.col("_led"), dialect)))
        .drop("_prepared", "_led", "_raw", "_covered", "_good", "_rest", "_skipped", "_after")
    )
    return parsed if on_error is None else with_error_policy(parsed, "error", on_error)


def csv_to_map(
    df: DataFrame,
    header: Sequence[str] | None = None,
    fields: str = "fields",
    order: str | Sequence[str] | None = None,
    name: str = "record",
    by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Pair header names with fields; the longer of the two is cut off.

    ``header`` is given, or the first row by ``order`` is the header: it is found
    by an aggregate and removed from the rows.  With ``by`` (as ``file`` of
    ``csv_scan``) each of its values has a header of its own.
    """
    if header is not None:
        names: Column = F.array(*[F.lit(h) for h in header])
        return df.withColumn(name, _zip_map(names, F.col(fields)))
    if order is None:
        raise ValueError("give a header, or the order that makes one row the first")
    order = [order] if isinstance(order, str) else list(order)
    at = F.struct(*order)
    if by is not None:
        keys = [by] if isinstance(by, str) else list(by)
        headers = df.groupBy(*keys).agg(F.min(F.struct(at.alias("at"), F.col(fields).alias("names"))).alias("_header"))
        headers = headers.withColumnsRenamed({k: f"_by_{k}" for k in keys})
        paired = df.join(headers, [F.col(k).eqNullSafe(F.col(f"_by_{k}")) for k in keys])
        paired = paired.where(at > F.col("_header.at"))
        return paired.withColumn(name, _zip_map(F.col("_header.names"), F.col(fields))).select(*df.columns, name)
    # One value by construction: the first row.
    first = df.agg(F.min(F.struct(at.alias("at"), F.col(fields).alias("names")))).scalar()
    return df.where(at > first["at"]).withColumn(name, _zip_map(first["names"], F.col(fields)))


def _zip_map(names: Column, fields: Column) -> Column:
    """A repeated name fails the query."""
    n = F.least(F.size(names), F.size(fields))
    return F.map_from_arrays(F.slice(names, F.lit(1), n), F.slice(fields, F.lit(1), n))


def csv_format(
    df: DataFrame,
    columns: Sequence[str],
    dialect: Dialect = DEFAULT,
    always: bool = False,
    name: str = "line",
) -> DataFrame:
    """Add a CSV line (without its end) made of ``columns``."""
    line = csv.format_record([F.col(c) for c in columns], dialect, always)
    return df.withColumn(name, line)

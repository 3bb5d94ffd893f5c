"""Typed message bodies."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def extract_json(df: DataFrame, body: str, schema: str, name: str = "value") -> DataFrame:
    """Parse a JSON body, text or UTF-8 bytes, to ``schema`` (a DDL string).  A
    body that is no such JSON gives null."""
    column = F.col(body)
    if dict(df.dtypes)[body] == "binary":
        column = F.try_validate_utf8(column.cast("string"))
    return df.withColumn(name, F.from_json(column, schema))


def write_json(df: DataFrame, name: str = "body", columns: Sequence[str] | None = None, binary: bool = True) -> DataFrame:
    """Pack ``columns`` (all, if not given) into one JSON body, UTF-8 bytes or text, in place of
    them; fields that are null are left out.  :func:`extract_json` reads it again."""
    columns = list(columns or df.columns)
    body = F.to_json(F.struct(*columns))
    rest = [c for c in df.columns if c not in columns and c != name]
    return df.select(*rest, (F.encode(body, "UTF-8") if binary else body).alias(name))


def write_body(df: DataFrame, writer: Callable[[DataFrame], Column], columns: Sequence[str], name: str = "body") -> DataFrame:
    """Like :func:`write_json` with any column expression as writer."""
    rest = [c for c in df.columns if c not in columns and c != name]
    return df.select(*rest, writer(df).alias(name))


def extract(df: DataFrame, body: str, extractor: Callable[[Column], Column], name: str = "value") -> DataFrame:
    """Like :func:`extract_json` with any column expression as extractor."""
    return df.withColumn(name, extractor(F.col(body)))

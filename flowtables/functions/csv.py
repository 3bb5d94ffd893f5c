"""CSV records as column expressions.

Dialect: a quote opens a quoted field only at the field's start; inside quotes a
doubled quote or escape + quote is a quote and a doubled escape is an escape; in
an unquoted field the escape may precede the delimiter or itself.  Anything else
after an escape is an error.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands for an escape at the start of a record, which is an ordinary character.
_LEADING_ESCAPE = "\ue000"


def _quoted(char: str) -> str:
    """The character as a regular expression, inside or outside a class."""
    return re.escape(char) if char.isascii() and not char.isalnum() else char


@dataclass(frozen=True)
class Dialect:
    delimiter: str = ","
    quote: str = '"'
    escape: str = "\\"

    def __post_init__(self):
        chars = (self.delimiter, self.quote, self.escape)
        if any(len(c) != 1 for c in chars) or len(set(chars)) != 3 or set(chars) & {"\r", "\n"}:
            raise ValueError("delimiter, quote and escape must be three different characters")

    # Possessive quantifiers: a long field must not cost stack or backtracking.

    @property
    def quoted_body(self) -> str:
        q, e = _quoted(self.quote), _quoted(self.escape)
        return rf"[^{q}{e}]*+(?:(?:{q}{q}|{e}[{q}{e}])[^{q}{e}]*+)*+"

    @property
    def plain_body(self) -> str:
        d, e = _quoted(self.delimiter), _quoted(self.escape)
        return rf"[^{d}{e}\r\n]*+(?:{e}[{e}{d}][^{d}{e}\r\n]*+)*+"

    @property
    def field(self) -> str:
        """One field after its delimiter; a closing quote must end the field."""
        d, q = _quoted(self.delimiter), _quoted(self.quote)
        return rf"{d}(?:{q}{self.quoted_body}{q}(?=[{d}\r\n]|\z)|(?!{q}){self.plain_body})"

    @property
    def needs_quotes(self) -> str:
        return rf"[\r\n{_quoted(self.delimiter)}{_quoted(self.quote)}{_quoted(self.escape)}]"


DEFAULT = Dialect()


def format_field(field: Column, dialect: Dialect = DEFAULT, always: bool = False) -> Column:
    """A field as it stands in a line: quoted if it has to be or ``always``, with
    quotes and escapes doubled; null is empty."""
    q, e = dialect.quote, dialect.escape
    field = F.coalesce(field.cast("string"), F.lit(""))
    doubled = F.replace(F.replace(field, F.lit(e), F.lit(e + e)), F.lit(q), F.lit(q + q))
    quoted = F.concat(F.lit(q), doubled, F.lit(q))
    return quoted if always else F.when(field.rlike(dialect.needs_quotes), quoted).otherwise(field)


def format_record(fields: list[Column], dialect: Dialect = DEFAULT, always: bool = False) -> Column:
    """A line without its end."""
    return F.concat_ws(dialect.delimiter, *[format_field(f, dialect, always) for f in fields])


def format_array(fields: Column, dialect: Dialect = DEFAULT, always: bool = False) -> Column:
    """Like :func:`format_record` for an array of strings of any length."""
    return F.array_join(
        F.transform(fields, lambda f: format_field(f, dialect, always)), dialect.delimiter
    )


def strip_line_end(record: Column) -> Column:
    cut = F.when(record.endswith("\r\n"), 2).when(record.endswith("\n") | record.endswith("\r"), 1)
    return F.when(cut.isNull(), record).otherwise(F.substring(record, F.lit(1), F.length(record) - cut))


# The steps of parsing.  Each step is used several times by the next ones, so the
# caller gives every step a column of its own instead of nesting them.


def prepared(record: Column, dialect: Dialect) -> Column:
    """The record with a delimiter before every field, also the first."""
    rest = F.substring(record, F.lit(2), F.length(record))
    led = F.concat(F.lit(dialect.delimiter + _LEADING_ESCAPE), rest)
    plain = F.concat(F.lit(dialect.delimiter), record)
    return F.when(record.startswith(dialect.escape), led).otherwise(plain)


def good_length(prepared: Column, dialect: Dialect) -> Column:
    """Length of the longest start of a prepared record made of good fields."""
    return F.length(F.regexp_extract(prepared, rf"^(?:{dialect.field})*+", 0))


def raw_fields(prepared: Column, dialect: Dialect) -> Column:
    """Fields of a prepared record with their quotes and escapes."""
    d, q = _quoted(dialect.delimiter), _quoted(dialect.quote)
    field = rf"{d}({q}{dialect.quoted_body}{q}|(?!{q}){dialect.plain_body})"
    return F.regexp_extract_all(prepared, F.lit(field), F.lit(1))


def is_covered(prepared: Column, raw: Column, dialect: Dialect) -> Column:
    """True if the fields found make up the whole record, so that it is good."""
    return F.length(F.array_join(raw, dialect.delimiter)) + 1 == F.length(prepared)


def clean_fields(raw: Column, prepared: Column, led: Column, dialect: Dialect) -> Column:
    """Fields without quotes and escapes; ``led`` says whether the record began
    with an escape."""
    d, q, e = (_quoted(c) for c in (dialect.delimiter, dialect.quote, dialect.escape))

    def unquote(f: Column) -> Column:
        return F.when(f.startswith(dialect.quote), F.substring(f, F.lit(2), F.length(f) - 2)).otherwise(f)

    def unescape(f: Column, i: Column) -> Column:
        quoted = F.get(raw, i).startswith(dialect.quote)
        in_quotes = F.regexp_replace(f, rf"{q}({q})|{e}([{q}{e}])", "$1$2")
        plain = F.regexp_replace(f, rf"{e}([{e}{d}])", "$1")
        special = (f.contains(dialect.quote)) | (f.contains(dialect.escape))
        return F.when(~special, f).when(quoted, in_quotes).otherwise(plain)

    def clean(fields: Column) -> Column:
        return F.transform(F.transform(fields, unquote), unescape)

    has_quotes = prepared.contains(dialect.quote)
    has_escapes = prepared.contains(dialect.escape)
    cleaned = F.when(has_quotes | has_escapes, clean(raw)).otherwise(raw)
    put_back = F.transform(
        cleaned,
        lambda f, i: F.when(i == 0, F.concat(F.lit(dialect.escape), F.substring(f, F.lit(2), F.length(f)))).otherwise(f),
    )
    return F.when(led, put_back).otherwise(cleaned)


def skipped_length(rest: Column, dialect: Dialect) -> Column:
    """How much of the bad rest of a record is the good start of a quoted field."""
    d, q = _quoted(dialect.delimiter), _quoted(dialect.quote)
    return F.length(F.regexp_extract(rest, rf"^{d}{q}{dialect.quoted_body}", 0))


def error_reason(after: Column, dialect: Dialect) -> Column:
    """What is wrong at the first character that does not fit."""
    return (
        F.when(after == dialect.escape, "no_character_after_escape")
        .when(after.startswith(dialect.escape), "wrong_escape")
        .when(after == "", "unterminated_quote")
        .when(after.rlike(r"^[\r\n]"), "line_end_in_record")
        .otherwise("delimiter_expected")
    )

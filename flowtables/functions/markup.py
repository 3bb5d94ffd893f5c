"""Markup text to tokens, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TAG_BODY = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_RAW_TEXT = r"(?i:<(script|style)\b[^>]*>.*?</\1\s*>)|"
#: Declarations that a document type may hold between brackets.
_SUBSET = r"""\[(?:<!--.*?-->|<\?.*?\?>|[^\]"'<]++|"[^"]*+"|'[^']*+'|<)*+\]"""
_DECLARATION = rf"""<!(?:[^>\["']++|"[^"]*+"|'[^']*+'|{_SUBSET})*+>"""
#: A comment, CDATA section or instruction without an end takes the rest of the text.
_TOKEN = (
    r"(?s)<!--.*?(?:-->|\z)|<!\[CDATA\[.*?(?:\]\]>|\z)|<\?.*?(?:\?>|\z)|"
    + _DECLARATION + r"|<![^>]*>|{raw}</[^>]+>|"
    r"<[\p{{L}}_:]" + _TAG_BODY.replace("{", "{{").replace("}", "}}") + r">|<[\p{{L}}_:][^>]*>|[^<]+|<"
)
#: Tokens of XML, and of HTML, where the text of script and style is no markup.
XML_TOKEN = _TOKEN.format(raw="")
HTML_TOKEN = _TOKEN.format(raw=_RAW_TEXT)

_ATTRIBUTE = r"""([^\s"'<>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_NAME = r"^</?\s*([^\s/>]+)"

# HTML elements that have no content and no end tag.
VOID_ELEMENTS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input",
    "link", "meta", "param", "source", "track", "wbr",
)


#: A reference, or text between references.
_REFERENCE = "&(?:#[0-9]+|#x[0-9A-Fa-f]+|lt|gt|quot|apos|amp);|[^&]+|&"
_NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}


def unescape(text: Column) -> Column:
    """Replace the five named XML entities and numeric character references, each
    once: what a reference gives is not read again.  A reference to no character
    stays as it is."""

    def put(piece: Column) -> Column:
        digits = F.regexp_replace(F.regexp_extract(piece, "^&#x?([0-9A-Fa-f]+);$", 1), "^0+", "")
        number = F.when(piece.startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
        code = F.when(F.length(digits).between(1, 7), number)
        good = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.when(good, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        out = F.when(piece.startswith("&#"), F.coalesce(char, piece))
        for entity, value in _NAMED.items():
            out = out.when(piece == entity, value)
        return out.otherwise(piece)

    pieces = F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    return F.when(text.contains("&"), F.array_join(F.transform(pieces, put), "")).otherwise(text)


def local_name(name: Column) -> Column:
    return F.substring_index(name, ":", -1)


def tag_name(token: Column) -> Column:
    return local_name(F.regexp_extract(token, _NAME, 1))


def attribute_body(tag: Column) -> Column:
    return F.regexp_extract(tag, r"(?s)^<[^\s/>]+(.*)$", 1)


def attribute_names(body: Column) -> Column:
    return F.transform(F.regexp_extract_all(body, F.lit(_ATTRIBUTE), F.lit(1)), local_name)


def attribute_values(body: Column) -> Column:
    """Attribute values without quotes."""
    strip = lambda v: F.regexp_replace(v, r"""(?s)^(["'])(.*)\1$""", "$2")
    values = F.transform(F.regexp_extract_all(body, F.lit(_ATTRIBUTE), F.lit(2)), strip)
    return F.when(body.contains("&"), F.transform(values, unescape)).otherwise(values)


def attribute_map(names: Column, values: Column) -> Column:
    """Of a repeated name the first value counts."""
    entries = F.arrays_zip(names.alias("key"), values.alias("value"))
    firsts = F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1)
    return F.map_from_entries(firsts)


def token_kind(token: Column, html: bool) -> Column:
    """What a token is; null for white space, declarations and document types;
    ``error`` for what has a start and no end."""

    def open_ended(start: str, end: str) -> Column:
        closed = token.endswith(end) & (F.length(token) >= len(start) + len(end))
        return token.startswith(start) & ~closed

    kind = (
        F.when(~token.startswith("<"), F.when(token.rlike(r"\S"), "characters"))
        .when(token == "<", "characters")
        .when(open_ended("<!--", "-->") | open_ended("<![CDATA[", "]]>") | open_ended("<?", "?>"), "error")
        .when(token.startswith("</"), "end_element")
        .when(token.startswith("<!--"), "comment")
        .when(token.startswith("<![CDATA["), "cdata")
        .when(token.startswith("<!"), None)
        .when(token.startswith("<?"), F.when(~token.rlike(r"^<\?[xX][mM][lL]\s"), "processing_instruction"))
    )
    if html:
        kind = kind.when(token.rlike(r"(?is)^<(?:script|style)\b.*</"), "raw")
        void = F.lower(F.regexp_extract(token, _NAME, 1)).isin(*VOID_ELEMENTS)
        kind = kind.when(void, "empty")
    return kind.when(token.endswith("/>"), "empty").otherwise("start_element")


def token_name(token: Column, kind: Column) -> Column:
    """Element name, or target of a processing instruction."""
    return F.when(
        kind == "processing_instruction", F.regexp_extract(token, r"^<\?([^\s?]+)", 1)
    ).when(kind.isin("start_element", "end_element", "empty", "raw"), tag_name(token))


def token_text(token: Column, kind: Column) -> Column:
    def inner(left: int, right: int) -> Column:
        return F.substring(token, F.lit(left + 1), F.length(token) - (left + right))

    return (
        F.when(kind == "characters", unescape(token))
        .when(kind == "error", token)
        .when(kind == "comment", inner(4, 3))
        .when(kind == "cdata", inner(9, 3))
        .when(kind == "processing_instruction", F.regexp_extract(token, r"(?s)^<\?\S+\s+(.*)\?>$", 1))
        .when(kind == "raw", F.regexp_extract(token, r"(?s)^<[^>]*>(.*)</[^<]*$", 1))
    )


def start_tag(token: Column, kind: Column) -> Column:
    return F.when(kind == "raw", F.regexp_extract(token, "^<[^>]*>", 0)).when(
        kind.isin("start_element", "empty"), token
    )


def token_events(kind: Column, name: Column, attrs: Column, text: Column) -> Column:
    """Events of one token, as an array: a start and an end for an element without
    content, with the text between them for one with raw text."""

    def event(event_kind, event_name=None, event_attrs=None, event_text=None) -> Column:
        return F.struct(
            (F.lit(event_kind) if isinstance(event_kind, str) else event_kind).alias("kind"),
            (F.lit(None) if event_name is None else event_name).cast("string").alias("name"),
            (F.lit(None) if event_attrs is None else event_attrs).cast("map<string,string>").alias("attrs"),
            (F.lit(None) if event_text is None else event_text).cast("string").alias("text"),
        )

    start = event("start_element", name, attrs)
    end = event("end_element", name)
    return (
        F.when(kind == "empty", F.array(start, end))
        .when((kind == "raw") & (text == ""), F.array(start, end))
        .when(kind == "raw", F.array(start, event("characters", None, None, text), end))
        .otherwise(F.array(event(kind, name, attrs, text)))
    )

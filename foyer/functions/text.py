"""Splitting, trimming and JSON text access with the feed's conventions."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from foyer.schemas import FIELD_SEPARATOR

# What the regex class \s matches, and what a whole-string trim strips
# (every character up to the space).
SPACE_CHARS = " \t\n\x0b\f\r"
TRIM_CHARS = "".join(map(chr, range(33)))


def line_field(line: Column, index: int) -> Column:
    """Field ``index`` of a delimited feed line; NULL where the line is too short."""
    return F.get(F.split(line, FIELD_SEPARATOR), F.lit(index))


def has_tag(line: Column, tag: str) -> Column:
    """Whether field 0 of a line with further fields is ``tag``."""
    return F.startswith(line, F.lit(tag + FIELD_SEPARATOR))


def _tokens(text: Column, pattern: str, delimiters: str) -> Column:
    # A text of delimiters only has no token, the empty text has one empty token, and
    # empty tokens count except at the end. Trimming the end first gives all three; most
    # texts end in something else and are split as they are.
    ends = reduce(or_, (F.endswith(text, F.lit(delimiter)) for delimiter in delimiters))
    kept = F.rtrim(text, F.lit(delimiters))
    none = F.array().cast("array<string>")
    trimmed = F.when(kept == "", none).otherwise(F.split(kept, pattern))
    return F.when(ends, trimmed).otherwise(F.split(text, pattern))


def tokens(text: Column, delimiter: str) -> Column:
    """Tokens between single-character delimiters, trailing empty ones dropped."""
    return _tokens(text, re.escape(delimiter), delimiter)


def space_tokens(text: Column) -> Column:
    """Tokens between single whitespace characters, trailing empty ones dropped."""
    return _tokens(text, "\\s", SPACE_CHARS)


def full_trim(text: Column) -> Column:
    """Strip spaces and control characters at both ends."""
    return F.trim(text, F.lit(TRIM_CHARS))


def unquoted(text: Column) -> Column:
    """The text without any double quote."""
    return F.replace(text, F.lit('"'), F.lit(""))


def json_field(body: Column, name: str) -> Column:
    """A field of a JSON object as text; NULL where the field is absent."""
    return F.get_json_object(body, f"$.{name}")


def json_field_text(body: Column, name: str) -> Column:
    """A field as printed JSON without quotes: a JSON null prints ``null``, absent is NULL."""
    fields = F.from_json(body, "map<string,string>")
    return F.when(
        F.map_contains_key(fields, name), unquoted(F.coalesce(fields[name], F.lit("null")))
    )

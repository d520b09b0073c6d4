"""HTML character references to characters, without leaving the JVM."""

from __future__ import annotations

import html.entities
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The full HTML5 table ships with Python; names with and without the semicolon.
NAMED = html.entities.html5
# Looked up from the front, so the frequent names stand there.
_FREQUENT = ("amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;", "copy;", "middot;", "ndash;", "mdash;", "hellip;", "rsquo;")
_ENTRY, _IS = "\x1e", "\x1f"
_TABLE = "".join(
    f"{_ENTRY}{name}{_IS}{NAMED[name]}" for name in [*_FREQUENT, *(n for n in NAMED if n not in _FREQUENT)]
) + _ENTRY
_LONGEST_VALUE = max(map(len, NAMED.values())) + 1
# Names that count without a semicolon even when more letters follow, longest first.
_BARE = "|".join(sorted((re.escape(n) for n in NAMED if not n.endswith(";")), key=len, reverse=True))


def _cp1252(code: int) -> str:
    """Numbers 128-159 mean the Windows characters; five of them are undefined there."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def _text(value: str) -> str:
    """A SQL literal that needs no escaping; the optimizer folds it to a constant."""
    return f"decode(unhex('{value.encode().hex()}'), 'UTF-8')"


REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

_CODE = """CAST(CASE WHEN r RLIKE '^&#[xX]'
  THEN conv(nullif(regexp_extract(r, '^&#[xX]0*([0-9a-fA-F]{0,8});?$', 1), ''), 16, 10)
  ELSE nullif(regexp_extract(r, '^&#0*([0-9]{0,8});?$', 1), '') END AS BIGINT)"""

# n is NULL for zero and for numbers of more than eight digits.
_NUMBER = f"""CASE
  WHEN n IS NULL OR n > 1114111 OR n BETWEEN 55296 AND 57343 THEN {_text(chr(0xFFFD))}
  WHEN n BETWEEN 128 AND 159 THEN substr({_text("".join(map(_cp1252, range(128, 160))))}, CAST(n AS INT) - 127, 1)
  WHEN n < 32 AND n NOT IN (9, 10, 12, 13) OR n = 127 OR n BETWEEN 64976 AND 65007 OR n & 65534 = 65534 THEN ''
  ELSE decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32') END"""


def _lookup(name: str) -> str:
    key = f"concat({_text(_ENTRY)}, {name}, {_text(_IS)})"
    at = f"locate({key}, names)"
    value = f"substr(names, {at} + length({name}) + 2, {_LONGEST_VALUE})"
    return f"CASE WHEN {at} > 0 THEN substring_index({value}, {_text(_ENTRY)}, 1) END"


_PREFIX = f"regexp_extract(b, {_text(f'^(?:{_BARE})')}, 0)"
# b is the reference without its ampersand, p the longest bare name it starts with.
_NAME = f"""coalesce({_lookup('b')}, transform(array({_PREFIX}),
  p -> CASE WHEN p <> '' THEN concat({_lookup('p')}, substr(b, length(p) + 1)) ELSE concat('&', b) END)[0])"""

_RESOLVE = f"""r -> CASE WHEN startswith(r, '&#') THEN transform(array({_CODE}), n -> {_NUMBER})[0]
  ELSE transform(array(substr(r, 2)), b -> {_NAME})[0] END"""

_UNESCAPE = f"""v -> CASE WHEN contains(v, '&') THEN transform(array({_text(_TABLE)}), names ->
  array_join(zip_with(split(v, {_text(REFERENCE)}), transform(regexp_extract_all(v, {_text(REFERENCE)}, 0), {_RESOLVE}),
    (t, c) -> concat(t, coalesce(c, ''))), ''))[0] ELSE v END"""


def html_unescape(value: Column) -> Column:
    """All numeric and named references; texts without an ampersand pass untouched.

    Written as SQL text: one expression to build, and names hold each
    intermediate result so that none is computed twice.
    """
    return F.get(F.call_function("transform", F.array(value), F.expr(_UNESCAPE)), F.lit(0))

"""Text expressions: trimming, anchored patterns, identifiers, array literals, log masking."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# An identifier holds only these characters, from first to last.
IDENTIFIER_PATTERN = r"\A[a-zA-Z0-9_\-.]+\z"

# Field names masked in log text, and the mask put there.
LOG_SECRET_FIELDS = ("password", "private_key", "client_email")
LOG_MASK = "****"


# The characters that count as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_whitespace(c: Column) -> Column:
    """Strip all Unicode whitespace at both ends (`trim` alone strips spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def normalized(c: Column) -> Column:
    return F.lower(strip_whitespace(c))


def java_pattern(pattern: str) -> str:
    """A Python pattern in Java's spelling, anchored at the start as `re.match` does.

    The flags give `\\w`, `\\d`, `\\s` and `\\b` their Unicode meaning, and line ends only after a line feed.  Named
    groups get plain names, the end-of-text anchor its own spelling, and characters that only Java reads as set
    operators inside brackets are escaped.
    """
    groups: dict[str, str] = {}

    def group(name: str) -> str:
        return groups.setdefault(name, f"g{len(groups)}x")

    def spelled(m: re.Match[str]) -> str:
        if m["escape"]:
            return r"\z" if m["escape"] == r"\Z" else m["escape"]
        if m["set"]:
            head = re.match(r"\[\^?\]?", m["set"])[0]
            inner = re.sub(r"(\\.)|([\[&])", lambda x: x[1] or "\\" + x[2], m["set"][len(head) : -1])
            return f"{head.replace(']', chr(92) + ']')}{inner}]"
        return f"(?<{group(m['name'])}>" if m["name"] else rf"\k<{group(m['back'])}>"

    parts = r"(?P<escape>\\.)|(?P<set>\[\^?\]?(?:\\.|[^\]\\])*\])|\(\?P<(?P<name>\w+)>|\(\?P=(?P<back>\w+)\)"
    return rf"(?Ud)\A(?:{re.sub(parts, spelled, pattern, flags=re.S)})"


def matches_at_start(c: Column, pattern: str) -> Column:
    """NULL for NULL input, else whether the value's text matches `pattern` from its first character."""
    return c.cast("string").rlike(java_pattern(pattern))


def is_identifier(c: Column) -> Column:
    """Whether the text is a plain identifier; NULL and the empty string are not."""
    return F.coalesce(c.rlike(IDENTIFIER_PATTERN), F.lit(False))


def require_identifier(name: str) -> str:
    """The same check for a table or column name used by a sink."""
    if not re.fullmatch(r"[a-zA-Z0-9_\-.]+", name or ""):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def array_literal(c: Column) -> Column:
    """A string array as the text literal `{"a","b",NULL}`; NULL and empty arrays give `{}`."""

    def element(x: Column) -> Column:
        escaped = F.replace(F.replace(x.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.coalesce(F.concat(F.lit('"'), escaped, F.lit('"')), F.lit("NULL"))

    body = F.array_join(F.transform(c, element), ",")
    return F.concat(F.lit("{"), F.coalesce(body, F.lit("")), F.lit("}"))


def mask_log_text(c: Column, fields: Iterable[str] = LOG_SECRET_FIELDS) -> Column:
    """Replace the value of `"field": "value"` and `'field': 'value'` pairs by a mask."""
    for field in fields:
        for quote in ('"', "'"):
            pair = rf"{quote}{re.escape(field)}{quote}:\s*{quote}[^{quote}]+{quote}"
            c = F.regexp_replace(c, pair, f"{quote}{field}{quote}: {quote}{LOG_MASK}{quote}")
    return c

"""Date expressions that give NULL, never an error, on bad input."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowkit.functions.text import strip_whitespace

# Fixed value: integer dates at or below this one count as "no date".
EARLIEST_INT_DATE = 18000101

# What follows an ISO date; a text of another shape is tried with the formats.
ISO_SHAPE = (
    r"\A\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?(?: ?(?:Z|UTC|[+-]\d{2}:?\d{2}))?)?\z"
)
DEFAULT_FORMATS = (
    "yyyy/MM/dd",
    "yyyy/MM/dd HH:mm:ss",
    "yyyyMMdd",
    "yyyyMMdd HH:mm:ss",
    "MM/dd/yyyy",
    "MM/dd/yyyy HH:mm",
    "MM/dd/yyyy HH:mm:ss",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
)


def int_to_date(c: Column) -> Column:
    """A YYYYMMDD integer as DATE; NULL when missing, too early, or no calendar day."""
    return F.when(c > EARLIEST_INT_DATE, F.try_to_date(c.cast("string"), "yyyyMMdd"))


def int_date_in_year(c: Column, year: int) -> Column:
    """Range form of "the year of this integer date is `year`", so that it reaches the file scan."""
    return c.between(year * 10000 + 101, year * 10000 + 1231) & int_to_date(c).isNotNull()


def _shape(pattern: str) -> str | None:
    """A regular expression for the texts that a pattern can match; None for patterns with other letters."""
    expression = ""
    for part in re.findall(r"'[^']*'|y+|M+|d+|H+|m+|s+|S+|.", pattern):
        if part in ("yyyy", "MM", "dd", "HH", "mm", "ss"):
            expression += rf"\d{{{len(part)}}}"
        elif part == "d":
            expression += r"\d{1,2}"
        elif part in ("MMM", "MMMM"):
            expression += r"[A-Z][a-z]{2}" if part == "MMM" else r"[A-Z][a-z]+"
        elif part[0] == "S":
            expression += rf"\d{{1,{len(part)}}}"
        elif part[0].isalpha():
            return None
        else:
            expression += re.escape(part.strip("'"))
    return rf"\A{expression}\z"


def parse_timestamp(c: Column, formats: Iterable[str] = DEFAULT_FORMATS) -> Column:
    """The first reading that fits, else NULL: ISO 8601 (with or without time, fraction, zone), then the formats.

    The text is stripped of white space first.  A text that cannot fit by its shape is not parsed, since a failed
    parse costs an exception.  A time without a zone is in the session's.
    """
    text = strip_whitespace(c.cast("string"))
    iso = F.regexp_replace(text, r" ?([+-]\d{2}):?(\d{2})\z", "$1:$2")

    def parsed(pattern: str) -> Column:
        value, shape = F.try_to_timestamp(text, F.lit(pattern)), _shape(pattern)
        return value if shape is None else F.when(text.rlike(shape), value)

    read = F.when(text.rlike(ISO_SHAPE), F.regexp_replace(iso, r"(\.\d{6})\d+", "$1").try_cast("timestamp"))
    return F.coalesce(read, *[parsed(f) for f in formats])


def unparsed(c: Column, formats: Iterable[str] = DEFAULT_FORMATS) -> Column:
    """Whether there is a text, blank ones aside, that gives no date."""
    return F.coalesce(strip_whitespace(c.cast("string")) != "", F.lit(False)) & parse_timestamp(c, formats).isNull()

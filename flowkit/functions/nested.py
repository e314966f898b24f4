"""Expressions over arrays of structs; they replace un-nesting subqueries, so no row is exploded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def localized_text(items: Column, language: str = "en") -> Column:
    """The `text` of the first item in `language`, else of the first item, else ''."""
    preferred = F.try_element_at(F.filter(items, lambda x: x["language"] == language), F.lit(1))["text"]
    first = F.try_element_at(items, F.lit(1))["text"]
    return F.coalesce(preferred, first, F.lit(""))


def field_values(items: Column, field: str) -> Column:
    """The non-NULL values of one struct field in array order; a NULL array gives an empty array.

    Only that field of the structs is read from the file.
    """
    return F.coalesce(F.array_compact(items.getField(field)), F.array().cast("array<string>"))


def distinct_values(items: Column, field: str, at_most: int = 5) -> Column:
    """The first `at_most` distinct non-NULL values in order of first appearance."""
    return F.slice(F.array_distinct(field_values(items, field)), 1, at_most)

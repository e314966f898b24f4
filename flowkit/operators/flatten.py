"""Flattening of nested publication records into the typed, relational layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.functions.dates import EARLIEST_INT_DATE, int_date_in_year, int_to_date
from flowkit.functions.nested import distinct_values, field_values, localized_text
from flowkit.functions.schema import INT, TEXT, schema, structs
from flowkit.sources.tables import cap_rows

# Plain columns that pass through, before and after the computed ones.
IDENTIFIERS = ("publication_number", "application_number", "country_code", "kind_code", "family_id")
ATTRIBUTES = ("entity_status", "art_unit")

NESTED_SCHEMA = schema(
    publication_number=TEXT,
    application_number=TEXT,
    country_code=TEXT,
    kind_code=TEXT,
    family_id=TEXT,
    title_localized=structs(text=TEXT, language=TEXT),
    filing_date=INT,
    publication_date=INT,
    inventor_harmonized=structs(name=TEXT),
    assignee_harmonized=structs(name=TEXT),
    cpc=structs(code=TEXT),
    citation=structs(publication_number=TEXT),
    entity_status=TEXT,
    art_unit=TEXT,
)


def flattened_columns() -> list[Column]:
    """The projection of one nested record; arrays are handled in place, so no row is exploded or joined."""
    return [
        *[F.col(c) for c in IDENTIFIERS],
        localized_text(F.col("title_localized")).alias("title_english"),
        int_to_date(F.col("filing_date")).alias("filing_date"),
        int_to_date(F.col("publication_date")).alias("publication_date"),
        F.array_size("inventor_harmonized").alias("inventor_count"),
        field_values(F.col("inventor_harmonized"), "name").alias("inventor_names"),
        F.array_size("assignee_harmonized").alias("assignee_count"),
        field_values(F.col("assignee_harmonized"), "name").alias("assignee_names"),
        distinct_values(F.col("cpc"), "code").alias("cpc_codes"),
        F.array_size("citation").alias("citation_count"),
        *[F.col(c) for c in ATTRIBUTES],
    ]


def has_valid_filing_date() -> Column:
    """Filter on the raw integer, so that it is pushed into the file scan."""
    return F.col("filing_date") > EARLIEST_INT_DATE


def filed_within(days: int, as_of: dt.date | None = None) -> Column:
    """Filing date at most `days` days before `as_of` (default: today).

    The bound is repeated on the integer form, which the scan can use.
    """
    today = F.lit(as_of) if as_of else F.current_date()
    oldest = F.date_sub(today, days)
    as_int = F.date_format(oldest, "yyyyMMdd").cast("int")
    return (F.col("filing_date") >= as_int) & (int_to_date(F.col("filing_date")) >= oldest)


def flatten(
    nested: DataFrame,
    limit: int | None = None,
    year: int | None = None,
    recent_days: int | None = None,
    as_of: dt.date | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Flatten nested records with a valid filing date; newest first, then by publication number.

    `ordered=False` leaves out the sort for a load that does not need it.  A `limit` needs the order.
    """
    kept = nested.where(has_valid_filing_date())
    if year is not None:
        kept = kept.where(int_date_in_year(F.col("filing_date"), year))
    if recent_days is not None:
        kept = kept.where(filed_within(recent_days, as_of))
    flat = kept.select(*flattened_columns())
    if limit is not None:
        return newest_first(flat, "filing_date", "publication_number", limit)
    return newest_first(flat, "filing_date", "publication_number") if ordered else flat


def newest_first(df: DataFrame, by: str, tie_break: str, limit: int | None = None) -> DataFrame:
    """Sort descending with a unique tie-break, at most `limit` rows."""
    kept = df if limit is None else cap_rows(df, limit, [by, tie_break], descending=[by])
    return kept.orderBy(F.col(by).desc_nulls_last(), F.col(tie_break))


def active_only(df: DataFrame) -> DataFrame:
    """Rows whose status is 'active'."""
    return df.where(F.col("status") == "active")


def recent_only(df: DataFrame, days: int = 30, as_of: dt.date | None = None) -> DataFrame:
    """Rows created in the last `days` days."""
    today = F.lit(as_of) if as_of else F.current_date()
    return df.where(F.col("created_at") >= F.date_sub(today, days))

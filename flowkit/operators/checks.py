"""Column checks over a whole frame.

Each check yields issue rows `(check, column, issue_type, count, percentage, severity)`.  A check fails when it has an
issue of severity `error`; `warning` and `info` do not fail it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.columns import col, comparable, is_missing, percent, present
from flowkit.functions.schema import DOUBLE, LONG, TEXT, schema
from flowkit.functions.text import matches_at_start

ISSUE_SCHEMA = schema(check=TEXT, column=TEXT, issue_type=TEXT, count=LONG, percentage=DOUBLE, severity=TEXT)

# The checks, in the order in which a full validation runs them.
CHECKS = ("null_values", "duplicates", "data_types", "ranges", "string_patterns")

# Fixed value: a nullable column is reported above this percentage of nulls.
HIGH_NULL_PERCENTAGE = 50

TOTAL = "__total"


class _Issues:
    """Counts to take in one aggregate, and the issue row that each count turns into."""

    def __init__(self) -> None:
        self.counts: list[Column] = []
        self.rows: list[Column] = []

    def add(self, check: str, column: str, kind: Column | str, bad: Column, severity: Column | str) -> None:
        name = f"__bad_{len(self.counts)}"
        self.counts.append(F.count_if(bad).alias(name))
        count = F.col(name)
        as_column = [x if isinstance(x, Column) else F.lit(x) for x in (kind, severity)]
        self.rows.append(
            F.struct(
                F.lit(check).alias("check"),
                F.lit(column).alias("column"),
                as_column[0].alias("issue_type"),
                count.alias("count"),
                percent(count, F.col(TOTAL)).alias("percentage"),
                as_column[1].alias("severity"),
            )
        )

    def add_nulls(self, df: DataFrame, nullable: Iterable[str]) -> None:
        allowed = set(nullable)
        for f in df.schema:
            missing = is_missing(f.name, f.dataType)
            if f.name in allowed:
                # Kept or dropped by its percentage in `evaluate`.
                self.add("null_values", f.name, "high_null_percentage", missing, "warning")
            else:
                self.add("null_values", f.name, "unexpected_nulls", missing, "error")

    def add_ranges(self, df: DataFrame, ranges: Mapping[str, tuple[Any, Any]], strict: bool) -> None:
        types = {f.name: f.dataType for f in df.schema}
        for name, (lo, hi) in ranges.items():
            if name in types:
                given = present(name, types[name])
                v = comparable(given, types[name], lo, hi)
                bad = (v < lo) | (v > hi) | (given.isNotNull() & v.isNull())
                self.add("ranges", name, "out_of_range", bad, "error" if strict else "info")

    def add_patterns(self, df: DataFrame, patterns: Mapping[str, str], strict: bool) -> None:
        types = {f.name: f.dataType for f in df.schema}
        for name, pattern in patterns.items():
            if name in types:
                v = present(name, types[name])
                bad = ~matches_at_start(v, pattern)
                self.add("string_patterns", name, "pattern_mismatch", bad, "error" if strict else "info")

    def evaluate(self, df: DataFrame) -> DataFrame:
        """One pass over `df`; only rows with a count stay."""
        if not self.rows:
            return df.sparkSession.createDataFrame([], ISSUE_SCHEMA)
        totals = df.agg(F.count(F.lit(1)).alias(TOTAL), *self.counts)
        tolerated = (F.col("issue_type") == "high_null_percentage") & (F.col("percentage") <= HIGH_NULL_PERCENTAGE)
        return totals.select(F.inline(F.array(*self.rows))).where((F.col("count") > 0) & ~tolerated)


def check_nulls(df: DataFrame, nullable: Iterable[str] = ()) -> DataFrame:
    """Any null fails a column that is not nullable; a nullable one is reported above 50 % nulls."""
    issues = _Issues()
    issues.add_nulls(df, nullable)
    return issues.evaluate(df)


def check_ranges(df: DataFrame, ranges: Mapping[str, tuple[Any, Any]], strict: bool = False) -> DataFrame:
    """Values strictly outside their bounds; missing values and absent columns are not counted.

    With numeric bounds, a text that is no number counts as outside.
    """
    issues = _Issues()
    issues.add_ranges(df, ranges, strict)
    return issues.evaluate(df)


def check_patterns(df: DataFrame, patterns: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Non-missing values whose text does not match the pattern from its first character."""
    issues = _Issues()
    issues.add_patterns(df, patterns, strict)
    return issues.evaluate(df)


def check_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every member of a group of rows that share the key counts; an empty key list passes.

    Groups are counted per task before the shuffle, so a hot key costs one row per task.
    """
    if not keys:
        return df.sparkSession.createDataFrame([], ISSUE_SCHEMA)
    groups = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__rows"))
    rows = F.col("__rows")
    totals = groups.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias(TOTAL),
        F.coalesce(F.sum(F.when(rows > 1, rows)), F.lit(0)).alias("count"),
    )
    return totals.where(F.col("count") > 0).select(
        F.lit("duplicates").alias("check"),
        F.lit(",".join(keys)).alias("column"),
        F.lit("duplicate_rows").alias("issue_type"),
        "count",
        percent(F.col("count"), F.col(TOTAL)).alias("percentage"),
        F.lit("error").alias("severity"),
    )


def check_types(df: DataFrame, expected: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Compare the schema with `numeric` / `string` expectations; reads no data."""
    types = {f.name: f.dataType for f in df.schema}
    issues = []
    for name, kind in expected.items():
        if name not in types:
            issues.append((name, "missing_column", "error" if strict else "info"))
        elif kind == "numeric" and not isinstance(types[name], T.NumericType):
            issues.append((name, "type_mismatch", "error"))
        elif kind == "string" and not isinstance(types[name], T.StringType):
            issues.append((name, "type_mismatch", "error" if strict else "warning"))
    rows = [("data_types", name, issue, None, None, severity) for name, issue, severity in issues]
    return df.sparkSession.createDataFrame(rows, ISSUE_SCHEMA)


def check_castable(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Values that do not cast to the expected type: the data-level form of the type check."""
    issues = _Issues()
    for name, target in expected.items():
        if name in df.columns:
            bad = col(name).isNotNull() & col(name).try_cast(target).isNull()
            issues.add("data_types", name, "not_castable", bad, "error")
    return issues.evaluate(df)


def check_all(
    df: DataFrame,
    nullable: Iterable[str] = (),
    keys: Sequence[str] = (),
    types: Mapping[str, str] | None = None,
    ranges: Mapping[str, tuple[Any, Any]] | None = None,
    patterns: Mapping[str, str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """All issues of the five checks: one wide aggregate, one keyed aggregate and a schema look-up."""
    wide = _Issues()
    wide.add_nulls(df, nullable)
    wide.add_ranges(df, ranges or {}, strict)
    wide.add_patterns(df, patterns or {}, strict)
    return (
        wide.evaluate(df)
        .unionByName(check_duplicates(df, keys))
        .unionByName(check_types(df, types or {}, strict))
    )


def check_results(issues: DataFrame) -> DataFrame:
    """One row per check `(check, passed, issue_count)` for the issues of `check_all`."""
    return issues.groupBy().agg(
        *[F.count_if((F.col("check") == c) & (F.col("severity") == "error")).alias(f"__errors_{c}") for c in CHECKS],
        *[F.count_if(F.col("check") == c).alias(f"__issues_{c}") for c in CHECKS],
    ).select(
        F.inline(
            F.array(*[
                F.struct(
                    F.lit(c).alias("check"),
                    (F.col(f"__errors_{c}") == 0).alias("passed"),
                    F.col(f"__issues_{c}").alias("issue_count"),
                )
                for c in CHECKS
            ])
        )
    )


def validation_summary(df: DataFrame, issues: DataFrame) -> DataFrame:
    """One row `(row_count, column_count, passed)`; `passed` is the AND of the checks."""
    errors = issues.agg(F.count_if(F.col("severity") == "error")).scalar()
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).alias("column_count"), (errors == 0).alias("passed")
    )


def dataset_score(annotated: DataFrame, valid: str = "is_valid") -> DataFrame:
    """One row `(total_rows, valid_rows, quality_score)`; an empty frame scores 100."""
    totals = annotated.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(col(valid)).alias("valid_rows"))
    share = F.try_divide(F.col("valid_rows").cast("double"), F.col("total_rows").cast("double")) * 100
    return totals.withColumn("quality_score", F.coalesce(share, F.lit(100.0)))

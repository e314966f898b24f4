"""History of quality checks, score and report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.functions.columns import percent
from flowkit.functions.schema import DOUBLE, FLAG, LONG, TEXT, TEXTS, TIME, schema

CHECK_SCHEMA = schema(
    timestamp=TIME,
    check_name=TEXT,
    passed=FLAG,
    records_total=LONG,
    records_valid=LONG,
    records_invalid=LONG,
    valid_percentage=DOUBLE,
    issues=TEXTS,
)

# The columns of the CSV export, in order.
CSV_COLUMNS = (
    "timestamp",
    "check_name",
    "passed",
    "records_total",
    "records_valid",
    "records_invalid",
    "valid_percentage",
)


def _score(valid: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(F.sum(valid).cast("double"), F.sum(total).cast("double")) * 100, F.lit(100.0))


def record_check(
    spark: SparkSession,
    check_name: str,
    passed: bool,
    total: int,
    valid: int,
    invalid: int,
    issues: Sequence[str] = (),
    now: dt.datetime | None = None,
) -> DataFrame:
    """One history row from known counts."""
    row = (now or dt.datetime.now(dt.UTC), check_name, passed, total, valid, invalid)
    share = valid / total * 100 if total > 0 else 0.0
    return spark.createDataFrame([(*row, share, list(issues))], CHECK_SCHEMA)


def check_records(annotated: DataFrame, check_name: Column, valid: Column, now: Column | None = None) -> DataFrame:
    """History rows computed from a frame: one per value of `check_name`, counting the rows where `valid` holds."""
    counts = annotated.groupBy(check_name.alias("check_name")).agg(
        F.count(F.lit(1)).alias("records_total"), F.count_if(valid).alias("records_valid")
    )
    total, ok = F.col("records_total"), F.col("records_valid")
    return counts.select(
        (F.current_timestamp() if now is None else now).alias("timestamp"),
        "check_name",
        (ok == total).alias("passed"),
        "records_total",
        "records_valid",
        (total - ok).alias("records_invalid"),
        percent(ok, total).alias("valid_percentage"),
        F.array().cast("array<string>").alias("issues"),
    )


def quality_score(history: DataFrame) -> DataFrame:
    """One row `(overall_score)`: record-weighted over the history, 100 when it is empty."""
    return history.agg(_score(F.col("records_valid"), F.col("records_total")).alias("overall_score"))


def _report_measures() -> list[Column]:
    return [
        _score(F.col("records_valid"), F.col("records_total")).alias("overall_score"),
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.coalesce(F.sum("records_total"), F.lit(0)).alias("total_records_checked"),
        F.coalesce(F.sum("records_valid"), F.lit(0)).alias("total_valid_records"),
        F.coalesce(F.sum("records_invalid"), F.lit(0)).alias("total_invalid_records"),
    ]


def quality_report(history: DataFrame) -> DataFrame:
    """One row with the score and the totals over the whole history."""
    return history.agg(*_report_measures())


def quality_rollup(history: DataFrame) -> DataFrame:
    """The same measures per check, and in total where `check_name` is NULL, from one job."""
    return history.rollup("check_name").agg(*_report_measures())


def export_report_json(history: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the report as JSON lines (two write jobs): `<path>/totals` with score and totals, `<path>/checks`."""
    quality_report(history).write.mode(mode).json(f"{path}/totals")
    history.write.mode(mode).json(f"{path}/checks")


def csv_rows(history: DataFrame) -> DataFrame:
    """The exported columns, with the percentage as text with two decimals."""
    shown = F.format_string("%.2f%%", F.col("valid_percentage"))
    return history.withColumn("valid_percentage", shown).select(*CSV_COLUMNS)


def export_report_csv(history: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the history as CSV with a header (one write job)."""
    csv_rows(history).write.mode(mode).option("header", True).csv(path)

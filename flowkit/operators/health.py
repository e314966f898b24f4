"""Health classification of probe results, metric samples and run totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses and thresholds.
HEALTHY, DEGRADED, UNHEALTHY, UNKNOWN = "healthy", "degraded", "unhealthy", "unknown"
LATENCY_LIMITS_MS = {"database": 1000.0, "warehouse": 2000.0}
MEMORY_ELEVATED, MEMORY_CRITICAL = 70.0, 85.0
MAX_FAILED_RECORDS, MAX_QUARANTINED = 100, 50
CHECK_INTERVAL_SECONDS = 60


def latency_status(component: Column, latency_ms: Column, error: Column | None = None) -> Column:
    """Healthy under the component's limit, degraded from it on; unhealthy on an error or without a measurement.

    A component without a limit is unknown.
    """
    limit = F.lit(None).cast("double")
    for name, ms in LATENCY_LIMITS_MS.items():
        limit = F.when(component == name, ms).otherwise(limit)
    failed = latency_ms.isNull() if error is None else latency_ms.isNull() | error.isNotNull()
    return (
        F.when(limit.isNull(), UNKNOWN)
        .when(failed, UNHEALTHY)
        .when(latency_ms < limit, HEALTHY)
        .otherwise(DEGRADED)
    )


def memory_status(percent: Column) -> Column:
    return (
        F.when(percent.isNull(), UNKNOWN)
        .when(percent < MEMORY_ELEVATED, HEALTHY)
        .when(percent < MEMORY_CRITICAL, DEGRADED)
        .otherwise(UNHEALTHY)
    )


def memory_message(percent: Column) -> Column:
    return (
        F.when(percent < MEMORY_ELEVATED, "Memory usage normal")
        .when(percent < MEMORY_CRITICAL, "Memory usage elevated")
        .when(percent.isNotNull(), "Memory usage critical")
    )


def pipeline_status(
    failed: Column,
    quarantined: Column,
    max_failed: int = MAX_FAILED_RECORDS,
    max_quarantined: int = MAX_QUARANTINED,
) -> Column:
    return (
        F.when(failed > max_failed, UNHEALTHY).when(quarantined > max_quarantined, DEGRADED).otherwise(HEALTHY)
    )


def pipeline_message(
    failed: Column,
    quarantined: Column,
    max_failed: int = MAX_FAILED_RECORDS,
    max_quarantined: int = MAX_QUARANTINED,
) -> Column:
    return (
        F.when(failed > max_failed, F.concat(F.lit("Too many failed records: "), failed.cast("string")))
        .when(
            quarantined > max_quarantined,
            F.concat(F.lit("DLQ has "), quarantined.cast("string"), F.lit(" entries")),
        )
        .otherwise("Pipeline operating normally")
    )


def latest_results(results: DataFrame) -> DataFrame:
    """The newest result of each component, from `(component, status, ts, …)`."""
    newest = F.max_by(F.struct(*results.columns), F.struct("ts", "status"))
    return results.groupBy("component").agg(newest.alias("__newest")).select("__newest.*")


def worst_status() -> Column:
    """The aggregate over `status`: the worst one; unknown when one is unknown and none is worse, or without any."""
    status = F.col("status")
    return (
        F.when(F.count_if(status == UNHEALTHY) > 0, UNHEALTHY)
        .when(F.count_if(status == DEGRADED) > 0, DEGRADED)
        .when((F.count(F.lit(1)) > 0) & (F.count_if(status == HEALTHY) == F.count(F.lit(1))), HEALTHY)
        .otherwise(UNKNOWN)
    )


def overall_status(results: DataFrame) -> DataFrame:
    """One row: the worst status of the components."""
    return results.agg(worst_status().alias("overall_status"))


def health_report(results: DataFrame) -> DataFrame:
    """One row: overall status and number of components per status.  The components are `latest_results`."""
    return results.agg(
        worst_status().alias("overall_status"),
        F.count_if(F.col("status") == HEALTHY).alias("healthy_count"),
        F.count_if(F.col("status") == DEGRADED).alias("degraded_count"),
        F.count_if(F.col("status") == UNHEALTHY).alias("unhealthy_count"),
    )


def due_checks(
    components: DataFrame, results: DataFrame, as_of: Column, interval_seconds: int = CHECK_INTERVAL_SECONDS
) -> DataFrame:
    """Per component: seconds since its last result and whether a check is due; never checked means due."""
    last = results.groupBy("component").agg(F.max("ts").alias("last_ts"))
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("last_ts").cast("timestamp"))) / 1_000_000
    due = F.coalesce(age >= interval_seconds, F.lit(True))
    return components.join(last, "component", "left").select(
        "component", "last_ts", age.alias("age_seconds"), due.alias("is_due")
    )

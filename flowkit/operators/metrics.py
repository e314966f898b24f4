"""Run metrics computed from event tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.functions.columns import col
from flowkit.plans.ordered import running_sums

UNPARSED = "UNPARSED"


def metric_values(samples: DataFrame, tie_break: str | None = None) -> DataFrame:
    """Per metric name: the last value (gauge) and the sum (counter) of samples `(name, value, ts)`."""
    when = F.struct("ts", tie_break) if tie_break else F.col("ts")
    return samples.groupBy("name").agg(F.max_by("value", when).alias("last_value"), F.sum("value").alias("total"))


def metrics_summary(runs: DataFrame) -> DataFrame:
    """One row of totals over runs `(started_at, ended_at, extracted, attempted, failed)`.

    Loaded rows are the attempted ones that did not fail; uptime spans from the first start to the last end.
    """
    uptime = F.unix_micros(F.max("ended_at")) - F.unix_micros(F.min("started_at"))
    return runs.agg(
        F.coalesce(F.sum("extracted"), F.lit(0)).alias("records_extracted"),
        F.coalesce(F.sum(F.col("attempted") - F.col("failed")), F.lit(0)).alias("records_loaded"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("records_failed"),
        F.coalesce(uptime / 1_000_000, F.lit(0.0)).alias("uptime_seconds"),
    )


def operation_counts(outcomes: DataFrame, tie_break: str | None = None) -> DataFrame:
    """Per component and operation of `(component, operation, ok, duration, ts)`: successes, failures, last duration."""
    when = F.struct("ts", tie_break) if tie_break else F.col("ts")
    return outcomes.groupBy("component", "operation").agg(
        F.count_if("ok").alias("success_count"),
        F.count_if(~F.col("ok")).alias("failure_count"),
        F.max_by("duration", when).alias("last_duration"),
    )


def throughput(rows: Column, seconds: Column) -> Column:
    """Rows per second; 0 when no time passed."""
    positive = F.when(seconds > 0, seconds.cast("double"))
    return F.coalesce(F.try_divide(rows.cast("double"), positive), F.lit(0.0))


def numeric_metrics(samples: DataFrame, metrics: str, *keys: str) -> DataFrame:
    """One row per numeric entry of a map column; entries that are no numbers are skipped."""
    entries = samples.select(*[col(k) for k in keys], F.explode(col(metrics)).alias("name", "__text"))
    value = F.col("__text").try_cast("double")
    return entries.where(value.isNotNull()).select(*[col(k) for k in keys], "name", value.alias("value"))


def progress_percent(done: Column, total: Column) -> Column:
    """Whole percent done, rounded down; 0 when the total is 0."""
    share = F.try_divide(done.cast("double"), F.when(total > 0, total.cast("double"))) * 100
    return F.coalesce(F.floor(share), F.lit(0)).cast("int")


def job_progress(
    chunks: DataFrame, order: Sequence[str], keys: Sequence[str] = ("job",), buckets: int | None = None
) -> DataFrame:
    """Running totals and progress of chunks `(job, rows, ok, total_rows)`, in `order` inside each job.

    Every chunk counts as extracted, and as loaded or failed by its outcome.  Jobs of any length are spread over
    tasks (see `plans.ordered`); the input is staged once.
    """
    rows = F.col("rows")
    sums = {
        "rows_extracted": rows,
        "rows_loaded": F.when(F.col("ok"), rows).otherwise(0),
        "rows_failed": F.when(F.col("ok"), 0).otherwise(rows),
    }
    running = running_sums(chunks, sums, order, keys, buckets)
    return running.withColumn("progress", progress_percent(F.col("rows_extracted"), F.col("total_rows")))


def log_counts(logs: DataFrame, every: str = "1 hour", **more: Column) -> DataFrame:
    """Log records `(timestamp, level)` per time window and level, with `more` aggregates of the same group.

    Records without a timestamp count in a window without a start.
    """
    width = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {every})")
    start = F.timestamp_micros(F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / width) * width)
    groups = logs.groupBy(start.alias("window_start"), "level")
    return groups.agg(F.count(F.lit(1)).alias("records"), *[c.alias(name) for name, c in more.items()])


def parse_logs(lines: DataFrame, text: str = "value") -> DataFrame:
    """JSON log lines as `(timestamp, level, logger, message, extra)`; `extra` is a map of all other fields.

    A line that is no JSON object stays, with the level `UNPARSED` and its text as message.  A time that does not
    parse is NULL.
    """
    known = ("timestamp", "level", "logger", "message")
    fields = F.from_json(col(text), "map<string,string>")
    # A malformed line gives NULL or an empty map, by its kind.
    tagged = lines.withColumn("__fields", fields).withColumn("__broken", F.coalesce(F.size("__fields") <= 0, F.lit(True)))
    broken = F.col("__broken")
    return tagged.select(
        F.when(~broken, F.try_to_timestamp(F.col("__fields")["timestamp"])).alias("timestamp"),
        F.when(broken, F.lit(UNPARSED)).otherwise(F.col("__fields")["level"]).alias("level"),
        F.when(~broken, F.col("__fields")["logger"]).alias("logger"),
        F.when(broken, col(text)).otherwise(F.col("__fields")["message"]).alias("message"),
        F.when(~broken, F.map_filter("__fields", lambda k, _: ~k.isin(*known))).alias("extra"),
    )

"""Quarantine table for failing records: enqueue, look up, replay, retry schedule, retention.

The table is partitioned by source and day, so look-ups by source and retention prune whole partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.schema import INT, TEXT, TIME, schema
from flowkit.plans.staging import partition_folders, remove
from flowkit.sources.tables import cap_rows

RECORD_SCHEMA = schema(ts=TIME, source=TEXT, error=TEXT, retry_count=INT, record=TEXT)
PARTITIONS = ("source", "dt")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Default retry policy (attempts, first delay and its growth, longest delay, jitter share).
MAX_RETRIES = 3
INITIAL_DELAY = 1.0
BACKOFF_MULTIPLIER = 2.0
MAX_DELAY = 60.0
JITTER_SHARE = 0.1

# Failures of these kinds are worth another attempt; a bad value stays bad.
TRANSIENT_ERRORS = r"(?i)timeout|timed out|connection|unavailable|temporar|throttl|deadlock|reset by peer"


def enqueue(
    failing: DataFrame,
    error: Column,
    source: Column | str,
    retry_count: Column | int = 0,
    now: Column | None = None,
    payload: list[str] | None = None,
) -> DataFrame:
    """Quarantine rows `(ts, source, error, retry_count, record, dt)`; `record` is the whole row as JSON."""
    fields = payload or failing.columns
    ts = F.current_timestamp() if now is None else now
    return failing.select(
        ts.alias("ts"),
        (source if isinstance(source, Column) else F.lit(source)).alias("source"),
        error.alias("error"),
        (retry_count if isinstance(retry_count, Column) else F.lit(retry_count)).cast("int").alias("retry_count"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record"),
        F.to_date(ts).alias("dt"),
    )


def violations_text(violations: Column) -> Column:
    """The messages of a violations array as one error text."""
    return F.array_join(F.transform(violations, lambda v: v["message"]), "; ")


def write_quarantine(rows: DataFrame, path: str) -> None:
    """Append to the quarantine table (one write job); files are balanced, also for a hot source or day."""
    rows.hint("rebalance", *PARTITIONS).write.mode("append").partitionBy(*PARTITIONS).parquet(path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    fields = [f for f in RECORD_SCHEMA if f.name not in PARTITIONS]
    partitions = [T.StructField("source", T.StringType()), T.StructField("dt", T.DateType())]
    return spark.read.schema(T.StructType([*fields, *partitions])).parquet(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Quarantine rows kept as JSON lines; lines that do not parse are skipped."""
    tagged = T.StructType([*RECORD_SCHEMA, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.text(path).select(F.from_json("value", tagged).alias("row")).select("row.*")
    return rows.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record").withColumn("dt", F.to_date("ts"))


def stats_by_source(quarantine: DataFrame) -> DataFrame:
    """Records per source; the total is the sum of its few rows."""
    return quarantine.groupBy("source").agg(F.count(F.lit(1)).alias("records"))


def stats_by_file(spark: SparkSession, path: str) -> DataFrame:
    """Files of a quarantine table with their record count and size."""
    rows = read_quarantine(spark, path).select("_metadata.file_path", "_metadata.file_size")
    return rows.groupBy(F.col("file_path").alias("file"), F.col("file_size").alias("size_bytes")).agg(
        F.count(F.lit(1)).alias("records")
    )


def latest_records(quarantine: DataFrame, source: str | None = None, limit: int = 100) -> DataFrame:
    """The newest records, of one source when given, with the record text as tie-break."""
    kept = quarantine if source is None else quarantine.where(F.col("source") == source)
    return cap_rows(kept, limit, ["ts", "source", "record", "error"], descending=["ts"])


def replay(
    quarantine: DataFrame,
    fields: T.StructType,
    check: Callable[[DataFrame], DataFrame],
    source: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Parse the records again and run `check`, which adds `is_valid` and `violations`.

    The result has the parsed columns, `succeeded`, and the quarantine row to write back for a failure, with its
    retry count raised by one, in `requeued` (NULL on success).  A record that does not parse fails.
    """
    kept = quarantine if source is None else quarantine.where(F.col("source") == source)
    tagged = T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = kept.withColumn("__parsed", F.from_json("record", tagged)).select(
        F.struct("source", "error", "retry_count", "record").alias("__queued"),
        (F.col("__parsed").isNull() | F.col("__parsed._corrupt_record").isNotNull()).alias("__unreadable"),
        *[F.col("__parsed")[f.name].alias(f.name) for f in fields],
    )
    checked = check(parsed)
    succeeded = F.col("is_valid") & ~F.col("__unreadable")
    error = F.when(F.col("__unreadable"), F.lit("unreadable record")).otherwise(violations_text(F.col("violations")))
    again = F.struct(
        (F.current_timestamp() if now is None else now).alias("ts"),
        F.col("__queued.source").alias("source"),
        error.alias("error"),
        (F.col("__queued.retry_count") + 1).alias("retry_count"),
        F.col("__queued.record").alias("record"),
    )
    return checked.select(
        *[F.col(f.name) for f in fields],
        succeeded.alias("succeeded"),
        F.when(~succeeded, again).alias("requeued"),
    )


def replay_counts(replayed: DataFrame) -> DataFrame:
    """One row `(total, succeeded, failed)`."""
    return replayed.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("succeeded").alias("succeeded"),
        F.count_if(~F.col("succeeded")).alias("failed"),
    )


def requeued(replayed: DataFrame) -> DataFrame:
    """The quarantine rows of the failures of a replay."""
    return replayed.where(~F.col("succeeded")).select("requeued.*").withColumn("dt", F.to_date("ts"))


def _is_cleared(source: str | None, older_than_days: int, as_of: dt.date | None) -> Column:
    cleared = F.lit(True) if source is None else F.col("source") == source
    if older_than_days > 0:
        cutoff = F.date_sub(F.lit(as_of) if as_of else F.current_date(), older_than_days)
        cleared = cleared & (F.col("dt") < cutoff)
    return cleared


def retained(
    quarantine: DataFrame, source: str | None = None, older_than_days: int = 0, as_of: dt.date | None = None
) -> DataFrame:
    """What a clear leaves: nothing of the source when `older_than_days` is 0, else its rows since the cutoff."""
    return quarantine.where(~_is_cleared(source, older_than_days, as_of))


def clear(
    spark: SparkSession,
    path: str,
    new_path: str,
    source: str | None = None,
    older_than_days: int = 0,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Write the retained rows as a new version of the table (one write job) and read it."""
    write_quarantine(retained(read_quarantine(spark, path), source, older_than_days, as_of), new_path)
    return read_quarantine(spark, new_path)


def clear_in_place(
    spark: SparkSession, path: str, source: str | None = None, older_than_days: int = 0, as_of: dt.date | None = None
) -> int:
    """Delete the folders of the cleared rows and return how many; all other files stay as they are.

    What is cleared depends on source and day alone, so no row is read or written, and a run that stopped half-way is
    finished by the next.
    """
    cutoff = (as_of or dt.datetime.now(dt.UTC).date()) - dt.timedelta(days=older_than_days)
    gone = 0
    for folder, name in partition_folders(spark, path, "source"):
        if source is not None and name != source:
            continue
        for day_folder, day in partition_folders(spark, folder, "dt"):
            # A row without a day is never older than a cutoff.
            if older_than_days <= 0 or (day != NO_VALUE and dt.date.fromisoformat(day) < cutoff):
                remove(spark, day_folder)
                gone += 1
    return gone


def backoff_seconds(
    retry_count: Column,
    initial: float = INITIAL_DELAY,
    multiplier: float = BACKOFF_MULTIPLIER,
    longest: float = MAX_DELAY,
    jitter_key: Column | None = None,
) -> Column:
    """min(initial * multiplier^retry_count, longest); with a key, moved by up to 10 % either way, never below 0.

    The jitter is a hash of the key, so that a re-run task gives the same delay.
    """
    delay = F.least(F.lit(initial) * F.pow(F.lit(multiplier), retry_count.cast("double")), F.lit(longest))
    if jitter_key is None:
        return delay
    share = F.pmod(F.xxhash64(jitter_key), F.lit(2_000_001)) / 1_000_000 - 1
    return F.greatest(F.lit(0.0), delay * (1 + share * JITTER_SHARE))


def with_retry_schedule(
    quarantine: DataFrame,
    max_retries: int = MAX_RETRIES,
    initial: float = INITIAL_DELAY,
    multiplier: float = BACKOFF_MULTIPLIER,
    longest: float = MAX_DELAY,
    jitter: bool = True,
    transient: str = TRANSIENT_ERRORS,
) -> DataFrame:
    """Add `retriable` (by error text), `delay_seconds`, and `state`: `due` while attempts are left, else `dead`."""
    key = F.concat_ws("|", "source", "record", F.col("retry_count").cast("string")) if jitter else None
    retriable = F.coalesce(F.col("error").rlike(transient), F.lit(False))
    due = retriable & (F.col("retry_count") < max_retries)
    return quarantine.withColumns({
        "retriable": retriable,
        "delay_seconds": backoff_seconds(F.col("retry_count"), initial, multiplier, longest, key),
        "state": F.when(due, "due").otherwise("dead"),
    })

"""Event-time operators on streams: keyed dedupe, windowed progress and health, and a sink for updated results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


from flowkit.functions.columns import col
from flowkit.operators.health import pipeline_status
from flowkit.operators.metrics import throughput
from flowkit.sources.tables import read_stream


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """A watermark on `ts`, which is cast because a stream's event time must be a zoned timestamp."""
    return df.withColumn(ts, col(ts).cast("timestamp")).withWatermark(ts, delay)


def deduplicate_stream(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    delay: str = "1 hour",
    salt_by: Sequence[str] = (),
    salts: int = 16,
) -> DataFrame:
    """The first row per key, remembered for the watermark delay, so that the state stays bounded.

    For hot keys name columns in `salt_by` that vary inside a key: copies are then dropped per key and salt first, so
    at most `salts` rows of a key meet in one task.
    """
    timed = with_event_time(df, ts, delay)
    if salt_by:
        salt = F.pmod(F.xxhash64(*[col(c) for c in salt_by]), F.lit(salts))
        timed = timed.withColumn("__salt", salt).dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt")
    return timed.dropDuplicatesWithinWatermark(list(keys))


def window_progress(
    df: DataFrame,
    failed: Column,
    every: str = "1 hour",
    ts: str = "ts",
    keys: Sequence[str] = (),
    delay: str = "1 hour",
    max_failed: int = 100,
) -> DataFrame:
    """Per time window and key: rows, failures, rows per second, and status.

    Counts are combined per task before the shuffle, so a hot key costs one row per task and window.  A row without a
    time belongs to no window; the query's progress counts such rows as `event_time.rows_without_time`.
    """
    df = df.observe("event_time", F.count_if(col(ts).isNull()).alias("rows_without_time"))
    windowed = with_event_time(df, ts, delay).groupBy(F.window(ts, every).alias("w"), *[col(k) for k in keys])
    seconds = (F.unix_micros(F.col("w.end")) - F.unix_micros(F.col("w.start"))) / 1_000_000
    counted = windowed.agg(F.count(F.lit(1)).alias("rows"), F.count_if(failed).alias("failed_rows"))
    return counted.select(
        F.col("w.start").alias("window_start"),
        *[col(k) for k in keys],
        "rows",
        "failed_rows",
        throughput(F.col("rows"), seconds).alias("rows_per_second"),
        pipeline_status(F.col("failed_rows"), F.lit(0), max_failed).alias("status"),
    )


def write_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the changed rows of a windowed aggregate, one directory per micro-batch; a repeated batch replaces its own.

    Only changed windows are written and windows behind the watermark leave the state; `latest_updates` reads the
    result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/update={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.outputMode("update").trigger(availableNow=True).start()


def latest_updates(spark: SparkSession, path: str, fields: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The last written row per key."""
    updates = spark.read.schema(T.StructType([*fields, T.StructField("update", T.LongType())])).parquet(path)
    newest = F.max_by(F.struct(*[col(f.name) for f in fields]), F.col("update"))
    return updates.groupBy(*[col(k) for k in keys]).agg(newest.alias("__newest")).select("__newest.*")


@dataclass(frozen=True)
class LateSplit:
    """Sends the rows of a stream that come too late aside, so that none is dropped behind a watermark.

    A row is late if its time lies more than `delay_seconds` before the latest time of the micro-batches before its own,
    or if it has none.  Each micro-batch writes `batch=<n>/side=on_time|late` in one pass and replaces it when it is
    repeated; its latest time is kept beside it, so a restart goes on with the same line.  An operator that reads the
    rows on time with the same delay drops none of them, since its own watermark is never later.
    """

    path: str
    checkpoint: str
    delay_seconds: int
    ts: str = "ts"

    def _marks(self, batch_id: int) -> str:
        return f"{self.path}/marks/batch={batch_id}"

    def _latest_before(self, spark: SparkSession, batch_id: int) -> int | None:
        """Microseconds of the latest time before a batch."""
        if batch_id == 0:
            return None
        return spark.read.schema("latest BIGINT").parquet(self._marks(batch_id - 1)).first()["latest"]

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """The body of `foreachBatch` (one write of the rows, one of a single row)."""
        spark = batch.sparkSession
        before, seen = self._latest_before(spark, batch_id), Observation()
        micros = F.unix_micros(col(self.ts).cast("timestamp"))
        line = None if before is None else before - self.delay_seconds * 1_000_000
        late = col(self.ts).isNull() if line is None else col(self.ts).isNull() | (micros < line)
        rows = batch.observe(seen, F.max(micros).alias("latest")).withColumn("side", F.when(late, "late").otherwise("on_time"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("side")
        writer.parquet(f"{self.path}/rows/batch={batch_id}")
        known = [t for t in (before, seen.get["latest"]) if t is not None]
        mark = spark.createDataFrame([(max(known, default=None),)], "latest BIGINT")
        mark.coalesce(1).write.mode("overwrite").parquet(self._marks(batch_id))

    def run_to_end(self, stream: DataFrame) -> None:
        """Split all present files; raises when the run fails."""
        writer = stream.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", self.checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    def late(self, spark: SparkSession, fields: T.StructType) -> DataFrame:
        parts = [T.StructField("batch", T.LongType()), T.StructField("side", T.StringType())]
        rows = spark.read.schema(T.StructType([*fields, *parts])).parquet(f"{self.path}/rows")
        return rows.where(F.col("side") == "late").select(*[col(f.name) for f in fields])

    def on_time(self, spark: SparkSession, fields: T.StructType, max_files: int | None = None) -> DataFrame:
        """The rows on time as a stream of the written files."""
        pattern = f"{self.path}/rows/batch=*/side=on_time/*.parquet"
        return read_stream(spark, pattern, fields, max_files=max_files)


def orphans_in_stream(
    children: DataFrame,
    parents: DataFrame,
    child: tuple[str, str],
    parent: tuple[str, str],
    delay: str,
    wait: str,
    since: str | None = None,
    salts: int = 1,
) -> DataFrame:
    """The children with a key that no parent has, each told once no such parent can come any more.

    `child` and `parent` name the key and the time of their side.  A parent counts if its time is at most `wait` after
    that of the child and, with `since`, at most so long before it; parents then leave the state too.  Both sides have a
    watermark of `delay`, and a child is kept until both have passed the time up to which its parent could come.  Rows
    behind the watermark are dropped, so split late ones off first.  With `salts`, the children of a key are dealt to so
    many tasks and every parent goes to each of them.
    """
    salt = F.pmod(F.xxhash64(*[col(c) for c in children.columns]), F.lit(salts)).cast("int")
    timed = with_event_time(children.where(col(child[0]).isNotNull()), child[1], delay).withColumn("__salt", salt)
    known = parents.select(col(parent[0]).alias("__parent"), col(parent[1]).cast("timestamp").alias("__at"))
    known = known.where("__parent IS NOT NULL").withWatermark("__at", delay)
    known = known.withColumn("__dealt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = (col(child[0]) == F.col("__parent")) & (F.col("__salt") == F.col("__dealt"))
    on = on & (F.col("__at") <= col(child[1]) + F.expr(f"INTERVAL {wait}"))
    if since is not None:
        on = on & (F.col("__at") >= col(child[1]) - F.expr(f"INTERVAL {since}"))
    joined = timed.join(known, on, "left_outer").where(F.col("__parent").isNull())
    return joined.drop("__salt", "__parent", "__at", "__dealt")

"""Incremental, restartable load of a stream, with rules, quarantine and run ledger.

Each micro-batch writes its own directory `load_run=<run>/batch_id=<n>` and replaces it when Spark repeats the batch
after a failure, so every row lands once.  Recovery is the streaming checkpoint's.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flowkit.functions.text import require_identifier
from flowkit.operators import ledger as run_ledger
from flowkit.operators.metrics import progress_percent, throughput
from flowkit.operators.quarantine import PARTITIONS, TRANSIENT_ERRORS, enqueue, violations_text
from flowkit.operators.rules import Rule, RuleSet, RuleType, annotate, split
from flowkit.plans.ordered import running_sums
from flowkit.plans.staging import remove, stage
from flowkit.sources.keyed import KeyedTarget

RUN_COLUMNS = ("load_run", "batch_id")
BATCH_FIELDS = "batch_id BIGINT, rows_loaded BIGINT, rows_failed BIGINT, error STRING"


@dataclass(frozen=True)
class StreamLoad:
    """Where a load writes and what it does to a batch on the way.

    With `rules`, rows that break one go to the quarantine instead of the target.  With a quarantine, a batch that
    fails as a whole is kept there and the run goes on; without one, the failure stops the run.  A transient failure
    (of storage or network) always stops it, and the batch is loaded when the run is started again.  A run has no row
    cap; cap its source with `sources.tables.cap_rows`.

    A `unique` rule holds over all batches of the run: the first row of a key in `order` wins (NULL is a key), a later
    one breaks the rule.  It needs a path for the `keys` seen so far, a keyed target with one insert per batch, so that
    a repeated batch finds the keys of the other batches only.  With `keys_kept`, keys of more batches ago than that
    are forgotten.  A batch that fails as a whole claims no keys.
    """

    target: str
    checkpoint: str
    run: str = "load"
    ledger: str | None = None
    quarantine: str | None = None
    rules: RuleSet | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    keys: str | None = None
    order: tuple[str, ...] = ()
    key_buckets: int = 64
    keys_kept: int | None = None

    def __post_init__(self) -> None:
        require_identifier(self.run)
        if self.rules and not self.quarantine:
            raise ValueError("rules need a quarantine path for the rows that break them")
        if self._unique_rules() and not (self.keys and self.order):
            raise ValueError("a unique rule needs a path for the keys seen so far and the order in which rows come first")

    def _unique_rules(self) -> list[Rule]:
        return [r for r in self.rules.get_all_rules() if r.rule_type is RuleType.UNIQUE] if self.rules else []

    def _index(self, rule: Rule) -> KeyedTarget:
        return KeyedTarget(f"{self.keys}/{rule.name}", (rule.column,), self.key_buckets)

    def _forget_keys(self, spark: SparkSession, batch_id: int) -> None:
        for rule in self._unique_rules():
            self._index(rule).forget(spark, f"{self.run}_{batch_id}")

    def _directory(self, root: str, batch_id: int) -> str:
        return f"{root}/load_run={self.run}/batch_id={batch_id}"

    def _write(self, rows: DataFrame, root: str, batch_id: int, partitions: tuple[str, ...] = ()) -> int:
        """Replace the batch's directory and return the rows written, counted by the write itself."""
        written = Observation()
        writer = rows.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        writer = writer.option("partitionOverwriteMode", "static")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(self._directory(root, batch_id))
        return written.get["rows"]

    def _reject(self, rows: DataFrame, batch_id: int) -> int:
        """Quarantine rows in the layout of the table, so that look-ups by source and day skip other folders."""
        return self._write(rows, self.quarantine, batch_id, PARTITIONS)

    def _repeated(self, rows: DataFrame, batch_id: int) -> tuple[DataFrame, dict[Rule, str]]:
        """The rows staged, and for each unique rule a column that tells whether an earlier row has the key."""
        spark, flags = rows.sparkSession, {}
        rows = stage(rows.withColumn("__row", F.monotonically_increasing_id()), "batch")
        for rule in self._unique_rules():
            if rule.column not in rows.columns:
                continue
            index, run = self._index(rule), f"{self.run}_{batch_id}"
            index.forget(spark, run)
            if self.keys_kept is not None:
                index.forget(spark, f"{self.run}_{batch_id - self.keys_kept - 1}")
            claims = rows.select(*dict.fromkeys([rule.column, *self.order, "__row"]))
            index.insert(claims, run, [*self.order, "__row"])
            flag = f"__repeated_{len(flags)}"
            first = index.read(spark, claims.schema, [run]).select("__row", F.lit(False).alias(flag))
            rows = rows.join(first, "__row", "left").withColumn(flag, F.coalesce(flag, F.lit(True)))
            flags[rule] = flag
        return rows.drop("__row"), flags

    def _load(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        shaped = self.transform(batch) if self.transform else batch
        if self.rules is None:
            if self.quarantine is not None:
                # An earlier attempt may have kept the batch there as a whole.
                remove(batch.sparkSession, self._directory(self.quarantine, batch_id))
            return self._write(shaped, self.target, batch_id), 0
        flagged, broken = self._repeated(shaped, batch_id) if self._unique_rules() else (shaped, {})
        annotated = annotate(flagged, self.rules, broken=broken).persist()
        try:
            valid, invalid = split(annotated)
            rejected = enqueue(invalid, violations_text(F.col("violations")), self.run, payload=shaped.columns)
            # The quarantine first: if the target fails, the whole batch replaces these rows there.
            failed = self._reject(rejected, batch_id)
            return self._write(valid, self.target, batch_id), failed
        finally:
            annotated.unpersist()

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """The body of `foreachBatch`; running it again for the same batch gives the same tables."""
        started = time.monotonic()
        error = None
        try:
            loaded, failed = self._load(batch, batch_id)
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            if self.quarantine is None or re.search(TRANSIENT_ERRORS, str(e).partition("\n")[0]):
                raise
            # An earlier attempt may have written the batch.
            remove(batch.sparkSession, self._directory(self.target, batch_id))
            self._forget_keys(batch.sparkSession, batch_id)
            loaded, failed = 0, self._reject(enqueue(batch, F.lit(error), self.run), batch_id)
        if self.ledger is not None:
            data = {"batch_id": batch_id, "rows_loaded": loaded, "rows_failed": failed, "error": error}
            row = run_ledger.checkpoint_row(
                batch.sparkSession, self.run, data, {"duration_seconds": time.monotonic() - started}
            )
            row.write.mode("overwrite").parquet(self._directory(self.ledger, batch_id))

    def start(self, stream: DataFrame, available_now: bool = True) -> StreamingQuery:
        """Start the load; with `available_now` it ends when all present files are loaded."""
        writer = stream.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", self.checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def run_to_end(self, stream: DataFrame) -> None:
        """Load all present files; raises when the run fails."""
        self.start(stream).awaitTermination()


def read_loaded(spark: SparkSession, path: str, fields: T.StructType) -> DataFrame:
    """The rows of a target or quarantine written by a load, without the run columns."""
    return spark.read.schema(fields).parquet(path).select(*fields.names)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_loaded(spark, path, run_ledger.LEDGER_SCHEMA)


def query_progress(ledger: DataFrame) -> DataFrame:
    """Every recorded micro-batch of a load: `(pipeline, batch_id, ts, input_rows, rows_per_second, seconds)`."""
    seconds = F.get_json_object("metadata", "$.duration_seconds").cast("double")
    data = F.from_json("data", BATCH_FIELDS)
    batches = ledger.select("pipeline", F.col("timestamp").alias("ts"), data.alias("data"), seconds.alias("seconds"))
    rows = F.col("data.rows_loaded") + F.col("data.rows_failed")
    return batches.select(
        "pipeline", "data.batch_id", "ts", rows.alias("input_rows"), throughput(rows, F.col("seconds")).alias("rows_per_second"), "seconds"
    )


def ledger_runs(ledger: DataFrame) -> DataFrame:
    """The recorded batches as runs `(started_at, ended_at, extracted, attempted, failed)` for `metrics_summary`."""
    progress, batches = query_progress(ledger), ledger_batches(ledger).select("pipeline", "batch_id", "rows_failed")
    rows = progress.join(batches, ["pipeline", "batch_id"])
    started = F.timestamp_micros((F.unix_micros("ts") - F.col("seconds") * 1_000_000).cast("long"))
    return rows.select(
        started.alias("started_at"), F.col("ts").alias("ended_at"), F.col("input_rows").alias("extracted"),
        F.col("input_rows").alias("attempted"), F.col("rows_failed").alias("failed"),
    )


def ledger_batches(ledger: DataFrame) -> DataFrame:
    """The recorded batches `(pipeline, batch_id, rows_loaded, rows_failed, error)` of a load's ledger."""
    data = F.from_json("data", BATCH_FIELDS)
    return ledger.select("pipeline", data.alias("data")).select("pipeline", "data.*")


def load_progress(ledger: DataFrame, total_rows: Column) -> DataFrame:
    """Running totals and progress after each recorded batch of a load of `total_rows` rows."""
    loaded, failed = F.col("rows_loaded"), F.col("rows_failed")
    sums = {"loaded_so_far": loaded, "failed_so_far": failed, "extracted_so_far": loaded + failed}
    running = running_sums(ledger_batches(ledger), sums, ["batch_id"], ["pipeline"])
    return running.withColumn("progress", progress_percent(F.col("extracted_so_far"), total_rows))

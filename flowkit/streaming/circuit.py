"""Circuit state per key over a stream of outcomes, in event time.

The state of a key depends on the outcome before it, so one key's outcomes are taken in order; keys run in parallel.
Spark brings a micro-batch and the states that the batch before it left together by key, and sorts each task's rows by
key and time.  A task passes over its rows once and holds five values of the key it is at, however many rows a key has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.columns import col

CLOSED, OPEN, HALF_OPEN = "closed", "open", "half_open"

# Consecutive failures that open a circuit, seconds until a trial, successes that close it.
FAILURE_THRESHOLD = 5
RECOVERY_SECONDS = 60
SUCCESSES_TO_CLOSE = 2

# Stands for a missing time on the way to Python, so that times stay whole numbers; it sorts last.
UNTIMED = (1 << 63) - 1

OUTCOME, STATE = "outcome", "state"
LEFT = ("failures", "successes", "last_failure", "last_seen")


@dataclass
class Circuit:
    """State of one key; times are microseconds."""

    threshold: int
    recovery: int
    state: str = CLOSED
    failures: int = 0
    successes: int = 0
    last_failure: int | None = None
    last_seen: int | None = None

    def apply(self, at: int | None, ok: bool) -> str:
        """Take one outcome; returns whether it was `applied`, `rejected` (circuit open) or `late` (ignored).

        One without a time is never late and starts no trial; as a failure it counts from the last time seen.
        """
        if at is not None:
            if self.last_seen is not None and at < self.last_seen:
                return "late"
            self.last_seen = at
        if self.state == OPEN:
            if at is None or (self.last_failure is not None and at - self.last_failure < self.recovery):
                return "rejected"
            self.state, self.failures, self.successes = HALF_OPEN, 0, 0
        (self._succeed if ok else self._fail)(self.last_seen)
        return "applied"

    def _succeed(self, at: int | None) -> None:
        self.failures = 0
        if self.state == HALF_OPEN:
            self.successes += 1
            if self.successes >= SUCCESSES_TO_CLOSE:
                self.state, self.successes = CLOSED, 0

    def _fail(self, at: int | None) -> None:
        self.failures += 1
        self.last_failure = at
        if self.state == HALF_OPEN or self.failures >= self.threshold:
            self.state = OPEN


def _stepped(batches: Iterator[pa.RecordBatch], threshold: int, recovery: int) -> Iterator[pa.RecordBatch]:
    """Outcomes with the states around them, and after each key the state it is left in.

    Rows come sorted by key; a key's state row, if it has one, comes first and then its outcomes in order.
    """
    circuit, at_key, started, row_type = None, None, False, None
    for batch in batches:
        row_type = batch.schema
        out: list[dict] = []
        for row in batch.to_pylist():
            if not started or row["key"] != at_key:
                if started:
                    out.append(_left(at_key, circuit))
                circuit, at_key, started = Circuit(threshold, recovery), row["key"], True
            if row["kind"] == STATE:
                circuit = Circuit(threshold, recovery, row["state_after"], *[row[c] for c in LEFT])
                continue
            before = circuit.state
            row["outcome"] = circuit.apply(None if row["at"] == UNTIMED else row["at"], bool(row["ok"]))
            row["state_before"], row["state_after"] = before, circuit.state
            out.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=row_type)
    if started:
        yield pa.RecordBatch.from_pylist([_left(at_key, circuit)], schema=row_type)


def _left(key: object, circuit: Circuit) -> dict:
    """The row that hands a key's state on."""
    return {"key": key, "kind": STATE, "state_after": circuit.state} | {c: getattr(circuit, c) for c in LEFT}


@dataclass(frozen=True)
class CircuitLog:
    """A log of outcomes and circuit states: `batch=<n>/kind=outcome` and the states after it, `kind=state`.

    Inside a micro-batch a key's outcomes are taken in (ts, tie-break) order; one that is older than the key's last is
    `late` and changes nothing, and those without a time come last.  A NULL outcome is a failure, a NULL key is a key.
    A repeated micro-batch starts from the states of the batch before and replaces its folder.  `idle_seconds` forgets
    keys whose last outcome lies that long before the latest of all; without it keys are kept.
    """

    path: str
    checkpoint: str
    key: str
    ok: str
    ts: str = "ts"
    tie_break: str = "event_id"
    threshold: int = FAILURE_THRESHOLD
    recovery_seconds: int = RECOVERY_SECONDS
    idle_seconds: int | None = None

    def _schema(self, kinds: T.StructType) -> T.StructType:
        named = {"key": kinds[self.key].dataType, "at": T.LongType(), "tie_break": kinds[self.tie_break].dataType, "ok": T.BooleanType()}
        named |= dict.fromkeys(("state_before", "state_after", "outcome"), T.StringType())
        named |= {"failures": T.IntegerType(), "successes": T.IntegerType(), "last_failure": T.LongType(), "last_seen": T.LongType()}
        return T.StructType([T.StructField(c, t) for c, t in (named | {"kind": T.StringType()}).items()])

    def _states(self, spark: SparkSession, whole: T.StructType, batch_id: int) -> DataFrame:
        """The states that the batch before left."""
        if batch_id == 0:
            return spark.createDataFrame([], whole)
        states = spark.read.schema(whole).parquet(f"{self.path}/batch={batch_id - 1}").where(F.col("kind") == STATE)
        if self.idle_seconds is None:
            return states
        latest = states.agg(F.max("last_seen")).first()[0]
        idle = F.lit(latest) - F.col("last_seen") >= self.idle_seconds * 1_000_000
        return states.where(~F.coalesce(idle, F.lit(False)))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """The body of `foreachBatch` (one write job)."""
        whole = self._schema(batch.schema)
        at = F.coalesce(F.unix_micros(col(self.ts).cast("timestamp")), F.lit(UNTIMED))
        given = {"key": col(self.key), "at": at, "tie_break": col(self.tie_break), "ok": col(self.ok), "kind": F.lit(OUTCOME)}
        events = batch.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in whole])
        rows = events.unionByName(self._states(batch.sparkSession, whole, batch_id))
        # A state sorts before the outcomes of its key, since its time is missing.
        dealt = rows.repartition("key").sortWithinPartitions("key", F.col("at").asc_nulls_first(), "tie_break")
        threshold, recovery = self.threshold, self.recovery_seconds * 1_000_000
        stepped = dealt.mapInArrow(lambda batches: _stepped(batches, threshold, recovery), whole)
        writer = stepped.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("kind")
        writer.parquet(f"{self.path}/batch={batch_id}")

    def run_to_end(self, stream: DataFrame) -> None:
        """Take in all present files; raises when the run fails."""
        writer = stream.writeStream.foreachBatch(self.write_batch).option("checkpointLocation", self.checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    def outcomes(self, spark: SparkSession, kinds: T.StructType) -> DataFrame:
        """Per outcome: `(key, ts, tie_break, ok, state_before, state_after, outcome)`; `kinds` is the stream's schema."""
        whole = T.StructType([*self._schema(kinds), T.StructField("batch", T.LongType())])
        found = spark.read.schema(whole).parquet(self.path).where(F.col("kind") == OUTCOME)
        ts = F.timestamp_micros(F.when(F.col("at") != UNTIMED, F.col("at")))
        return found.select("key", ts.alias("ts"), "tie_break", "ok", "state_before", "state_after", "outcome")

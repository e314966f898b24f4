"""Loading quarantined records again, round by round, until each is loaded or parked.

A round takes the open records that are due, parses and checks them again, and writes one directory `round=<n>` in one
job: the records that passed (`outcome=loaded`), those to try later (`queued`), those given up (`parked`).  Records not
yet due are carried along as queued.  A round counts when its directory is complete, and the open records are the queued
ones of the last such round; so at every moment, a crash included, a record stands in exactly one of the three.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.schema import INT, TEXT, TIME, schema
from flowkit.operators.quarantine import (
    BACKOFF_MULTIPLIER,
    INITIAL_DELAY,
    MAX_DELAY,
    MAX_RETRIES,
    violations_text,
    with_retry_schedule,
)
from flowkit.plans.staging import children, exists

LOADED, QUEUED, PARKED = "loaded", "queued", "parked"
RECORD = schema(ts=TIME, source=TEXT, error=TEXT, retry_count=INT, record=TEXT)


@dataclass(frozen=True)
class Redrive:
    """Where the rounds lie, the columns of a record, and the retry policy.

    An open record is due when its delay (see `with_retry_schedule`) has passed since its last failure.  One whose error
    is not worth another attempt, or that has none left, is parked.
    """

    path: str
    fields: T.StructType
    max_retries: int = MAX_RETRIES
    initial: float = INITIAL_DELAY
    multiplier: float = BACKOFF_MULTIPLIER
    longest: float = MAX_DELAY
    jitter: bool = True

    def _round(self, number: int) -> str:
        return f"{self.path}/round={number}"

    def _schema(self) -> T.StructType:
        row = T.StructField("row", T.StructType([T.StructField(f.name, f.dataType) for f in self.fields]))
        return T.StructType([*RECORD, row, T.StructField("outcome", T.StringType())])

    def rounds(self, spark: SparkSession) -> list[int]:
        """The numbers of the complete rounds, in order."""
        found = [int(n.removeprefix("round=")) for n in children(spark, self.path) if n.startswith("round=")]
        return sorted(n for n in found if exists(spark, f"{self._round(n)}/_SUCCESS"))

    def _read(self, spark: SparkSession, rounds: list[int], outcome: str) -> DataFrame:
        if not rounds:
            return spark.createDataFrame([], self._schema())
        reader = spark.read.schema(self._schema()).option("basePath", self.path)
        return reader.parquet(*map(self._round, rounds)).where(F.col("outcome") == outcome)

    def loaded(self, spark: SparkSession) -> DataFrame:
        """The rows that were loaded, of all rounds."""
        return self._read(spark, self.rounds(spark), LOADED).select("row.*")

    def parked(self, spark: SparkSession) -> DataFrame:
        """The records given up, of all rounds."""
        return self._read(spark, self.rounds(spark), PARKED).select(*RECORD.names)

    def open(self, spark: SparkSession) -> DataFrame:
        """The records still to be loaded."""
        return self._read(spark, self.rounds(spark)[-1:], QUEUED).select(*RECORD.names)

    def _placed(self, records: DataFrame, outcome: Column, row: Column | None = None) -> DataFrame:
        whole = self._schema()["row"].dataType
        row = (F.lit(None) if row is None else row).cast(whole).alias("row")
        return records.select(*RECORD.names, row, outcome.alias("outcome"))

    def _later(self, records: DataFrame) -> DataFrame:
        """Records with an outcome: queued while an attempt is left that is worth it, else parked."""
        planned = with_retry_schedule(records, self.max_retries, self.initial, self.multiplier, self.longest, self.jitter)
        return self._placed(planned, F.when(F.col("state") == "due", QUEUED).otherwise(PARKED))

    def _write(self, rows: DataFrame, number: int) -> None:
        rows.hint("rebalance", "outcome").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "outcome"
        ).parquet(self._round(number))

    def admit(self, records: DataFrame) -> None:
        """Take in quarantine rows as the next round (one write job); open records are carried along."""
        spark = records.sparkSession
        number = (self.rounds(spark) or [-1])[-1] + 1
        open_rows = self._placed(self.open(spark), F.lit(QUEUED))
        self._write(open_rows.unionByName(self._later(records.select(*RECORD.names))), number)

    def run(
        self, spark: SparkSession, check: Callable[[DataFrame], DataFrame], now: Column | None = None
    ) -> int:
        """One round (one write job); returns its number.

        `check` gets the parsed records with the columns of `fields` and `retry_count`, and adds `is_valid` and
        `violations`.  A record that does not parse is parked.  If the check fails as a whole, its error is counted as an
        attempt of every due record; if storage fails, the round does not count and nothing has changed.
        """
        number = (self.rounds(spark) or [-1])[-1] + 1
        now = F.current_timestamp() if now is None else now
        planned = with_retry_schedule(
            self.open(spark), self.max_retries, self.initial, self.multiplier, self.longest, self.jitter
        )
        waited = F.unix_micros("ts") + (F.col("delay_seconds") * 1_000_000).cast("long")
        planned = planned.withColumn("__due", waited <= F.unix_micros(now.cast("timestamp")))
        carried = self._placed(planned.where("NOT __due"), F.lit(QUEUED))
        due = planned.where("__due").select(*RECORD.names)
        try:
            self._write(carried.unionByName(self._attempted(due, check, now)), number)
        except Exception as e:  # noqa: BLE001 - whatever the check raises is the records' error
            error = F.lit(f"{type(e).__name__}: {e}".partition("\n")[0])
            failed = self._later(self._again(due, error, now))
            self._write(carried.unionByName(failed), number)
        return number

    def _again(self, records: DataFrame, error: Column, now: Column) -> DataFrame:
        """The records as they fail once more."""
        tries = (F.col("retry_count") + 1).cast("int")
        return records.withColumns({"ts": now.cast("timestamp"), "error": error, "retry_count": tries})

    def _attempted(self, due: DataFrame, check: Callable[[DataFrame], DataFrame], now: Column) -> DataFrame:
        tagged = T.StructType([*self.fields, T.StructField("_corrupt_record", T.StringType())])
        parsed = due.withColumn("__parsed", F.from_json("record", tagged)).select(
            F.struct(*RECORD.names).alias("__record"),
            "retry_count",
            (F.col("__parsed").isNull() | F.col("__parsed._corrupt_record").isNotNull()).alias("__unreadable"),
            *[F.col("__parsed")[f.name].alias(f.name) for f in self.fields],
        )
        checked = check(parsed)
        passed = F.coalesce(F.col("is_valid"), F.lit(False)) & ~F.col("__unreadable")
        error = F.when(F.col("__unreadable"), "unreadable record").otherwise(violations_text(F.col("violations")))
        row = F.struct(*[F.col(f"`{f.name}`") for f in self.fields])
        judged = checked.select("__record.*", passed.alias("__passed"), error.alias("__error"), row.alias("__row"))
        # One pass for all outcomes, so that a check runs once for a record.
        again = self._again(judged.withColumn("__was", F.struct(*RECORD.names)), F.col("__error"), now)
        planned = with_retry_schedule(again, self.max_retries, self.initial, self.multiplier, self.longest, self.jitter)
        outcome = F.when(F.col("__passed"), LOADED).when(F.col("state") == "due", QUEUED).otherwise(PARKED)
        chosen = {c: F.when(F.col("__passed"), F.col("__was")[c]).otherwise(F.col(c)) for c in RECORD.names}
        kept = planned.withColumns({**chosen, "outcome": outcome, "__row": F.when(F.col("__passed"), F.col("__row"))})
        return self._placed(kept, F.col("outcome"), F.col("__row"))

"""Jobs: named transformation chains, clean-validate-transform, and a table migration job."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.text import require_identifier
from flowkit.operators.clean import clean
from flowkit.operators.metrics import progress_percent
from flowkit.operators.rules import RuleSet, annotate, split
from flowkit.plans.staging import exists, scratch_path, stage
from flowkit.sources.sinks import create_table, table_location
from flowkit.sources.tables import read_stream, row_count, select_rows
from flowkit.streaming.load import StreamLoad, ledger_batches, read_ledger

log = logging.getLogger(__name__)

Transformation = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Step:
    """What became of one named transformation: applied, failed or unknown."""

    name: str
    status: str
    error: str | None = None


@dataclass
class Transformations:
    """A registry of DataFrame -> DataFrame functions."""

    functions: dict[str, Transformation] = field(default_factory=dict)

    def register(self, name: str, function: Transformation) -> Transformations:
        self.functions[name] = function
        return self

    def apply(self, df: DataFrame, names: Sequence[str] | None = None) -> tuple[DataFrame, list[Step]]:
        """Chain the named functions (default: all, as registered).

        An unknown name or a function that raises is skipped and its input goes on.  Spark analyses a step when it is
        built, so a wrong column or type is caught here; data errors appear only when the result is used, so steps
        that must tolerate bad values use the `try_*` functions.
        """
        steps = []
        for name in names or list(self.functions):
            function = self.functions.get(name)
            if function is None:
                log.warning("unknown transformation %s; known: %s", name, list(self.functions))
                steps.append(Step(name, "unknown"))
                continue
            try:
                result = function(df)
                result.schema  # noqa: B018 - forces the analysis on lazily analysed sessions too
            except Exception as e:
                log.warning("transformation %s failed: %s", name, e)
                steps.append(Step(name, "failed", f"{type(e).__name__}: {e}"))
                continue
            df = result
            steps.append(Step(name, "applied"))
        return df, steps


@dataclass(frozen=True)
class Processed:
    """The lazy output, the rows that broke a rule, the steps, and row counts that fill in when `data` is used."""

    data: DataFrame
    invalid: DataFrame | None
    steps: list[str]
    transformations: list[Step]
    counts: dict[str, Observation]

    def row_counts(self) -> dict[str, int]:
        """Rows per observed step, after an action on `data`."""
        return {step: seen.get["rows"] for step, seen in self.counts.items()}


def process(
    df: DataFrame,
    clean_first: bool = True,
    rules: RuleSet | None = None,
    transformations: Transformations | None = None,
    names: Sequence[str] | None = None,
    types: Mapping[str, str] | None = None,
    drop_invalid: bool = False,
) -> Processed:
    """Clean, validate against the rules, transform.

    Row counts per step are taken by the job that uses the result, not by extra jobs; annotated rows are staged (one
    write).  With `drop_invalid` rows that
    break a rule leave the data; else they stay and carry their annotation.
    """
    counts: dict[str, Observation] = {}
    steps: list[str] = []

    def counted(frame: DataFrame, step: str) -> DataFrame:
        counts[step] = Observation(step)
        return frame.observe(counts[step], F.count(F.lit(1)).alias("rows"))

    invalid, chain = None, []
    if clean_first:
        df = counted(clean(df, types), "clean")
        steps.append("clean")
    if rules is not None:
        # Staged, so that joins and Python rules run once for both halves.
        annotated = stage(annotate(df, rules), "annotated")
        valid, invalid = split(annotated)
        df = counted(valid if drop_invalid else annotated, "validate")
        steps.append("validate")
    if transformations is not None and transformations.functions:
        df, chain = transformations.apply(df, names)
        df = counted(df, "transform")
        steps.append("transform")
    return Processed(df, invalid, steps, chain, counts)


def migrate(
    spark: SparkSession,
    source: str,
    table: str,
    where: str | None = None,
    limit: int | None = None,
    order: Sequence[str] = (),
    drop: bool = False,
    pattern: str | None = None,
    location: str | None = None,
    max_files: int | None = None,
    checkpoint: str | None = None,
    run: str = "migration",
    rules: RuleSet | None = None,
    transform: Transformation | None = None,
) -> DataFrame:
    """Copy Parquet files at `source` into a catalog table and return one status row.

    Counts the source, creates the table from its schema (after a drop with its files, if asked), loads it as a file
    stream (`StreamLoad`) and compares.  Rows that break a rule and batches that fail are kept in
    `<checkpoint>/quarantine` and counted, and the run goes on; `<checkpoint>/ledger` records every batch, which
    `streaming.load.load_progress` turns into running progress.  The same `checkpoint` and `run` resume a broken
    migration: the table is not dropped then, and a `limit` keeps the rows it chose at the start.  No cap without
    `limit`.
    """
    require_identifier(run)
    state = checkpoint or scratch_path(spark, "migration")
    resumed = exists(spark, f"{state}/offsets")
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    frame = reader.parquet(source)
    fields = frame.schema
    if limit is not None:
        capped = f"{state}/capped"
        if not exists(spark, f"{capped}/_SUCCESS"):
            select_rows(frame, where, limit, order).write.mode("overwrite").parquet(capped)
        source, pattern, where, frame = capped, None, None, spark.read.schema(fields).parquet(capped)
    total = row_count(frame, where).first()["total_rows"]
    shaped = (transform(frame) if transform else frame).schema.fields
    columns = T.StructType([*shaped, T.StructField("load_run", T.StringType()), T.StructField("batch_id", T.LongType())])
    create_table(spark, table, columns, ["load_run", "batch_id"], location, replace=drop and not resumed)
    before = 0 if resumed else _run_rows(spark, table, run)
    if before:
        raise ValueError(f"run {run!r} already loaded {before} rows; resume it with its checkpoint")
    load = StreamLoad(
        target=table_location(spark, table),
        checkpoint=state,
        run=run,
        ledger=f"{state}/ledger",
        quarantine=f"{state}/quarantine",
        rules=rules,
        transform=transform,
    )
    load.run_to_end(select_rows(read_stream(spark, source, fields, max_files, pattern=pattern), where))
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    failed = ledger_batches(read_ledger(spark, load.ledger)).agg(F.sum("rows_failed").alias("n")).first()["n"] or 0
    done, all_rows = F.col("rows_loaded"), F.lit(total).cast("long")
    status = spark.table(table).where(F.col("load_run") == run).agg(F.count(F.lit(1)).alias("rows_loaded"))
    return status.select(
        F.when(done == all_rows, "completed").otherwise("failed").alias("status"),
        progress_percent(done + failed, all_rows).alias("progress"),
        all_rows.alias("rows_extracted"),
        done.alias("rows_loaded"),
        F.lit(failed).cast("long").alias("rows_failed"),
    )


def _run_rows(spark: SparkSession, table: str, run: str) -> int:
    return spark.table(table).where(F.col("load_run") == run).agg(F.count(F.lit(1)).alias("n")).first()["n"]

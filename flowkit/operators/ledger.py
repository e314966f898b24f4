"""Run ledger: an append-only table of pipeline checkpoints, for history and inspection.

Recovery itself is the streaming checkpoint's job; the ledger is what people query.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowkit.functions.schema import TEXT, TIME, schema
from flowkit.plans.staging import partition_folders, remove, stage

SALTS = 16
LEDGER_SCHEMA = schema(id=TEXT, pipeline=TEXT, timestamp=TIME, data=TEXT, metadata=TEXT)


def checkpoint_id(ts: Column) -> Column:
    """`YYYYMMDD_HHMMSS_mmm`, in the session's time zone (UTC)."""
    return F.date_format(ts, "yyyyMMdd_HHmmss_SSS")


def checkpoint_row(
    spark: SparkSession,
    pipeline: str,
    data: Mapping[str, Any],
    metadata: Mapping[str, Any] | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    """One ledger row; append it with `save`."""
    ts = now or dt.datetime.now(dt.UTC)
    stamp = f"{ts:%Y%m%d_%H%M%S}_{ts.microsecond // 1000:03d}"
    row = (stamp, pipeline, ts, json.dumps(data, default=str), json.dumps(metadata or {}, default=str))
    return spark.createDataFrame([row], LEDGER_SCHEMA)


def checkpoint_rows(df: DataFrame, pipeline: Column, ts: Column, data: Column, metadata: Column) -> DataFrame:
    """Ledger rows from a frame; `data` and `metadata` are struct columns."""
    return df.select(
        checkpoint_id(ts).alias("id"),
        pipeline.alias("pipeline"),
        ts.alias("timestamp"),
        F.to_json(data).alias("data"),
        F.to_json(metadata).alias("metadata"),
    )


def save(rows: DataFrame, path: str) -> None:
    """Append ledger rows (one write job)."""
    rows.write.mode("append").parquet(path)


def save_by_pipeline(rows: DataFrame, path: str) -> None:
    """Append ledger rows to a ledger with a folder per pipeline, which can be cleaned up in place (one write job)."""
    rows.hint("rebalance", "pipeline").write.mode("append").partitionBy("pipeline").parquet(path)


def read_by_pipeline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path).select(*LEDGER_SCHEMA.names)


def _replace(kept: DataFrame, path: str, touched: list[str]) -> None:
    """Put the kept rows of the touched pipelines in the place of their folders; a pipeline without any loses its own.

    The rows are staged first, since they are read from the folders they replace.
    """
    spark = kept.sparkSession
    staged = stage(kept, "kept")
    writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("pipeline").parquet(path)
    left = {r[0] for r in staged.select("pipeline").distinct().collect()}
    for folder, pipeline in partition_folders(spark, path, "pipeline"):
        if pipeline in touched and pipeline not in left:
            remove(spark, folder)


def prune_in_place(spark: SparkSession, path: str, keep: int = 5, pipeline: str | None = None) -> list[str]:
    """Keep the newest `keep` checkpoints per pipeline, or of the one named; returns the pipelines that had more.

    Only the folders of those are written again; all other files stay as they are.  The names of the pipelines go
    through the driver, as the folders do.
    """
    ledger = read_by_pipeline(spark, path)
    own = ledger if pipeline is None else ledger.where(F.col("pipeline") == pipeline)
    counted = own.groupBy("pipeline").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > keep)
    touched = sorted(r["pipeline"] for r in counted.collect())
    if touched:
        _replace(keep_newest(ledger.where(F.col("pipeline").isin(touched)), keep), path, touched)
    return touched


def delete_in_place(spark: SparkSession, path: str, pipeline: str, checkpoint: str | None = None) -> None:
    """Delete one checkpoint of a pipeline, or its whole folder; other folders are not touched."""
    own = read_by_pipeline(spark, path).where(F.col("pipeline") == pipeline)
    if checkpoint is None:
        for folder, name in partition_folders(spark, path, "pipeline"):
            if name == pipeline:
                remove(spark, folder)
    elif not own.where(F.col("id") == checkpoint).isEmpty():
        _replace(own.where(F.col("id") != checkpoint), path, [pipeline])


def latest(ledger: DataFrame) -> DataFrame:
    """The newest checkpoint of every pipeline; combined per task, so a busy pipeline costs one row per task."""
    newest = F.max_by(F.struct(*ledger.columns), F.struct("id", "timestamp", "data"))
    return ledger.groupBy("pipeline").agg(newest.alias("__newest")).select("__newest.*")


def load(ledger: DataFrame, pipeline: str, checkpoint: str | None = None) -> DataFrame:
    """The newest checkpoint of a pipeline, or the one with the given id; no row when there is none."""
    own = ledger.where(F.col("pipeline") == pipeline)
    return latest(own) if checkpoint is None else own.where(F.col("id") == checkpoint)


def recovery_point(ledger: DataFrame, pipeline: str) -> DataFrame:
    """The `data` of the newest checkpoint."""
    return load(ledger, pipeline).select("data")


def list_checkpoints(ledger: DataFrame, pipeline: str) -> DataFrame:
    """Checkpoints of a pipeline, newest first."""
    return ledger.where(F.col("pipeline") == pipeline).select("id", "timestamp").orderBy(F.col("id").desc())


def stats(ledger: DataFrame) -> DataFrame:
    """Per pipeline: count, bytes of the recorded data and metadata, oldest and newest id."""
    size = F.octet_length("data") + F.octet_length("metadata")
    return ledger.groupBy("pipeline").agg(
        F.count(F.lit(1)).alias("total_checkpoints"),
        F.sum(size.cast("long")).alias("total_size_bytes"),
        F.min("id").alias("oldest"),
        F.max("id").alias("newest"),
    )


def keep_newest(ledger: DataFrame, keep: int = 5, pipeline: str | None = None) -> DataFrame:
    """What a clean-up leaves: the newest `keep` checkpoints per pipeline, or of the one named.

    A pipeline's checkpoints are spread over `SALTS` tasks, which hand on their newest `keep` each; so the task that
    takes the last cut gets at most `SALTS` times `keep` of them, however many there are.
    """
    newest = [F.col("id").desc(), F.col("timestamp").desc(), F.col("data")]
    own = ledger if pipeline is None else ledger.where(F.col("pipeline") == pipeline)
    salted = own.withColumn("__salt", F.pmod(F.xxhash64("id", "data"), F.lit(SALTS)))
    for keys in (["pipeline", "__salt"], ["pipeline"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
        salted = salted.withColumn("__rank", rank).where(F.col("__rank") <= keep).drop("__rank")
    kept = salted.drop("__salt")
    return kept if pipeline is None else kept.unionByName(ledger.where(F.col("pipeline") != pipeline))


def deleted_counts(ledger: DataFrame, keep: int = 5) -> DataFrame:
    """Checkpoints that a clean-up removes, per pipeline."""
    surplus = F.greatest(F.count(F.lit(1)) - keep, F.lit(0))
    return ledger.groupBy("pipeline").agg(surplus.alias("deleted"))


def without(ledger: DataFrame, pipeline: str, checkpoint: str | None = None) -> DataFrame:
    """The ledger without one checkpoint, or without all of a pipeline."""
    gone = F.col("pipeline") == pipeline
    if checkpoint is not None:
        gone = gone & (F.col("id") == checkpoint)
    return ledger.where(~gone)


def rewrite(kept: DataFrame, new_path: str) -> DataFrame:
    """Write the kept rows as a new version of the ledger (one write job) and read it."""
    kept.write.mode("errorifexists").parquet(new_path)
    return kept.sparkSession.read.schema(LEDGER_SCHEMA).parquet(new_path)

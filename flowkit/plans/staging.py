"""Staged tables: a frame written once to shared storage and read back.

A staged table cuts the lineage and survives the loss of executors, because it lives in the folder that
`spark.checkpoint.dir` names.  Only a local session may fall back to a folder on this machine.
"""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and streaming state."""
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="flowkit-")
    spark.conf.set(SETTING, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's part of the shared folder; nothing is created yet."""
    return f"{scratch_root(spark)}/flowkit/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def kept_path(spark: SparkSession, label: str) -> str:
    """A path that stays the same over the application and that `clear_staged` leaves alone, for stored inputs."""
    return f"{scratch_root(spark)}/flowkit-kept/{spark.sparkContext.applicationId}/{label}"


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any file system that Spark reaches."""
    files, where = _at(spark, path)
    return files.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder, none if it is not there."""
    files, where = _at(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def partition_folders(spark: SparkSession, path: str, column: str) -> list[tuple[str, str]]:
    """The folders of a partition column directly below a path, each with its value as text."""
    named = [n for n in children(spark, path) if n.startswith(f"{column}=")]
    return [(f"{path}/{n}", unquote(n.partition("=")[2])) for n in named]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    files, where = _at(spark, path)
    files.delete(where, True)


def clear_staged(spark: SparkSession) -> None:
    """Delete what this application has staged; frames that read it stop working."""
    remove(spark, f"{scratch_root(spark)}/flowkit/{spark.sparkContext.applicationId}")


def clear_kept(spark: SparkSession) -> None:
    """Delete the stored inputs that this application has kept."""
    remove(spark, f"{scratch_root(spark)}/flowkit-kept/{spark.sparkContext.applicationId}")


def write_stage(df: DataFrame, label: str) -> str:
    """Write `df` to a fresh staged table (one write job) and return its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to a fresh staged table and read it back (one write job)."""
    return df.sparkSession.read.schema(df.schema).parquet(write_stage(df, label))

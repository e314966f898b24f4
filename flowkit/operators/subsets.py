"""Conditional subsets kept up to date from batches of changed rows, without reading the source again.

A batch holds the new state of some rows.  Compared with the subset as it was, a row comes in, goes out, changes, or
does not matter; what matters is written as the batch's changes.  The subset is the last complete base plus the last
change of each key since; `compact` writes a new base.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.columns import col
from flowkit.plans.staging import children, exists

IN, OUT, CHANGED = "in", "out", "changed"


@dataclass(frozen=True)
class KeptSubset:
    """Where the subset lies, its columns and key, and the condition (one SQL expression) its rows fulfil.

    A row whose condition is NULL is not in the subset.  NULL is a key as any other.
    """

    path: str
    fields: T.StructType
    keys: tuple[str, ...]
    condition: str

    def _numbers(self, spark: SparkSession, kind: str) -> list[int]:
        """The numbers of the complete folders of a kind."""
        named = [n.partition("=")[2] for n in children(spark, f"{self.path}/{kind}") if "=" in n]
        return sorted(int(n) for n in named if exists(spark, f"{self.path}/{kind}/batch={n}/_SUCCESS"))

    def _plain(self, *more: T.StructField) -> T.StructType:
        return T.StructType([*[T.StructField(f.name, f.dataType) for f in self.fields], *more])

    def changes(self, spark: SparkSession, after: int = -1, before: int | None = None) -> DataFrame:
        """`(batch, op, columns...)` of the batches within bounds; `op` is in, out or changed."""
        chosen = [n for n in self._numbers(spark, "changes") if n > after and (before is None or n < before)]
        whole = self._plain(T.StructField("op", T.StringType()), T.StructField("batch", T.LongType()))
        if not chosen:
            return spark.createDataFrame([], whole)
        reader = spark.read.schema(whole).option("basePath", f"{self.path}/changes")
        return reader.parquet(*[f"{self.path}/changes/batch={n}" for n in chosen])

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The rows of the subset, as it is or as it was before a batch."""
        names = self.fields.names
        bases = [n for n in self._numbers(spark, "base") if before is None or n < before]
        since = bases[-1] if bases else -1
        changed = self.changes(spark, since, before)
        if bases:
            base = spark.read.schema(self._plain()).parquet(f"{self.path}/base/batch={since}")
            changed = changed.unionByName(base.withColumns({"op": F.lit(IN), "batch": F.lit(since).cast("long")}))
        newest = F.max_by(F.struct("op", *[col(c) for c in names]), F.col("batch")).alias("__row")
        last = changed.groupBy(*[col(k).alias(f"__key_{i}") for i, k in enumerate(self.keys)]).agg(newest)
        return last.where(F.col("__row.op") != OUT).select(*[F.col("__row")[c].alias(c) for c in names])

    def apply(self, rows: DataFrame, batch: int, order: Sequence[str], deleted: Column | None = None) -> None:
        """Take in a batch: the last row per key in `order` is its new state, unless `deleted` says it is gone.

        Batches are numbered upwards; applying the last one again replaces its changes.  (One write job; it reads the
        batch and the keys of the subset.)
        """
        if any(n >= batch for n in self._numbers(rows.sparkSession, "base")):
            raise ValueError(f"batch {batch} is part of the base already")
        names = self.fields.names
        gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
        state = F.struct(*[col(c) for c in names], gone.alias("__gone"))
        # NULLs come first in a struct's order, as everywhere else.
        last = rows.groupBy(*[col(k).alias(f"__key_{i}") for i, k in enumerate(self.keys)]).agg(
            F.max_by(state, F.struct(*[col(c) for c in order])).alias("__new")
        )
        now = last.select("__new.*")
        old = self.read(rows.sparkSession, batch).select(F.struct(*[col(c) for c in names]).alias("__old"))
        same_key = reduce(lambda a, b: a & b, [col(k).eqNullSafe(F.col("__old")[k]) for k in self.keys])
        both = now.join(old, same_key, "left")
        holds = F.coalesce(F.expr(self.condition), F.lit(False)) & ~F.col("__gone")
        was = F.col("__old").isNotNull()
        differs = reduce(lambda a, b: a | b, [~col(c).eqNullSafe(F.col("__old")[c]) for c in names])
        op = F.when(holds & ~was, IN).when(~holds & was, OUT).when(holds & differs, CHANGED)
        both.withColumn("op", op).where("op IS NOT NULL").select(*names, "op").write.mode("overwrite").parquet(
            f"{self.path}/changes/batch={batch}"
        )

    def compact(self, spark: SparkSession) -> None:
        """Write the subset after the last batch as a new base (one write job)."""
        if numbers := self._numbers(spark, "changes"):
            self.read(spark).write.mode("overwrite").parquet(f"{self.path}/base/batch={numbers[-1]}")

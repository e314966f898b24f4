"""A Parquet target with a key index, into which rows are inserted if their key is absent.

Layout: `rows/insert=<run>/key_bucket=<n>` holds the rows that a run inserted, `filters/insert=<run>` the run's Bloom filters.
A key belongs to the bucket its hash names.  A bucket's filter is a set of 64-bit blocks: a key picks one block and a few
bits of it, so a probe is an equi-join on (bucket, block) and a filter is never held whole.  Only keys that some filter
may hold are looked up, and only in the buckets they fall in.

A run is committed when its filters are complete, and only committed runs are read.  Running it again then changes
nothing; a run that stopped half-way is written anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.columns import col
from flowkit.functions.schema import INT, LONG, schema
from flowkit.functions.text import require_identifier
from flowkit.operators.clean import keep_first
from flowkit.plans.staging import children, exists, remove, stage

BITS_PER_BLOCK = 64
BITS_PER_KEY = 16
PROBES = 4
BUCKET = "key_bucket"
FILTER_SCHEMA = schema(key_bucket=INT, block=LONG, bits=LONG)
DONE = "_SUCCESS"


@dataclass(frozen=True)
class KeyedTarget:
    """Where the target lies, its key, and for how many keys a bucket is laid out.

    `buckets` and `keys_per_bucket` are fixed for the life of a target (an insert with others is refused).  More keys
    than they provide for cost accuracy of the filters, never correctness.  Key columns may hold NULL, which equals
    NULL here.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 64
    keys_per_bucket: int = 1_000_000

    def __post_init__(self) -> None:
        if not self.keys or self.buckets < 1 or self.keys_per_bucket < 1:
            raise ValueError("a keyed target needs a key and room for it")

    def _hash(self, seed: int) -> Column:
        # The hash passes over a NULL, so whether there is one counts too.
        return F.xxhash64(F.lit(seed), *[part for k in self.keys for part in (col(k).isNull(), col(k))])

    def placed(self, rows: DataFrame) -> DataFrame:
        """Rows with the bucket, the block and the bits of their key."""
        blocks = max(1, self.keys_per_bucket * BITS_PER_KEY // BITS_PER_BLOCK)
        places = [F.pmod(F.shiftright(self._hash(3), 6 * i), F.lit(BITS_PER_BLOCK)).cast("int") for i in range(PROBES)]
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
        return rows.withColumns({
            BUCKET: F.pmod(self._hash(1), F.lit(self.buckets)).cast("int"),
            "__block": F.pmod(self._hash(2), F.lit(blocks)),
            "__bits": reduce(lambda a, b: a.bitwiseOR(b), bits),
        })

    def _rows(self, run: str) -> str:
        return f"{self.path}/rows/insert={run}"

    def _filters(self, run: str) -> str:
        return f"{self.path}/filters/insert={run}"

    def _layout(self) -> str:
        return f"{self.path}/layout"

    def runs(self, spark: SparkSession) -> list[str]:
        """The names of the committed runs."""
        named = [name.removeprefix("insert=") for name in children(spark, f"{self.path}/filters")]
        return sorted(run for run in named if exists(spark, f"{self._filters(run)}/{DONE}"))

    def _check_layout(self, spark: SparkSession) -> None:
        own = (",".join(self.keys), self.buckets, self.keys_per_bucket)
        fields = "keys STRING, buckets INT, keys_per_bucket INT"
        if not exists(spark, f"{self._layout()}/{DONE}"):
            spark.createDataFrame([own], fields).coalesce(1).write.mode("overwrite").parquet(self._layout())
        elif (found := tuple(spark.read.schema(fields).parquet(self._layout()).first())) != own:
            raise ValueError(f"the target is laid out as {found}, not as {own}")

    def read(self, spark: SparkSession, fields: T.StructType, runs: Sequence[str] | None = None) -> DataFrame:
        """The rows of the committed runs, or of some of them, with the partition columns `insert` and `key_bucket`."""
        parts = [T.StructField("insert", T.StringType()), T.StructField(BUCKET, T.IntegerType())]
        whole = T.StructType([*[T.StructField(f.name, f.dataType) for f in fields], *parts])
        paths = [self._rows(run) for run in (self.runs(spark) if runs is None else runs)]
        if not paths:
            return spark.createDataFrame([], whole)
        return spark.read.schema(whole).option("basePath", f"{self.path}/rows").parquet(*paths)

    def rows(self, spark: SparkSession, fields: T.StructType) -> DataFrame:
        """The rows of the target."""
        return self.read(spark, fields).select(*[col(f.name) for f in fields])

    def forget(self, spark: SparkSession, run: str) -> None:
        """Take a run out of the target: its keys count as absent again."""
        remove(spark, self._filters(run))
        remove(spark, self._rows(run))

    def _maybe_known(self, first: DataFrame, runs: Sequence[str]) -> DataFrame:
        """The keys of `first` that a filter may hold, with their bucket."""
        spark = first.sparkSession
        filters = spark.read.schema(FILTER_SCHEMA).parquet(*[self._filters(run) for run in runs])
        probe = filters.select(F.col(BUCKET).alias("__b"), F.col("block").alias("__k"), "bits")
        meets = (F.col(BUCKET) == F.col("__b")) & (F.col("__block") == F.col("__k"))
        held = meets & (F.col("bits").bitwiseAND(F.col("__bits")) == F.col("__bits"))
        return first.join(probe, held, "left_semi").select(*[col(k) for k in self.keys], BUCKET)

    def known_keys(self, first: DataFrame, runs: Sequence[str]) -> DataFrame:
        """The keys of `first` (placed, one row per key) that a run has inserted.

        The buckets to look into, at most `buckets` numbers, go through the driver, so that the scan of the target is
        pruned to them.  (Runs the probe.)
        """
        maybe = stage(self._maybe_known(first, runs), "probed")
        asked = sorted(r[0] for r in maybe.select(BUCKET).distinct().collect())
        fields = T.StructType([first.schema[k] for k in self.keys])
        target = self.read(first.sparkSession, fields, runs).where(F.col(BUCKET).isin(asked))
        named = target.select(F.col(BUCKET).alias("__b"), *[col(k).alias(f"__key_{i}") for i, k in enumerate(self.keys)])
        return maybe.join(named, self._same_key() & (F.col(BUCKET) == F.col("__b")), "left_semi")

    def _same_key(self) -> Column:
        on = [col(k).eqNullSafe(F.col(f"__key_{i}")) for i, k in enumerate(self.keys)]
        return reduce(lambda a, b: a & b, on)

    def absent(self, placed: DataFrame, runs: Sequence[str]) -> DataFrame:
        """The rows of `placed` (one per key) whose key no run has inserted."""
        if not runs:
            return placed
        known = self.known_keys(placed, runs).select(*[col(k).alias(f"__key_{i}") for i, k in enumerate(self.keys)])
        return placed.join(known, self._same_key(), "left_anti")

    def insert(self, new: DataFrame, run: str, order: Sequence[str]) -> bool:
        """Insert the first row per key in `order` where the target lacks the key, as run `run`.

        Returns whether anything was done: a committed run is left alone.  (Runs the reduction to one row per key, the
        probe, a write of the rows, and one of the filters, which are made from the written rows.)
        """
        spark = new.sparkSession
        require_identifier(run)
        if {"insert", BUCKET} & set(new.columns):
            raise ValueError(f"a row may not have a column insert or {BUCKET}")
        if exists(spark, f"{self._filters(run)}/{DONE}"):
            return False
        self._check_layout(spark)
        remove(spark, self._filters(run))
        first = stage(self.placed(keep_first(new, self.keys, order)), "first")
        absent = self.absent(first, self.runs(spark)).drop("__block", "__bits")
        absent.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self._rows(run))
        written = self.placed(self.read(spark, new.schema, [run]).drop("insert", BUCKET))
        made = written.groupBy(BUCKET, F.col("__block").alias("block")).agg(F.bit_or("__bits").alias("bits"))
        made.write.mode("overwrite").parquet(self._filters(run))
        return True

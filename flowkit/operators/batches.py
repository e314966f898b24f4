"""Consecutive batches, per-batch functions, map-reduce, and size estimates."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowkit.functions.columns import col
from flowkit.plans.ordered import running_sums, with_row_index

BATCH, CHUNK = "batch_id", "chunk_id"

# Bytes of a value of each fixed-width type.
WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def with_batch_id(df: DataFrame, order: Sequence[str], batch_size: int, buckets: int | None = None) -> DataFrame:
    """Add the number of the consecutive batch of `batch_size` rows, in a global `order`; no one-task sort."""
    indexed = with_row_index(df, order, name="__index", buckets=buckets)
    return indexed.withColumn(BATCH, F.floor(F.col("__index") / batch_size).cast("long")).drop("__index")


def process_batches(
    df: DataFrame, process: Callable[[pd.DataFrame], Any], data_type: str, batch: str = BATCH
) -> DataFrame:
    """Run `process` on each batch as a pandas frame: `(batch_id, success, data, error, duration_ms)`.

    A batch that raises gives a row with its error and leaves the others alone.  A batch is held in memory by one
    task, so bound its size with `with_batch_id`.  Batches go to a fixed number of tasks, since Spark would merge
    tasks by their bytes, which say nothing about the work of a Python function.
    """

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        started = time.perf_counter()
        data, error = None, None
        try:
            data = process(pdf.drop(columns=[batch]))
        except Exception as e:  # noqa: BLE001 - any error of a user function is the batch's result
            error = f"Batch {key[0]} failed: {e}"
        took = (time.perf_counter() - started) * 1000
        row = {"batch_id": key[0], "success": error is None, "data": data, "error": error, "duration_ms": took}
        return pd.DataFrame([row])

    schema = f"batch_id BIGINT, success BOOLEAN, data {data_type}, error STRING, duration_ms DOUBLE"
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, col(batch)).groupBy(col(batch)).applyInPandas(run, schema)


def process_items(
    df: DataFrame,
    process: Callable[[pd.DataFrame], Any],
    data_type: str,
    order: Sequence[str],
    batch_size: int = 100,
    buckets: int | None = None,
) -> DataFrame:
    """`process_batches` over consecutive batches."""
    return process_batches(with_batch_id(df, order, batch_size, buckets), process, data_type)


def map_reduce(
    df: DataFrame,
    map_value: Callable[[Any], Any],
    reduce_values: Callable[[Any, Any], Any],
    result_type: str,
    fan_in: int = 64,
    by_batch: bool = False,
) -> DataFrame:
    """One row `(result)`: map every row, given as a dict, then combine with an associative and commutative function.

    Values are as stored: None for NULL, whole numbers as int, arrays as lists.  With `by_batch` the map gets Arrow
    record batches instead, of any size, and gives one value for each; a batch whose map raises is mapped again by
    halves.  Only rows whose map raises by themselves are dropped; without any mapped value the result is NULL.  Each
    task reduces its own rows and sends one value on; the values meet in `fan_in` tasks and then in one.  Prefer
    built-in aggregates where they express the reduction.
    """
    schema = T.StructType.fromDDL(f"result {result_type}")
    arrow = to_arrow_schema(schema)

    def tried(item: Any) -> Iterator[Any]:
        try:
            value = map_value(item)
        except Exception:  # noqa: BLE001 - a failed map drops its row
            if by_batch and item.num_rows > 1:
                half = item.num_rows // 2
                yield from tried(item.slice(0, half))
                yield from tried(item.slice(half))
            return
        yield value

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[Any]:
        for batch in batches:
            for item in [batch] if by_batch else batch.to_pylist():
                yield from tried(item)

    def fold(values: Iterator[Any]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        total = reduce(lambda a, b: b if a is nothing else reduce_values(a, b), values, nothing)
        if total is not nothing:
            yield pa.RecordBatch.from_pylist([{"result": total}], schema=arrow)

    def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fold(mapped(batches))

    def next_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fold(v for batch in batches for v in batch.column("result").to_pylist())

    partial = df.mapInArrow(first_level, schema)
    combined = partial.repartition(fan_in).mapInArrow(next_level, schema)
    return combined.repartition(1).mapInArrow(next_level, schema).agg(F.first("result").alias("result"))


def optimal_chunk_size(total: Column, item_mb: Column, max_mb: float = 500) -> Column:
    """Items per chunk that fit into `max_mb`, between 1 and the total; without a size, a tenth, at least 100."""
    fitting = F.floor(F.try_divide(F.lit(max_mb).cast("double"), item_mb.cast("double")))
    known = F.greatest(F.lit(1), F.least(fitting, total))
    unknown = F.greatest(F.lit(100), F.floor(total / 10))
    return F.when(item_mb <= 0, unknown).otherwise(known).cast("long")


def _bytes(f: T.StructField) -> Column:
    if isinstance(f.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(col(f.name))
    width = next((w for kind, w in WIDTHS.items() if isinstance(f.dataType, kind)), None)
    if width is not None:
        return F.lit(width)
    return F.octet_length(F.to_json(F.struct(col(f.name))))


def column_bytes(df: DataFrame) -> DataFrame:
    """Estimated bytes per column `(column, bytes)`: text by its length, fixed-width values by their width."""
    sums = df.agg(*[
        F.coalesce(F.sum(_bytes(f).cast("long")), F.lit(0)).alias(str(i)) for i, f in enumerate(df.schema)
    ])
    pairs = [F.struct(F.lit(n).alias("column"), F.col(str(i)).alias("bytes")) for i, n in enumerate(df.columns)]
    return sums.select(F.inline(F.array(*pairs)))


def cut_by_bytes(df: DataFrame, budget: int, order: Sequence[str], name: str = CHUNK) -> DataFrame:
    """Add the number of a chunk of consecutive rows in `order`; no chunk has more than `budget` bytes.

    Bytes are those of `column_bytes`.  Rows of more than half a budget are chunks of their own (only a single row that
    is larger than the budget exceeds it).  The others fall, by the sum of the bytes before them, into cells of half a
    budget; a cell's rows begin within half a budget and the last one ends within another half.  Numbers grow along the
    order and may leave gaps.  The sums run over ranges of rows, so neither one task nor the driver sees all of them.
    """
    half = max(1, budget // 2)
    size = reduce(lambda a, b: a + b, [F.coalesce(_bytes(f).cast("long"), F.lit(0).cast("long")) for f in df.schema])
    rows = df.withColumn("__bytes", size).withColumn("__wide", (F.col("__bytes") > half).cast("int"))
    narrow = F.col("__bytes") * (1 - F.col("__wide"))
    summed = running_sums(rows, {"__before": narrow, "__wides": F.col("__wide")}, order)
    cell = F.floor((F.col("__before") - narrow) / half)
    return summed.withColumn(name, (2 * F.col("__wides") - F.col("__wide") + cell).cast("long")).select(*df.columns, name)


def estimated_megabytes(df: DataFrame) -> DataFrame:
    """One row `(megabytes)` for the whole frame."""
    return column_bytes(df).agg((F.sum("bytes") / (1024 * 1024)).alias("megabytes"))

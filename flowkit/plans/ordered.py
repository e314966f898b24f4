"""Ordered operators (index, running sum, fill) without a one-task window.

`Window.orderBy` with no partition, or with a key that holds a third of the rows, runs in one task.  Here rows are
range-partitioned on (keys, order) into buckets of similar size, each row is tagged with its bucket, and the tagged
frame is staged, so the tag is the same for every later read.  Windows then run inside (keys, bucket).

What a bucket needs from the buckets before or after it is a carry row.  A key lies in one bucket unless it crosses a
bucket boundary, and at most two keys per bucket cross one; so the carry table has at most two rows per bucket.

Give `order` a unique tie-break as its last column; without one, tied rows have no defined order, as in any sort.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.columns import col, present
from flowkit.plans.staging import stage

BUCKET = "__bucket"
ROWS_PER_BUCKET = 10_000_000
ROWS_WORTH_A_BUCKET = 1_000


def bucket_count(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Enough buckets for the row count; one per shuffle partition unless the frame is small (runs a count)."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.count()
    return max(1, min(partitions, rows // ROWS_WORTH_A_BUCKET), math.ceil(rows / rows_per_bucket))


def stage_in_order(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """`df` plus its bucket number, staged (one range shuffle, one write).  Buckets follow (keys, order)."""
    n = buckets or bucket_count(df)
    ranges = [col(c).asc_nulls_first() for c in [*keys, *order]]
    return stage(df.repartitionByRange(n, *ranges).withColumn(BUCKET, F.spark_partition_id()), "ordered")


def _within(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*[col(k) for k in keys], BUCKET).orderBy(*[col(c).asc_nulls_first() for c in order])


def _carry_table(summary: DataFrame, keys: Sequence[str], carried: Mapping[str, Column]) -> DataFrame:
    """Rows of `summary` for the keys found in more than one bucket, with the `carried` columns over the buckets."""
    per_key = Window.partitionBy(*[col(k) for k in keys])
    return (
        summary.withColumns({**carried, "__buckets": F.count(F.lit(1)).over(per_key)})
        .where(F.col("__buckets") > 1)
        .select(
            *[col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
            F.col(BUCKET).alias("__carry_bucket"),
            *carried,
        )
    )


def _with_carry(staged: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The carry table is broadcast if its rows, at most two per bucket, have a fixed width; else Spark decides."""
    fixed = all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) for f in carry.schema)
    on = F.col(BUCKET) == F.col("__carry_bucket")
    for i, k in enumerate(keys):
        on = on & col(k).eqNullSafe(F.col(f"__key_{i}"))
    helpers = ["__carry_bucket", *[f"__key_{i}" for i in range(len(keys))]]
    return staged.join(F.broadcast(carry) if fixed else carry, on, "left").drop(*helpers)


def running_sums(
    df: DataFrame,
    sums: Mapping[str, Column],
    order: Sequence[str],
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Add running totals (current row included) per key, or over the whole frame when `keys` is empty."""
    staged = stage_in_order(df, order, keys, buckets)
    names = list(sums)
    summary = staged.groupBy(*[col(k) for k in keys], BUCKET).agg(
        *[F.sum(sums[n]).alias(f"__part_{i}") for i, n in enumerate(names)]
    )
    before = (
        Window.partitionBy(*[col(k) for k in keys])
        .orderBy(BUCKET)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = {f"__carry_{i}": F.sum(f"__part_{i}").over(before) for i in range(len(names))}
    local = _within(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0)
    out = _with_carry(staged, _carry_table(summary, keys, carried), keys)
    totals = {
        n: F.coalesce(F.sum(sums[n]).over(local), zero) + F.coalesce(F.col(f"__carry_{i}"), zero)
        for i, n in enumerate(names)
    }
    return out.withColumns(totals).drop(BUCKET, *carried)


def _indexed(df: DataFrame, order: Sequence[str], name: str, buckets: int | None) -> DataFrame:
    by = [col(c).asc_nulls_first() for c in order]
    ranges = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    placed = stage(placed.withColumn("__place", F.monotonically_increasing_id()), "indexed")
    # An id is the task's number in its high bits and the place in the task in the 33 low ones.
    task = F.shiftright("__place", 33).alias("__task")
    before = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(task).agg(F.count(F.lit(1)).alias("__rows"))
    starts = counts.select("__task", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    # One row per task that wrote, so the table is small whatever the size of the data.
    joined = placed.withColumn("__task", task).join(F.broadcast(starts), "__task")
    place = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn(name, F.col("__start") + place).select(*df.columns, name)


def with_row_index(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    name: str = "row_index",
    buckets: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in `order`, per key or over the whole frame.

    Without keys the rows are shuffled once: they are sorted within their ranges, staged with their place in the range,
    and a range's first position is the number of rows in the ranges before it.
    """
    if not keys:
        return _indexed(df, order, name, buckets)
    counted = running_sums(df, {name: F.lit(1).cast("long")}, order, keys, buckets)
    return counted.withColumn(name, F.col(name) - 1)


def fill_along(
    df: DataFrame,
    columns: Sequence[str],
    order: Sequence[str],
    keys: Sequence[str] = (),
    buckets: int | None = None,
) -> DataFrame:
    """Forward fill, then backward fill, the missing values of `columns` in `order`."""
    staged = stage_in_order(df, order, keys, buckets)
    types = {f.name: f.dataType for f in df.schema}
    value = {c: present(c, types[c]) for c in columns}
    position = F.struct(*[col(c) for c in order])
    ends = []
    for i, c in enumerate(columns):
        known = F.when(value[c].isNotNull(), position)
        ends += [
            F.min_by(value[c], known).alias(f"__first_{i}"),
            F.max_by(value[c], known).alias(f"__last_{i}"),
        ]
    summary = staged.groupBy(*[col(k) for k in keys], BUCKET).agg(*ends)
    across = Window.partitionBy(*[col(k) for k in keys]).orderBy(BUCKET)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    # What the forward fill leaves lies before the first known value, so the backward fill is that value.  Frames
    # that end at the current row or span the whole group take linear time; "from here on" would be quadratic.
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried: dict[str, Column] = {}
    for i in range(len(columns)):
        carried[f"__prev_{i}"] = F.last(f"__last_{i}", ignorenulls=True).over(before)
        carried[f"__next_{i}"] = F.first(f"__first_{i}", ignorenulls=True).over(whole)
    upto = _within(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = _within(keys, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = _with_carry(staged, _carry_table(summary, keys, carried), keys)
    filled = {
        c: F.coalesce(
            F.last(value[c], ignorenulls=True).over(upto),
            F.col(f"__prev_{i}"),
            F.first(value[c], ignorenulls=True).over(inside),
            F.col(f"__next_{i}"),
        )
        for i, c in enumerate(columns)
    }
    return out.withColumns(filled).drop(BUCKET, *carried)

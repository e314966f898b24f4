"""Attach per-key facts to rows when a few keys may hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowkit.functions.columns import col

# A key is hot when it holds more than this share of all rows, so there are fewer than 1 / share hot keys.
HOT_SHARE = 0.001


def _same_key(keys: Sequence[str]) -> Column:
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & col(k).eqNullSafe(F.col(f"__key_{i}"))
    return on


def attach_by_key(
    rows: DataFrame, facts: DataFrame, keys: Sequence[str], rows_column: str, hot_share: float = HOT_SHARE
) -> DataFrame:
    """Add the columns of `facts`, which has one row for every key in `rows`, with its row count in `rows_column`.

    `facts` comes from a group-by on `rows`, so it is combined before its shuffle.  The facts of hot keys, at most
    1 / hot_share of them, are broadcast.  In the join with the other facts a hot row has nothing to match, and goes
    to a partition by the number of its input partition, so no task gets more than its share.
    """
    helpers = [f"__key_{i}" for i in range(len(keys))]
    added = [c for c in facts.columns if c not in keys]
    named = facts.withColumnsRenamed({k: f"__key_{i}" for i, k in enumerate(keys)})
    total = rows.agg(F.count(F.lit(1))).scalar()
    is_hot = F.coalesce(col(rows_column) > total * hot_share, F.lit(False))
    hot = named.where(is_hot).withColumnsRenamed({c: f"__hot_{c}" for c in added})
    cold = named.where(~is_hot).withColumn("__cold", F.lit(-1))
    spread = F.when(col(f"__hot_{rows_column}").isNotNull(), F.spark_partition_id()).otherwise(-1)
    near = rows.join(F.broadcast(hot), _same_key(keys), "left").drop(*helpers).withColumn("__spread", spread)
    both = near.join(cold, _same_key(keys) & (F.col("__spread") == F.col("__cold")), "left")
    return both.select(
        *[col(c) for c in rows.columns], *[F.coalesce(col(f"__hot_{c}"), col(c)).alias(c) for c in added]
    )


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], flag: str = "is_duplicate", hot_share: float = HOT_SHARE
) -> DataFrame:
    """Mark every member of a group of rows that share `keys`; NULL keys count as equal."""
    facts = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__rows"))
    facts = facts.withColumn(flag, F.col("__rows") > 1)
    return attach_by_key(df, facts, keys, "__rows", hot_share).drop("__rows")


def flag_orphans(
    df: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    flag: str = "is_orphan",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Mark rows whose non-NULL `column` has no equal in `parent`.

    The parent is joined to the distinct child keys, not to the rows, so a hot child key crosses that join once.
    """
    known = parent.select(col(parent_column).alias("__parent")).distinct()
    facts = (
        df.groupBy(col(column))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .join(known, col(column) == F.col("__parent"), "left")
        .withColumn(flag, col(column).isNotNull() & F.col("__parent").isNull())
        .drop("__parent")
    )
    return attach_by_key(df, facts, [column], "__rows", hot_share).drop("__rows")

"""Reading: tables, filtered and capped sources, row counts, scan cost, file streams."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.columns import col
from flowkit.functions.text import require_identifier

# Price of a scanned TiB, largest run, preview size.
USD_PER_TIB = 5.0
MAX_ROWS_PER_RUN = 1_000_000
SAMPLE_ROWS = 10_000

# A limit up to which each task hands on its own first rows.
SMALL_LIMIT = 1_000


def read_query(spark: SparkSession, query: str) -> DataFrame:
    """The result of a SQL query, as a lazy frame."""
    return spark.sql(query)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; with `split_on` and `bounds`, read by `partitions` tasks over ranges of that column."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    if split_on and bounds:
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()


def resolve_table_name(project: str, dataset: str, table: str) -> str:
    """`dataset` with a dot already names its project."""
    return f"{dataset}.{table}" if "." in dataset else f"{project}.{dataset}.{table}"


def read_source(
    spark: SparkSession,
    project: str,
    dataset: str,
    table: str,
    where: str | None = None,
    limit: int | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Rows of a catalog table that fulfil a predicate, at most `limit` of them in `order`."""
    name = require_identifier(resolve_table_name(project, dataset, table))
    return select_rows(spark.table(name), where, limit, order)


def select_rows(
    df: DataFrame, where: str | None = None, limit: int | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Rows that fulfil a predicate (one SQL expression), at most `limit` of them in `order`.

    A limit needs an order with a unique last column, else its rows are arbitrary.
    """
    kept = df if where is None else df.where(F.expr(where))
    return kept if limit is None else cap_rows(kept, limit, order)


def _order(order: Sequence[str], descending: Collection[str]) -> list[Column]:
    return [col(c).desc_nulls_last() if c in descending else col(c).asc_nulls_first() for c in order]


def _until(row: Mapping[str, Any], order: Sequence[str], descending: Collection[str], types: T.StructType) -> Column:
    """Whether a row stands before the given one in the order, or at its place.

    The condition on the first column is repeated by itself, so that it reaches the file scan.
    """
    rest = F.lit(True)
    for name in reversed(order):
        c, bound = col(name), F.lit(row[name]).cast(types[name].dataType)
        if name in descending:
            before = c.isNotNull() if row[name] is None else F.coalesce(c > bound, F.lit(False))
        else:
            before = F.lit(False) if row[name] is None else c.isNull() | (c < bound)
        rest = before | (c.eqNullSafe(bound) & rest)
    first, bound = col(order[0]), F.lit(row[order[0]]).cast(types[order[0]].dataType)
    if row[order[0]] is None:
        return rest if order[0] in descending else rest & first.isNull()
    return rest & (first >= bound if order[0] in descending else first.isNull() | (first <= bound))


def cap_rows(df: DataFrame, limit: int, order: Sequence[str], descending: Collection[str] = ()) -> DataFrame:
    """The first `limit` rows in `order`: ascending with NULLs first, or descending with NULLs last.

    The order needs a unique last column, else the rows at the cut are arbitrary.  The order columns alone are
    range-partitioned and counted (one job); rows of the ranges before the cut are then taken by a filter on the order
    columns, and the range at the cut is a top-n.  So no task holds more than one range, whatever the limit.  A limit of
    at most `SMALL_LIMIT` is a top-n of the whole frame: each task hands on so many rows, in one pass.
    """
    if not order:
        raise ValueError("a row limit needs an order")
    if limit <= 0:
        return df.limit(0)
    by = _order(order, descending)
    if limit <= SMALL_LIMIT:
        return df.orderBy(*by).limit(limit)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(*[col(c) for c in order]).repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    last = F.last(F.struct(*[col(c) for c in order])).alias("last")
    counted = keys.groupBy(F.spark_partition_id().alias("range")).agg(F.count(F.lit(1)).alias("rows"), last)
    seen, before = 0, None
    for part in sorted(counted.collect(), key=lambda r: r["range"]):
        if seen + part["rows"] < limit:
            seen, before = seen + part["rows"], part["last"]
            continue
        rows = df.where(_until(part["last"], order, descending, df.schema))
        if before is None:
            return rows.orderBy(*by).limit(limit)
        whole = _until(before, order, descending, df.schema)
        return df.where(whole).unionByName(rows.where(~whole).orderBy(*by).limit(limit - seen))
    return df


def sample_rows(df: DataFrame, keys: Sequence[str], rows: int = SAMPLE_ROWS, seed: int = 0) -> DataFrame:
    """An exact-size sample that a re-run repeats: the rows with the smallest seeded MD5 of their unique key."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[col(k).cast("string") for k in keys]).cast("binary"))
    return cap_rows(df.withColumn("__digest", digest), rows, ["__digest", *keys]).drop("__digest")


def row_count(df: DataFrame, where: str | None = None, limit: int | None = None) -> DataFrame:
    """One row `(total_rows)`: the rows that a source with this predicate and cap delivers."""
    kept = df if where is None else df.where(F.expr(where))
    counted: Column = F.count(F.lit(1))
    return kept.agg((counted if limit is None else F.least(counted, F.lit(limit))).alias("total_rows"))


def scan_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """`(path, length)` of the files below a path; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return files.load(path).select("path", "length")


def estimate_cost(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row `(bytes_processed, cost_usd)` for whole files: an upper bound, since columns are pruned."""
    total = F.coalesce(F.sum("length"), F.lit(0))
    return scan_files(spark, path, pattern).agg(
        total.alias("bytes_processed"), (total / 1024**4 * USD_PER_TIB).alias("cost_usd")
    )


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Parquet files as a stream; `max_files` or `max_bytes` bounds a micro-batch, the unit of a chunked load.

    The path is a folder or a glob; a single file has to be given as a glob.
    """
    options = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes, "pathGlobFilter": pattern}
    given = {k: str(v) for k, v in options.items() if v is not None}
    return spark.readStream.schema(schema).options(**given).parquet(path)

"""What a scan of some columns reads, from Parquet footers.

Files are listed by Spark and their footers, some kilobytes each, are read in tasks; data pages never are.  A row group
counts if its statistics do not exclude the bounds, as in the scan itself.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowkit.sources.tables import USD_PER_TIB, scan_files

FILES_PER_TASK = 64
CHUNKS = "path STRING, row_group INT, column STRING, rows BIGINT, bytes BIGINT, uncompressed_bytes BIGINT"
Bound = tuple[str, str, Any]

# Whether values between a least and a largest one may fulfil `value <operator> bound`.
_MAY_HOLD = {
    "=": lambda low, high, v: low <= v <= high,
    "<": lambda low, high, v: operator.lt(low, v),
    "<=": lambda low, high, v: operator.le(low, v),
    ">": lambda low, high, v: operator.gt(high, v),
    ">=": lambda low, high, v: operator.ge(high, v),
}


def _may_hold(group: pq.RowGroupMetaData, places: dict[str, int], bounds: Sequence[Bound]) -> bool:
    """Whether the statistics of a row group leave room for rows within all bounds."""
    for column, sign, value in bounds:
        chunk = group.column(places[column])
        facts = chunk.statistics if chunk.is_stats_set else None
        if facts is None:
            continue
        if facts.has_null_count and facts.null_count == group.num_rows:
            return False
        if facts.has_min_max and not _MAY_HOLD[sign](facts.min, facts.max, value):
            return False
    return True


def column_chunks(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    bounds: Sequence[Bound] = (),
    pattern: str = "*.parquet",
) -> DataFrame:
    """`(path, row_group, column, rows, bytes, uncompressed_bytes)` of the column chunks that a scan reads.

    `columns` are those asked for (all, if not given); columns with a bound `(column, operator, value)` are read too.  A
    nested column counts with all its leaves.  Row groups that no row within the bounds can be in are left out, and so
    are columns that a file lacks.  Executors open the files by pyarrow, so the file system has to be one it knows.
    """
    if unknown := {sign for _, sign, _ in bounds} - set(_MAY_HOLD):
        raise ValueError(f"no such operator: {sorted(unknown)}")
    asked = None if columns is None else {*columns, *[c for c, _, _ in bounds]}

    def footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("path").to_pylist():
                files, where = fs.FileSystem.from_uri(name)
                with files.open_input_file(where) as f:
                    footer = pq.ParquetFile(f).metadata
                places = {footer.schema.column(i).path: i for i in range(footer.num_columns)}
                present = [b for b in bounds if b[0] in places]
                rows: list[tuple] = []
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    if len(present) < len(bounds) or not _may_hold(group, places, present):
                        continue
                    for leaf, i in places.items():
                        top = leaf.partition(".")[0]
                        if asked is None or top in asked or leaf in asked:
                            chunk = group.column(i)
                            rows.append((name, g, top, group.num_rows, chunk.total_compressed_size, chunk.total_uncompressed_size))
                names = ("path", "row_group", "column", "rows", "bytes", "uncompressed_bytes")
                kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    listed = scan_files(spark, path, pattern).select("path")
    tasks = -(-listed.count() // FILES_PER_TASK)
    return (listed.repartition(tasks, "path") if tasks > 1 else listed).mapInArrow(footers, CHUNKS)


def column_cost(chunks: DataFrame) -> DataFrame:
    """Per column: `rows`, `bytes`, and the price of reading them, `cost_usd`."""
    groups = chunks.groupBy("path", "row_group", "column").agg(F.max("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    total = F.sum("bytes")
    return groups.groupBy("column").agg(
        F.sum("rows").alias("rows"), total.alias("bytes"), (total / 1024**4 * USD_PER_TIB).alias("cost_usd")
    )


def scan_cost(chunks: DataFrame) -> DataFrame:
    """One row `(bytes_processed, cost_usd)` for the referenced columns."""
    total = F.coalesce(F.sum("bytes"), F.lit(0))
    return chunks.agg(total.alias("bytes_processed"), (total / 1024**4 * USD_PER_TIB).alias("cost_usd"))

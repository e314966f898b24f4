"""What the operators on whole documents share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowkit.plans.ordered import with_row_index
from flowkit.plans.staging import stage

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
LEAST_ID = -(1 << 63)
ROW = "__row"

SLICE_ROWS = 512
BYTES_PER_BUCKET = 64 << 20
UNKNOWN_BYTES = 1 << 60


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that few texts are held as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


def bucket_count(docs: DataFrame) -> int:
    """Buckets by the size of the tables that are read, so that one holds as much at any size of the corpus.

    Never fewer than shuffle partitions; that many where Spark does not know a size, as for rows made in a session.
    """
    leaves = docs._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    expected = 0 if any(size >= UNKNOWN_BYTES for size in sizes) else sum(sizes)
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), expected // BYTES_PER_BUCKET + 1)


def settled(df: DataFrame, label: str) -> DataFrame:
    """`df` staged, with the shuffle files behind it removed once it is written (nothing reads `df` again).

    Texts go to Python in smaller batches meanwhile, which bounds the memory of a task on both sides.
    """
    conf = df.sparkSession.conf
    wanted = {CLEANUP: "true", BATCH_ROWS: str(SLICE_ROWS * 2)}
    before = {k: conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        conf.set(k, v)
    try:
        return stage(df, label)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def _shared_ids(docs: DataFrame) -> bool:
    return not docs.groupBy("doc_id").count().where("count > 1").isEmpty()


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` with their place `ROW` in the order of id (null first), hash of all columns, and a number among repeats.

    The number is staged before rows are sorted by it, so a row keeps its place however often it is read.
    """
    tie = {"__first": F.xxhash64(*docs.columns), "__second": F.xxhash64(F.lit(1), *docs.columns), "__nth": F.monotonically_increasing_id()}
    return with_row_index(settled(docs.withColumns(tie), "numbered"), ["doc_id", *tie], name=ROW).drop(*tie)


def row_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """All rows, and the column that tells them apart: `doc_id` if no two rows share one, else `ROW`, which is added.

    (Runs a count of the ids alone; texts are moved only if some are shared.)
    """
    return (numbered(docs), ROW) if _shared_ids(docs) else (docs, "doc_id")


def by_document(docs: DataFrame, run: Callable[[DataFrame], DataFrame], ids: Sequence[str] = ("doc_id",)) -> DataFrame:
    """`run` over `doc_id` (long, unique) and `text` (null as empty); `ids` are the columns of ids it returns.

    Rows with the same id and text are one document.  If other rows share an id, `run` sees the places of the rows
    instead, and the ids are put back afterwards, so every text is judged.  (Runs a count of the ids.)
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if not _shared_ids(docs):
        return run(docs)
    rows = numbered(docs.distinct())
    found = run(rows.select(F.col(ROW).alias("doc_id"), "text"))
    columns = found.columns
    for c in ids:
        own = rows.select(F.col(ROW).alias(c), F.col("doc_id").alias("__id"))
        found = found.join(own, c).withColumn(c, F.col("__id")).select(*columns)
    return found


def packed_texts(docs: DataFrame) -> DataFrame:
    """Documents as (doc, doc_id, packed text), so that less is moved; a null id is the least number in `doc`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in sliced(batches):
            ids = batch.column("doc_id")
            packed = pa.array([press.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([ids.fill_null(LEAST_ID), ids, packed], names=["doc", "doc_id", "packed"])

    return docs.mapInArrow(run, "doc long, doc_id long, packed binary")

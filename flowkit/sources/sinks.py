"""Writing: target schemas, load preparation, tables, JDBC, insert-if-absent."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.columns import col, nan_to_null, quoted
from flowkit.functions.schema import DAY, INT, SHORT_TEXT, TEXT, TEXTS, TIME, schema
from flowkit.functions.text import array_literal, require_identifier
from flowkit.operators.clean import keep_first
from flowkit.plans.staging import remove

# What happens when the target exists, in the writer's words.
WRITE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
INSERT_BATCH_ROWS = 10_000

# Name endings of array columns that load as array literals.
ARRAY_SUFFIXES = ("_names", "_codes")

FLATTENED_TARGET = schema(
    publication_number=TEXT,
    application_number=TEXT,
    country_code=SHORT_TEXT,
    kind_code=SHORT_TEXT,
    family_id=TEXT,
    title_english=TEXT,
    filing_date=DAY,
    publication_date=DAY,
    inventor_count=INT,
    inventor_names=TEXTS,
    assignee_count=INT,
    assignee_names=TEXTS,
    cpc_codes=TEXTS,
    citation_count=INT,
    entity_status=TEXT,
    art_unit=TEXT,
    loaded_at=TIME,
)
SIMPLE_TARGET = schema(
    publication_number=TEXT, application_number=TEXT, country_code=SHORT_TEXT, filing_date=DAY, loaded_at=TIME
)
ENHANCED_TARGET = schema(
    publication_number=TEXT,
    application_number=TEXT,
    country_code=SHORT_TEXT,
    kind_code=SHORT_TEXT,
    filing_date=DAY,
    publication_date=DAY,
    grant_date=DAY,
    title=TEXT,
    abstract=TEXT,
    assignee=TEXT,
    inventors=TEXT,
    cpc_codes=TEXT,
    loaded_at=TIME,
)
LARGE_TARGET = ENHANCED_TARGET


def stamp_loaded_at(df: DataFrame, loaded_at: dt.datetime | None = None) -> DataFrame:
    """Add the load time; every row of a run has the same one."""
    return df.withColumn("loaded_at", F.current_timestamp() if loaded_at is None else F.lit(loaded_at))


def _conformed(source: T.DataType | None, f: T.StructField) -> Column:
    target = "string" if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType)) else f.dataType
    if source is None:
        return F.lit(None).cast(target)
    nested = (T.ArrayType, T.StructType, T.MapType)
    if target == "string" and isinstance(source, nested):
        return F.to_json(col(f.name))
    if isinstance(source, nested):
        return col(f.name).cast(target)
    return col(f.name).try_cast(target)


def conform_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Exactly the target's columns and types: bad values and absent columns become NULL, arrays become JSON text."""
    types = {f.name: f.dataType for f in df.schema}
    return df.select(*[_conformed(types.get(f.name), f).alias(f.name) for f in target])


def is_oversized(target: T.StructType) -> Column:
    """Whether a row has a text longer than its VARCHAR column takes."""
    limited = [f for f in target if isinstance(f.dataType, T.VarcharType)]
    too_long = [F.coalesce(F.char_length(col(f.name)) > f.dataType.length, F.lit(False)) for f in limited]
    return reduce(lambda a, b: a | b, too_long, F.lit(False))


def encode_arrays(df: DataFrame, suffixes: tuple[str, ...] = ARRAY_SUFFIXES) -> DataFrame:
    """Array columns with one of the endings become array literals, for targets without array types."""
    arrays = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType) and f.name.endswith(suffixes)]
    return df.withColumns({c: array_literal(col(c)) for c in arrays}) if arrays else df


def prepare_for_load(df: DataFrame) -> DataFrame:
    """NaN to NULL and arrays to literals: the row as a relational target takes it."""
    return encode_arrays(nan_to_null(df))


def table_ddl(name: str, fields: T.StructType, partitions: Sequence[str] = (), location: str | None = None) -> str:
    require_identifier(name)
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    by = f" PARTITIONED BY ({', '.join(quoted(p) for p in partitions)})" if partitions else ""
    at = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}{at}"


def create_table(
    spark: SparkSession,
    name: str,
    fields: T.StructType,
    partitions: Sequence[str] = (),
    location: str | None = None,
    replace: bool = False,
) -> None:
    """Create a typed table; `replace` drops an existing one with its files first, else it stays."""
    ddl = table_ddl(name, fields, partitions, location)
    if replace:
        drop_table(spark, name, files=True)
        if location:
            remove(spark, location)
    spark.sql(ddl)


def table_location(spark: SparkSession, name: str) -> str | None:
    """The folder of a catalog table; None when there is no such table."""
    if not spark.catalog.tableExists(require_identifier(name)):
        return None
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return facts["data_type"] if facts else None


def drop_table(spark: SparkSession, name: str, files: bool = False) -> None:
    """Drop a table if it is there; a table with a location of its own keeps its files, unless `files` is given."""
    where = table_location(spark, name) if files else None
    spark.sql(f"DROP TABLE IF EXISTS {require_identifier(name)}")
    if where:
        remove(spark, where)


def write_table(df: DataFrame, name: str, if_exists: str = "append") -> None:
    """Write to a catalog table; `if_exists` is fail, replace or append."""
    df.write.mode(WRITE_MODES[if_exists]).format("parquet").saveAsTable(require_identifier(name))


def write_parquet(
    df: DataFrame, path: str, if_exists: str = "append", partitions: Sequence[str] = (), file_rows: int = 0
) -> None:
    """Write files; `file_rows` bounds the rows of a file (0 for no bound)."""
    writer = df.write.mode(WRITE_MODES[if_exists]).option("maxRecordsPerFile", file_rows)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    if_exists: str = "append",
    properties: Mapping[str, str] | None = None,
    batch_rows: int = INSERT_BATCH_ROWS,
    column_types: str | None = None,
    connections: int = 32,
) -> None:
    """Insert prepared rows into a database in batches, over at most `connections` connections."""
    options = {
        "url": url,
        "dbtable": require_identifier(table),
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
        **(properties or {}),
    }
    if column_types:
        options["createTableColumnTypes"] = column_types
    prepare_for_load(df).write.format("jdbc").options(**options).mode(WRITE_MODES[if_exists]).save()


def absent_rows(new: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of `new` to insert: the first per key in `order`, where the target lacks the key.

    Both sides are reduced to one row per key before they meet, so no key is hot in the join.
    """
    known = target.select(*[col(k) for k in keys]).distinct()
    return keep_first(new, keys, order).join(known, list(keys), "left_anti")


def insert_if_absent(new: DataFrame, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Append the absent rows to a Parquet target (one write job)."""
    target = new.sparkSession.read.schema(new.schema).parquet(path)
    absent_rows(new, target, keys, order).write.mode("append").parquet(path)


def append_frames(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name; a column that a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

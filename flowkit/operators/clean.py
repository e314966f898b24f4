"""Cleaning: deduplication, null filling, coercion, text and date normalisation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.columns import col, is_missing, numeric_columns, present, string_columns
from flowkit.functions.dates import DEFAULT_FORMATS, parse_timestamp
from flowkit.functions.text import normalized
from flowkit.plans.medians import column_sizes, exact_medians
from flowkit.plans.ordered import fill_along
from flowkit.plans.staging import stage

# Bookkeeping columns that do not make two rows different.
IGNORED_IN_KEYS = ("created_at", "updated_at")


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype)
    return isinstance(dtype, T.MapType) or (isinstance(dtype, T.ArrayType) and _has_map(dtype.elementType))


def _groupable(c: Column, dtype: T.DataType) -> Column:
    """A value as a grouping key; maps at any depth have no equality, so they compare by their sorted entries."""
    if not _has_map(dtype):
        return c
    if isinstance(dtype, T.StructType):
        fields = [_groupable(c.getField(f.name), f.dataType).alias(f.name) for f in dtype]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _groupable(x, dtype.elementType))

    def entry(e: Column) -> Column:
        return F.struct(_groupable(e["key"], dtype.keyType).alias("key"), _groupable(e["value"], dtype.valueType).alias("value"))

    return F.array_sort(F.transform(F.map_entries(c), entry))


def _with_map_keys(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """`df` with helper keys for columns that hold maps, the names to group by, and the helpers."""
    maps = [c for c in columns if _has_map(df.schema[c].dataType)]
    helpers = {f"__key_{i}": _groupable(col(c), df.schema[c].dataType) for i, c in enumerate(maps)}
    return (df.withColumns(helpers) if helpers else df), [*[c for c in columns if c not in maps], *helpers], list(helpers)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Full-row dedupe in which NULL equals NULL and NaN equals NaN, with maps at any depth."""
    keyed, keys, helpers = _with_map_keys(df, df.columns)
    return keyed.dropDuplicates(keys).drop(*helpers) if helpers else df.dropDuplicates()


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in `order`, ascending, NULLs first.

    Spark takes each task's first row per key before the shuffle, so a hot key does not travel as a whole.
    """
    by_order = Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(c).asc_nulls_first() for c in order])
    return df.withColumn("__rank", F.row_number().over(by_order)).where(F.col("__rank") == 1).drop("__rank")


def deduplicate_rows(
    df: DataFrame, order: Sequence[str], ignored: Iterable[str] = IGNORED_IN_KEYS
) -> DataFrame:
    """Keep the first row in `order` among rows that agree in all columns but the ignored ones.

    A hash of the text columns goes before the columns themselves, so that sorting seldom compares long texts.
    """
    keyed, keys, helpers = _with_map_keys(df, [c for c in df.columns if c not in set(ignored)])
    texts = [c for c in keys if keyed.schema[c].dataType == T.StringType()]
    if texts:
        keyed, keys, helpers = keyed.withColumn("__hash", F.xxhash64(*[col(c) for c in texts])), ["__hash", *keys], ["__hash", *helpers]
    return keep_first(keyed, keys, order).drop(*helpers)


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column `(column, null_count)` from a single pass."""
    counts = df.agg(*[F.count_if(is_missing(f.name, f.dataType)).alias(f"{i}") for i, f in enumerate(df.schema)])
    pairs = [F.struct(F.lit(n).alias("column"), F.col(str(i)).alias("null_count")) for i, n in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*pairs)))


def fill_numeric_median(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True, accuracy: int = 10_000
) -> DataFrame:
    """Fill missing numbers with the column's median; only columns with a gap change, and they become DOUBLE.

    A column without any value stays NULL.  Runs one-row aggregates; `exact=False` uses one sketch instead.
    """
    sizes = column_sizes(df, numeric_columns(df) if columns is None else columns)
    gaps = [c for c, size in sizes.items() if size.count < size.rows]
    if not gaps:
        return df
    types = {f.name: f.dataType for f in df.schema}
    if exact:
        medians = exact_medians(df, gaps, sizes=sizes)
    else:
        sketched = [F.percentile_approx(present(c, types[c]).cast("double"), 0.5, accuracy) for c in gaps]
        medians = dict(zip(gaps, df.agg(*sketched).first(), strict=True))
    return df.withColumns({
        c: F.coalesce(present(c, types[c]).cast("double"), F.lit(medians[c]).cast("double")) for c in gaps
    })


def fill_string_empty(df: DataFrame) -> DataFrame:
    """NULL strings become ''."""
    return df.fillna("", subset=string_columns(df)) if string_columns(df) else df


def _failed_cast(name: str, target: str) -> Column:
    return col(name).isNotNull() & col(name).try_cast(target).isNull()


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per mapped column `(column, target, cast_failed)`: values that do not cast."""
    known = {c: t for c, t in types.items() if c in df.columns}
    counts = df.agg(*[F.count_if(_failed_cast(c, t)).alias(str(i)) for i, (c, t) in enumerate(known.items())])
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("target"), F.col(str(i)).alias("cast_failed"))
        for i, (c, t) in enumerate(known.items())
    ]
    return counts.select(F.inline(F.array(*rows)))


def coerce_types(df: DataFrame, types: Mapping[str, str], whole_columns: bool = False) -> DataFrame:
    """Cast columns by name; unknown columns are skipped and a value that does not cast becomes NULL.

    `whole_columns=True` leaves a column as it is when any of its values fails (one one-row aggregate).
    """
    known = {c: t for c, t in types.items() if c in df.columns}
    if whole_columns and known:
        failed = df.agg(*[F.max(_failed_cast(c, t)).alias(str(i)) for i, (c, t) in enumerate(known.items())]).first()
        known = {c: t for (c, t), bad in zip(known.items(), failed, strict=True) if not bad}
    return df.withColumns({c: col(c).try_cast(t) for c, t in known.items()}) if known else df


def normalize_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Lower-case string columns and strip Unicode whitespace at both ends."""
    names = string_columns(df) if columns is None else columns
    return df.withColumns({c: normalized(col(c)) for c in names}) if names else df


def standardize_dates(df: DataFrame, formats: Iterable[str] = DEFAULT_FORMATS) -> DataFrame:
    """Parse columns whose name holds 'date' or 'time'; bad text becomes NULL, typed columns stay as they are."""
    formats = tuple(formats)
    parsed = {
        f.name: parse_timestamp(col(f.name), formats)
        for f in df.schema
        if ("date" in f.name.lower() or "time" in f.name.lower()) and isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(parsed) if parsed else df


def handle_missing_values(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Forward fill, then backward fill, in `order`; inside each key when `keys` is given (stages the input)."""
    names = columns if columns is not None else [c for c in df.columns if c not in {*order, *keys}]
    return fill_along(df, names, order, keys, buckets)


def _strategy(dtype: T.DataType) -> str:
    if isinstance(dtype, T.NumericType):
        return "median"
    return "empty" if isinstance(dtype, T.StringType) else "none"


def cleaning_report(df: DataFrame) -> DataFrame:
    """One row per column: rows in and out, duplicates removed, nulls left to fill and how; one shuffle.

    `df` is the input of the cleaning.  Nulls are counted after the dedupe, as the fill sees them.
    """
    keys = [_groupable(col(f.name), f.dataType).alias(f.name) for f in df.schema]
    types = {f.name: f.dataType for f in df.schema}
    distinct = df.select(*keys).groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__rows"))
    kinds = {f.name: f.dataType for f in distinct.schema}
    totals = distinct.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_out"),
        *[F.count_if(is_missing(c, kinds[c])).alias(f"__nulls_{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"__nulls_{i}").alias("null_count"),
            F.when(F.col(f"__nulls_{i}") > 0, _strategy(types[c])).otherwise("none").alias("strategy"),
        )
        for i, c in enumerate(df.columns)
    ]
    return totals.select(
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("duplicates_removed"),
        F.inline(F.array(*rows)),
    )


def clean(df: DataFrame, types: Mapping[str, str] | None = None, exact_median: bool = True) -> DataFrame:
    """Dedupe, fill numbers with the median, fill strings with '', coerce types.

    The deduplicated rows are staged, since the median and the fill both read them.
    """
    distinct = stage(drop_duplicate_rows(df), "distinct")
    filled = fill_string_empty(fill_numeric_median(distinct, exact=exact_median))
    return coerce_types(filled, types or {})

"""Missing values and column-name helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)


def quoted(name: str) -> str:
    """A top-level column name that may hold dots or spaces, quoted for `F.col`."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def is_missing(name: str, dtype: T.DataType) -> Column:
    """NULL, or NaN on floating columns."""
    c = col(name)
    return c.isNull() | F.isnan(c) if isinstance(dtype, FLOATING) else c.isNull()


def present(name: str, dtype: T.DataType) -> Column:
    """The value with NaN turned into NULL."""
    c = col(name)
    return F.when(~F.isnan(c), c) if isinstance(dtype, FLOATING) else c


def comparable(value: Column, dtype: T.DataType, *bounds: object) -> Column:
    """The value to compare with bounds: a text as a number if the bounds are numbers, NULL if it is none."""
    numbers = all(isinstance(b, (int, float)) for b in bounds)
    return value.try_cast("double") if numbers and isinstance(dtype, T.StringType) else value


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every float and double column; a plain projection."""
    floats = {f.name: present(f.name, f.dataType) for f in df.schema if isinstance(f.dataType, FLOATING)}
    return df.withColumns(floats) if floats else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 as DOUBLE, 0 when `whole` is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100, F.lit(0.0))

"""Schemas as Python values; unlike DDL text they need no running session."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
SHORT_TEXT = T.VarcharType(10)
INT = T.IntegerType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
FLAG = T.BooleanType()
DAY = T.DateType()
TIME = T.TimestampType()
TEXTS = T.ArrayType(TEXT)


def schema(**columns: T.DataType) -> T.StructType:
    """A schema of nullable columns, in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def structs(**fields: T.DataType) -> T.ArrayType:
    """An array of structs."""
    return T.ArrayType(schema(**fields))

"""Masking of sensitive fields in nested rows, and required-field checks on JSON documents."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.functions.columns import col

# Names whose whole value is masked, compared without case, and the mask.
SENSITIVE_KEYS = ("credentials", "password", "private_key", "client_email", "token_uri", "private_key_id")
MASK = "********"

# Fields that a service-account document must have, in reporting order.
REQUIRED_FIELDS = ("type", "project_id", "private_key", "client_email")


def _holds_sensitive(dtype: T.DataType, keys: frozenset[str]) -> bool:
    """Whether a value of this type can hold a field to mask; maps can, since their keys are data."""
    if isinstance(dtype, T.StructType):
        return any(f.name.lower() in keys or _holds_sensitive(f.dataType, keys) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return isinstance(dtype.elementType, (T.StructType, T.MapType)) and _holds_sensitive(dtype.elementType, keys)
    return isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType)


def _masked_field(name: str, value: Column, dtype: T.DataType, keys: frozenset[str]) -> Column:
    return F.lit(MASK) if name.lower() in keys else _masked(value, dtype, keys)


def _masked(value: Column, dtype: T.DataType, keys: frozenset[str]) -> Column:
    if not _holds_sensitive(dtype, keys):
        return value
    if isinstance(dtype, T.StructType):
        fields = [_masked_field(f.name, value[f.name], f.dataType, keys).alias(f.name) for f in dtype]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _masked(x, dtype.elementType, keys))

    # A map's type is fixed before its keys are seen: a masked value that is no string becomes NULL.
    hidden = F.lit(MASK) if isinstance(dtype.valueType, T.StringType) else F.lit(None)

    def entry(k: Column, v: Column) -> Column:
        return F.when(F.lower(k).isin(*keys), hidden).otherwise(_masked(v, dtype.valueType, keys))

    return F.transform_values(value, entry)


def mask_sensitive(df: DataFrame, keys: Iterable[str] = SENSITIVE_KEYS) -> DataFrame:
    """Mask fields by name at any depth of structs, arrays of structs, and maps, in one projection.

    The name masks the whole value below it, which becomes a STRING.
    """
    names = frozenset(k.lower() for k in keys)
    return df.select(*[_masked_field(f.name, col(f.name), f.dataType, names).alias(f.name) for f in df.schema])


def missing_fields(document: Column, required: Sequence[str] = REQUIRED_FIELDS) -> Column:
    """The required top-level fields that a JSON text lacks, in order; all of them when it does not parse."""
    present = F.coalesce(F.json_object_keys(document), F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(f) for f in required]), present)

"""Normalisation of file values before they are compared with, or loaded into, a table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Flags as database exports write them, case-exact, and the canonical time stamp text.
TRUE_FLAGS = ["t", "TRUE"]
FALSE_FLAGS = ["f", "FALSE"]
CANONICAL_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSSx"
CANONICAL_TIME_NO_ZONE = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def empty_to_null(text: Column) -> Column:
    """The empty text is an absent value."""
    return F.nullif(text, F.lit(""))


def flag_to_boolean(text: Column) -> Column:
    """``t``/``TRUE`` and ``f``/``FALSE`` become booleans, anything else NULL.

    Meant for columns declared boolean; a text column that holds ``'t'`` is left alone by the operators.
    """
    return F.when(text.isin(TRUE_FLAGS), F.lit(True)).when(text.isin(FALSE_FLAGS), F.lit(False))


def canonical_time_text(text: Column) -> Column:
    """A time stamp text in one fixed form with six digits and offset, e.g. ``2019-07-14 10:32:22.123000+00``.

    The text is parsed, so a missing fraction or offset is filled in and another offset is converted. What cannot
    be parsed is NULL. The session zone must be UTC.
    """
    return F.date_format(F.try_to_timestamp(text), CANONICAL_TIME)


def time_text(ts: Column, zone: bool = True) -> Column:
    """A stored time stamp as text, for comparing with a file that keeps times as text."""
    return F.date_format(ts, CANONICAL_TIME if zone else CANONICAL_TIME_NO_ZONE)


def _floats(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_floats(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _floats(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.DoubleType, T.FloatType))


def _canonical(value: Column, dtype: T.DataType) -> Column:
    """Equal values made the same: 0.0 for -0.0, and the entries of maps in the order of their keys."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return value + F.lit(0.0).cast(dtype)
    if not _floats(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda v: _canonical(v, dtype.elementType))
    if isinstance(dtype, T.MapType):

        def entry(e: Column) -> Column:
            key, content = _canonical(e["key"], dtype.keyType), _canonical(e["value"], dtype.valueType)
            return F.struct(key.alias("key"), content.alias("value"))

        entries = F.transform(F.map_entries(value), entry)

        def by_key(a: Column, b: Column) -> Column:
            return F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)

        return F.array_sort(entries, by_key)
    fields = [_canonical(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def comparable_text(value: Column, dtype: T.DataType) -> Column:
    """A text that is equal exactly for equal values of the type, NULL for NULL. Maps are equal in any order of entries."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return (value + F.lit(0.0).cast(dtype)).cast("string")  # -0.0 equals 0.0
    if isinstance(dtype, T.BinaryType):
        return F.hex(value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("string")  # much cheaper than the calendar form
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        micros = "yyyy-MM-dd HH:mm:ss.SSSSSS"
        formats = {"timestampFormat": micros, "timestampNTZFormat": micros, "ignoreNullFields": "false"}
        return F.to_json(_canonical(value, dtype), formats)
    return value.cast("string")

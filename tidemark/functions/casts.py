"""Casts with a stated behaviour on values that do not fit, whatever the session's ANSI setting is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import truncate_utf8

SIZED_TEXT = (T.VarcharType, T.CharType)
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)

_INTEGRAL_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_INTEGRAL_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def cast_or_fail(value: Column, to: T.DataType, label: str) -> Column:
    """Cast; a value that has no counterpart in ``to`` stops the query."""
    cast = value.try_cast(to)
    message = F.concat(
        F.lit("Failed to convert value '"), value.cast("string"), F.lit(f"' to {to.simpleString()} for '{label}'")
    )
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(message).cast(to)).otherwise(cast)


def never_fails(source: T.DataType, to: T.DataType) -> bool:
    """Whether every non-NULL ``source`` value has a non-NULL counterpart in ``to``."""
    if source == to or isinstance(to, (*SIZED_TEXT, T.StringType)):
        return True
    if isinstance(source, T.NullType):
        return True
    digits = _INTEGRAL_DIGITS.get(type(source))
    if isinstance(to, (T.FloatType, T.DoubleType)):
        return digits is not None or isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType))
    if isinstance(to, T.DecimalType):
        if isinstance(source, T.DecimalType):
            return to.scale >= source.scale and to.precision - to.scale >= source.precision - source.scale
        return digits is not None and to.precision - to.scale >= digits
    if digits is not None and type(to) in _INTEGRAL_ORDER:
        return _INTEGRAL_ORDER.index(type(source)) <= _INTEGRAL_ORDER.index(type(to))
    return isinstance(to, T.TimestampNTZType) and isinstance(source, (T.DateType, T.TimestampType))


def as_text(value: Column, source: T.DataType) -> Column:
    """Text form of any value: JSON for nested types, Base64 for bytes."""
    if isinstance(source, NESTED):
        return F.to_json(value, {"ignoreNullFields": "false"})
    if isinstance(source, T.BinaryType):
        return F.base64(value)
    return value if isinstance(source, T.StringType) else value.cast("string")


def conformed(value: Column, source: T.DataType, to: T.DataType) -> Column:
    """``value`` as target type ``to``: text is cut to its byte width, misfits become NULL."""
    if isinstance(to, SIZED_TEXT):
        return truncate_utf8(as_text(value, source), to.length)
    if isinstance(to, T.StringType):
        return as_text(value, source)
    if source == to:
        return value
    return value.try_cast(to)

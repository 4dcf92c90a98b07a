"""The type maps between source columns, Spark columns and target columns.

Names are read with Spark's own type parser and then mapped by type class, so spelling variants
(``int``/``integer``, upper case, blanks inside ``decimal( 20, 0 )``) all mean the same type.
"""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import types as T

# Default target widths in bytes, and the decimal used when none is given.
STRING_WIDTH = 255
WIDE_WIDTH = 65535
MAX_PRECISION = 38
BARE_DECIMAL = T.DecimalType(38, 10)

_KEPT = (
    T.IntegerType,
    T.LongType,
    T.DoubleType,
    T.FloatType,
    T.BooleanType,
    T.DateType,
    T.DecimalType,
)


def parse_type(name: str) -> T.DataType | None:
    """The Spark type a type name stands for, or None if Spark knows no such type."""
    bare = name.strip().lower()
    if bare == "decimal":
        return BARE_DECIMAL
    if bare in ("varchar", "char"):
        return T.StringType()
    try:
        return T.DataType.fromDDL(name.strip())
    except ParseException:
        return None


def spark_type(name: str) -> T.DataType:
    """Spark type for a source type name; ``float`` widens, whatever is unknown becomes a string."""
    parsed = parse_type(name)
    if isinstance(parsed, T.FloatType):
        return T.DoubleType()
    if isinstance(parsed, (T.TimestampType, *_KEPT)):
        return parsed
    if name.strip().lower().startswith("decimal"):
        return BARE_DECIMAL
    return T.StringType()


def is_mapped(source: str | T.DataType) -> bool:
    """Whether a target type is defined for ``source`` (otherwise it is stored as text)."""
    parsed = parse_type(source) if isinstance(source, str) else source
    return isinstance(parsed, (T.TimestampType, T.TimestampNTZType, *_KEPT)) or type(parsed) is T.StringType


def declared_text(field: T.StructField) -> T.VarcharType | None:
    """Text of the width that a source table declares for a column, whose values Spark reads as strings."""
    declared = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING")
    return T.VarcharType(T.DataType.fromDDL(declared).length) if declared else None


def target_type(
    source: str | T.DataType, string_width: int = STRING_WIDTH, other_width: int = WIDE_WIDTH
) -> T.DataType:
    """Target column type: plain strings get ``string_width`` bytes, unmapped types ``other_width``."""
    parsed = parse_type(source) if isinstance(source, str) else source
    if type(parsed) is T.StringType:
        return T.VarcharType(string_width)
    if isinstance(parsed, (T.TimestampType, T.TimestampNTZType)):
        return T.TimestampNTZType()
    if isinstance(parsed, _KEPT):
        return parsed
    return T.VarcharType(other_width)


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is the same value in ``new``, which holds more: longer text, larger numbers."""
    if old == new:
        return False
    if isinstance(old, T.VarcharType):
        return type(new) is T.StringType or (isinstance(new, T.VarcharType) and new.length > old.length)
    if old in _EXACT_DIGITS:
        limit = _EXACT_DIGITS[old]
        if isinstance(new, T.DecimalType):
            return new.precision - new.scale >= limit
        if isinstance(new, (T.FloatType, T.DoubleType)):
            return limit <= (7 if isinstance(new, T.FloatType) else 15)
        return _EXACT_DIGITS.get(new, 0) > limit
    if isinstance(old, T.DecimalType):
        return (
            isinstance(new, T.DecimalType)
            and new.scale >= old.scale
            and new.precision - new.scale >= old.precision - old.scale
        )
    return (old, new) in ((T.FloatType(), T.DoubleType()), (T.DateType(), T.TimestampNTZType()))


# Decimal digits that hold every value of a type; doubles hold 15, floats not quite 7.
_EXACT_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def clamp_decimal(source: T.DecimalType, max_precision: int = MAX_PRECISION) -> T.DecimalType:
    """Limit precision to the target's maximum and scale to the precision."""
    precision = min(source.precision, max_precision)
    return T.DecimalType(precision, min(source.scale, precision))

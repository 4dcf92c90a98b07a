"""Type conversion of whole frames. Each operator is one select over all columns."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import types
from tidemark.functions.casts import NESTED, SIZED_TEXT, as_text, cast_or_fail, conformed, never_fails
from tidemark.functions.text import column

# Fixed value: the type MySQL-style connectors give to unsigned 64-bit integers.
UNSIGNED_LONG = T.DecimalType(20, 0)

# Columns that loads add to rows; tables cannot have columns of these names.
REJECTED, CUT, RECORD, REASONS = "_rejected", "_cut", "_record", "_reasons"
REASON_TYPE = "array<struct<column:string,value:string,wanted:string>>"
# What a line that is no record should have been.
A_RECORD = "record"

Columns = list[tuple[str, T.DataType]]


def _recast(frame: DataFrame, new_types: dict[str, T.DataType], on_misfit: str) -> DataFrame:
    if on_misfit not in ("fail", "null"):
        raise ValueError("on_misfit is 'fail' or 'null'")
    selected = []
    for field in frame.schema.fields:
        value, to = column(field.name), new_types.get(field.name, field.dataType)
        if to == field.dataType:
            selected.append(value)
        elif on_misfit == "null" or never_fails(field.dataType, to):
            selected.append(value.try_cast(to).alias(field.name))
        else:
            selected.append(cast_or_fail(value, to, field.name).alias(field.name))
    return frame.select(*selected)


def unsigned_longs_to_long(frame: DataFrame, on_misfit: str = "fail") -> DataFrame:
    """Every ``decimal(20,0)`` column becomes a bigint; values beyond 64 bits fail, or become NULL."""
    found = {f.name: T.LongType() for f in frame.schema.fields if f.dataType == UNSIGNED_LONG}
    return _recast(frame, found, on_misfit)


def decimals_to_double(frame: DataFrame) -> DataFrame:
    """Every decimal column becomes a double."""
    found = {f.name: T.DoubleType() for f in frame.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return _recast(frame, found, "fail")


def clamp_decimals(
    frame: DataFrame, max_precision: int = types.MAX_PRECISION, on_misfit: str = "fail"
) -> DataFrame:
    """Every decimal column fits the target's largest precision."""
    found = {
        f.name: types.clamp_decimal(f.dataType, max_precision)
        for f in frame.schema.fields
        if isinstance(f.dataType, T.DecimalType)
    }
    return _recast(frame, found, on_misfit)


def cast_by_names(frame: DataFrame, type_names: dict[str, str], on_misfit: str = "fail") -> DataFrame:
    """Cast the given columns to the Spark types their source type names stand for."""
    return _recast(frame, {name: types.spark_type(t) for name, t in type_names.items()}, on_misfit)


def target_schema(
    frame: DataFrame, string_width: int = types.STRING_WIDTH, other_width: int = types.WIDE_WIDTH
) -> Columns:
    """Target columns for a frame."""
    return [
        (f.name, types.declared_text(f) or types.target_type(f.dataType, string_width, other_width))
        for f in frame.schema.fields
    ]


def unmapped_columns(frame: DataFrame) -> list[str]:
    """Columns without a target type of their own; they are stored as text."""
    return [f.name for f in frame.schema.fields if not types.is_mapped(f.dataType)]


def _misfit(field: T.StructField, to: T.DataType, cast: Column | None = None) -> Column | None:
    """Whether a value has no counterpart in ``to``, which ``cast`` tells if it is known; None if that cannot happen."""
    value = column(field.name)
    if _is_too_wide(field, to):
        return F.coalesce(F.octet_length(as_text(value, field.dataType)) > to.length, F.lit(False))
    if never_fails(field.dataType, to):
        return None
    return value.isNotNull() & (conformed(value, field.dataType, to) if cast is None else cast).isNull()


def _is_too_wide(field: T.StructField, to: T.DataType) -> bool:
    """Whether the width of a value, not its cast, decides if it fits."""
    return isinstance(field.dataType, NESTED) and isinstance(to, SIZED_TEXT)


Matched = list[tuple[str, T.DataType, T.StructField | None]]


def _matched(frame: DataFrame, columns: Columns, broken: str | None = None) -> Matched:
    """Target columns with the frame's field of the same name, whatever the case; ``broken`` is none of them."""
    fields = {field.name.lower(): field for field in frame.schema.fields if field.name != broken}
    names = {name.lower() for name, _ in columns}
    extra = fields.keys() - names
    if extra:
        raise ValueError(f"columns missing in the target: {', '.join(sorted(extra))}")
    reserved = names & {REJECTED, CUT, RECORD, REASONS}
    if reserved:
        raise ValueError(f"columns with reserved names: {', '.join(sorted(reserved))}")
    return [(name, to, fields.get(name.lower())) for name, to in columns]


Casts = dict[str, Column]


def _misfits(matched: Matched, casts: Casts) -> list[tuple[str, Column, Column, str]]:
    """(column, whether a value has no counterpart, the value as text, the type wanted) where that can happen."""
    found = [(name, _misfit(field, to, casts.get(name)), field, to) for name, to, field in matched if field is not None]
    return [
        (name, misfit, as_text(column(field.name), field.dataType), to.simpleString())
        for name, misfit, field, to in found
        if misfit is not None
    ]


def _rejected(matched: Matched, broken: str | None = None, casts: Casts | None = None) -> Column | None:
    misfits = [misfit for _, misfit, _, _ in _misfits(matched, casts or {})]
    misfits += [column(broken).isNotNull()] if broken else []
    return reduce(or_, misfits) if misfits else None


def _reasons(matched: Matched, broken: str | None, casts: Casts) -> Column:
    """Why a row is rejected: each column with a misfit, its value and the type it should have.

    Arrays of one reason are joined: a filter over all of them would leave the generated code.
    """

    def reason(misfit: Column, name: str, value: Column, wanted: str) -> Column:
        one = F.array(F.struct(F.lit(name).alias("column"), value.alias("value"), F.lit(wanted).alias("wanted")))
        return F.when(misfit, one).otherwise(F.expr("array()").cast(REASON_TYPE))

    found = [reason(misfit, name, value, wanted) for name, misfit, value, wanted in _misfits(matched, casts)]
    if broken:
        found.append(reason(column(broken).isNotNull(), broken, F.lit(None).cast("string"), A_RECORD))
    return F.concat(*found)


def fallible_columns(frame: DataFrame, columns: Columns, broken: str | None = None) -> list[str]:
    """The columns whose values can be a reason to reject a row."""
    return [name for name, *_ in _misfits(_matched(frame, columns, broken), {})] + ([broken] if broken else [])


def _with_casts(frame: DataFrame, matched: Matched) -> tuple[DataFrame, Casts]:
    """The frame with the casts that can fail as columns, each done once for the value, the flag and the reason."""
    prefix = "_as"
    while any(name.startswith(prefix) for name in frame.columns):
        prefix += "_"
    selected, casts = [], {}
    for i, (name, to, field) in enumerate(matched):
        if field is not None and not _is_too_wide(field, to) and not never_fails(field.dataType, to):
            casts[name] = F.col(f"{prefix}{i}")
            selected.append(conformed(column(field.name), field.dataType, to).alias(f"{prefix}{i}"))
    return (frame.select(*[column(name) for name in frame.columns], *selected) if selected else frame), casts


def _cut(matched: Matched) -> Column | None:
    """How many values of a row lose text to a column's width; None if there is no such column."""
    cut = [
        F.coalesce((F.octet_length(as_text(column(field.name), field.dataType)) > to.length).cast("int"), F.lit(0))
        for _, to, field in matched
        if field is not None and isinstance(to, SIZED_TEXT) and isinstance(field.dataType, (T.StringType, T.BinaryType))
    ]
    return reduce(add, cut) if cut else None


def align(
    frame: DataFrame,
    columns: Columns,
    count_cut: bool = False,
    keep_rejects: bool = False,
    reasons: bool = False,
    broken: str | None = None,
) -> DataFrame:
    """The target's columns in the target's order and types.

    A reject flag is added where casts can fail, and if asked for the number of cut values where text can be,
    the reasons of a reject, and the rejected rows as they came, as JSON. A target
    column the frame lacks becomes NULL; a frame column the target lacks is an error. A row is rejected if
    one of its values has no counterpart in the column's type; text is not rejected but cut, except for the
    JSON of a nested value, which would be broken. A row is also rejected where the column ``broken``, which is
    not part of the target, has a line that is no record; that line is then kept as it came.
    """
    matched, own = _matched(frame, columns, broken), frame.columns
    frame, casts = _with_casts(frame, matched)
    selected = [
        F.lit(None).cast(T.StringType() if isinstance(to, SIZED_TEXT) else to).alias(name)
        if field is None
        else casts.get(name, conformed(column(field.name), field.dataType, to)).alias(name)
        for name, to, field in matched
    ]
    rejected = _rejected(matched, broken, casts)
    if rejected is not None:
        selected.append(rejected.alias(REJECTED))
        if reasons:
            selected.append(F.when(rejected, _reasons(matched, broken, casts)).alias(REASONS))
        if keep_rejects:
            whole = F.to_json(F.struct(*(column(n) for n in own if n != broken)), {"ignoreNullFields": "false"})
            whole = F.coalesce(column(broken), whole) if broken else whole
            selected.append(F.when(rejected, whole).alias(RECORD))
    cut = _cut(matched) if count_cut else None
    if cut is not None:
        selected.append(cut.alias(CUT))
    return frame.select(*selected)


def to_target(frame: DataFrame, columns: Columns | None = None) -> DataFrame:
    """``frame`` in target types; a value that does not fit becomes NULL."""
    return align(frame, columns or target_schema(frame)).drop(REJECTED)


def split_rejects(frame: DataFrame, columns: Columns) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, in target types; rows that do not, as they came)."""
    rejected = _rejected(_matched(frame, columns))
    if rejected is None:
        return to_target(frame, columns), frame.where(F.lit(False))
    return to_target(frame.where(~rejected), columns), frame.where(rejected)

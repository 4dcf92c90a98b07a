"""Delimited specification strings as tables: one text column in, typed rows out.

Everything is native higher-order functions on the text column, so a table with any number of such
strings is one narrow pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import column, literal_pattern, strip

# Fields that are typed by their name.
TYPE_OF_FIELD = {"columns": "list", "start_id": "int", "end_id": "int"}
# Fixed value: what a table name may consist of.
IDENTIFIER = "^[a-zA-Z0-9_]+$"
# How a table is read when no split is configured for it.
DEFAULT_FIELD = "id"
DEFAULT_PARTS = "1"

# What the errors of the format say.
NOT_OF_TYPE = "Failed to convert value '{value}' to type int for key '{key}'"
LENGTHS_DIFFER = "Length of types must match length of keys"

_INTEGER = r"^[+-]?\d+(_\d+)*$"


def _stripped_items(text: Column | str, delimiter: str) -> Column:
    return F.transform(F.split(text, literal_pattern(delimiter)), strip)


def spec_values(
    frame: DataFrame, text: str, entry_delimiter: str = ";", value_delimiter: str = ":"
) -> DataFrame:
    """One row per non-blank entry of ``text``: its position and its values, blank ones as NULL.

    The other columns of ``frame`` are repeated; blank text yields no row.
    """
    entries = F.array_remove(_stripped_items(column(text), entry_delimiter), "")
    others = [column(name) for name in frame.columns if name != text]
    values = F.transform(_stripped_items("entry", value_delimiter), lambda value: F.nullif(value, F.lit("")))
    return frame.select(*others, F.posexplode(entries).alias("pos", "entry")).select(
        *others, "pos", values.alias("values")
    )


def _as_integer(text: Column) -> Column:
    """bigint of an integer numeral, NULL for anything else."""
    return F.when(text.rlike(_INTEGER), F.regexp_replace(text, "_", "").try_cast("bigint"))


def _typed(value: Column, kind: str, key: str) -> Column:
    if kind == "str":
        return value
    if kind == "list":
        return F.array_remove(_stripped_items(value, ","), "")
    if kind == "int":
        number = _as_integer(value)
        before, after = NOT_OF_TYPE.split("{value}")
        message = F.concat(F.lit(before), value, F.lit(after.replace("{key}", key)))
        return F.when(value.isNotNull() & number.isNull(), F.raise_error(message).cast("bigint")).otherwise(number)
    raise ValueError(f"unknown type {kind!r}: use str, int or list")


def keyed_specs(
    frame: DataFrame, text: str, keys: list[str], types: list[str] | None = None
) -> DataFrame:
    """Entries with their values named by position and typed ``str``, ``int`` or ``list``.

    Missing values are NULL, surplus ones dropped. A value that is not of its type stops the query.
    """
    if types and len(types) != len(keys):
        raise ValueError(LENGTHS_DIFFER)
    rows = spec_values(frame, text)
    others = [column(name) for name in frame.columns if name != text]
    fields = [
        _typed(F.get("values", F.lit(i)), kind, key).alias(key)
        for i, (key, kind) in enumerate(zip(keys, types or ["str"] * len(keys)))
    ]
    return rows.select(*others, "pos", *fields)


def named_specs(frame: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """As ``keyed_specs``, with the types taken from the field names."""
    return keyed_specs(frame, text, keys, [TYPE_OF_FIELD.get(key, "str") for key in keys])


def bookmark_entries(frame: DataFrame, text: str) -> DataFrame:
    """One row per entry of a ``name:bookmark,name`` list, flagged valid or not.

    A name without bookmark starts at 0, and ``given`` tells it from an explicit 0. Invalid are names that are no identifiers, bookmarks that are
    no integers, and entries with more than one colon; their bookmark is NULL.
    """
    others = [column(name) for name in frame.columns if name != text]
    # One select per step, so that no step's work is repeated where its result is used twice.
    rows = frame.select(*others, F.posexplode(F.split(column(text), ",")).alias("pos", "entry"))
    kept = [*others, "pos", "entry"]
    rows = rows.select(*kept, F.split("entry", ":").alias("_fields"))
    rows = rows.select(
        *kept,
        F.size("_fields").alias("_count"),
        strip(F.get("_fields", F.lit(0))).alias("name"),
        strip(F.get("_fields", F.lit(1))).alias("_bookmark"),
    )
    bookmark = F.when(F.col("_count") == 1, F.lit(0).cast("bigint")).otherwise(_as_integer(F.col("_bookmark")))
    rows = rows.select(
        *kept,
        "name",
        F.when((F.col("_count") <= 2) & F.col("name").rlike(IDENTIFIER), bookmark).alias("bookmark"),
    )
    return rows.withColumns({"valid": F.col("bookmark").isNotNull(), "given": F.size(F.split("entry", ":")) > 1})


def last_bookmarks(
    entries: DataFrame, order: Sequence[str] = ("pos",), within: Sequence[str] = (), also: Sequence[str] = ()
) -> DataFrame:
    """One row per valid name: its last bookmark (and columns ``also``) in ``order``, at the place of its first mention.

    Repeated names are reduced before the shuffle, so a name may be repeated without limit.
    """
    place = _place(order)
    return (
        entries.where(column("valid"))
        .groupBy(*[column(name) for name in within], "name")
        .agg(F.max_by(F.struct("bookmark", *also), place).alias("last"), F.min(place).alias("place"))
        .select(
            *[column(name) for name in within],
            *([F.col("place").alias(order[0])] if len(order) == 1 else ["place.*"]),
            "name",
            "last.bookmark",
            *(f"last.{name}" for name in also),
        )
    )


def _place(order: Sequence[str]) -> Column:
    """What rows are ordered by: a plain column if one is enough, which aggregates by hash, not by sort."""
    return column(order[0]) if len(order) == 1 else F.struct(*[column(name) for name in order])


def with_partition_config(
    specs: DataFrame, configs: DataFrame, name: str = "name", order: Sequence[str] = ("pos",)
) -> DataFrame:
    """Each spec row with the first matching partition config, or the defaults.

    ``configs`` has table_name, hashfield and hashpartitions. They are reduced to one row per table
    before the join, so the join never multiplies rows; Spark picks the join by the sides' sizes.
    """
    first = (
        configs.where(column("table_name").isNotNull())
        .groupBy(column("table_name").alias("_table"))
        .agg(F.min_by(F.struct("hashfield", "hashpartitions"), _place(order)).alias("_config"))
        .select(
            "_table",
            F.nullif("_config.hashfield", F.lit("")).alias("_field"),
            F.nullif("_config.hashpartitions", F.lit("")).alias("_parts"),
        )
        .withColumn("_split", _typed(F.col("_parts"), "int", "hashpartitions") > 1)
    )
    return specs.join(first, column(name) == column("_table"), "left").select(
        *[column(field) for field in specs.columns],
        F.coalesce("_field", F.lit(DEFAULT_FIELD)).alias("hashfield"),
        F.coalesce("_parts", F.lit(DEFAULT_PARTS)).alias("hashpartitions"),
        F.coalesce("_split", F.lit(int(DEFAULT_PARTS) > 1)).alias("should_partition"),
    )

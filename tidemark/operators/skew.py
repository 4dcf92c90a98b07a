"""Joins and layouts on keys of which a few have very many rows.

A hot key's rows get one of several salts, and the rows of the other side come once for each salt: so a join by key
and salt has the same rows as one by key, and no task has all rows of a key.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import column

#: The column that tells the pieces of a hot key apart; 0 for all other rows.
SALT = "_salt"
#: Keys that a sketch reports, and that it tracks: more than the first cannot have a thousandth of all rows each.
TOP, TRACKED = 1000, 16_384
#: Pieces of a hot key for each part that its rows would fill; hashing deals that many evenly enough.
PIECES = 16


def can_hash(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(can_hash(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return can_hash(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def frequent(key: Column) -> Column:
    """The most frequent keys, as text, and about how many rows each has: an aggregate, as JSON."""
    found = F.call_function("approx_top_k", key, F.lit(TOP), F.lit(TRACKED))
    rows = F.transform(found, lambda row: F.struct(row["item"].cast("string").alias("key"), row["count"].alias("n")))
    return F.to_json(rows)


def pieces_of(found: str | None, rows: int, parts: int) -> tuple[tuple[str, int], ...]:
    """The keys that fill over half of one of ``parts`` equal parts, and into how many pieces each is cut."""
    hot = []
    for row in json.loads(found or "[]"):
        if row.get("key") is not None and row["n"] * parts * 2 > rows and parts > 1:
            hot.append((row["key"], max(2, math.ceil(PIECES * row["n"] * parts / rows))))
    return tuple(sorted(hot))


def hot_keys(frame: DataFrame, key: str, parts: int) -> tuple[tuple[str, int], ...]:
    """The hot keys of a column and the pieces of each, from one pass over the column."""
    value = column(key)
    row = frame.agg(frequent(value).alias("found"), F.count(value).alias("n")).first()
    return pieces_of(row["found"], row["n"], parts)


def _pieces(key: Column, hot: dict[str, int]) -> Column:
    """How many pieces a key has; NULL for one that is not hot."""
    if not hot:
        return F.lit(None).cast("int")
    known = F.map_from_arrays(F.lit(list(hot)), F.lit(list(hot.values())))
    return F.try_element_at(known, key.cast("string"))


def with_salt(frame: DataFrame, key: str, hot: dict[str, int], null_pieces: int = 1) -> DataFrame:
    """``frame`` with the salt of each row: which piece of its key it belongs to, by a hash of the row.

    Rows without a key, which no join finds, are dealt to ``null_pieces``.
    """
    hashed = [column(f.name) for f in frame.schema.fields if can_hash(f.dataType)]
    pieces = F.when(column(key).isNull(), F.lit(null_pieces)).otherwise(F.coalesce(_pieces(column(key), hot), F.lit(1)))
    # another seed than the shuffle's hash, so that pieces do not follow it
    return frame.withColumn(SALT, F.pmod(F.xxhash64(F.lit("salt"), *hashed), pieces).cast("int"))


def for_each_salt(frame: DataFrame, key: str, hot: dict[str, int]) -> DataFrame:
    """``frame`` with every row of a hot key once for each of its salts."""
    last = F.coalesce(_pieces(column(key), hot), F.lit(1)) - 1
    return frame.withColumn(SALT, F.explode(F.sequence(F.lit(0), last)))


def join_salted(salted: DataFrame, other: DataFrame, key: str, hot: dict[str, int], how: str = "inner") -> DataFrame:
    """The join by key of a frame that has salts and one that has none; the result has no salt.

    Rows of ``other`` are repeated, so what it has and ``salted`` lacks cannot be part of the result.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("how is inner, left, left_semi or left_anti")
    return salted.join(for_each_salt(other, key, hot), [key, SALT], how).drop(SALT)


def skewed_join(left: DataFrame, right: DataFrame, key: str, parts: int | None = None, how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` by ``key``, with the left's hot keys dealt to several of ``parts`` tasks."""
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = dict(hot_keys(left, key, parts))
    return join_salted(with_salt(left, key, hot), right, key, hot, how)

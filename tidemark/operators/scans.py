"""Projections and key bounds. All are plain selects and filters, so they reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import column

_DELETED_TO_KEPT = {">": "<=", ">=": "<"}


def project(frame: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The listed columns in the listed order; nothing listed, or ``*`` among them, means all."""
    if not columns or "*" in columns:
        return frame
    return frame.select(*[column(name) for name in columns])


def select_fields(frame: DataFrame, names: list[str], strict: bool = False) -> DataFrame:
    """The named fields in the given order. Unknown names are left out, or refused when ``strict``."""
    unknown = [name for name in names if name not in frame.columns]
    if unknown and strict:
        raise ValueError(f"unknown fields: {', '.join(unknown)}")
    return frame.select(*[column(name) for name in names if name in frame.columns])


def include_columns(frame: DataFrame, included: list[str] | None = None) -> DataFrame:
    """The included columns in the frame's own order, matched by exact name; ``*`` means all."""
    if not included or "*" in included:
        return frame
    return frame.select(*[column(name) for name in frame.columns if name in included])


def from_key(frame: DataFrame, key: str, start: int | None) -> DataFrame:
    """Rows with ``key >= start``. No start, or one that is not positive, means no bound."""
    if not start or start <= 0:
        return frame
    return frame.where(column(key) >= F.lit(start))


def after_key(frame: DataFrame, key: str, bookmark: int) -> DataFrame:
    """Rows with ``key > bookmark``; rows without a key are left out."""
    return frame.where(column(key) > F.lit(bookmark))


def survives(key: str, start: int, delete_op: str = ">") -> Column:
    """What a tail delete leaves: rows at or below the bound, and rows without a key.

    Spelled as a disjunction of plain comparisons, which file formats use to skip data.
    """
    kept = column(key) <= F.lit(start) if kept_op(delete_op) == "<=" else column(key) < F.lit(start)
    return kept | column(key).isNull()


def replaced_tail(
    old: DataFrame, new: DataFrame, key: str, start: int, delete_op: str = ">"
) -> DataFrame:
    """``old`` without its tail, and all of ``new``. Nothing is de-duplicated and nothing shuffled."""
    return old.where(survives(key, start, delete_op)).unionByName(new)


def kept_op(delete_op: str) -> str:
    if delete_op not in _DELETED_TO_KEPT:
        raise ValueError(f"a tail delete uses > or >=, not {delete_op!r}")
    return _DELETED_TO_KEPT[delete_op]


def scan(frame: DataFrame, columns: list[str] | None, key: str, start: int | None) -> DataFrame:
    """The listed columns of the rows at and above ``start``; the key need not be listed."""
    return project(from_key(frame, key, start), columns)

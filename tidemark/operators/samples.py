"""Samples that are the same on every run, and that can be merged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import column

_HASH, _RANK = "_sample_hash", "_sample_rank"


def digest(frame: DataFrame, keys: Sequence[str], seed: str = "") -> Column:
    """The hash that a sample is drawn by: md5 of the seed and the keys as text, whatever the engine."""
    parts = [F.coalesce(column(key).cast(T.StringType()), F.lit("")) for key in keys]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def stable_sample(frame: DataFrame, n: int, keys: Sequence[str], by: Sequence[str] = (), seed: str = "") -> DataFrame:
    """The ``n`` rows with the least hashes of ``keys``, or as many of each group ``by``.

    The same rows on every run and in every order of the input. Each task keeps ``n`` rows of what it reads (of
    a group), so that hardly more is shuffled, however large the input or a group is. The sample of two
    samples is that of their union: new rows are sampled alone and merged. Rows with equal keys are ordered by all columns
    that can be.
    """
    hashed = frame.withColumn(_HASH, digest(frame, keys, seed))
    ties = [column(f.name) for f in frame.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [F.col(_HASH), *ties]
    if not by:
        return hashed.orderBy(*order).limit(n).drop(_HASH)
    window = Window.partitionBy(*[column(name) for name in by]).orderBy(*order)
    ranked = hashed.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) <= n).drop(_HASH, _RANK)

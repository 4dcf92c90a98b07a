"""What a load learns about its rows in the pass that writes them: ranges, distinct values, depths of the key."""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Steps of the key's depth, and the size of the sketch that finds them (a rank error of about 0.4 %).
STEPS, KLL_SIZE = 50, 800
#: Bits of the sketch of distinct values (a standard error of 1.6 %, some 4 KB).
HLL_BITS = 12


def depths_of(key: Column) -> Column:
    """Whole keys at equal steps of depth, from the lowest to the highest: an aggregate."""
    shares = F.array(*(F.lit(i / STEPS) for i in range(STEPS + 1)))
    found = F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint(key, F.lit(KLL_SIZE)), shares)
    return F.when(F.count(key) > 0, found)


def share_kept(depths: tuple[int, ...], op: str, bound: int) -> float:
    """The share of keys at or below (``<=``), or below (``<``), a bound."""
    steps = len(depths) - 1
    i = (bisect_right if op == "<=" else bisect_left)(depths, bound)
    if i == 0:
        return 0.0
    if i > steps:
        return 1.0
    low, high = depths[i - 1], depths[i]
    return min((i - 1 + (bound - low) / max(high - low, 1)) / steps, 1.0)


def distinct_of(value: Column, kind: T.DataType) -> Column:
    """A sketch of the distinct values of a column: an aggregate, in Base64."""
    if isinstance(kind, T.IntegralType):
        counted = value.cast("bigint")
    elif isinstance(kind, (T.StringType, T.VarcharType, T.CharType, T.BinaryType)):
        counted = value
    else:  # a hash tells values apart as well as their text, and costs less
        counted = F.when(value.isNotNull(), F.xxhash64(value))
    return F.base64(F.hll_sketch_agg(counted, F.lit(HLL_BITS)))


def column_of(value: Column, kind: T.DataType) -> Column:
    """Count, range and distinct values of a column: an aggregate, as JSON."""
    return F.to_json(
        F.struct(
            F.count(value).alias("n"),
            F.min(value).cast("string").alias("low"),
            F.max(value).cast("string").alias("high"),
            distinct_of(value, kind).alias("distinct"),
        )
    )


def as_column(n: int, low: int | None, high: int | None, distinct: str) -> str:
    """What ``column_of`` gives, for a key whose count and range are known."""
    return json.dumps({"n": n, "low": None if low is None else str(low), "high": None if high is None else str(high), "distinct": distinct})


def can_sketch(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.StringType, T.VarcharType, T.CharType, T.DateType, T.TimestampType, T.TimestampNTZType))


def in_order(kind: T.DataType):
    """What the text of values is ordered by."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float
    return Decimal if isinstance(kind, T.NumericType) else str


def merged(spark: SparkSession, parts: Iterable[tuple[int, dict]], kinds: dict[str, T.DataType], exact: bool) -> DataFrame:
    """One row for each column: n_rows, n_nulls, low, high, n_distinct, exact.

    ``parts`` are the live rows and the observed columns (name to what ``column_of`` found) of each segment. Only
    their sketches are joined by Spark; nothing is read again. A column that some segment does not know has no row.
    """
    parts = [(rows, known) for rows, known in parts if rows]
    rows = []
    for name, kind in kinds.items():
        if not parts or any(name not in known for _, known in parts):
            continue
        found = [(live, known[name]) for live, known in parts]
        order = in_order(kind)
        lows = [f["low"] for _, f in found if f.get("low") is not None]
        highs = [f["high"] for _, f in found if f.get("high") is not None]
        low, high = min(lows, key=order, default=None), max(highs, key=order, default=None)
        live, nulls = sum(n for n, _ in found), sum(f["nulls"] for _, f in found)
        rows += [(name, live, nulls, low, high, f["distinct"]) for _, f in found]
    kinds_sql = "column string, n_rows bigint, n_nulls bigint, low string, high string, sketch string"
    sketches = spark.createDataFrame(rows, kinds_sql).withColumn("sketch", F.unbase64("sketch"))
    one = [F.first(c).alias(c) for c in ("n_rows", "n_nulls", "low", "high")]
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy("column").agg(*one, union.alias("n_distinct")).withColumns(
        {"n_distinct": F.least("n_distinct", F.col("n_rows") - F.col("n_nulls")), "exact": F.lit(exact)}
    )


def parsed(text: str, rows: int) -> dict:
    """An observed column, with its number of NULLs among ``rows`` rows."""
    found = json.loads(text)
    return {"low": found.get("low"), "high": found.get("high"), "distinct": found["distinct"], "nulls": rows - found["n"]}

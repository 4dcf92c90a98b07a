"""JSON files as a source, and bounded looks at any frame."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BROKEN = "_corrupt_record"


def read_json(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType | str | None = None,
    recursive: bool = True,
    sampling_ratio: float | None = None,
) -> DataFrame:
    """JSON records below ``paths``; a line that is no record stops the query.

    Without a schema Spark reads all input once more to infer it; give one, or a sampling ratio, on
    large input. ``read_json_or_reject`` goes on after broken lines.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", str(sampling_ratio))
    return reader.json(paths)


def read_json_or_reject(
    spark: SparkSession, paths: str | list[str], schema: StructType, recursive: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(records of the schema, lines that are no such record as ``record``), both from one kind of scan.

    A line that does not parse, or has a value of another type, is a reject, not a row of NULLs.
    """
    whole = StructType([*schema.fields]).add(BROKEN, "string")
    lines = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(paths).where("trim(value) <> ''")
    parsed = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    records = lines.select("value", parsed.alias("parsed"))
    fits = F.col("parsed").isNotNull() & F.col(f"parsed.{BROKEN}").isNull()
    good = records.where(fits).select("parsed.*").drop(BROKEN)
    return good, records.where(~fits).select(F.col("value").alias("record"))


def schema_report(frame: DataFrame) -> DataFrame:
    """(position, column, type) of a frame's columns."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(frame.schema.fields)]
    return frame.sparkSession.createDataFrame(rows, "position int, column string, type string")


def preview(frame: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows."""
    return frame.limit(n)


def preview_pandas(frame: DataFrame, n: int = 5) -> pd.DataFrame:
    """Any ``n`` rows on the driver; the bound holds whatever the size of ``frame``."""
    return preview(frame, n).toPandas()

"""Which files of a folder are new: a listing against the manifest of what was loaded."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import BROKEN


#: A file, with its time of modification in microseconds.
FILES = "path string, length bigint, modified bigint"


class ChangedFiles(RuntimeError):
    """Files that were loaded, or are being read, are not what they were; ``paths`` has them."""

    def __init__(self, paths: list[str], shown: int = 10):
        more = f" and {len(paths) - shown} more" if len(paths) > shown else ""
        super().__init__(f"files changed after they were loaded: {', '.join(paths[:shown])}{more}")
        self.paths = paths


def listing(spark: SparkSession, paths: str | list[str], recursive: bool = True, pattern: str | None = None) -> DataFrame:
    """Path, length and time of modification of the files below ``paths``; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(paths).select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def new_files(listed: DataFrame, known: DataFrame, most: int) -> list[tuple]:
    """The first ``most`` files that are not known, oldest first, as (path, length, modified).

    A file whose length or time is not the one in the manifest is an error that names it. Files that are known but
    no longer listed are no change: what was loaded stays.
    """
    before = known.select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    changed = (F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified"))
    found = listed.join(before, "path", "left").select("path", "length", "modified", F.coalesce(changed, F.lit(False)).alias("changed"), "_length")
    # the changed ones first, so that one job tells both
    rows = found.where("changed OR _length IS NULL").orderBy(F.desc("changed"), "modified", "path").limit(most).collect()
    if rows and rows[0].changed:
        raise ChangedFiles(sorted(row.path for row in rows if row.changed))
    return [(row.path, row.length, row.modified) for row in rows]


def check_unchanged(listed: DataFrame, files: list[tuple]) -> None:
    """An error if files are listed with another length or time than when they were chosen."""
    read = listed.sparkSession.createDataFrame(files, FILES)
    new_files(listed.join(read.select("path"), "path", "left_semi"), read, 1)


def read_files(
    spark: SparkSession, paths: list[str], schema: str, file_format: str = "json", options: dict[str, str] | None = None
) -> tuple[DataFrame, str | None]:
    """(rows of the files, the column with lines that are no records, or None).

    For JSON and CSV a line that does not parse, or has a value of another type, is kept whole in that column.
    """
    literal = [re.sub(r"([\\{}\[\]*?])", r"\\\1", path) for path in paths]  # names, not patterns
    reader = spark.read.format(file_format).options(**(options or {}))
    if file_format not in ("json", "csv"):
        return reader.schema(schema).load(literal), None
    reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN)
    return reader.schema(f"{schema}, {BROKEN} string").load(literal), BROKEN

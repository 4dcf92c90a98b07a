"""Loading only the files that are new since the last run."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def load_new_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    table: str,
    checkpoint: str,
    file_format: str = "json",
    files_per_batch: int | None = None,
) -> None:
    """Append the records of files not seen before to ``table``; a line that is no record stops the run.

    The checkpoint folder remembers the files, and the table's own commit log makes each batch count
    once, so a run that is lost half-way is repeated without duplicates. ``files_per_batch`` bounds the
    size of one commit when very many files wait. ``jobs.load_files`` publishes through a target, and goes on
    after broken lines.
    """
    reader = spark.readStream.format(file_format).schema(schema).option("recursiveFileLookup", "true").option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    query = (
        reader.load(path)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
    query.awaitTermination()

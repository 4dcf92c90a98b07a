"""Tables of the session catalog as a source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import types
from tidemark.functions.text import quoted
from tidemark.operators.partitions import Parts


def table_columns(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """Column names and declared types in catalog order (declared, so text widths are kept)."""
    columns = []
    for row in spark.sql(f"DESCRIBE TABLE {table}").collect():
        if not row.col_name or row.col_name.startswith("#"):
            break
        columns.append((row.col_name, row.data_type))
    return columns


def target_columns(
    spark: SparkSession,
    table: str,
    included: list[str] | None = None,
    string_width: int = types.STRING_WIDTH,
    other_width: int = types.WIDE_WIDTH,
) -> list[tuple[str, str]]:
    """Catalog columns with their target types; ``included`` filters by exact name, ``*`` means all."""
    everything = not included or "*" in included
    return [
        (name, types.target_type(declared, string_width, other_width).simpleString())
        for name, declared in table_columns(spark, table)
        if everything or name in included
    ]


@dataclass(frozen=True)
class CatalogSource:
    """Tables ``prefix + name`` of one catalog database."""

    spark: SparkSession
    database: str
    prefix: str = ""

    def identifier(self, name: str) -> str:
        return f"{quoted(self.database)}.{quoted(self.prefix + name)}"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.identifier(name))

    def read(
        self, name: str, parts: Parts | None = None, key: str | None = None, start: int | None = None
    ) -> DataFrame:
        """The whole table. Spark splits file scans itself, so only the name matters here."""
        return self.spark.table(self.identifier(name))

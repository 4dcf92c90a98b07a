"""What runs of jobs have done, kept as each table ends, so that it outlives the driver."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import quoted, sql_string

_ROW = (
    "run string, at timestamp, table_name string, status string, n_rows bigint, n_rejects bigint, high_key bigint, "
    "as_text array<string>, error string, n_cut bigint"
)
_REPORTED = ["table_name", "status", "n_rows", "n_rejects", "high_key", "as_text", "error", "n_cut"]
_OWNER = "tidemark.ledger"
# Rows are added one after the other: jobs that append to one table at a time would share its staging folder.
_ADDING = threading.Lock()


class Ledger:
    """An appended table of report rows with the run they belong to. It is only ever added to."""

    def __init__(self, spark: SparkSession, database: str, table: str = "tidemark_runs"):
        self.spark = spark
        self.name = f"{quoted(database)}.{quoted(table)}"
        if not spark.catalog.tableExists(self.name):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({_ROW}) USING parquet TBLPROPERTIES ({sql_string(_OWNER)} = 'true')")
        properties = {row.key for row in spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        if _OWNER not in properties:
            raise ValueError(f"{self.name} is not a ledger")

    def add(self, run: str, row: tuple) -> None:
        """Add the report row of a table that has ended."""
        kinds = _ROW.replace("at timestamp, ", "")
        frame = self.spark.createDataFrame([(run, *row)], kinds)
        columns = ["run", F.current_timestamp().alias("at"), *_REPORTED]
        with _ADDING:
            frame.select(*columns).coalesce(1).write.insertInto(self.name)

    def rows(self, run: str | None = None) -> DataFrame:
        """All rows, or those of a run."""
        rows = self.spark.table(self.name)
        return rows if run is None else rows.where(F.col("run") == run)

    def last(self, run: str) -> DataFrame:
        """The last row of each table in a run."""
        row = F.struct("run", "at", *_REPORTED)
        return self.rows(run).groupBy(F.lower("table_name").alias("_name")).agg(F.max_by(row, "at").alias("row")).select("row.*")

    def ended_well(self, run: str) -> dict[str, tuple]:
        """The report rows of the tables that have ended well in a run, by lower-case name."""
        ok = self.rows(run).where("status = 'ok'").groupBy(F.lower("table_name").alias("name"))
        rows = ok.agg(F.max_by(F.struct(*_REPORTED), "at").alias("row")).collect()
        return {found["name"]: tuple(found["row"]) for found in rows}

"""Database tables over JDBC as a source."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.partitions import Parts, part_predicates

# Fixed value: databases that quote names with back-quotes, by the beginning of their URL; others use double quotes.
BACK_QUOTED = ("jdbc:mysql:", "jdbc:mariadb:", "jdbc:databricks:", "jdbc:hive2:")


@dataclass(frozen=True)
class JdbcSource:
    """Tables of one JDBC connection.

    ``hash_expression`` is the database's own integer hash with ``{field}`` in it, needed when a split
    field is not an integer, for example ``CRC32({field})``. ``ranges`` is the number of queries that read
    a table with a whole-number key for which no parts are given. ``probe`` is a query that needs no table.
    """

    spark: SparkSession
    url: str
    properties: dict[str, str] = field(default_factory=dict)
    hash_expression: str = "{field}"
    ranges: int = 8
    probe: str = "SELECT 1 AS found"

    def _quoted(self, name: str) -> str:
        mark = "`" if self.url.startswith(BACK_QUOTED) else '"'
        return mark + name.replace(mark, mark * 2) + mark

    def _reader(self):
        return self.spark.read.format("jdbc").option("url", self.url).options(**self.properties)

    def exists(self, name: str) -> bool:
        """Whether the table can be read. A database that does not answer at all is an error, not a missing table."""
        try:
            self._reader().option("query", f"SELECT 1 AS found FROM {name} WHERE 1 = 0").load()
            return True
        except Exception:
            self._reader().option("query", self.probe).load()
            return False

    def read(
        self, name: str, parts: Parts | None = None, key: str | None = None, start: int | None = None
    ) -> DataFrame:
        """The whole table, lazily: later filters and column lists reach the database.

        With ``parts``, one query per hash part runs in parallel; otherwise, with a ``key``, one per key
        range, spread over the keys from ``start`` on. Together they return every row once.
        """
        if parts is not None and parts.count > 1:
            predicates = part_predicates(self._quoted(parts.field), parts.count, self.hash_expression)
            return self.spark.read.jdbc(self.url, name, predicates=predicates, properties=self.properties)
        reader = self._reader().option("dbtable", name)
        if key is not None and self.ranges > 1:
            low, high = self._key_range(name, key)
            if _whole(low) and _whole(high):
                reader.option("partitionColumn", key).option("numPartitions", str(self.ranges))
                # The bounds only place the cuts; the outer ranges are open and take rows without a key.
                low = max(int(low), start or int(low))
                reader.option("lowerBound", str(low)).option("upperBound", str(max(int(high), low) + 1))
        return reader.load()

    def _key_range(self, name: str, key: str) -> tuple:
        quoted = self._quoted(key)
        query = f"SELECT MIN({quoted}) AS low, MAX({quoted}) AS high FROM {name}"
        row = self._reader().option("query", query).load().first()
        return row[0], row[1]


def _whole(value) -> bool:
    return isinstance(value, (int, Decimal)) and not isinstance(value, bool) and value == int(value)

"""Database scans up to the connection: no database runs here, so only what is sent to one is checked."""

from decimal import Decimal
from unittest.mock import MagicMock

import pytest

from tidemark.operators.partitions import Parts
from tidemark.sources.jdbc import JdbcSource


def test_names_are_quoted_as_the_database_does(spark):
    assert JdbcSource(spark, "jdbc:mysql://host/db")._quoted("k") == "`k`"
    assert JdbcSource(spark, "jdbc:postgresql://host/db")._quoted('k"') == '"k"""'


def test_an_unreachable_database_is_no_missing_table(spark):
    with pytest.raises(Exception, match="no.such.Driver"):
        JdbcSource(spark, "jdbc:none://host/db", {"driver": "no.such.Driver"}).exists("orders")


def test_a_missing_table_does_not_exist():
    spark, asked = session(), []
    options(spark.read)
    spark.read.option.side_effect = lambda key, value: asked.append(value) or spark.read
    spark.read.load.side_effect = lambda: 1 / ("FROM gone" not in asked[-1])
    source = JdbcSource(spark, "jdbc:x")
    assert source.exists("orders") and not source.exists("gone")
    spark.read.load.side_effect = ConnectionError("away")
    with pytest.raises(ConnectionError):
        source.exists("orders")


def session():
    return MagicMock()


def options(reader):
    found = {}
    reader.option.side_effect = lambda key, value: found.update({key: value}) or reader
    reader.options.side_effect = lambda **given: found.update(given) or reader
    reader.format.return_value = reader
    return found


def test_parts_are_one_query_each():
    spark = session()
    JdbcSource(spark, "jdbc:x", {"user": "u"}).read("orders", Parts("o_custkey", 2))
    spark.read.jdbc.assert_called_once_with(
        "jdbc:x",
        "orders",
        predicates=['ABS(MOD("o_custkey", 2)) = 0 OR "o_custkey" IS NULL', 'ABS(MOD("o_custkey", 2)) = 1'],
        properties={"user": "u"},
    )


def test_without_parts_and_key_one_query():
    spark = session()
    found = options(spark.read)
    JdbcSource(spark, "jdbc:x", {"user": "u"}).read("orders", Parts("id", 1))
    assert found == {"url": "jdbc:x", "user": "u", "dbtable": "orders"}
    spark.read.jdbc.assert_not_called()


@pytest.mark.parametrize(
    "keys, start, bounds",
    [
        ((-5, 100), None, ("-5", "101")),
        ((Decimal(1), Decimal(100)), 90, ("90", "101")),
        ((1, 100), 500, ("500", "501")),
        ((None, None), None, None),
        (("a", "b"), None, None),
    ],
)
def test_a_key_is_read_in_ranges(keys, start, bounds):
    spark = session()
    found = options(spark.read)
    spark.read.load.return_value.first.return_value = keys
    JdbcSource(spark, "jdbc:x", ranges=7).read("orders", None, "id", start)
    assert found["query"] == 'SELECT MIN("id") AS low, MAX("id") AS high FROM orders'
    if bounds is None:
        assert "partitionColumn" not in found
    else:
        wanted = {"partitionColumn": "id", "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": "7"}
        assert wanted.items() <= found.items()
